"""Cleaning: which copy survives, and independence from order and partitioning."""

import datetime

import pytest
from pyspark.sql import functions as F

from aeropanel.operators import clean as cleaning
from aeropanel.operators import profile, ranking, stats, trends
from aeropanel.schema import POLLUTANTS
from aeropanel.sources import tables


def test_survivor_does_not_depend_on_partitioning_or_order(raw):
    first = cleaning.dedup_city_day(raw, ["k"])
    other = cleaning.dedup_city_day(raw.repartition(13, "Toluene").orderBy(F.desc("NO2")), ["k"])
    assert first.exceptAll(other).isEmpty() and other.exceptAll(first).isEmpty()


def test_survivor_without_a_tie_break_is_deterministic(raw):
    panel = raw.drop("k")
    first = cleaning.dedup_city_day(panel)
    other = cleaning.dedup_city_day(panel.repartition(7, "CO"))
    assert first.count() == panel.select("City", "Date").distinct().count()
    assert first.exceptAll(other).isEmpty()


def test_copies_go_before_rows_without_target(spark):
    day = datetime.date(2020, 1, 1)
    rows = tables.literal_rows(
        spark, [("A", day, 1, None), ("A", day, 2, 80.0), ("B", day, 2, None), ("B", day, 1, 70.0)],
        "City string, Date date, k int, AQI double").withColumns({p: F.lit(1.0) for p in POLLUTANTS})
    assert [r.City for r in cleaning.clean(rows, ["k"]).collect()] == ["B"]


def test_text_dates_negative_and_nan_readings(spark):
    rows = tables.literal_rows(
        spark, [("A", "2020-12-31", -1.0, 10.0), ("B", "2020-07-01", float("nan"), 1000.0),
                ("C", "2020-03-01", 0.0, 1000.5), ("D", "2020-10-01", 2.0, 0.0), ("E", "2020-10-01", 0.0, 1.0)],
        "City string, Date string, PM25 double, AQI double")
    rows = rows.withColumns({p: F.lit("3") for p in POLLUTANTS if p != "PM25"})
    got = {r.City: r for r in cleaning.clean(rows).collect()}
    assert set(got) == {"A", "B", "E"}
    assert (got["A"].PM25, got["B"].PM25, got["E"].PM25) == (None, None, 0.0)
    assert got["A"].NO2 == 3.0
    assert (got["A"].Season, got["B"].Season, got["E"].Season) == ("Winter", "Monsoon", "Post-Monsoon")
    assert (got["A"].Year, got["A"].Month) == (2020, 12)


def test_funnel_only_falls(raw):
    counts = [r.rows for r in profile.cleaning_funnel(raw, ["k"]).orderBy("step").collect()]
    assert counts == sorted(counts, reverse=True) and len(counts) == 4


def test_zero_mode_equals_stat_corr(clean):
    ours = {r.pollutant: r["corr"] for r in stats.corr_with_target(clean, nulls="zero").collect()}
    for p in ("PM25", "O3", "Xylene"):
        shown = "PM2.5" if p == "PM25" else p
        assert abs(ours[shown] - clean.stat.corr(p, "AQI")) <= 0.0005


def test_matrix_row_equals_correlation_with_target(clean):
    matrix = {r.a: r.r for r in stats.corr_matrix(clean).filter("b = 'AQI' AND a <> 'AQI'").collect()}
    direct = {r.pollutant: r["corr"] for r in stats.corr_with_target(clean).collect()}
    assert matrix == direct


def test_fixed_cities_give_the_same_as_a_join(clean):
    n = clean.select("Year").distinct().count()
    joined = clean.join(trends.full_coverage(clean, n), "City", "left_semi").groupBy("Year") \
        .agg(F.round(F.avg("AQI"), 1).alias("avg_aqi"))
    assert trends.yearly_fixed(clean, n).exceptAll(joined).isEmpty()


def test_a_city_without_one_period_is_left_out(clean):
    base, event = ("1999-03-25", "1999-05-31"), ("2000-03-25", "2000-05-31")
    gone = clean.filter(~((F.col("City") == "NATION_5") & F.col("Date").between(*event)))
    names = {r.City for r in trends.period_comparison(gone, base, event).collect()}
    assert "NATION_5" not in names and len(names) == 24
    assert trends.period_overall(gone, base, event).first().cities == 24


@pytest.mark.parametrize("few", [0, 999, 1000])
def test_ranks_over_equal_values(spark, few):
    df = spark.range(1000).select((F.col("id") % 7).cast("double").alias("v"), F.col("id").cast("string").alias("name"))
    got = ranking.with_rank(df.repartition(5), "v", ["name"], few=few).orderBy("rank").collect()
    want = sorted(((r.v, r.name) for r in df.collect()), key=lambda x: (-x[0], x[1]))
    assert [(r.v, r.name) for r in got] == want
    assert [r.rank for r in got] == list(range(1, 1001))


def test_malformed_text_becomes_null_and_is_counted(spark):
    from aeropanel.operators import profile
    from aeropanel.schema import POLLUTANTS
    others = [c for c in POLLUTANTS if c != "NO2"]
    rows = [("A", "2020-01-05", "1.5", "100"), ("A", "2020-13-45", "NA", "None"), ("A", "soon", "-3", "0x1"), ("A", None, None, None)]
    raw = tables.literal_rows(spark, rows, "City string, Date string, NO2 string, AQI string").selectExpr(
        "*", *(f"CAST(NULL AS DOUBLE) AS {c}" for c in others), "'x' AS AQI_Bucket")
    cleaned = cleaning.clean(raw, ["NO2"]).collect()
    assert [(str(r.Date), r.NO2, r.AQI) for r in cleaned] == [("2020-01-05", 1.5, 100.0)]
    lost = {r["column"]: r.lost for r in profile.lost_values(raw).collect()}
    assert (lost["Date"], lost["NO2"], lost["AQI"], lost["O3"]) == (2, 1, 2, 0)
