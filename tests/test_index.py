"""The index from concentrations: golden rows, properties, and equal forms."""

import math

import pytest
from pyspark.sql import functions as F

from aeropanel.operators import daily_index
from aeropanel.schema import CATEGORIES, CONCENTRATION_EDGES, INDEX_EDGES, INDEX_POLLUTANTS
from aeropanel.sources import tables

# PM25, PM10, NO2, SO2, CO, O3, NH3 -> index, dominant, category; worked out by hand.
GOLDEN = [
    ((180.0, 300.0, 60.0, 15.0, 1.5, 40.0, None), 346.0, "PM2.5", "Very Poor"),
    ((60.0, 100.0, None, None, None, None, None), None, None, None),
    ((None, None, 40.0, 40.0, 1.0, None, None), None, None, None),
    ((30.0, 50.0, 40.0, None, None, None, None), 50.0, "PM2.5", "Good"),
    ((510.0, 50.0, 40.0, None, None, None, None), 600.0, "PM2.5", "Severe"),
    ((29.7, 50.4, 10.0, None, None, None, None), 50.0, "PM2.5", "Good"),
    ((-5.0, 100.0, 40.0, 40.0, None, None, None), 100.0, "PM10", "Satisfactory"),
    ((math.nan, 100.0, 40.0, 40.0, None, None, None), 100.0, "PM10", "Satisfactory"),
]


def rows_of(spark, values):
    return tables.ad_hoc_rows(spark, values, INDEX_POLLUTANTS)


@pytest.mark.parametrize("case", range(len(GOLDEN)))
def test_golden_rows(spark, case):
    values, *expected = GOLDEN[case]
    row = daily_index.index_of(rows_of(spark, [values])).first()
    assert [row.AQI_calc, row.Dominant, row.Bucket_calc] == expected


def test_missing_columns_count_as_not_measured(spark):
    rows = tables.ad_hoc_rows(spark, [(180.0, 300.0, 60.0)], ["PM25", "PM10", "NO2"])
    assert daily_index.index_of(rows).first().AQI_calc == 346.0


@pytest.mark.parametrize("pollutant", INDEX_POLLUTANTS)
def test_sub_index_hits_every_edge_and_never_falls(spark, pollutant):
    edges = CONCENTRATION_EDGES[pollutant]
    steps = spark.range(0, 1201).select((F.col("id") * (edges[-1] * 1.2 / 1200)).alias("c"))
    from aeropanel.functions.columns import sub_index
    got = [r.s for r in steps.select(sub_index("c", pollutant).alias("s")).orderBy("c").collect()]
    assert all(a <= b for a, b in zip(got, got[1:]))
    assert got[-1] > INDEX_EDGES[-1]
    at_edges = tables.ad_hoc_rows(spark, [(float(e),) for e in edges], ["c"])
    assert sorted(r.s for r in at_edges.select(sub_index("c", pollutant).alias("s")).collect()) == INDEX_EDGES


def test_range_join_equals_expression(spark, daily):
    long_form = daily_index.to_long(daily, ("City", "Date", "k"))
    joined = daily_index.sub_index_long(long_form, tables.breakpoints(spark))
    wide = daily.select("City", "Date", "k", *INDEX_POLLUTANTS, *(f"SI_{p}" for p in INDEX_POLLUTANTS))
    parts = F.array(*(F.struct(F.lit(p).alias("pollutant"), F.col(p).alias("level"), F.col(f"SI_{p}").alias("sub_index"))
                      for p in INDEX_POLLUTANTS))
    direct = wide.select("City", "Date", "k", F.inline(parts)).filter("level IS NOT NULL")
    assert joined.count() == direct.count()
    assert joined.exceptAll(direct).isEmpty()


def test_dominant_is_null_exactly_where_the_index_is(daily):
    assert daily.filter(F.col("Dominant").isNull() != F.col("AQI_calc").isNull()).isEmpty()
    assert daily.filter(F.col("Bucket_calc").isNull() != F.col("AQI_calc").isNull()).isEmpty()


def test_dominant_shares_sum_to_100(daily):
    total = daily_index.dominant_share(daily).agg(F.sum("pct")).first()[0]
    assert abs(total - 100) < 0.5


def test_samples_have_the_exact_size(daily):
    both = daily.filter("AQI IS NOT NULL AND AQI_calc IS NOT NULL").count()
    assert daily_index.recorded_vs_calculated(daily, 0.4, 7).count() == int(both * 0.4 + 0.5)


def test_reconciled_tables_count_rows_missing_on_either_side(spark):
    schema = "City string, Date string, AQI double, AQI_calc double"
    ours = spark.createDataFrame([("a", "1", 1.0, 2.0), ("a", "2", None, 2.0), (None, "1", 5.0, None), ("b", "1", 1.0, 1.0)], schema)
    theirs = spark.createDataFrame([("a", "1", 1.0, 4.5), ("a", "2", None, None), (None, "1", 6.0, None), ("c", "1", 1.0, 1.0)], schema)
    found = {r.column: tuple(r)[1:] for r in daily_index.reconcile_tables(ours, theirs).collect()}
    assert found == {"AQI": (5, 1, 1, 2, 0, 1, 1.0), "AQI_calc": (5, 1, 1, 1, 1, 1, 2.5)}
    empty = daily_index.reconcile_tables(ours.limit(0), theirs.limit(0)).collect()
    assert [tuple(r)[1:] for r in empty] == [(0, 0, 0, 0, 0, 0, None)] * 2


def test_breakpoint_table(spark):
    bp = tables.breakpoints(spark)
    assert bp.count() == 42
    first = bp.filter("pollutant = 'CO' AND band = 3").first()
    assert tuple(first) == ("CO", 3, 2.0, 10.0, 100.0, 200.0)


def test_band_table_texts(spark):
    grid = {r.category: r.asDict() for r in daily_index.band_table(tables.breakpoints(spark)).collect()}
    assert list(grid) == [name for _, name, _, _ in CATEGORIES]
    assert grid["Good"]["PM25"] == "0–30"
    assert grid["Moderate"]["CO"] == "2–10"
    assert grid["Severe"]["O3"] == "748+"


def test_advice_of_a_missing_value(spark):
    df = tables.literal_rows(spark, [(None,), (50.0,), (401.0,)], "v double")
    got = {r.v: (r.category, r.advice) for r in daily_index.with_advice(df, "v").collect()}
    assert got[None] == ("No AQI", "")
    assert got[50.0] == ("Good", CATEGORIES[0][3])
    assert got[401.0] == ("Severe", CATEGORIES[5][3])


def test_fast_rounding_equals_round(spark):
    from aeropanel.functions.columns import round_rows
    values = spark.range(40000).selectExpr(
        "CASE id % 4 WHEN 0 THEN id / 128D WHEN 1 THEN (id - 20000) / 200D WHEN 2 THEN id * 1.005D ELSE id * 1e9D / 7 END AS v")
    for digits in (0, 1, 2):
        assert values.filter(~round_rows("v", digits).eqNullSafe(F.round("v", digits))).isEmpty()


def test_a_missing_pollutant_is_never_dominant_whatever_the_order(spark, monkeypatch):
    order = ["NH3", *(p for p in INDEX_POLLUTANTS if p != "NH3")]
    monkeypatch.setattr(daily_index, "INDEX_POLLUTANTS", order)
    monkeypatch.setattr("aeropanel.functions.columns.INDEX_POLLUTANTS", order)
    row = daily_index.index_of(rows_of(spark, [(0.0, 0.0, 0.0, 0.0, 0.0, 0.0, None)])).first()
    assert (row.AQI_calc, row.Dominant) == (0.0, "PM2.5")


def test_rounding_near_ties_and_of_large_values_equals_round(spark):
    from aeropanel.functions.columns import round_rows
    values = [0.5, 1.5, 2.675, 1.005, -0.5, 1e6 + 0.5, 12345678.5, 1e15 + 0.3, 99999.995, 0.1 + 0.2, -2.5]
    df = tables.literal_rows(spark, [(v,) for v in values], "v double")
    for digits in (0, 1, 2):
        got = df.select(round_rows("v", digits).alias("a"), F.round("v", digits).alias("b"))
        assert got.filter("a <> b").isEmpty()
