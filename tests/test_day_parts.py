"""Parts of feeds: merged results equal those of the whole panel, and a new day touches nothing else."""

import os

import pytest
from pyspark.sql import functions as F

from aeropanel.operators import cities, daily_index, day_parts, profile, trends
from aeropanel.operators import clean as cleaning
from conftest import SMOKE


@pytest.fixture(scope="module")
def panel(spark):
    from aeropanel.sources import driver_tables as given
    return given.city_day(spark, SMOKE).persist()


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_adding_a_day_gives_the_whole_result(spark, panel, tmp_path):
    path = str(tmp_path / "parts")
    last = panel.agg(F.max("Date")).first()[0]
    before, day = panel.filter(F.col("Date") < last), panel.filter(F.col("Date") == last)
    day_parts.add_feed(before, path, "before", ["k"])
    old = files(path)
    n_before = rows(day_parts.overview(day_parts.read_parts(spark, path), 5))[0][0]
    day_parts.add_feed(day, path, str(last), ["k"])
    day_parts.add_feed(day, path, str(last), ["k"])  # delivered twice
    assert {f: t for f, t in files(path).items() if "before" in f} == old
    assert day.count() > 0 and n_before == before.count()
    day_parts.fold(spark, path, str(tmp_path / "folded"), "all")
    cleaned = cleaning.clean(panel, ["k"])
    for parts in (day_parts.read_parts(spark, path), day_parts.read_parts(spark, str(tmp_path / "folded"))):
        assert rows(day_parts.overview(parts, len(panel.columns))) == rows(profile.overview(panel))
        assert rows(day_parts.yearly(parts)) == rows(trends.yearly(cleaned))
        assert rows(day_parts.city_base(parts)) == rows(cities.city_base(cleaned))
        assert rows(day_parts.city_ranking(parts)) == rows(trends.city_ranking(cleaned))
        assert rows(day_parts.full_coverage(parts, 5)) == rows(trends.full_coverage(cleaned, 5))


def test_odd_and_missing_rows(spark, panel, tmp_path):
    path = str(tmp_path / "parts")
    odd = panel.limit(1).select(*(F.lit(None).cast(t).alias(c) for c, t in panel.dtypes))  # no city, no date, no target
    some = panel.filter("City IS NOT NULL").limit(40).unionByName(odd).unionByName(odd)
    day_parts.add_feed(some, path, "some", ["k"])
    day_parts.add_feed(panel.limit(0), path, "none", ["k"])
    parts = day_parts.read_parts(spark, path)
    assert rows(day_parts.overview(parts, 3)) == rows(profile.overview(some.select("City", "Date", "k")))
    assert rows(day_parts.yearly(parts)) == rows(trends.yearly(cleaning.clean(some, ["k"])))
    day_parts.add_feed(panel.limit(0), path, "some", ["k"])  # a feed that is taken back
    emptied = day_parts.read_parts(spark, path)
    assert rows(day_parts.overview(emptied, 3)) == [(0, 3, 0, None, None)] and rows(day_parts.city_base(emptied)) == []


def test_a_year_is_replaced_and_no_other(spark, panel, tmp_path):
    path = str(tmp_path / "years")
    some = panel.filter(F.col("City").isin(*[r.City for r in panel.select("City").distinct().orderBy("City").limit(3).collect()]))
    daily = daily_index.daily_index(some, ["k"])
    day_parts.replace_years(daily, path)
    old, want = files(path), rows(day_parts.read_years(spark, path))
    year = sorted({f.split("year=")[1][:4] for f in old if "year=" in f})[1]
    day_parts.replace_years(daily.filter(F.year("Date") == int(year)), path)
    new = files(path)
    kept = {f for f in old if "year=" in f and f"year={year}" not in f}
    assert kept and all(new.get(f) == old[f] for f in kept)
    assert not {f for f in old if f"year={year}" in f} & set(new)
    assert rows(day_parts.read_years(spark, path)) == want
