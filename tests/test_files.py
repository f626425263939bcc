"""Readers and writers, and the whole study from a CSV to the result folders."""

import datetime
import json

import pytest
from conftest import SMOKE
from pyspark.sql import functions as F

from aeropanel.__main__ import main
from aeropanel.operators import hourly
from aeropanel.schema import CITY_DAY, DAILY_OUTPUT, display_name
from aeropanel.session import scratch_path
from aeropanel.sources import driver_tables as given
from aeropanel.sources import readers, writers

HEADER = ",".join(display_name(c) for c in CITY_DAY.fieldNames())


@pytest.fixture()
def csv(tmp_path):
    path = tmp_path / "city_day.csv"
    path.write_text("\n".join([
        HEADER,
        "A,2020-01-01,10.5,,1,2,3,4,0.5,6,7,8,9,10,120,Moderate",
        "A,2020-01-02,NaN,50,1,2,3,4,0.5,6,7,8,9,10,,",
    ]) + "\n")
    return str(path)


def test_csv_with_the_fixed_schema(spark, csv):
    df = readers.read_city_day(spark, csv)
    assert df.schema == CITY_DAY
    first, second = df.orderBy("Date").collect()
    assert (first.PM25, first.PM10, first.Date) == (10.5, None, datetime.date(2020, 1, 1))
    assert (second.PM25, second.AQI, second.AQI_Bucket) == (None, None, None)


def test_csv_with_an_inferred_schema(spark, csv):
    df = readers.read_city_day(spark, csv, infer=True)
    assert df.columns == CITY_DAY.fieldNames()
    assert df.orderBy("Date").collect()[1].PM25 is None


def test_csv_with_other_columns_is_refused(spark, tmp_path):
    path = tmp_path / "other.csv"
    path.write_text("City,Date,NO\nA,2020-01-01,1\n")
    with pytest.raises(Exception, match="header"):
        readers.read_city_day(spark, str(path)).collect()


def test_paths():
    assert readers.storage_of("hdfs://node:9000/a/b.csv") == "HDFS"
    assert readers.storage_of("/a/b.csv") == "local file"
    assert readers.default_output("hdfs://node:9000/a/b.csv") == "hdfs://node:9000/a/output"


def test_one_city_reads_only_its_folder(spark, daily):
    path = scratch_path(spark, "prune-test")
    writers.write_daily(daily, path)
    one = readers.read_city(spark, path, "NATION_3")
    plan = one._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(City" in plan
    assert all("City=NATION_3" in f for f in one.select(F.input_file_name().alias("f")).distinct().toPandas().f)
    assert one.count() == daily.filter("City = 'NATION_3'").count()
    assert sorted(one.columns) == sorted(DAILY_OUTPUT)


def test_a_large_city_is_written_by_several_tasks(spark, daily):
    path = scratch_path(spark, "skew-test")
    hot = daily.withColumn("City", F.when(F.hash("k") % 3 == 0, F.lit("HOT")).otherwise(F.col("City")))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "16k")
    try:
        writers.write_daily(hot.repartition(8), path)
    finally:
        spark.conf.unset(size)
    back = readers.read_daily(spark, path)
    assert back.count() == daily.count()
    files = back.filter("City = 'HOT'").select(F.input_file_name().alias("f")).distinct().count()
    assert files > 1


def test_export_is_sorted_over_its_files(spark, daily):
    path = scratch_path(spark, "export-test")
    writers.export_daily_csv(daily, path)
    parts = spark.read.option("header", True).csv(path).select("City", "Date", F.input_file_name().alias("f"))
    rows = [(r.f, r.City, r.Date) for r in parts.collect()]
    keys = [k[1:] for k in sorted(rows)]
    assert keys == sorted(keys)
    assert {"AQI_recorded", "PM2.5"} <= set(spark.read.option("header", True).csv(path).columns)


def test_documents_list_days_in_order(spark, daily):
    docs = writers.city_documents(daily).collect()
    assert len(docs) == 25
    days = [d.date for d in docs[0].days]
    assert days == sorted(set(days))


def test_json_keeps_missing_values(spark, tmp_path):
    path = str(tmp_path / "j")
    writers.write_json(spark.sql("SELECT 1 AS a, CAST(NULL AS DOUBLE) AS b"), path)
    assert [json.loads(r.value) for r in spark.read.text(path).collect()] == [{"a": 1, "b": None}]


def test_payloads_from_files(spark, tmp_path):
    payload = {"city": "S", "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "pm2_5": [1.0, None],
                                       "pm10": [2.0, 3.0], "nitrogen_dioxide": [None, 4.0], "sulphur_dioxide": [5.0, 6.0],
                                       "carbon_monoxide": [7.0, 8.0], "ozone": [9.0, 10.0]}}
    (tmp_path / "feed.json").write_text(json.dumps(payload))
    rows = hourly.flatten_hourly(readers.read_hourly_payloads(spark, str(tmp_path / "feed.json"))).collect()
    assert [(r.station, r.time.hour, r.pm2_5, r.ozone) for r in rows] == [("S", 0, 1.0, 9.0), ("S", 1, None, 10.0)]


def test_persisted_frames_are_released(spark):
    with readers.persisted(spark.range(10)) as df:
        assert df.is_cached and df.count() == 10
    assert not df.is_cached


def test_the_whole_study_from_a_csv(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    given.city_day(spark, SMOKE).drop("k").withColumnsRenamed({"PM25": "PM2.5"}) \
        .write.option("header", True).csv(source)
    written = main(["--input", source, "--output", out, "--years", "7", "--no-models"])
    city = spark.read.json(written["results/city_aqi"])
    assert city.count() == 25
    summary = spark.read.json(written["dashboard/summary"]).first()
    assert summary.overview.records == 1500 and len(summary.overview.monthly) == 12
    assert spark.read.json(written["dashboard/cities"]).count() == 25
    assert spark.read.json(written["results/data_source"]).first().storage == "local file"
    assert spark.read.parquet(written["daily_aqi"]).count() == spark.read.parquet(written["one_per_day"]).count()


def test_a_point_lookup_reads_few_row_groups(spark, tmp_path):
    """Of 60,000 days of three cities, only one folder and there a small part of the rows is read."""
    days = spark.range(60_000).select(
        F.concat(F.lit("C"), (F.col("id") % 3).cast("string")).alias("City"),
        F.date_add(F.lit("1900-01-01").cast("date"), F.floor(F.col("id") / 3).cast("int")).alias("Date"),
        *(F.rand(i).alias(c) for i, c in enumerate(DAILY_OUTPUT[2:-2])), *(F.lit("x").alias(c) for c in DAILY_OUTPUT[-2:]))
    writers.write_daily(days, str(tmp_path), row_group_bytes=64 * 1024)
    found = readers.read_city_days(spark, str(tmp_path), "C1", "1930-06-15")
    plan = found._jdf.queryExecution().executedPlan()
    assert found.count() == 1
    assert "PartitionFilters: [isnotnull(City" in plan.toString() and "PushedFilters: [IsNotNull(Date)" in plan.toString()
    rows = _scanned(found)
    assert 0 < rows < 6_000


def _scanned(df):
    """Rows that the scans of a frame give out when it runs."""
    df._jdf.queryExecution().executedPlan().executeCollect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))
