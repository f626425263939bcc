"""Rolling means against a plain loop over arrays, and the stream against the batch."""

import datetime
import random

import pytest
from conftest import CHECK
from pyspark.sql import functions as F

from aeropanel.operators import hourly
from aeropanel.schema import HOURLY
from aeropanel.session import scratch_path
from aeropanel.sources import driver_tables as given
from aeropanel.sources import tables
from aeropanel.streaming import hourly_stream

START = datetime.datetime(2024, 1, 1)


def hour(i):
    return START + datetime.timedelta(hours=i)


def mean_of(values, first, last, needed):
    present = [v for v in values[first:last + 1] if v is not None]
    return sum(present) / len(present) if len(present) >= needed else None


def loop_mean24(values, end):
    return mean_of(values, max(end - 23, 0), end, 16)


def loop_max8(values, end):
    means = [mean_of(values, s, s + 7, 6) for s in range(max(end - 23, 0), end - 6)]
    means = [m for m in means if m is not None]
    return max(means) if means else None


@pytest.fixture(scope="module")
def gappy(spark):
    """Two stations over more than two blocks of 31 days, with gaps of all lengths, one starting mid-block."""
    rng, rows, dense = random.Random(5), [], {}
    for station, first, hours in (("A", 0, 1700), ("B", 700, 900)):
        dense[station] = (first, [[None] * hours for _ in hourly.FIELDS])
        at, silent = 0, 0
        while at < hours:
            if silent == 0 and rng.random() < 0.02:
                silent = rng.choice([1, 3, 9, 30])
            edge = at in (0, hours - 1)
            if silent and not edge:
                silent -= 1
            else:
                values = [None if rng.random() < 0.2 else rng.randrange(4000) / 8 for _ in hourly.FIELDS]
                rows.append((station, hour(first + at), *values))
                for column, v in zip(dense[station][1], values):
                    column[at] = v
            at += 1
    return tables.literal_rows(spark, rows, HOURLY), dense


def test_rolling_means_equal_the_loop(gappy):
    rows, dense = gappy
    got = {(r.station, r.time): r for r in hourly.rolling_means(rows).collect()}
    assert len(got) == sum(len(cols[0]) for _, cols in dense.values())
    for station, (first, columns) in dense.items():
        by_field = dict(zip(hourly.FIELDS, columns))
        for end in range(len(columns[0])):
            row = got[station, hour(first + end)]
            assert row["mean24_pm2_5"] == loop_mean24(by_field["pm2_5"], end)
            assert row["max8_ozone"] == loop_max8(by_field["ozone"], end)
            want8 = mean_of(by_field["ozone"], end - 7, end, 6) if end >= 7 else None
            assert row["mean8_ozone"] == want8


def test_index_starts_with_the_24th_hour(gappy):
    rows, dense = gappy
    firsts = {r.station: r.t for r in hourly.rolling_index(rows).groupBy("station").agg(F.min("time").alias("t")).collect()}
    assert firsts == {s: hour(first + 23) for s, (first, _) in dense.items()}


def test_dense_hours_have_no_gap(gappy):
    rows, dense = gappy
    counts = {r.station: r["count"] for r in hourly.densify_hours(rows).groupBy("station").count().collect()}
    assert counts == {s: len(cols[0]) for s, (_, cols) in dense.items()}


@pytest.mark.parametrize("as_of", [hour(30), hour(1000), hour(5000)])
def test_trend_is_the_end_of_the_whole_series(gappy, as_of):
    rows, _ = gappy
    past = rows.filter(F.col("time") <= F.lit(as_of))
    ends = past.filter("pm2_5 IS NOT NULL").groupBy("station").agg(F.max("time").alias("end"))
    whole = hourly.rolling_index(rows).join(ends, "station").filter(
        (F.col("time") <= F.col("end")) & (F.col("time") > F.col("end") - F.expr("INTERVAL 24 HOURS"))).drop("end")
    trend = hourly.trend24(rows, str(as_of))
    assert sorted(map(str, trend.collect())) == sorted(map(str, whole.select(*trend.columns).collect()))
    latest = hourly.latest_index(rows, str(as_of))
    assert {(r.station, r.time) for r in latest.collect()} <= {(r.station, r.end) for r in ends.collect()}


def test_a_station_with_less_than_a_day_is_left_out(spark):
    rows = [("S", hour(i), 10.0, 20.0, 5.0, 5.0, 100.0, 10.0) for i in range(23)]
    short = tables.literal_rows(spark, rows, HOURLY)
    assert hourly.latest_index(short, str(hour(40))).isEmpty()
    longer = tables.literal_rows(spark, [*rows, ("S", hour(23), *rows[0][2:])], HOURLY)
    assert hourly.latest_index(longer, str(hour(40))).first().AQI_calc is not None


def test_arrays_are_matched_by_position(spark, hourly_rows):
    nested = hourly.nest_hourly(hourly_rows)
    assert nested.agg(F.max(F.size("hourly.time"))).first()[0] <= 24
    flat = hourly.flatten_hourly(nested)
    assert flat.exceptAll(hourly_rows.select(*flat.columns)).isEmpty()


def test_local_hour_of_a_half_hour_zone(spark):
    from aeropanel.functions.columns import local_hour
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 18:40:00' AS t")
    assert df.select(local_hour("t", "Asia/Kolkata")).first()[0] == datetime.datetime(2024, 1, 2, 0, 0)


READINGS = "station string, ts timestamp, " + ", ".join(f"{c} double" for c in hourly.FIELDS)


def reading(station, ts, value=80.0):
    return (station, ts, *[value] * len(hourly.FIELDS))


def streamed(spark, path, with_index=False):
    """Runs what lies in path/in through the streams -> what the first one has done."""
    arriving = hourly_stream.read_stream(spark, f"{path}/in", spark.read.parquet(f"{path}/in").schema)
    run = hourly_stream.run_to_parquet(
        hourly_stream.closed_hours(hourly_stream.stream_hourly(arriving)), f"{path}/hours", f"{path}/cp1", 2)
    if with_index:
        closed = hourly_stream.read_stream(spark, f"{path}/hours", spark.read.parquet(f"{path}/hours").schema)
        hourly_stream.run_to_parquet(hourly_stream.stream_rolling_index(closed), f"{path}/index", f"{path}/cp2", 2)
    return run


def test_late_rows_are_dropped_and_counted(spark):
    events = given.table(spark, CHECK, "events")
    late = F.col("event_type") == given.LATE_TYPE
    path = scratch_path(spark, "late-test")
    dropped = []
    for part in (events.filter(~late), events.filter(late)):
        given.readings(part).write.mode("append").parquet(f"{path}/in")
        dropped.append(streamed(spark, path).late_station_hours)
    assert dropped[0] == 0 and dropped[1] > 0


def test_late_rows_of_more_batches_than_spark_remembers(spark, tmp_path):
    path = str(tmp_path)
    tables.literal_rows(spark, [reading("A", hour(0)), reading("A", hour(2000))], READINGS).coalesce(1).write.parquet(f"{path}/in")
    arrive = lambda: hourly_stream.run_to_parquet(
        hourly_stream.closed_hours(hourly_stream.stream_hourly(
            hourly_stream.read_stream(spark, f"{path}/in", spark.read.parquet(f"{path}/in").schema, max_files=1))),
        f"{path}/hours", f"{path}/cp", 1)
    arrive()
    rows = tables.literal_rows(spark, [reading("A", hour(100 + i)) for i in range(240)], READINGS)
    rows.repartitionByRange(120, "ts").write.mode("append").parquet(f"{path}/in")
    run = arrive()
    assert run.batches > 100 and run.late_station_hours == 240


def test_unseen_progress_is_an_error():
    run = hourly_stream.Run()
    run.add({"batchId": 3, "stateOperators": []})
    with pytest.raises(RuntimeError):
        run.add({"batchId": 5, "stateOperators": []})


def station_histories(spark):
    """One station over all the time, one that starts late, one that ends early, one of 17 hours, gaps in all."""
    spans = {"whole": (0, 200), "late": (90, 200), "ended": (0, 60), "short": (20, 37)}
    rows = [reading(s, hour(i) + datetime.timedelta(minutes=i % 60), 10.0 + i % 90) for s, (a, b) in spans.items()
            for i in range(a, b) if i % 11 != 5 or i in (a, b - 1)]
    return tables.literal_rows(spark, rows, READINGS)


def test_stream_equals_batch_on_closed_hours(spark, tmp_path):
    path = str(tmp_path)
    readings = station_histories(spark)
    # files in the order of time, in two runs: the state goes on where the first run ended
    for cond in ("ts < '2024-01-04 08:00:00'", "ts >= '2024-01-04 08:00:00'"):
        readings.filter(cond).coalesce(1).write.mode("append").parquet(f"{path}/in")
        streamed(spark, path, with_index=True)
    closed = spark.read.parquet(f"{path}/hours")
    got, batch = spark.read.parquet(f"{path}/index"), hourly.rolling_index(closed)
    assert got.exceptAll(batch.select(*got.columns)).isEmpty() and batch.select(*got.columns).exceptAll(got).isEmpty()
    first = {r.station: r.t for r in got.groupBy("station").agg(F.min("time").alias("t")).collect()}
    assert first == {"whole": hour(23), "late": hour(113), "ended": hour(23)}
    assert got.filter("station = 'ended'").agg(F.max("time")).first()[0] == hour(59)


def test_stream_equals_batch_on_the_given_events(spark):
    path = scratch_path(spark, "stream-test")
    given.readings(given.table(spark, CHECK, "events")).repartition(5).write.parquet(f"{path}/in")
    streamed(spark, path, with_index=True)
    got = spark.read.parquet(f"{path}/index")
    batch = hourly.rolling_index(spark.read.parquet(f"{path}/hours")).select(*got.columns)
    assert batch.count() > 5000 and batch.exceptAll(got).isEmpty() and got.exceptAll(batch).isEmpty()


def index_of_files(spark, path, files, **options):
    """Runs each file of closed hours through the index stream on its own -> the last run."""
    for rows in files:
        rows.coalesce(1).write.mode("append").parquet(f"{path}/hours")
        closed = hourly_stream.read_stream(spark, f"{path}/hours", rows.schema)
        run = hourly_stream.run_to_parquet(hourly_stream.stream_rolling_index(closed, **options), f"{path}/index", f"{path}/cp", 2)
    return run


def closed_rows(spark, spans, step=1):
    rows = [(s, hour(i), *[float(10 + (i * step) % 90)] * 6) for s, a, b in spans for i in range(a, b) if i % 11 != 5 or i in (a, b - 1)]
    return tables.literal_rows(spark, rows, HOURLY)


def same_rows(got, want):
    want = want.select(*got.columns)
    return got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_files_out_of_order_give_the_batch_result(spark, tmp_path):
    hours = closed_rows(spark, [("A", 0, 150), ("B", 30, 150)])
    parts = [(0, 40), (60, 80), (40, 60), (100, 120), (80, 100), (120, 150)]
    files = [hours.filter(f"time >= timestamp'{hour(a)}' AND time < timestamp'{hour(b)}'") for a, b in parts]
    index_of_files(spark, str(tmp_path), files, delay="48 hours")
    got = spark.read.parquet(f"{tmp_path}/index")
    settled = hours.filter(f"time <= timestamp'{hour(149 - 48)}'")
    assert same_rows(got, hourly.rolling_index(settled)) and got.count() > 100


def test_ended_stations_leave_the_state(spark, tmp_path):
    hours = closed_rows(spark, [("ended", 0, 60), ("back", 0, 50), ("whole", 0, 300), ("back", 200, 260)])
    cuts = [(0, 60), (60, 100), (100, 201), (201, 300)]
    kept = []
    for a, b in cuts:
        part = hours.filter(f"time >= timestamp'{hour(a)}' AND time < timestamp'{hour(b)}'")
        kept.append(index_of_files(spark, str(tmp_path), [part], silence=72).state_rows)
    assert kept == [3, 3, 2, 2]
    got = spark.read.parquet(f"{tmp_path}/index")
    back = hours.filter("station = 'back'")
    lives = [hourly.rolling_index(back.filter(f"time {sign} timestamp'{hour(100)}'")) for sign in ("<", ">")]
    want = hourly.rolling_index(hours.filter("station <> 'back'")).unionByName(lives[0]).unionByName(lives[1])
    assert same_rows(got, want)


def test_a_silence_is_judged_alike_in_one_batch(spark, tmp_path):
    hours = closed_rows(spark, [("back", 0, 50), ("whole", 0, 300), ("back", 200, 260)])
    index_of_files(spark, str(tmp_path), [hours], silence=72)
    starts = spark.read.parquet(f"{tmp_path}/index").filter(f"station = 'back' AND time >= timestamp'{hour(50)}'").agg(F.min("time")).first()[0]
    assert starts == hour(223)


def test_late_readings_are_kept_and_the_others_count(spark, tmp_path):
    path = str(tmp_path)
    first = [reading("A", hour(i) + datetime.timedelta(minutes=5), 10.0) for i in range(30)]
    second = [reading("A", hour(3), 99.0), reading("B", hour(10), 5.0), reading("A", hour(28), 50.0), reading("A", hour(40), 1.0)]
    for rows in (first, second):
        tables.literal_rows(spark, rows, READINGS).coalesce(1).write.mode("append").parquet(f"{path}/in")
        marked = hourly_stream.with_late(hourly_stream.read_stream(spark, f"{path}/in", spark.read.parquet(f"{path}/in").schema))
        hourly_stream.run_to_parquet(marked, f"{path}/split", f"{path}/cp", 2, hourly_stream.write_split)
    late = hourly_stream.read_split(spark, f"{path}/split", late=True).select("station", "ts", "ozone").collect()
    assert sorted(map(tuple, late)) == [("A", hour(3), 99.0), ("B", hour(10), 5.0)]
    assert hourly_stream.read_split(spark, f"{path}/split", late=False).count() == 32
    hours = hourly_stream.closed_hours(hourly_stream.stream_hourly(hourly_stream.read_on_time(spark, f"{path}/split")))
    run = hourly_stream.run_to_parquet(hours, f"{path}/hours", f"{path}/cp-hours", 2)
    got = {r.time: r.ozone for r in spark.read.parquet(f"{path}/hours").collect()}
    assert run.late_station_hours == 0 and got[hour(28)] == 50.0 and got[hour(3)] == 10.0 and len(got) == 30


OPERATORS = {
    "densify_hours": hourly.densify_hours, "mean24": hourly.mean24, "mean8": hourly.mean8, "max8": hourly.max8,
    "rolling_index": hourly.rolling_index, "latest_index": lambda h: hourly.latest_index(h, str(hour(150))),
    "trend24": lambda h: hourly.trend24(h, str(hour(150))), "live_ranking": lambda h: hourly.live_ranking(h, str(hour(150)))}


def test_hours_are_those_of_the_clock_in_every_zone(spark, tmp_path):
    """The same wall-clock readings give the same labels and values in UTC and half an hour off."""
    found = {}
    for zone in ("UTC", "Asia/Kolkata", "America/St_Johns"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            clock = station_histories_by_clock(spark)
            hours = clock.groupBy("station", F.date_trunc("hour", "ts").alias("time")).agg(*(F.max(c).alias(c) for c in hourly.FIELDS))
            rows = {name: shown(op(hours)) for name, op in OPERATORS.items()}
            path = str(tmp_path / zone.replace("/", "-"))
            clock.coalesce(1).write.parquet(f"{path}/in")
            streamed(spark, path, with_index=True)
            rows |= {name: shown(spark.read.parquet(f"{path}/{name}")) for name in ("hours", "index")}
            found[zone] = rows
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    for name, rows in found["UTC"].items():
        assert rows and all(found[zone][name] == rows for zone in found), name
    assert found["UTC"]["densify_hours"][0][1] == "2024-01-01 00:00:00"


def station_histories_by_clock(spark):
    texts = [(s, f"2024-01-{1 + i // 24:02d} {i % 24:02d}:{i % 60:02d}:00", 10.0 + i % 90)
             for s, (a, b) in {"A": (0, 160), "B": (40, 120)}.items() for i in range(a, b) if i % 13 != 5]
    rows = tables.literal_rows(spark, texts, "station string, at string, v double")
    return rows.select("station", F.col("at").cast("timestamp").alias("ts"), *(F.col("v").alias(c) for c in hourly.FIELDS))


def shown(df):
    """Rows with times as the session's clock shows them."""
    kept = [F.col(c).cast("string") if kind.startswith("timestamp") else F.col(c) for c, kind in df.dtypes]
    return sorted(map(tuple, df.select(*kept).collect()), key=repr)


def test_many_readings_of_one_hour_are_combined_before_the_blocks(spark):
    rows = tables.literal_rows(spark, [("S", hour(i // 3), *[float(i)] * 6) for i in range(90)], HOURLY)
    one = hourly.one_per_hour(rows)
    assert one.count() == 30 and one.agg(F.max("ozone")).first()[0] == 89.0
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max(ozone") > plan.index("Exchange hashpartitioning(station")
