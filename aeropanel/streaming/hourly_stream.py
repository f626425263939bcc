"""Readings as a stream: hourly values, then the rolling index, with a watermark for late rows.

The hourly values are a windowed aggregate, written as a table of closed hours. The rolling index is a second stream over
that table: it keeps the first hour and the last 23 hours of every station as state, so the rule that an index needs 24
hours holds per station, whenever it starts. Missing hours are filled in once a later hour of the station has closed, as
in the batch form; both give the same rows for closed hours. Hours that come out of order wait for the watermark, and stations
that have ended leave the state. Readings that come after their hour has closed can be written to a table of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from aeropanel.operators.daily_index import index_columns
from aeropanel.operators.hourly import (
    DAY_FIELDS,
    FIELDS,
    HALO_HOURS,
    INDEX_RESULT,
    SHORT_FIELDS,
    hour_number,
    hour_start,
    index_inputs,
)
from aeropanel.schema import DAY_HOURS, DAY_MIN_READINGS, SHORT_HOURS, SHORT_MIN_READINGS

MEANS = [*(f"mean24_{c}" for c in DAY_FIELDS), *(f"max8_{c}" for c in SHORT_FIELDS)]
MEANS_SCHEMA = "station string, hour long, " + ", ".join(f"{c} double" for c in MEANS)
STATE_SCHEMA = "first long, last long, last_at long, held array<double>, hours array<long>, at array<long>, waiting array<double>"
HOUR_MS = 3_600_000
SILENCE_HOURS = 7 * 24
POLL_SECONDS = 0.2


def read_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def hour_window(readings: DataFrame, time: str = "ts") -> Column:
    """Windows of one hour of the session's clock; without an offset Spark's windows are hours of UTC."""
    if dict(readings.dtypes)[time] == "timestamp_ntz":
        return F.window(time, "1 hour")
    offset = readings.sparkSession.sql("SELECT unix_seconds(TIMESTAMP_LTZ'2024-01-01 00:00:00') % 3600").first()[0]
    return F.window(time, "1 hour", "1 hour", f"{offset} seconds")


def stream_hourly(readings: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Largest reading per station and hour -> station, window, and the six fields; sent once the hour is closed."""
    return (
        readings.withWatermark("ts", delay)
        .groupBy("station", hour_window(readings).alias("window"))
        .agg(*(F.max(c).alias(c) for c in FIELDS))
    )


def _rolling(values: np.ndarray, hours: int, needed: int) -> np.ndarray:
    """Means of the present values of every run of `hours` rows, NaN where too few are present."""
    runs = np.lib.stride_tricks.sliding_window_view(values, hours)
    present = (~np.isnan(runs)).sum(axis=1)
    return np.where(present >= needed, np.nansum(runs, axis=1) / np.maximum(present, 1), np.nan)


def rolling_rows(values: np.ndarray) -> np.ndarray:
    """Readings (hours, FIELDS) without gaps -> the columns MEANS for every hour from the 24th on."""
    day = [_rolling(values[:, FIELDS.index(c)], DAY_HOURS, DAY_MIN_READINGS) for c in DAY_FIELDS]
    short = []
    for c in SHORT_FIELDS:
        means = _rolling(values[:, FIELDS.index(c)], SHORT_HOURS, SHORT_MIN_READINGS)
        inside = np.lib.stride_tricks.sliding_window_view(means, DAY_HOURS - SHORT_HOURS + 1)
        highest = np.where(np.isnan(inside), -np.inf, inside).max(axis=1)
        short.append(np.where(np.isneginf(highest), np.nan, highest))
    return np.stack([*day, *short], axis=1)


@dataclass
class Station:
    """What the stream keeps of a station: its span, the readings of the last hours of it, and hours that may still be preceded."""

    first: int | None
    last: int
    last_at: int
    held: np.ndarray
    hours: np.ndarray
    at: np.ndarray
    waiting: np.ndarray

    @classmethod
    def of(cls, state: GroupState) -> Station:
        first, last, last_at, held, hours, at, waiting = state.get if state.exists else (None, 0, 0, [], [], [], [])
        table = lambda values: np.array(values, float).reshape(-1, len(FIELDS))
        return cls(first, last, last_at, table(held), np.array(hours, np.int64), np.array(at, np.int64), table(waiting))

    def kept(self) -> tuple:
        return (self.first, self.last, self.last_at, self.held.ravel().tolist(), self.hours.tolist(), self.at.tolist(),
                self.waiting.ravel().tolist())

    def wait(self, rows: pd.DataFrame) -> None:
        """Adds hours that have arrived; of an hour that arrives again the largest readings count."""
        named = pd.DataFrame(self.waiting, columns=FIELDS).assign(hour=self.hours, at=self.at)
        by_hour = pd.concat([named, rows[[*FIELDS, "hour", "at"]]]).groupby("hour", sort=True).max().reset_index()
        self.hours, self.at = by_hour["hour"].to_numpy(np.int64), by_hour["at"].to_numpy(np.int64)
        self.waiting = by_hour[FIELDS].to_numpy(float)

    def settle(self, watermark: int, silence: int) -> Iterator[pd.DataFrame]:
        """Takes the hours that nothing can precede any more; gives the means of all hours that a full day precedes.

        After more than `silence` hours without one the station begins anew.
        """
        done = self.at <= watermark
        hours, at, values = self.hours[done], self.at[done], self.waiting[done]
        self.hours, self.at, self.waiting = self.hours[~done], self.at[~done], self.waiting[~done]
        gaps = np.diff(hours, prepend=hours[:1] if self.first is None else self.last)
        for part in np.split(np.arange(len(hours)), np.flatnonzero(gaps > silence)):
            if len(part):
                if self.first is None or hours[part[0]] - self.last > silence:
                    self.first, self.last, self.held = int(hours[part[0]]), int(hours[part[0]]) - 1, np.zeros((0, len(FIELDS)))
                new = np.full((int(hours[part[-1]]) - self.last, len(FIELDS)), np.nan)
                new[hours[part] - self.last - 1] = values[part]
                span = np.concatenate([self.held, new])
                self.held, self.last, self.last_at = span[-HALO_HOURS:], int(hours[part[-1]]), int(at[part[-1]])
                if len(span) >= DAY_HOURS:
                    rows = pd.DataFrame(rolling_rows(span), columns=MEANS)
                    rows.insert(0, "hour", np.arange(self.last - len(rows) + 1, self.last + 1))
                    yield rows


def advancing(silence: int):
    """The step of one station: hours wait until the watermark has passed them, and a station that has ended leaves the state."""
    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        station, watermark = Station.of(state), state.getCurrentWatermarkMs()
        arrived = [] if state.hasTimedOut else list(frames)
        if arrived:
            station.wait(pd.concat(arrived))
        for rows in station.settle(watermark, silence):
            rows.insert(0, "station", key[0])
            yield rows
        end = station.last_at + silence * HOUR_MS
        if not len(station.hours) and end <= watermark:
            state.remove()
            return
        state.update(station.kept())
        # a time-out comes once the watermark is past its time
        next_at = int(station.at.min()) if len(station.hours) else end
        state.setTimeoutTimestamp(max(next_at - 1, watermark + 1))

    return advance


def closed_hours(hourly_stream: DataFrame) -> DataFrame:
    """The output of `stream_hourly` as the table that the second stream reads: station, time and the six fields."""
    return hourly_stream.select("station", F.col("window.start").alias("time"), *FIELDS)


def stream_rolling_index(hours: DataFrame, delay: str = "0 seconds", silence: int = SILENCE_HOURS) -> DataFrame:
    """Rolling index per station and hour, from the station's 24th hour on, over a stream of closed hours.

    Files may come in any order within `delay`: an hour waits until that much later hours of any station have been seen. A
    station without a reading for more than `silence` hours has ended and leaves the state; if it comes back it begins
    anew, whether or not the stream had forgotten it yet, so the rows do not depend on how files fall into batches.
    """
    hours = hours.withWatermark("time", delay) \
        .select("station", "time", F.unix_millis("time").alias("at"), hour_number("time").alias("hour"), *FIELDS)
    means = hours.groupBy("station").applyInPandasWithState(
        advancing(silence), MEANS_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)
    inputs = means.select("station", hour_start(F.col("hour")).alias("time"), *(c.alias(p) for p, c in index_inputs().items()))
    return index_columns(inputs).select(*INDEX_RESULT)


def _marked(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The readings of a station, told apart by whether their hour is closed; keeps no state."""
    watermark = state.getCurrentWatermarkMs()
    for rows in frames:
        rows["late"] = (rows.pop("closes") <= watermark).astype("int32")
        yield rows[["station", "ts", *FIELDS, "late"]]


def with_late(readings: DataFrame, delay: str = "2 hours") -> DataFrame:
    """A stream of readings, each with `late`: whether its hour had closed before the batch it came in.

    Spark drops such rows at the aggregate without a trace. Written by `write_split`, they stay: the late ones in a folder of
    their own, the others in one that `stream_hourly` reads, where no row is late again, as it sees at most the same rows.
    """
    closes = F.unix_millis(hour_window(readings)["end"].cast("timestamp"))
    rows = readings.withWatermark("ts", delay).select("station", "ts", closes.alias("closes"), *FIELDS)
    schema = "station string, ts timestamp, " + ", ".join(f"{c} double" for c in FIELDS) + ", late int"
    marked = rows.groupBy("station").applyInPandasWithState(_marked, schema, "n int", "append", GroupStateTimeout.NoTimeout)
    return marked.withColumn("late", F.col("late") == 1)


def write_split(marked: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends the rows of `with_late` to Parquet below `path`, on-time and late ones in folders of their own."""
    return (
        marked.writeStream.outputMode("append").format("parquet").partitionBy("late")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def read_split(spark: SparkSession, path: str, late: bool) -> DataFrame:
    """What `write_split` has written: the late readings, or the others."""
    return spark.read.parquet(path).filter(F.col("late") == late).drop("late")


def read_on_time(spark: SparkSession, path: str) -> DataFrame:
    """The readings on time as a stream, for `stream_hourly`."""
    schema = "station string, ts timestamp, " + ", ".join(f"{c} double" for c in FIELDS) + ", late boolean"
    return spark.readStream.schema(schema).parquet(path).filter(~F.col("late")).drop("late")


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends the stream to Parquet files at `path`, all that is available now."""
    return (
        stream.writeStream.outputMode("append").format("parquet")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


@dataclass
class Run:
    """What a finished stream has done.

    `late_station_hours` counts the rows that came too late at the stateful operators: a station's hour that late
    readings of one batch would have changed is one, however many readings it has. `state_rows` are those kept at the end.
    """

    batches: int = 0
    late_station_hours: int = 0
    state_rows: int = 0
    last_batch: int | None = None

    def add(self, progress: dict) -> None:
        batch = progress["batchId"]
        if self.last_batch is not None and batch > self.last_batch + 1:
            raise RuntimeError(f"progress of the batches after {self.last_batch} was not seen")
        self.last_batch, self.batches = batch, self.batches + 1
        self.state_rows = sum(op["numRowsTotal"] for op in progress["stateOperators"])
        self.late_station_hours += sum(op["numRowsDroppedByWatermark"] for op in progress["stateOperators"])


def finish(query: StreamingQuery) -> Run:
    """Waits for the end of a stream and adds up the progress of all its batches.

    Spark keeps the progress of the last batches only, so it is read while the stream runs; a gap is an error.
    """
    run = Run()
    while True:
        active = query.isActive
        for progress in query.recentProgress:
            if run.last_batch is None or progress["batchId"] > run.last_batch:
                run.add(progress)
        if not active:
            query.awaitTermination()
            return run
        query.awaitTermination(POLL_SECONDS)


def run_to_parquet(stream: DataFrame, path: str, checkpoint: str, state_partitions: int | None = None,
                   write: Callable[[DataFrame, str, str], StreamingQuery] = write_stream) -> Run:
    """Runs `write` to its end.

    `state_partitions` is the number of state stores per operator, by default the session's shuffle partitions. It
    is fixed by the first run on a checkpoint; every batch opens all of them, so a small stream wants few.
    """
    spark, option = stream.sparkSession, "spark.sql.shuffle.partitions"
    before = spark.conf.get(option)
    spark.conf.set(option, str(state_partitions or before))
    try:
        query = write(stream, path, checkpoint)
    finally:
        spark.conf.set(option, before)
    return finish(query)
