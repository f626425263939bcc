"""Hourly readings and the rolling index of every station.

A station's hours are cut into blocks of 31 days, and each block also gets the 23 hours before it, so
windows run per (station, block): no group exceeds 767 hours, however much one station holds, and a
single shuffle serves all frames. Missing hours come from a spine of empty slots. There is one reading per
station and hour; of several the largest counts. Hours are those of the session's clock, also where its zone is half an
hour off.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeropanel.functions.columns import round_rows
from aeropanel.operators.daily_index import index_columns
from aeropanel.operators.ranking import with_rank
from aeropanel.schema import (
    DAY_HOURS,
    DAY_MIN_READINGS,
    HOURLY_FIELDS,
    INDEX_POLLUTANTS,
    SHORT_HOURS,
    SHORT_MIN_READINGS,
)

FIELDS = list(HOURLY_FIELDS)
DAY_FIELDS = ["pm2_5", "pm10", "nitrogen_dioxide", "sulphur_dioxide"]
SHORT_FIELDS = ["carbon_monoxide", "ozone"]
BLOCK_HOURS = 31 * 24
HALO_HOURS = DAY_HOURS - 1
SUB_INDICES = [f"SI_{p}" for p in INDEX_POLLUTANTS]
INDEX_RESULT = ["station", "time", *INDEX_POLLUTANTS, "AQI_calc", "Dominant", "Bucket_calc"]


def hour_number(time: Column | str = "time") -> Column:
    """Hours since the start of 1970 on the clock of the session."""
    time = F.col(time) if isinstance(time, str) else time
    return F.datediff(F.to_date(time), F.lit("1970-01-01").cast("date")).cast("long") * 24 + F.hour(time)


def hour_start(number: Column) -> Column:
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(number / 24).cast("int"))
    in_day = F.make_dt_interval(F.lit(0), F.pmod(number, F.lit(24)).cast("int"))
    return (day.cast("timestamp_ntz") + in_day).cast("timestamp")


def one_per_hour(hourly: DataFrame, cols: Sequence[str] = FIELDS) -> DataFrame:
    """station, hour number and the largest readings; combined before its shuffle, so many of one hour are few rows."""
    return hourly.groupBy("station", hour_number().alias("hour")).agg(*(F.max(c).alias(c) for c in cols))


def flatten_hourly(payloads: DataFrame) -> DataFrame:
    """Objects of parallel arrays -> one row per station and hour; arrays are matched by position."""
    zipped = F.arrays_zip(*(F.col(f"hourly.{f}").alias(f) for f in ["time", *FIELDS]))
    return payloads.select(F.col("city").alias("station"), F.inline(zipped)).select(
        "station", F.to_timestamp("time", "yyyy-MM-dd'T'HH:mm").alias("time"), *FIELDS)


def nest_hourly(hourly: DataFrame) -> DataFrame:
    """The payload form of flat readings, one object per station and day, so arrays hold 24 hours at most."""
    hours = F.sort_array(F.collect_list(F.struct(F.date_format("time", "yyyy-MM-dd'T'HH:mm").alias("time"), *FIELDS)))
    return hourly.groupBy(F.col("station").alias("city"), F.to_date("time").alias("_day")).agg(hours.alias("_hours")) \
        .select("city", F.struct(*(F.col(f"_hours.{f}").alias(f) for f in ["time", *FIELDS])).alias("hourly"))


def station_spans(hourly: DataFrame) -> DataFrame:
    """First and last hour number of every station."""
    hour = hour_number()
    return hourly.groupBy("station").agg(F.min(hour).alias("first"), F.max(hour).alias("last"))


def densify_hours(hourly: DataFrame) -> DataFrame:
    """Every hour between a station's first and last; hours without a reading are rows of nulls."""
    hours = station_spans(hourly).select("station", F.explode(F.sequence("first", "last")).alias("_hour"))
    readings = hourly.select("station", hour_number().alias("_hour"), *FIELDS)
    return hours.join(readings, ["station", "_hour"], "left") \
        .select("station", hour_start(F.col("_hour")).alias("time"), *FIELDS)


def _blocks_of(first: Column, last: Column) -> Column:
    return F.explode(F.sequence(F.floor(first / BLOCK_HOURS), F.floor(last / BLOCK_HOURS))).alias("block")


def _slots(spans: DataFrame) -> DataFrame:
    """Empty hours of every block, with the hours before it that its frames look back to."""
    blocks = spans.select("station", "first", "last", _blocks_of(F.col("first"), F.col("last")))
    start = F.col("block") * BLOCK_HOURS
    hours = F.sequence(F.greatest("first", start - HALO_HOURS), F.least("last", start + BLOCK_HOURS - 1))
    return blocks.select("station", "block", F.explode(hours).alias("hour"), "first", "last")


def _placed_hours(hourly: DataFrame, spans: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per station, block and hour, halo included, without gaps.

    Slots and readings are brought together by block; the grouping by hour and all windows then find their rows
    in place.
    """
    slots = _slots(spans).withColumns({c: F.lit(None).cast("double") for c in cols})
    hour, no_span = F.col("hour"), F.lit(None).cast("long")
    readings = one_per_hour(hourly, cols).select(
        "station", _blocks_of(hour, hour + HALO_HOURS), "hour", no_span.alias("first"), no_span.alias("last"), *cols)
    placed = slots.unionByName(readings).repartition("station", "block")
    merged = placed.groupBy("station", "block", "hour").agg(*(F.max(c).alias(c) for c in ("first", "last", *cols)))
    return merged.filter(F.col("first").isNotNull())


def rolling_means(hourly: DataFrame, spans: DataFrame | None = None, cols: Sequence[str] = FIELDS) -> DataFrame:
    """Rolling means per station and hour, missing hours included -> station, time, first, last, and per column

    - `mean24_*`: mean of the last 24 hours, null below 16 readings (particulates, NO2, SO2),
    - `mean8_*`: mean of the last 8 hours, null below 6 readings, or before the 8th hour (CO, O3),
    - `max8_*`: highest `mean8_*` whose 8 hours lie inside the last 24.

    A frame is evaluated from scratch for every row, so only short ones are used: 24 hours are three sums of 8,
    17 windows are two overlapping runs of 9.
    """
    day, short = [c for c in DAY_FIELDS if c in cols], [c for c in SHORT_FIELDS if c in cols]
    hours = _placed_hours(hourly, station_spans(hourly) if spans is None else spans, cols)
    by_hour = Window.partitionBy("station", "block").orderBy("hour")
    eight, nine = by_hour.rowsBetween(1 - SHORT_HOURS, 0), by_hour.rowsBetween(-SHORT_HOURS, 0)

    sums = hours.withColumns(
        {f"sum_{c}": F.coalesce(F.sum(c).over(eight), F.lit(0.0)) for c in cols}
        | {f"n_{c}": F.count(c).over(eight) for c in cols})
    has_eight = F.col("hour") >= F.col("first") + SHORT_HOURS - 1
    means = sums.withColumns({
        f"mean8_{c}": F.when(has_eight & (F.col(f"n_{c}") >= SHORT_MIN_READINGS), F.col(f"sum_{c}") / F.col(f"n_{c}"))
        for c in short})

    def over_day(part: str) -> Column:
        return sum((F.lag(part, back, 0).over(by_hour) for back in range(SHORT_HOURS, DAY_HOURS, SHORT_HOURS)), F.col(part))

    totals = means.withColumns(
        {f"day_{part}_{c}": over_day(f"{part}_{c}") for part in ("sum", "n") for c in day}
        | {f"top_{c}": F.max(f"mean8_{c}").over(nine) for c in short})
    highest = totals.withColumns(
        {f"max8_{c}": F.greatest(f"top_{c}", F.lag(f"top_{c}", SHORT_HOURS).over(by_hour)) for c in short})
    in_own_block = F.floor(F.col("hour") / BLOCK_HOURS) == F.col("block")
    return highest.filter(in_own_block).select(
        "station", *(hour_start(F.col(c)).alias(n) for n, c in (("time", "hour"), ("first", "first"), ("last", "last"))),
        *(F.when(F.col(f"day_n_{c}") >= DAY_MIN_READINGS, F.col(f"day_sum_{c}") / F.col(f"day_n_{c}")).alias(f"mean24_{c}")
          for c in day),
        *(f"{kind}_{c}" for kind in ("mean8", "max8") for c in short))


def mean24(hourly: DataFrame) -> DataFrame:
    means = rolling_means(hourly, cols=DAY_FIELDS)
    return means.select("station", "time", *(round_rows(f"mean24_{c}", 1).alias(c) for c in DAY_FIELDS))


def mean8(hourly: DataFrame) -> DataFrame:
    return rolling_means(hourly, cols=SHORT_FIELDS).select("station", "time", *(f"mean8_{c}" for c in SHORT_FIELDS))


def max8(hourly: DataFrame) -> DataFrame:
    return rolling_means(hourly, cols=SHORT_FIELDS).select("station", "time", *(f"max8_{c}" for c in SHORT_FIELDS))


def index_inputs() -> dict[str, Column]:
    """Rolling means -> the seven concentrations: CO in mg, NH3 not measured, 24-hour means at 1 decimal."""
    levels = {HOURLY_FIELDS[c]: round_rows(f"mean24_{c}", 1) for c in DAY_FIELDS}
    levels["CO"] = round_rows("max8_carbon_monoxide * 0.001D", 2)
    levels["O3"] = round_rows("max8_ozone", 1)
    levels["NH3"] = F.lit(None).cast("double")
    return levels


def _indexed(means: DataFrame, parts: bool = False) -> DataFrame:
    """Index from the rolling means, only where a full day of hours precedes; `parts` adds the sub-indices."""
    full_day = F.col("time") >= F.col("first") + F.expr(f"INTERVAL {HALO_HOURS} HOURS")
    inputs = means.filter(full_day).select("station", "time", *(c.alias(p) for p, c in index_inputs().items()))
    return index_columns(inputs).select(*INDEX_RESULT, *(SUB_INDICES if parts else []))


def rolling_index(hourly: DataFrame) -> DataFrame:
    """Index of every station and hour, from the 24th hour of the station on."""
    return _indexed(rolling_means(hourly))


def latest_hours(past: DataFrame) -> DataFrame:
    """Per station its first hour and its latest one with a PM2.5 reading -> station, first, last."""
    hour = hour_number()
    return past.groupBy("station").agg(
        F.min(hour).alias("first"), F.max(F.when(F.col("pm2_5").isNotNull(), hour)).alias("last")
    ).filter(F.col("last").isNotNull())


def _recent_means(hourly: DataFrame, as_of: str) -> DataFrame:
    """Rolling means over the 47 hours per station that the last 24 windows can see, whatever the history.

    The hours wanted are listed and looked up by station and hour, so a station with a long history is spread
    over all tasks.
    """
    past = hourly.filter(F.col("time") <= F.lit(as_of).cast("timestamp"))
    earliest = F.greatest("first", F.col("last") - 2 * HALO_HOURS)
    spans = latest_hours(past).select("station", earliest.alias("first"), "last")
    wanted = spans.select("station", F.explode(F.sequence("first", "last")).alias("_hour"))
    recent = past.withColumn("_hour", hour_number()).join(wanted, ["station", "_hour"], "left_semi")
    return rolling_means(recent.select(*hourly.columns), spans)


def trend24(hourly: DataFrame, as_of: str) -> DataFrame:
    """Index of the 24 hours that end at each station's latest hour; hours before its 24th are left out."""
    return _indexed(_recent_means(hourly, as_of))


def latest_index(hourly: DataFrame, as_of: str) -> DataFrame:
    """Index of each station at its latest hour, and how it came about: the sub-indices.

    Stations with less than a day of hours are left out.
    """
    return _indexed(_recent_means(hourly, as_of).filter(F.col("time") == F.col("last")), parts=True)


def live_ranking(hourly: DataFrame, as_of: str) -> DataFrame:
    """Stations by their latest index, most polluted first; stations without one are left out."""
    latest = latest_index(hourly, as_of).filter(F.col("AQI_calc").isNotNull())
    ranked = with_rank(latest, "AQI_calc", ["station"])
    return ranked.select("rank", "station", "time", "AQI_calc", "Dominant").orderBy("rank")
