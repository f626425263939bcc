"""Profiles of the raw panel, each in one pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeropanel.functions.columns import count_where
from aeropanel.operators.clean import dedup_city_day, with_date, with_numbers
from aeropanel.schema import MAX_TARGET, POLLUTANTS
from aeropanel.sources.tables import literal_rows


def null_profile(df: DataFrame) -> DataFrame:
    """Percent of missing values per column -> column, missing_pct."""
    filled = df.agg(F.count("*").alias("rows"), F.array(*(F.count(F.col(f"`{c}`")) for c in df.columns)).alias("filled"))
    return _missing(filled, df.columns)


def _missing(filled: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row and value counts (rows, filled) -> column, missing_pct."""
    names = F.array(*(F.lit(c) for c in columns))
    pairs = filled.select("rows", F.inline(F.arrays_zip(names.alias("column"), F.col("filled").alias("n"))))
    return pairs.select("column", F.round((F.col("rows") - F.col("n")) * F.lit(100.0) / F.nullif("rows", F.lit(0)), 2).alias("missing_pct"))


def overview(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("rows"),
        F.lit(len(df.columns)).alias("cols"),
        F.countDistinct("City").alias("cities"),
        F.min("Date").alias("start"),
        F.max("Date").alias("end"),
    )


def lost_values(df: DataFrame, numbers: Sequence[str] = (*POLLUTANTS, "AQI")) -> DataFrame:
    """Text that could not be read, per column -> column, lost; negative readings are not among it."""
    kinds = {"Date": "DATE"} | {c: "DOUBLE" for c in numbers}
    lost = {c: F.count_if(F.col(f"`{c}`").isNotNull() & F.expr(f"TRY_CAST(`{c}` AS {kind})").isNull()) for c, kind in kinds.items()}
    counts = df.agg(*(n.alias(c) for c, n in lost.items()))
    return counts.unpivot([], [F.col(f"`{c}`") for c in kinds], "column", "lost")


@dataclass(frozen=True)
class RawProfile:
    """What is known of the raw rows after one pass; each frame holds a few literal rows."""

    missing: DataFrame
    overview: DataFrame
    rows: int


def raw_profile(raw: DataFrame) -> RawProfile:
    """Null profile, overview and row count from one pass over the raw rows."""
    spark, date = raw.sparkSession, F.expr("TRY_CAST(Date AS DATE)")
    seen = raw.agg(
        F.count("*").alias("rows"), F.array(*(F.count(F.col(f"`{c}`")) for c in raw.columns)).alias("filled"),
        F.countDistinct("City").alias("cities"), F.min(date).alias("start"), F.max(date).alias("end")).first()
    one = literal_rows(spark, [(seen.rows, seen.filled)], "rows long, filled array<long>")
    shown = literal_rows(spark, [(seen.rows, len(raw.columns), seen.cities, seen.start, seen.end)],
                         "rows long, cols int, cities long, start date, end date")
    return RawProfile(_missing(one, raw.columns), shown, seen.rows)


def funnel_of(unique: DataFrame, raw_rows: int) -> DataFrame:
    """The cleaning funnel from the panel without copies and the number of raw rows; no shuffle of rows."""
    return _funnel(unique, F.lit(raw_rows).cast("long"))


def cleaning_funnel(raw: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """Rows left after each cleaning step -> step, name, rows; the steps share one pass after the raw count."""
    dated = with_numbers(with_date(raw))
    if order_by:
        dated = dated.select("City", "Date", "AQI", *(c for c in order_by if c not in ("City", "Date", "AQI")))
    return _funnel(dedup_city_day(dated, order_by), raw.agg(F.count("*")).scalar())


def _funnel(per_day: DataFrame, raw_rows: Column) -> DataFrame:
    target = F.col("AQI")
    kept = per_day.agg(
        F.count("*").alias("deduplicated"),
        F.count("AQI").alias("with_target"),
        count_where((target > 0) & (target <= MAX_TARGET)).alias("in_range"),
    )
    names = ["raw", "deduplicated", "with_target", "in_range"]
    counts = kept.select(raw_rows.alias("raw"), *names[1:])
    steps = F.array(*(F.struct(F.lit(i).alias("step"), F.lit(n).alias("name"), F.col(n).alias("rows"))
                      for i, n in enumerate(names)))
    return counts.select(F.inline(steps))
