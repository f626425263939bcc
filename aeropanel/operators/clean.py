"""Cleaning steps of the daily panel, and the whole chain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeropanel.functions.columns import reading, season
from aeropanel.schema import MAX_TARGET, POLLUTANTS

CITY_DAY_KEY = ["City", "Date"]


def with_date(df: DataFrame) -> DataFrame:
    """Text that is no date becomes null."""
    return df.withColumn("Date", F.expr("TRY_CAST(Date AS DATE)"))


def with_numbers(df: DataFrame) -> DataFrame:
    """A target read as text becomes a number, or null if it is none."""
    if dict(df.dtypes).get("AQI") != "string":
        return df
    return df.withColumn("AQI", F.expr("TRY_CAST(AQI AS DOUBLE)"))


def dedup_city_day(df: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per city and day: the first one in the order of `order_by`.

    `order_by` should tell the copies apart; without it all other columns are the order, which is
    deterministic too but reads every column. Spark limits each group to one row before the shuffle
    (WindowGroupLimit), so even a city-day that holds a third of all rows sends one row per task.
    """
    order = list(order_by) if order_by else [c for c in df.columns if c not in CITY_DAY_KEY]
    by_order = Window.partitionBy(*CITY_DAY_KEY).orderBy(*(F.col(c).asc_nulls_last() for c in order))
    return df.withColumn("_copy", F.row_number().over(by_order)).filter("_copy = 1").drop("_copy")


def require(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNotNull())


def in_range(df: DataFrame, col: str, above: float, up_to: float) -> DataFrame:
    return df.filter((F.col(col) > above) & (F.col(col) <= up_to))


def null_negatives(df: DataFrame, cols: Sequence[str] = POLLUTANTS) -> DataFrame:
    return df.withColumns({c: reading(c) for c in cols})


def with_calendar(df: DataFrame) -> DataFrame:
    return df.withColumns({"Year": F.year("Date"), "Month": F.month("Date")})


def with_season(df: DataFrame) -> DataFrame:
    return df.withColumn("Season", season("Month"))


def one_per_day(raw: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """The typed panel both analyses start from; write it once when more than one is to be run."""
    return dedup_city_day(with_numbers(with_date(raw)), order_by)


def clean_rows(unique: DataFrame) -> DataFrame:
    """Cleaning steps after the copies are gone; no shuffle."""
    with_target = in_range(require(unique, "AQI"), "AQI", 0, MAX_TARGET)
    return with_season(with_calendar(null_negatives(with_target)))


def clean(raw: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """Panel for the analyses on the recorded index.

    Copies are removed before rows without a target, so a city-day whose first copy has no target is lost.
    """
    return clean_rows(one_per_day(raw, order_by))
