"""Questions about single days, months and years of the indexed panel."""

from __future__ import annotations

import calendar as months_of
import datetime
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeropanel.functions.columns import count_where
from aeropanel.operators.daily_index import recomputed, stored_form
from aeropanel.operators.ranking import with_rank
from aeropanel.schema import MONTHS
from aeropanel.session import scratch_path

POOR_FROM = 200  # fixed value: an index above this is Poor or worse


def _on(date: str):
    return F.col("Date") == F.lit(date).cast("date")


def busiest_date(daily: DataFrame) -> DataFrame:
    """Date with an index for most cities, the latest when equal -> Date, cities."""
    return daily.groupBy("Date").agg(F.count("AQI_calc").alias("cities")) \
        .orderBy(F.desc("cities"), F.desc("Date")).limit(1)


def _everywhere(daily: DataFrame, cities: DataFrame | None) -> DataFrame:
    """The list of cities; given as raw rows or any other, it spares a removal of copies."""
    return (daily if cities is None else cities).select("City").distinct()


def day_snapshot(daily: DataFrame, date: str, cities: DataFrame | None = None) -> DataFrame:
    """Every city on one day: rank, City, index, recorded, Dominant, has_row, and the index computed again.

    Only cities with an index are ranked; the others follow without a rank, those without a row last. `recalculated`
    is the index from the readings at their published precision, `match` whether it is the published one.
    `cities` are rows with all cities; without them the list is taken from the panel.
    """
    on_day = daily.filter(_on(date))
    again = recomputed(stored_form(on_day)).select(F.col("City").alias("_city"), "recalculated", "match")
    shown = on_day.select("City", "AQI_calc", "AQI", "Bucket_calc", "Dominant", F.lit(True).alias("has_row"))
    shown = shown.join(again, F.col("City") == F.col("_city")).drop("_city")
    # a row per city, written once for the ranked and the other ones
    path = scratch_path(daily.sparkSession, "snapshot")
    shown.write.parquet(path)
    shown = daily.sparkSession.read.parquet(path)
    ranked = with_rank(shown.filter(F.col("AQI_calc").isNotNull()), "AQI_calc", ["City"])
    unranked = shown.filter(F.col("AQI_calc").isNull()).withColumn("rank", F.lit(None).cast("int"))
    rows = ranked.unionByName(unranked)
    return (
        _everywhere(daily, cities).join(rows, "City", "left")
        .withColumn("has_row", F.coalesce("has_row", F.lit(False)))
        .orderBy(F.col("rank").asc_nulls_last(), F.desc("has_row"), "City")
    )


def day_summary(daily: DataFrame, date: str) -> DataFrame:
    """One day over all cities; of equal cities the first name is most polluted, the last one cleanest.

    `reconciled` counts the cities whose index is the same when it is computed again from the published readings.
    """
    worst = F.min(F.struct((-F.col("AQI_calc")).alias("key"), "City"))
    cleanest = F.max(F.struct((-F.col("AQI_calc")).alias("key"), "City"))
    on_day = daily.filter(_on(date) & F.col("AQI_calc").isNotNull())
    matching = recomputed(stored_form(on_day)).agg(count_where(F.col("match")).alias("reconciled"))
    found = on_day.agg(
        F.count("*").alias("reporting"), F.round(F.avg("AQI_calc")).alias("mean"),
        worst.alias("_w"), cleanest.alias("_c"),
        count_where(F.col("AQI_calc") > POOR_FROM).alias("poor_or_worse"))
    return found.select(
        "reporting", "mean", F.col("_w.City").alias("worst_city"), F.negative("_w.key").alias("worst_aqi"),
        F.col("_c.City").alias("cleanest_city"), F.negative("_c.key").alias("cleanest_aqi"), "poor_or_worse",
        matching.scalar().alias("reconciled"))


def month_grid(daily: DataFrame, year: int, month: int, cities: DataFrame | None = None) -> DataFrame:
    """City (rows) by day of the month (columns d1 to d31): the computed index, null where there is none.

    `cities` are rows with all cities; without them the list is taken from the panel.
    """
    days = months_of.monthrange(year, month)[1]
    first, last = datetime.date(year, month, 1), datetime.date(year, month, days)
    in_month = daily.filter(F.col("Date").between(F.lit(first), F.lit(last)))
    grid = in_month.groupBy("City").agg(*(
        F.max(F.when(F.dayofmonth("Date") == d, F.col("AQI_calc"))).alias(f"d{d}") for d in range(1, days + 1)))
    return _everywhere(daily, cities).join(grid, "City", "left").orderBy("City")


def year_calendar(
    daily: DataFrame, city: str, year: int, value: Literal["calculated", "recorded"] = "calculated",
) -> DataFrame:
    """Month (rows) by day (columns d1 to d31) of one city and year; all 12 months are rows."""
    shown = F.col("AQI_calc" if value == "calculated" else "AQI")
    in_year = daily.filter((F.col("City") == city) & F.col("Date").between(
        F.lit(datetime.date(year, 1, 1)), F.lit(datetime.date(year, 12, 31))))
    by_month = in_year.groupBy(F.month("Date").alias("Month")).agg(*(
        F.max(F.when(F.dayofmonth("Date") == d, shown)).alias(f"d{d}") for d in range(1, 32)))
    spine = daily.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("Month"))
    named = spine.withColumn("name", F.get(F.array(*map(F.lit, MONTHS)), F.col("Month") - 1))
    return named.join(by_month, "Month", "left").orderBy("Month")


def city_year_days(daily: DataFrame) -> DataFrame:
    """City, Year, days: days with a computed index, years without any left out."""
    return daily.groupBy("City", F.year("Date").alias("Year")).agg(F.count("AQI_calc").alias("days")) \
        .filter(F.col("days") > 0)


def fullest_year(daily: DataFrame) -> DataFrame:
    """City, Year, days of the year with most days, the latest when equal."""
    years = city_year_days(daily).groupBy("City", "days").agg(F.max("Year").alias("Year"))
    return years.groupBy("City").agg(F.max_by("Year", "days").alias("Year"), F.max("days").alias("days"))


def city_year_stats(stored: DataFrame) -> DataFrame:
    """Per city and year, from the stored form: days with an index, mean, worst and cleanest day, reconciled days.

    Of equal days the earliest is named. Rows whose index is recomputed exactly are the reconciled ones.
    """
    # by value first, so that both steps combine in hash tables; the index is whole, so the mean stays exact
    by_value = recomputed(stored).groupBy("City", F.year("Date").alias("Year"), "AQI_calc").agg(
        F.count("*").alias("_n"), F.min("Date").alias("_first"), count_where(F.col("match")).alias("_match"))
    calc, n = F.col("AQI_calc"), F.col("_n")
    days = F.sum(F.when(calc.isNotNull(), n).otherwise(F.lit(0)))
    return by_value.groupBy("City", "Year").agg(
        F.sum(n).alias("rows"), days.alias("days"), F.round(F.sum(calc * n) / F.nullif(days, F.lit(0))).alias("mean"),
        F.max("AQI_calc").alias("worst_aqi"), F.max_by("_first", "AQI_calc").alias("worst_day"),
        F.min("AQI_calc").alias("cleanest_aqi"), F.min_by("_first", "AQI_calc").alias("cleanest_day"),
        F.sum("_match").alias("reconciled"))


def lookup(daily: DataFrame, city: str, date: str) -> DataFrame:
    """One city-day; both filters reach the scan, and a city filter prunes a panel partitioned by City."""
    return daily.filter((F.col("City") == city) & _on(date))
