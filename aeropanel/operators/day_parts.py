"""Sums and counts of the feeds of a panel, kept per feed and merged, so that a new day does not read the old ones.

A feed is a set of whole days with a name: the years so far, a month, or the day that came in last. Its part has a row per
city and year with what rankings, yearly means, city profiles and the overview are made of: row counts, sums with their
counts, and first and last dates. Parts merge by adding, and as the city is a key of a part, numbers of distinct cities stay
exact. A part is one folder that is replaced as a whole, so a feed that is delivered again, or a job that is run twice,
counts once. `fold` merges the parts of many days into one.

Feeds must not share a day, because copies are removed within a day and so within a feed. Rows without a date belong to the
feed they come in, rows without a city count as rows but not as cities, and a feed without rows has an empty part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeropanel.operators import clean as cleaning
from aeropanel.schema import DAILY_OUTPUT

MEASURED = ("AQI", "PM25")
ADDED = ("raw_rows", "days", *(f"{kind}_{c}" for c in MEASURED for kind in ("n", "sum")))
LOWEST, HIGHEST = ("raw_first", "first"), ("raw_last", "last")


def feed_part(raw: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """City, year, counts, sums and dates of a feed's raw rows; `year` is null for what is counted before cleaning."""
    seen = cleaning.with_date(raw).groupBy("City").agg(
        F.count("*").alias("raw_rows"), F.min("Date").alias("raw_first"), F.max("Date").alias("raw_last"))
    kept = cleaning.clean(raw, order_by).groupBy("City", F.col("Year").alias("year")).agg(
        F.count("*").alias("days"), *(f(c).alias(f"{kind}_{c}") for c in MEASURED for kind, f in (("n", F.count), ("sum", F.sum))),
        F.min("Date").alias("first"), F.max("Date").alias("last"))
    return seen.unionByName(kept, allowMissingColumns=True)


def merged(parts: DataFrame, *keys: str) -> DataFrame:
    """Parts added up by `keys`; the result has the columns of a part but for other keys, and merges again."""
    return parts.groupBy(*keys).agg(
        *(F.sum(c).alias(c) for c in ADDED), *(F.min(c).alias(c) for c in LOWEST), *(F.max(c).alias(c) for c in HIGHEST))


def add_feed(raw: DataFrame, path: str, feed: str, order_by: Sequence[str] | None = None) -> None:
    """Writes a feed's part in place of what had its name; other parts are neither read nor touched."""
    # a row per city and year: few rows, so one file
    feed_part(raw, order_by).coalesce(1).write.mode("overwrite").parquet(f"{path}/feed={feed}")


def read_parts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def fold(spark: SparkSession, path: str, to: str, feed: str) -> None:
    """Merges all parts below `path` into one, in another place, to which later feeds are added."""
    merged(read_parts(spark, path), "City", "year").coalesce(1).write.mode("overwrite").parquet(f"{to}/feed={feed}")


def overview(parts: DataFrame, n_columns: int) -> DataFrame:
    """As `profile.overview` of the raw rows."""
    by_city = merged(parts.filter("raw_rows IS NOT NULL"), "City")
    return by_city.agg(
        F.coalesce(F.sum("raw_rows"), F.lit(0).cast("long")).alias("rows"), F.lit(n_columns).alias("cols"),
        F.count("City").alias("cities"), F.min("raw_first").alias("start"), F.max("raw_last").alias("end"))


def yearly(parts: DataFrame) -> DataFrame:
    """As `trends.yearly` of the cleaned panel."""
    city_years = merged(parts.filter("year IS NOT NULL"), "City", "year")
    return city_years.groupBy(F.col("year").alias("Year")).agg(
        F.round(F.sum("sum_AQI") / F.sum("n_AQI"), 1).alias("avg_aqi"), F.count("City").alias("cities")).orderBy("Year")


def city_base(parts: DataFrame) -> DataFrame:
    """As `cities.city_base` of the cleaned panel."""
    by_city = merged(parts.filter("year IS NOT NULL"), "City")
    mean = lambda c: F.round(F.try_divide(f"sum_{c}", f"n_{c}"), 1)
    return by_city.select("City", mean("AQI").alias("avg"), mean("PM25").alias("pm25"), "days", "first", "last")


def city_ranking(parts: DataFrame) -> DataFrame:
    """As `trends.city_ranking` of the cleaned panel."""
    return city_base(parts).select("City", F.col("avg").alias("avg_aqi"), F.col("pm25").alias("avg_pm25"), "days") \
        .orderBy(F.desc("avg_aqi"), "City")


def full_coverage(parts: DataFrame, n_years: int) -> DataFrame:
    """As `trends.full_coverage` of the cleaned panel."""
    city_years = parts.filter("year IS NOT NULL").groupBy("City", "year").agg(F.sum("days").alias("days"))
    return city_years.groupBy("City").agg(F.count("*").alias("years")).filter(F.col("years") == n_years).select("City").orderBy("City")


def replace_years(daily: DataFrame, path: str) -> None:
    """Writes whole years of the indexed panel into folders by city and year, in place of what these held.

    A day is added by computing its year anew; other years are neither read nor touched, and running it again changes nothing.
    """
    out = daily.select(*DAILY_OUTPUT, F.year("Date").alias("year"))
    out.hint("rebalance", "City", "year").sortWithinPartitions("City", "year", "Date").write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy("City", "year").parquet(path)


def read_years(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).select(*DAILY_OUTPUT)
