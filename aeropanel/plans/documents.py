"""Nested documents of the results: one row each, put together from scalar subqueries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeropanel.functions.columns import count_where, mean, mean_where, nice_date
from aeropanel.operators import cities, stats, trends
from aeropanel.operators.trends import Period
from aeropanel.schema import CATEGORY_NAMES, SEASONS


def as_struct(one_row: DataFrame) -> Column:
    """A one-row frame as a struct value."""
    return one_row.select(F.struct(*one_row.columns)).scalar()


def as_list(rows: DataFrame, *cols: str, largest_first: bool = False) -> Column:
    """A short result as an array of structs, ordered by `cols`; only for results with a fixed number of rows."""
    listed = F.sort_array(F.collect_list(F.struct(*cols)), asc=not largest_first)
    return rows.agg(listed).scalar()


def _whole(value: Column) -> Column:
    """The shown mean has one decimal first, then none."""
    return F.round(value)


def _panel_overview(clean: DataFrame) -> DataFrame:
    """Everything of the overview that is a mean or a count of the cleaned panel, in one pass."""
    share = lambda name: F.round(
        count_where(F.col("AQI_Bucket") == name) * F.lit(100.0) / F.nullif(F.count("*"), F.lit(0)), 1)
    return clean.agg(
        F.count("*").alias("clean_records"),
        mean("AQI", 1).alias("avg_aqi"), mean("PM25", 1).alias("avg_pm25"),
        F.array(*(_whole(mean_where(F.col("Month") == m, "AQI", 1)) for m in range(1, 13))).alias("monthly"),
        F.struct(*(_whole(mean_where(F.col("Season") == s, "AQI", 1)).alias(s) for s in SEASONS)).alias("season"),
        F.array(*(share(n) for n in CATEGORY_NAMES)).alias("buckets"))


def _period_document(clean: DataFrame, base: Period, event: Period) -> DataFrame:
    overall = trends.period_overall(clean, base, event)
    drops = trends.biggest_drops(trends.period_comparison(clean, base, event))
    pair = lambda c: F.array(f"{c}_base", f"{c}_event").alias(c)
    return overall.select("cities", pair("aqi"), pair("pm25"), pair("no2"),
                          as_list(drops, "aqi_change_pct", "City").alias("biggest_drops"))


def overview_document(
    raw_overview: DataFrame, clean: DataFrame, regions: DataFrame, base: Period, event: Period, nulls: stats.Nulls = "skip",
) -> DataFrame:
    """National overview -> one row; `raw_overview` is that of `profile`.

    Its parts read the cleaned panel several times, each only some columns: hand over a table, not a computation.
    """
    source = raw_overview.select(
        F.col("rows").alias("records"), "cities", nice_date("start").alias("start"), nice_date("end").alias("end"))
    return clean.sparkSession.range(1).select(
        as_struct(source).alias("source"),
        as_struct(_panel_overview(clean)).alias("panel"),
        as_struct(_period_document(clean, base, event)).alias("period"),
        as_list(stats.corr_with_target(clean, nulls), "corr", "pollutant", largest_first=True).alias("correlation"),
        as_list(cities.region_rollup(cities.city_base(clean), regions), "avg", "Region", "cities",
                largest_first=True).alias("regions"),
    ).select("source.*", "panel.*", "period", "correlation", "regions")


def dashboard_document(
    overview: DataFrame, check: DataFrame, dominant: DataFrame, model: DataFrame | None = None,
) -> DataFrame:
    """Summary of everything -> one row of structs.

    City profiles are not part of it: their number grows with the data, so they stay a table of one document
    per city next to it.
    """
    spark = overview.sparkSession
    parts = [
        F.lit(f"Apache Spark {spark.version}").alias("generated_by"),
        as_struct(overview).alias("overview"),
        as_struct(check).alias("daily_check"),
        as_list(dominant, "days", "Dominant", "pct", largest_first=True).alias("dominant"),
    ]
    if model is not None:
        parts.append(as_struct(model).alias("model"))
    return spark.range(1).select(*parts)
