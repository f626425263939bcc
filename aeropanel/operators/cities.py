"""Profiles of cities and regions.

Everything that is a mean or a count per city comes from one conditional aggregate over the panel; only
the extreme days need a second, narrow one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeropanel.functions.columns import between_dates, count_where, mean, mean_where, nice_date, pct_change
from aeropanel.operators.ranking import with_rank
from aeropanel.operators.trends import COMPARED, Period
from aeropanel.schema import CATEGORY_NAMES, PROFILE_POLLUTANTS, SEASONS, display_name


def city_rank(clean: DataFrame) -> DataFrame:
    """Cities by their unrounded mean, equal ones by name -> City, rank."""
    means = clean.groupBy("City").agg(F.avg("AQI").alias("_mean"))
    return with_rank(means, "_mean", ["City"]).select("City", "rank")


def with_state(df: DataFrame, states: DataFrame) -> DataFrame:
    """Adds the state of each city, '' where it is not known; the lookup has one row per city."""
    return df.join(states.select("City", "State"), "City", "left") \
        .withColumn("State", F.coalesce("State", F.lit("")))


def _base() -> dict[str, Column]:
    return {
        "avg": mean("AQI", 1),
        "pm25": mean("PM25", 1),
        "days": F.count("*"),
        "first": F.min("Date"),
        "last": F.max("Date"),
    }


def _monthly() -> Column:
    return F.array(*(mean_where(F.col("Month") == m, "AQI", 0) for m in range(1, 13)))


def _season() -> Column:
    return F.array(*(mean_where(F.col("Season") == s, "AQI", 0) for s in SEASONS))


def _pollutants() -> Column:
    return F.struct(*(mean(p, 2 if p == "CO" else 1).alias(p) for p in PROFILE_POLLUTANTS))


def _buckets() -> Column:
    known = F.nullif(F.count("AQI_Bucket"), F.lit(0))
    return F.array(*(
        F.coalesce(F.round(count_where(F.col("AQI_Bucket") == name) * F.lit(100.0) / known, 1), F.lit(0.0))
        for name in CATEGORY_NAMES))


def _period(base: Period, event: Period) -> dict[str, Column]:
    return {f"{c.lower()}_{name}": mean_where(between_dates(p), c, 1)
            for c in COMPARED for name, p in (("base", base), ("event", event))}


def _period_struct(prefix: str = "") -> Column:
    """Struct of a city's two periods, null when either has no index."""
    col = lambda name: F.col(prefix + name)
    pair = lambda c: F.array(col(f"{c}_base"), col(f"{c}_event")).alias(c)
    change = pct_change(col("aqi_base"), col("aqi_event"), 1).alias("change_pct")
    known = col("aqi_base").isNotNull() & col("aqi_event").isNotNull()
    return F.when(known, F.struct(pair("aqi"), change, pair("pm25"), pair("no2")))


def city_base(clean: DataFrame) -> DataFrame:
    return clean.groupBy("City").agg(*(c.alias(n) for n, c in _base().items()))


def city_monthly_array(clean: DataFrame) -> DataFrame:
    """City, monthly: 12 means, null where a month has no data."""
    return clean.groupBy("City").agg(_monthly().alias("monthly"))


def city_season_array(clean: DataFrame) -> DataFrame:
    """City, season: means in the order Winter, Summer, Monsoon, Post-Monsoon."""
    return clean.groupBy("City").agg(_season().alias("season"))


def city_pollutants(clean: DataFrame) -> DataFrame:
    """City, pollutants: struct of the six mean levels."""
    return clean.groupBy("City").agg(_pollutants().alias("pollutants"))


def pollutants_long(city_levels: DataFrame) -> DataFrame:
    """City, pollutant, mean."""
    rows = F.array(*(F.struct(F.lit(display_name(p)).alias("pollutant"), F.col(f"pollutants.{p}").alias("mean"))
                     for p in PROFILE_POLLUTANTS))
    return city_levels.select("City", F.inline(rows))


def city_category_share(clean: DataFrame) -> DataFrame:
    """City, buckets: percent of the days with a category, in band order, 0 when absent."""
    return clean.groupBy("City").agg(_buckets().alias("buckets"))


def category_share_long(shares: DataFrame) -> DataFrame:
    """City, ord, AQI_Bucket, pct."""
    rows = F.array(*(F.struct(F.lit(i + 1).alias("ord"), F.lit(name).alias("AQI_Bucket"), F.get("buckets", F.lit(i)).alias("pct"))
                     for i, name in enumerate(CATEGORY_NAMES)))
    return shares.select("City", F.inline(rows))


def city_yearly(clean: DataFrame) -> DataFrame:
    """City, yearly: array of (Year, mean) over the years with data; as long as the years, not the rows."""
    years = clean.groupBy("City", "Year").agg(mean("AQI", 0).alias("mean"))
    return years.groupBy("City").agg(F.sort_array(F.collect_list(F.struct("Year", "mean"))).alias("yearly"))


def city_extremes(clean: DataFrame) -> DataFrame:
    """City, worst_day, worst_aqi, best_aqi; of equal worst days the earliest."""
    # dates by city and value first: both steps combine in hash tables, a minimum of structs would sort the rows
    first = clean.groupBy("City", "AQI").agg(F.min("Date").alias("_first"))
    return first.groupBy("City").agg(
        F.max_by("_first", "AQI").alias("worst_day"), F.max("AQI").alias("worst_aqi"), F.min("AQI").alias("best_aqi"))


def city_period(clean: DataFrame, base: Period, event: Period) -> DataFrame:
    """City, period: struct of both periods, null when one has no index; all cities are kept."""
    means = clean.groupBy("City").agg(*(c.alias(n) for n, c in _period(base, event).items()))
    return means.select("City", _period_struct().alias("period"))


def region_rollup(base: DataFrame, regions: DataFrame) -> DataFrame:
    """Region, cities, avg: plain mean of the rounded city means, not weighted by days."""
    return (
        base.select("City", "avg").join(regions.select("City", "Region"), "City")
        .groupBy("Region").agg(F.count("*").alias("cities"), F.round(F.avg("avg"), 1).alias("avg"))
        .orderBy(F.desc("avg"), "Region")
    )


def city_profiles(clean: DataFrame, states: DataFrame, base: Period, event: Period) -> DataFrame:
    """The whole profile, one row per city, from four aggregates; `clean` is best a table, as each reads it once."""
    parts = clean.groupBy("City").agg(
        *(c.alias(n) for n, c in _base().items()),
        _monthly().alias("monthly"), _season().alias("season"), _pollutants().alias("pollutants"),
        _buckets().alias("buckets"), *(c.alias(f"_{n}") for n, c in _period(base, event).items()))
    joined = parts
    for more in (city_yearly(clean), city_extremes(clean), city_rank(clean)):
        joined = joined.join(more, "City")
    return with_state(joined, states).select(
        "City", F.col("State").alias("state"), "rank", "avg", "pm25", "days",
        nice_date("first").alias("first"), nice_date("last").alias("last"),
        "monthly", "season", "pollutants", "buckets", "yearly",
        nice_date("worst_day").alias("worst_day"), F.col("worst_aqi").cast("int").alias("worst_aqi"),
        F.col("best_aqi").cast("int").alias("best_aqi"), _period_struct("_").alias("period"))


def extreme_months(monthly: DataFrame, by: Sequence[str] = (), value: str = "avg_aqi") -> DataFrame:
    """Worst and cleanest month from monthly means, the first month when equal, per group or overall."""
    by_month = F.array(*(F.max(F.when(F.col("Month") == m, F.col(value))) for m in range(1, 13)))
    found = monthly.filter(F.col(value).isNotNull()).groupBy(*by).agg(by_month.alias("_m"))
    month_of = lambda extreme: F.array_position("_m", extreme("_m")).cast("int")
    return found.select(*by, month_of(F.array_max).alias("worst_month"), month_of(F.array_min).alias("cleanest_month"))


def city_months(clean: DataFrame) -> DataFrame:
    """City, Month, avg_aqi as a whole number, the base of `extreme_months` per city."""
    return clean.groupBy("City", "Month").agg(mean("AQI", 0).alias("avg_aqi"))


def limit_exceedance(levels: DataFrame, limits: DataFrame) -> DataFrame:
    """Mean level against the limit -> City, pollutant, mean, limit, unit, ratio, over; no reading is not over."""
    return levels.join(limits, "pollutant").select(
        "City", "pollutant", "mean", "limit", "unit",
        (F.col("mean") / F.col("limit")).alias("ratio"),
        F.coalesce(F.col("mean") > F.col("limit"), F.lit(False)).alias("over"))


def period_changes(overall: DataFrame) -> DataFrame:
    """Whole-percent change of each compared column -> measure, before, after, change_pct."""
    rows = F.array(*(
        F.struct(F.lit(display_name(c)).alias("measure"), F.col(f"{c.lower()}_base").alias("before"),
                 F.col(f"{c.lower()}_event").alias("after")) for c in COMPARED))
    return overall.select(F.inline(rows)).withColumn("change_pct", pct_change(F.col("before"), F.col("after")))
