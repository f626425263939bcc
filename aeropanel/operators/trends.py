"""Rankings, trends, shares and period comparisons over the cleaned panel.

Every query groups before anything else, so Spark combines on the map side and a hot city costs
no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeropanel.functions.columns import between_dates, mean, mean_where, pct_change
from aeropanel.schema import MONTHS, POOR_OR_WORSE
from aeropanel.sources.tables import categories

Period = tuple[str, str]


def city_ranking(clean: DataFrame) -> DataFrame:
    return (
        clean.groupBy("City")
        .agg(mean("AQI", 1).alias("avg_aqi"), mean("PM25", 1).alias("avg_pm25"), F.count("*").alias("days"))
        .orderBy(F.desc("avg_aqi"), "City")
    )


def yearly(clean: DataFrame) -> DataFrame:
    return (
        clean.groupBy("Year")
        .agg(mean("AQI", 1).alias("avg_aqi"), F.countDistinct("City").alias("cities"))
        .orderBy("Year")
    )


def full_coverage(clean: DataFrame, n_years: int) -> DataFrame:
    """Cities with data in `n_years` different years."""
    return clean.groupBy("City").agg(F.countDistinct("Year").alias("years")).filter(F.col("years") == n_years) \
        .select("City").orderBy("City")


def yearly_fixed(clean: DataFrame, n_years: int) -> DataFrame:
    """Yearly mean over the cities of `full_coverage` only.

    The panel is reduced to one row per city and year before cities are chosen, so it is scanned
    once and never joined.
    """
    city_years = clean.groupBy("City", "Year").agg(F.sum("AQI").alias("total"), F.count("AQI").alias("n"))
    years_of_city = F.count("*").over(Window.partitionBy("City"))
    chosen = city_years.withColumn("years", years_of_city).filter(F.col("years") == n_years)
    return chosen.groupBy("Year").agg(F.round(F.sum("total") / F.sum("n"), 1).alias("avg_aqi")).orderBy("Year")


def monthly(clean: DataFrame) -> DataFrame:
    return (
        clean.groupBy("Month")
        .agg(mean("AQI", 1).alias("avg_aqi"), mean("PM25", 1).alias("avg_pm25"))
        .orderBy("Month")
    )


def seasonal(clean: DataFrame) -> DataFrame:
    return clean.groupBy("Season").agg(mean("AQI", 1).alias("avg_aqi")).orderBy(F.desc("avg_aqi"), "Season")


def share_of_total(col: str = "days") -> Column:
    """Percent of the total of `col`; for frames that are already one row per category or pollutant."""
    return F.round(F.col(col) * F.lit(100.0) / F.sum(col).over(Window.partitionBy()), 1)


def category_share(clean: DataFrame) -> DataFrame:
    """Days and share per recorded category; the share is of all rows, also those without a category."""
    counts = clean.groupBy("AQI_Bucket").agg(F.count("*").alias("days"))
    return (
        counts.withColumn("pct", share_of_total())
        .filter(F.col("AQI_Bucket").isNotNull())
        .orderBy(F.desc("days"), "AQI_Bucket")
    )


def ordered_categories(shares: DataFrame) -> DataFrame:
    """All categories in band order; those without days get zeros."""
    bands = categories(shares.sparkSession).select("ord", F.col("name").alias("AQI_Bucket"))
    return bands.join(shares, "AQI_Bucket", "left").fillna(0, ["days", "pct"]) \
        .select("ord", "AQI_Bucket", "days", "pct").orderBy("ord")


def city_month_matrix(clean: DataFrame, cities: Sequence[str]) -> DataFrame:
    """Mean index per city (rows) and month (columns Jan to Dec); empty months are null."""
    names = F.element_at(F.array(*map(F.lit, MONTHS)), F.col("Month"))
    return (
        clean.filter(F.col("City").isin(*cities))
        .withColumn("name", names)
        .groupBy("City").pivot("name", MONTHS).agg(mean("AQI", 0))
        .orderBy("City")
    )


def diagnose(clean: DataFrame, cities: Sequence[str]) -> DataFrame:
    columns = {"AQI": 1, "PM25": 1, "PM10": 1, "CO": 2, "NO2": 1, "SO2": 1}
    return (
        clean.filter(F.col("City").isin(*cities)).groupBy("City")
        .agg(*(mean(c, digits).alias(c.lower()) for c, digits in columns.items()))
        .orderBy("City")
    )


COMPARED = ["AQI", "PM25", "NO2"]


def in_either(base: Period, event: Period) -> Column:
    return between_dates(base) | between_dates(event)


def period_means(clean: DataFrame, base: Period, event: Period) -> DataFrame:
    """Mean of the compared columns per city in both periods; null where a city has no reading."""
    return clean.groupBy("City").agg(*(
        mean_where(between_dates(period), c, 1).alias(f"{c.lower()}_{name}")
        for c in COMPARED for name, period in (("base", base), ("event", event))))


def period_comparison(clean: DataFrame, base: Period, event: Period) -> DataFrame:
    """Cities with an index in both periods, largest drop first.

    Only the two periods are read; the change is taken from the rounded means.
    """
    means = period_means(clean.filter(in_either(base, event)), base, event)
    return (
        means.dropna(subset=["aqi_base", "aqi_event"])
        .withColumn("aqi_change_pct", pct_change(F.col("aqi_base"), F.col("aqi_event"), 1))
        .orderBy("aqi_change_pct", "City")
    )


def period_overall(clean: DataFrame, base: Period, event: Period) -> DataFrame:
    """Row-level means over the cities of `period_comparison` -> one row, with the number of cities.

    Sums and counts per city are enough, so the choice of cities needs no join back to the rows.
    """
    sums = clean.filter(in_either(base, event)).groupBy("City").agg(*(
        f(F.when(between_dates(period), F.col(c))).alias(f"{c}_{name}_{part}")
        for c in COMPARED for name, period in (("base", base), ("event", event))
        for part, f in (("sum", F.sum), ("n", F.count))))
    chosen = sums.filter((F.col("AQI_base_n") > 0) & (F.col("AQI_event_n") > 0))
    return chosen.agg(
        F.count("*").alias("cities"),
        *(F.round(F.sum(f"{c}_{name}_sum") / F.nullif(F.sum(f"{c}_{name}_n"), F.lit(0)), 1)
          .alias(f"{c.lower()}_{name}") for c in COMPARED for name in ("base", "event")))


def biggest_drops(comparison: DataFrame, k: int = 5) -> DataFrame:
    return comparison.select("City", "aqi_change_pct").orderBy("aqi_change_pct", "City").limit(k)


def national_mean(clean: DataFrame) -> DataFrame:
    return clean.agg(mean("AQI", 1).alias("avg_aqi"), mean("PM25", 1).alias("avg_pm25"))


def poor_or_worse(shares: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sum of the shown shares of the three worst categories, over everything or per group."""
    bad = F.when(F.col("AQI_Bucket").isin(*POOR_OR_WORSE), F.col("pct"))
    return shares.groupBy(*by).agg(F.round(F.sum(bad), 1).alias("poor_or_worse_pct"))
