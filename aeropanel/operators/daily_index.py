"""The index computed from concentrations, day by day, and its checks against the recorded index."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeropanel.functions.columns import (
    category,
    category_or_none,
    count_where,
    dominant,
    index_value,
    round_rows,
    sub_index,
    whole,
)
from aeropanel.operators.clean import null_negatives, one_per_day
from aeropanel.operators.selection import sample_exactly
from aeropanel.operators.trends import share_of_total
from aeropanel.schema import CATEGORIES, DAILY_OUTPUT, INDEX_POLLUTANTS, display_name

MISSING = -1e6


def _gap() -> Column:
    return F.col("AQI").isNull() & F.col("AQI_calc").isNotNull()


def _both() -> Column:
    return F.col("AQI").isNotNull() & F.col("AQI_calc").isNotNull()


def index_columns(df: DataFrame) -> DataFrame:
    """Adds SI_*, AQI_calc, Dominant and Bucket_calc to rows that hold the seven concentrations."""
    # The JVM compiles no method over 8000 bytes, and Spark makes one of this whole stage. Values that cannot be
    # null need far less code: a large negative level stands for a missing one; its sub-index is below -1 on every slope, so it is never the largest.
    levels = df.withColumns({f"_{p}": F.coalesce(p, F.lit(MISSING)) for p in INDEX_POLLUTANTS})
    lines = levels.withColumns({f"_{p}": sub_index(f"_{p}", p) for p in INDEX_POLLUTANTS})
    rounded = F.array(*(whole(F.col(f"_{p}")) for p in INDEX_POLLUTANTS))
    with_index = lines.withColumn("_rounded", rounded).withColumn("AQI_calc", index_value(F.col("_rounded")))
    calc = F.col("AQI_calc")
    return with_index.withColumns(
        {f"SI_{p}": F.when(F.col(p).isNotNull(), F.col(f"_{p}")) for p in INDEX_POLLUTANTS}
        | {"Dominant": dominant(F.col("_rounded"), calc), "Bucket_calc": category("AQI_calc")},
    ).drop("_rounded", *(f"_{p}" for p in INDEX_POLLUTANTS))


def index_of(rows: DataFrame) -> DataFrame:
    """Index of any concentration rows; columns the rows lack count as not measured."""
    absent = {p: F.lit(None).cast("double") for p in INDEX_POLLUTANTS if p not in rows.columns}
    return index_columns(null_negatives(rows.withColumns(absent) if absent else rows, INDEX_POLLUTANTS))


def daily_index(raw: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """Index of every city-day, also those without a recorded one."""
    return daily_rows(one_per_day(raw, order_by))


def daily_rows(unique: DataFrame) -> DataFrame:
    """The index columns once the copies are gone; no shuffle."""
    return index_columns(null_negatives(unique, INDEX_POLLUTANTS))


def to_long(df: DataFrame, keys: Sequence[str] = ("City", "Date")) -> DataFrame:
    """One row per measured concentration -> keys, pollutant, level."""
    return (
        df.select(*keys, *INDEX_POLLUTANTS)
        .unpivot(list(keys), INDEX_POLLUTANTS, "pollutant", "level")
        .filter(F.col("level").isNotNull())
    )


def sub_index_long(readings: DataFrame, breakpoints: DataFrame) -> DataFrame:
    """Sub-index of long-form readings by a range join with the breakpoint table.

    The pollutant is an equality key, so the band test is only a residual condition of a hash join.
    A breakpoint table of literal rows is broadcast by Spark's own rule.
    """
    lowest = F.min("band").over(Window.partitionBy("pollutant"))
    highest = F.max("band").over(Window.partitionBy("pollutant"))
    bands = breakpoints.withColumns({"lowest": lowest, "highest": highest})
    r, b = readings.alias("r"), bands.alias("b")
    level = F.col("r.level")
    inside = (
        (F.col("r.pollutant") == F.col("b.pollutant"))
        & ((level > F.col("b.c_lo")) | (F.col("b.band") == F.col("b.lowest")))
        & ((level <= F.col("b.c_hi")) | (F.col("b.band") == F.col("b.highest")))
    )
    line = F.col("i_lo") + (level - F.col("c_lo")) * (F.col("i_hi") - F.col("i_lo")) / (F.col("c_hi") - F.col("c_lo"))
    return r.join(b, inside).select("r.*", line.alias("sub_index"))


def index_check(daily: DataFrame) -> DataFrame:
    """Coverage of the computed index and its agreement with the recorded one -> one row.

    A day whose recorded category is missing counts as a mismatch.
    """
    same = F.coalesce((F.col("AQI_Bucket") == F.col("Bucket_calc")).cast("double"), F.lit(0.0))
    return daily.agg(
        F.count("*").alias("total_days"),
        F.count("AQI_calc").alias("calculated_days"),
        F.count("AQI").alias("recorded_days"),
        count_where(_gap()).alias("gaps_filled"),
        count_where(_both()).alias("both_days"),
        F.round(F.avg(F.abs(F.col("AQI") - F.col("AQI_calc"))), 1).alias("mae"),
        F.round(F.avg(F.when(_both(), same)) * 100, 1).alias("bucket_match_pct"),
        F.round(F.corr("AQI", "AQI_calc"), 3).alias("corr"),
    )


def dominant_share(daily: DataFrame) -> DataFrame:
    """Days per dominant pollutant and their share of the days that have one."""
    counts = daily.groupBy("Dominant").agg(F.count("Dominant").alias("days"))
    return counts.withColumn("pct", share_of_total()).filter("days > 0").orderBy(F.desc("days"), "Dominant")


def recorded_vs_calculated(daily: DataFrame, fraction: float = 0.4, seed: int = 7, keys: Sequence[str] = ("City", "Date")) -> DataFrame:
    """A sample of exactly that part of the days that have both values, for a scatter plot."""
    return sample_exactly(daily.filter(_both()), keys, fraction, seed).select("AQI", "AQI_calc")


def daily_output(daily: DataFrame) -> DataFrame:
    return daily.select(*DAILY_OUTPUT).orderBy("City", "Date")


def gaps_filled(daily: DataFrame) -> DataFrame:
    """Days without a recorded index for which one could be computed."""
    return daily.filter(_gap())


def stored_form(daily: DataFrame) -> DataFrame:
    """The published precision: readings at 2 decimals, recorded and computed index whole."""
    return daily.select(
        "City", "Date",
        *(round_rows(p, 2).alias(p) for p in INDEX_POLLUTANTS),
        round_rows("AQI", 0).alias("AQI"), round_rows("AQI_calc", 0).alias("AQI_calc"),
    )


def recomputed(stored: DataFrame) -> DataFrame:
    """Adds the index computed again from the stored readings, and whether it is identical."""
    inputs = stored.select("City", "Date", *INDEX_POLLUTANTS, "AQI", F.col("AQI_calc").alias("stored_calc"))
    again = index_columns(inputs)
    return again.withColumnRenamed("AQI_calc", "recalculated").withColumnRenamed("stored_calc", "AQI_calc") \
        .withColumn("match", F.col("recalculated").eqNullSafe(F.col("AQI_calc")))


def reconcile(stored: DataFrame) -> DataFrame:
    """Stored index against the one recomputed from the stored readings -> one row of counts.

    `same` bands both numbers, unlike `index_check`, which uses the recorded category text.
    """
    return recomputed(stored).agg(
        F.count("*").alias("total"),
        count_where(F.col("match")).alias("match"),
        F.count("AQI_calc").alias("calc"),
        count_where(_gap()).alias("filled"),
        count_where(_both()).alias("both"),
        count_where(category("AQI") == category("AQI_calc")).alias("same"),
    )


def reconcile_tables(ours: DataFrame, theirs: DataFrame, cols: Sequence[str] = ("AQI", "AQI_calc"),
                     keys: Sequence[str] = ("City", "Date")) -> DataFrame:
    """Two stored panels against each other, row by row of a full outer join.

    A row per column of `cols`: total keys, rows only in ours and only in theirs, rows in both with equal values (two missing
    ones are equal), with a value missing on one side, and with different values; and `worst`, the largest difference. Keys
    match null-safely; a key should be in each panel once. Keys are dealt by all their columns, so no single one is hot.
    """
    def named(side: str, df: DataFrame) -> DataFrame:
        return df.select(*(F.col(k).alias(f"{side}_{k}") for k in keys), *(F.col(c).alias(f"{side}_{c}") for c in cols), F.lit(True).alias(side))

    same_key = reduce(lambda a, b: a & b, (F.col(f"ours_{k}").eqNullSafe(F.col(f"theirs_{k}")) for k in keys))
    joined = named("ours", ours).join(named("theirs", theirs), same_key, "full_outer")
    in_both = F.col("ours").isNotNull() & F.col("theirs").isNotNull()

    def judged(c: str) -> Column:
        a, b = F.col(f"ours_{c}"), F.col(f"theirs_{c}")
        return F.struct(
            F.lit(c).alias("column"), F.count("*").alias("total"),
            count_where(F.col("theirs").isNull()).alias("only_ours"), count_where(F.col("ours").isNull()).alias("only_theirs"),
            count_where(in_both & a.eqNullSafe(b)).alias("equal"), count_where(in_both & (a.isNull() != b.isNull())).alias("one_missing"),
            count_where(in_both & (a != b)).alias("different"), F.max(F.abs(a - b)).alias("worst"))

    return joined.agg(F.array(*(judged(c) for c in cols)).alias("found")).select(F.inline("found"))


def breakdown(daily: DataFrame) -> DataFrame:
    """How each day's index came about -> City, Date, pollutant, level, sub_index, is_dominant.

    One row per pollutant, measured or not.
    """
    parts = F.array(*(
        F.struct(
            F.lit(display_name(p)).alias("pollutant"),
            F.col(p).alias("level"),
            F.col(f"SI_{p}").alias("sub_index"),
            F.coalesce(F.col("Dominant") == display_name(p), F.lit(False)).alias("is_dominant"),
        ) for p in INDEX_POLLUTANTS))
    return daily.select("City", "Date", F.inline(parts))


def with_advice(df: DataFrame, col: str) -> DataFrame:
    """Adds the category of `col` and its health advice; a missing value gives "No AQI" and no advice."""
    name = category_or_none(col)
    advice = F.coalesce(*(F.when(F.col("category") == n, F.lit(text)) for _, n, _, text in CATEGORIES), F.lit(""))
    return df.withColumn("category", name).withColumn("advice", advice)


def band_table(breakpoints: DataFrame) -> DataFrame:
    """Concentration range of every category (rows) and pollutant (columns) as text; the last is open."""
    top = F.max("band").over(Window.partitionBy("pollutant"))
    lo, hi = (F.regexp_replace(F.col(c).cast("string"), r"\.0$", "") for c in ("c_lo", "c_hi"))
    text = F.when(F.col("band") == F.col("top"), F.concat(lo, F.lit("+"))).otherwise(F.concat_ws("–", lo, hi))
    names = F.element_at(F.array(*(F.lit(n) for _, n, _, _ in CATEGORIES)), F.col("band"))
    return (
        breakpoints.withColumn("top", top).withColumn("text", text).withColumn("category", names)
        .groupBy("band", "category").pivot("pollutant", INDEX_POLLUTANTS).agg(F.first("text"))
        .orderBy("band")
    )
