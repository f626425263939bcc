"""Consecutive ranks over all rows without one task that sorts them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeropanel.session import scratch_path

FEW_ROWS = 10_000


def with_rank(df: DataFrame, value: str, ties: Sequence[str], name: str = "rank", few: int = FEW_ROWS) -> DataFrame:
    """Adds ranks from 1 by falling `value`, equal values by `ties`; `value` must not be null.

    The rows are written first, so that they are computed once, and counted. Up to `few` of them are ranked in one window.

    More rows are cut into ranges of (value, ties) of about equal size, from bounds that Spark samples, so equal values are
    split too. A row's rank is its place in its range plus the rows of all ranges before; only the sizes of the ranges,
    one row per task, meet in one place. The ranges are written, as both steps must see the same ones.
    """
    order = [F.desc(value), *ties]
    path = scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    df = df.sparkSession.read.parquet(path)
    if df.count() <= few:
        return df.withColumn(name, F.row_number().over(Window.orderBy(*order)).cast("int"))
    path = scratch_path(df.sparkSession, "ranges")
    df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    ranged = df.sparkSession.read.parquet(path)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_range").agg(F.count("*").alias("_n")).select(
        F.col("_range").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    in_range = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    placed = ranged.join(starts, F.col("_range") == F.col("_of"))
    return placed.withColumn(name, (F.col("_before") + in_range).cast("int")).drop("_range", "_of", "_before")
