"""Pearson correlations, all pairs in one pass."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Literal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeropanel.schema import POLLUTANTS, display_name

Nulls = Literal["skip", "zero"]


def _operand(col: str, nulls: Nulls) -> Column:
    return F.coalesce(F.col(col), F.lit(0.0)) if nulls == "zero" else F.col(col)


def corr_with_target(
    clean: DataFrame, nulls: Nulls = "skip", cols: Sequence[str] = POLLUTANTS, target: str = "AQI",
) -> DataFrame:
    """Correlation of each column with the target -> pollutant, corr; strongest first.

    "skip" uses the rows where both values are present; "zero" counts a missing value as 0, which is
    what `DataFrame.stat.corr` does.
    """
    row = clean.agg(*(
        F.round(F.corr(_operand(c, nulls), _operand(target, nulls)), 3).alias(display_name(c)) for c in cols))
    return row.unpivot([], [F.col(f"`{c}`") for c in row.columns], "pollutant", "corr") \
        .orderBy(F.desc_nulls_last("corr"), "pollutant")


def pair_moments(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Reducer of a task's batches to one row per pair of columns.

    It counts the rows where both columns are present and keeps their means and centred second moments; entry
    [a, b] of `mean` and `square` belongs to column a on the rows where b is present. It is a closure, so that it
    travels to the executors whole.
    """

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, square, product = (np.zeros((width, width)) for _ in range(4))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            present = ~np.isnan(x)
            # Sums are taken around the batch mean to keep their digits.
            centre = np.where(present, x, 0.0).sum(axis=0) / np.maximum(present.sum(axis=0), 1)
            z, m = np.where(present, x - centre, 0.0), present.astype(float)
            more = m.T @ m
            shift = z.T @ m / np.maximum(more, 1)
            apart = shift + centre[:, None] - mean
            total = np.maximum(n + more, 1)
            square += (z * z).T @ m - shift * shift * more + apart * apart * n * more / total
            product += z.T @ z - shift * shift.T * more + apart * apart.T * n * more / total
            mean += apart * more / total
            n += more
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_pydict({
            "i": i.astype("int32"), "j": j.astype("int32"), "n": n[i, j], "mx": mean[i, j], "my": mean[j, i],
            "sx": square[i, j], "sy": square[j, i], "c": product[i, j]})

    return reduce


def corr_matrix(clean: DataFrame, cols: Sequence[str] = (*POLLUTANTS, "AQI"), digits: int = 3) -> DataFrame:
    """Pairwise-complete correlation of every two columns -> a, b, r; both orders and the diagonal.

    Tasks reduce their Arrow batches with matrix products and send one row per pair of columns. A pass of 91
    correlation functions is too large for Spark to compile, and fanning rows out to the pairs took six times as long.
    """
    numbers = clean.select(*(F.col(c).cast("double") for c in cols))
    parts = numbers.mapInArrow(
        pair_moments(len(cols)), "i int, j int, n double, mx double, my double, sx double, sy double, c double")

    def merged(within: str, x: str, y: str) -> Column:
        """Second moment over all tasks: the parts plus what their means are apart."""
        n = F.nullif(F.sum("n"), F.lit(0.0))
        between = F.sum(F.col("n") * F.col(x) * F.col(y)) - F.sum(F.col("n") * F.col(x)) * F.sum(F.col("n") * F.col(y)) / n
        return F.sum(within) + between

    spread = F.sqrt(merged("sx", "mx", "mx") * merged("sy", "my", "my"))
    r = F.round(merged("c", "mx", "my") / F.nullif(spread, F.lit(0.0)), digits)
    upper = parts.groupBy("i", "j").agg(r.alias("r"))
    names = F.array(*(F.lit(display_name(c)) for c in cols))
    one_way = F.struct(F.get(names, "i").alias("a"), F.get(names, "j").alias("b"), "r")
    other_way = F.struct(F.get(names, "j").alias("a"), F.get(names, "i").alias("b"), "r")
    return upper.select(F.inline(
        F.when(F.col("i") == F.col("j"), F.array(one_way)).otherwise(F.array(one_way, other_way))))


def top_drivers(corr: DataFrame, exclude: Sequence[str] = ("NO", "NOx"), k: int = 5) -> DataFrame:
    return corr.filter(~F.col("pollutant").isin(*exclude)).orderBy(F.desc_nulls_last("corr"), "pollutant").limit(k)
