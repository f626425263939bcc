"""Linear regression from the Gram matrix: one pass over the rows, one small solve, and a certificate.

The sums of products of all pairs of columns are all that leaves the rows; their number depends on the columns only. That
a fit is the least-squares one shows in the residuals: they are orthogonal to every column and to the constant.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Fit(NamedTuple):
    columns: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def prediction(self) -> Column:
        terms = [F.col(c) * F.lit(w) for c, w in zip(self.columns, self.coefficients, strict=True)]
        return sum(terms, F.lit(self.intercept))


def gram(rows: DataFrame, columns: Sequence[str], label: str) -> tuple[np.ndarray, np.ndarray]:
    """(X'X, X'y) with the constant as the last column; rows that lack a value are left out."""
    names = [*columns, label]
    whole = rows.select(*names).dropna()
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = [F.sum(F.col(names[i]) * F.col(names[j])) for i, j in pairs] + [F.sum(c) for c in names] + [F.count("*").cast("double")]
    # one array, so that the sums are one column of the plan
    found = whole.agg(F.array(*(F.coalesce(s, F.lit(0.0)) for s in sums))).first()[0]
    full = np.zeros((len(names) + 1, len(names) + 1))
    for (i, j), value in zip(pairs, found):
        full[i, j] = full[j, i] = value
    full[-1, :-1] = full[:-1, -1] = found[len(pairs):-1]
    full[-1, -1] = found[-1]
    known = [*range(len(columns)), len(names)]
    return full[np.ix_(known, known)], full[known, len(columns)]


def fit(rows: DataFrame, columns: Sequence[str], label: str) -> Fit:
    """Least squares by the normal equations; columns that others give get the smallest coefficients that fit."""
    products, target = gram(rows, columns, label)
    scale = np.sqrt(np.maximum(np.diag(products), np.finfo(float).tiny))
    scaled, right = products / np.outer(scale, scale), target / scale
    try:
        solved = np.linalg.solve(scaled, right)
    except np.linalg.LinAlgError:
        solved = np.linalg.lstsq(scaled, right, rcond=None)[0]
    weights = (solved / scale).tolist()
    return Fit(tuple(columns), tuple(weights[:-1]), weights[-1])


def certificate(rows: DataFrame, found: Fit, label: str, digits: int = 6) -> DataFrame:
    """A row per column and one for the constant: rows, the column's sum, and its cosine with the residuals, 0 for a fit."""
    names = [*found.columns, "1"]
    column = lambda c: F.lit(1.0) if c == "1" else F.col(c)
    known = rows.select(*found.columns, label).dropna().withColumn("_residual", F.col(label) - found.prediction())
    length = F.sqrt(F.sum(F.col("_residual") * F.col("_residual")))
    cosine = lambda c: F.sum(F.col("_residual") * column(c)) / (length * F.sqrt(F.sum(column(c) * column(c))))
    told = [F.struct(F.lit(c).alias("feature"), F.count("*").alias("rows"), F.sum(column(c)).alias("total"),
                     # adding 0 takes the sign off a zero
                     (F.round(F.coalesce(cosine(c), F.lit(0.0)), digits) + 0.0).alias("cosine")) for c in names]
    return known.agg(F.array(*told).alias("told")).select(F.inline("told"))
