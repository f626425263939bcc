"""Exact order statistics of columns of any size, and samples of an exact size.

A value of a given rank is found by counting: the range that holds it is cut into steps, one aggregation counts the
values of every step, and the step with the wanted rank is cut next, until all of its values are equal. Each round reads
the rows once for all columns and brings at most `steps` counts per wanted rank to the driver; no column is sorted or
sampled. Missing, NaN and infinite values do not count.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = 256


class Range(NamedTuple):
    """Values of a column in [low, high], and how many are below."""

    column: str
    low: float
    high: float
    below: int


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    values = df.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols))))
    return values.filter((F.abs("value") < float("inf")) & ~F.isnan("value"))


def _counted(values: DataFrame, ranges: Sequence[Range], steps: int) -> dict[int, list[tuple[float, float, int]]]:
    """For each range its non-empty steps in order: least value, greatest value, number."""
    inside = [(F.col("column") == r.column) & F.col("value").between(r.low, r.high) for r in ranges]
    number = reduce(lambda case, i: case.when(inside[i], i), range(1, len(ranges)), F.when(inside[0], 0))

    def step(r: Range) -> Column:
        width = r.high / steps - r.low / steps
        if width == 0:
            return (F.col("value") > r.low).cast("int")
        # the greatest value is never in the step of the least one, so every round narrows
        return F.least(F.floor((F.col("value") - r.low) / width).cast("int"), F.lit(steps - 1)) if r.high - r.low < float("inf") \
            else (F.col("value") > r.low / 2 + r.high / 2).cast("int")

    which = reduce(lambda case, i: case.when(inside[i], step(ranges[i])), range(1, len(ranges)), F.when(inside[0], step(ranges[0])))
    rows = values.select("value", number.alias("range"), which.alias("step")).filter(F.col("range").isNotNull()) \
        .groupBy("range", "step").agg(F.min("value").alias("least"), F.max("value").alias("most"), F.count("*").alias("n")).collect()
    found = defaultdict(list)
    for r in sorted(rows, key=lambda r: (r.range, r.step)):
        found[r.range].append((r.least, r.most, r.n))
    return found


def ranked_values(df: DataFrame, ranks: Mapping[str, Sequence[float]], steps: int = STEPS) -> dict[str, list[float | None]]:
    """For each column the values at the given places, as shares of its values from 0 (least) to 1 (greatest).

    A place between two values takes the lower one; `0.5` of an even number of values is the lower median. A column
    without values gives None.
    """
    counts = {r.column: r for r in _long(df, list(ranks)).groupBy("column").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("n")).collect()}
    wanted = {(c, int(place * (counts[c].n - 1))) for c, places in ranks.items() if c in counts for place in places}
    found = _at_ranks(df, {c: (r.low, r.high) for c, r in counts.items()}, wanted, steps)
    return {c: [found[c, int(p * (counts[c].n - 1))] if c in counts else None for p in places] for c, places in ranks.items()}


def _at_ranks(df: DataFrame, spans: Mapping[str, tuple[float, float]], wanted: set[tuple[str, int]],
              steps: int = STEPS) -> dict[tuple[str, int], float]:
    """The values of the columns at ranks from 0."""
    if not wanted:
        return {}
    values, found = _long(df, list(spans)), {}
    open_ranges: dict[Range, set[int]] = defaultdict(set)
    for column, rank in wanted:
        open_ranges[Range(column, *spans[column], 0)].add(rank)
    while open_ranges:
        ranges, following = list(open_ranges), defaultdict(set)
        counted = _counted(values, ranges, steps)
        for i, r in enumerate(ranges):
            below = r.below
            for least, most, n in counted[i]:
                for rank in open_ranges[r]:
                    if below <= rank < below + n:
                        if least == most:
                            found[r.column, rank] = least
                        else:
                            following[Range(r.column, least, most, below)].add(rank)
                below += n
        open_ranges = following
    return found


def medians(df: DataFrame, cols: Sequence[str], steps: int = STEPS) -> dict[str, float | None]:
    """Exact medians: the mean of the two middle values where their number is even; None for a column without values."""
    counts = {r.column: r for r in _long(df, cols).groupBy("column").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.count("*").alias("n")).collect()}
    middle = {c: ((r.n - 1) // 2, r.n // 2) for c, r in counts.items()}
    found = _at_ranks(df, {c: (r.low, r.high) for c, r in counts.items()}, {(c, k) for c, ks in middle.items() for k in ks}, steps)
    return {c: found[c, middle[c][0]] / 2 + found[c, middle[c][1]] / 2 if c in middle else None for c in cols}


def key_hash(keys: Sequence[str], seed: int) -> Column:
    """52 bits of the digest of seed and keys: a whole number that a double holds, the same on any engine."""
    text = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")


def sample_exactly(df: DataFrame, keys: Sequence[str], fraction: float, seed: int) -> DataFrame:
    """The rows with the smallest hashes of their keys: the nearest whole number to `fraction` of them.

    Which rows they are depends on the keys only, not on partitions, so reruns agree and samples of parts merge. Rows with
    the same keys are taken together.
    """
    hashed = df.withColumn("_hash", key_hash(keys, seed))
    low, high, n = hashed.agg(F.min("_hash"), F.max("_hash"), F.count("_hash")).first()
    size = int(n * fraction + 0.5)
    if not size:
        return df.limit(0)
    bound = _at_ranks(hashed, {"_hash": (low, high)}, {("_hash", size - 1)})["_hash", size - 1]
    return hashed.filter(F.col("_hash") <= bound).drop("_hash")
