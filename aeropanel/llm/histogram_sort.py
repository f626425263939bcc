"""Shards of nearly equal bytes by histogram sort.

Rows have a total order: (key, tie, row), three whole numbers that are not negative. To find where the order is to be cut,
the bytes and rows below candidate boundaries are counted exactly, over all partitions: every interval that holds a wanted
cut is parted by `probes` boundaries between its least and greatest value, one aggregation counts all of them, and the
interval between the two boundaries around the cut is probed next. An interval of one key is probed by tie, one of one tie
by row. Only the counts at boundaries reach the driver, at most `probes` for each cut, however many rows there are. Then
each row's shard is known from the cuts by comparison, and rows are exchanged once to be numbered.

Rows of one key (equal texts) stay together where that costs little: a cut goes to the nearer end of the key's rows if that is
within `tolerance` of a shard's bytes, and otherwise to the nearest row inside of them, so a text that a third of all rows
hold is dealt over as many shards as it fills. Both are the exact nearest ends, ties to the lower one, so the result does
not depend on the partitioning or on the probes. Shards of more than `part_rows` rows are cut into parts the same way, and
slots continue over the parts of a shard, so no task orders more than a part.

Defined cases: a missing text has no bytes of its own and the checksum of the empty text; a missing id counts as an empty
one in the order. Rows with the same text and id are told apart by a number that is given when the keys are written, and are
interchangeable. A row is in one shard whole, so one of more bytes than a shard leaves neighbours empty; without any rows
nothing is returned. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from functools import reduce
from math import ceil
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeropanel.session import scratch_path

SHARDS = 40
ROW_BYTES = 16
TOLERANCE = 0.01
PROBES = 256
PART_ROWS = 20_000_000
LAW = "bytes"
LARGEST = (1 << 63) - 1
ORDER = ("key", "tie", "row")


class Interval(NamedTuple):
    """Rows whose first order columns are `fixed` and whose next one lies in [low, high]; what lies before them."""

    fixed: tuple[int, ...]
    low: int
    high: int
    bytes_before: int
    rows_before: int


class Cut(NamedTuple):
    """The least row right of a cut (its first order columns) and what lies left of it."""

    at: tuple[int, ...]
    bytes_before: int
    rows_before: int


def hashed(value: Column) -> Column:
    """60 bits of the digest of a text."""
    return F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("long")


def keyed(documents: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the order columns of documents."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select(
        "doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), hashed(text).alias("key"),
        hashed(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("tie"), F.monotonically_increasing_id().alias("row"))


def _number(value: int) -> Column:
    return F.lit(value).cast("long")


def _among(cases: list[tuple[Column, int]], otherwise: int = -1) -> Column:
    return reduce(lambda found, case: found.when(*case), cases[1:], F.when(*cases[0])).otherwise(_number(otherwise))


def _histogram(rows: DataFrame, intervals: list[Interval], probes: int) -> dict[int, list]:
    """For each interval its non-empty steps in order: (least value, greatest value, bytes, rows)."""
    column = [F.col(ORDER[len(i.fixed)]) for i in intervals]
    inside = [(reduce(lambda a, b: a & b, [F.col(c) == _number(v) for c, v in zip(ORDER, i.fixed)], c.between(_number(i.low), _number(i.high))), n)
              for n, (i, c) in enumerate(zip(intervals, column))]
    which = rows.withColumn("interval", _among(inside)).filter(F.col("interval") >= 0)
    level = F.element_at(F.array(*(_number(len(i.fixed)) for i in intervals)), (F.col("interval") + 1).cast("int"))
    value = F.element_at(F.array(*ORDER), (level + 1).cast("int"))
    low = F.element_at(F.array(*(_number(i.low) for i in intervals)), (F.col("interval") + 1).cast("int"))
    width = F.element_at(F.array(*(_number((i.high - i.low) // probes + 1) for i in intervals)), (F.col("interval") + 1).cast("int"))
    stepped = which.select("interval", value.alias("value"), low.alias("low"), width.alias("width"), "size") \
        .selectExpr("interval", "(value - low) DIV width AS step", "value", "size")
    counted = stepped.groupBy("interval", "step").agg(
        F.min("value").alias("least"), F.max("value").alias("most"), F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    found = defaultdict(list)
    for r in counted.collect():
        found[r.interval].append((r.least, r.most, r.bytes, r.rows))
    return {n: sorted(steps) for n, steps in found.items()}


def _nearer(before: int, after: int, goal: int, parts: int) -> bool:
    """Whether the end before the goal (in `parts` of the total) is the nearer one."""
    return abs(before * parts - goal) <= abs(after * parts - goal)


def cuts(rows: DataFrame, parts: int, tolerance: float = TOLERANCE, probes: int = PROBES) -> list[Cut]:
    """The parts - 1 cuts of rows (size and the order columns) into parts of nearly equal bytes."""
    total, n_rows = rows.agg(F.sum("size"), F.count("*")).first()
    goals = {g: g * (total or 0) for g in range(1, parts)}
    found: dict[int, Cut] = {}
    end = Cut((LARGEST,), total or 0, n_rows)
    open_goals = {Interval((), 0, LARGEST, 0, 0): sorted(goals)} if n_rows else {}
    ends: dict[Interval, Cut] = {i: end for i in open_goals}
    while open_goals:
        intervals = list(open_goals)
        counted = _histogram(rows, intervals, probes)
        following: dict[Interval, list[int]] = defaultdict(list)
        for n, interval in enumerate(intervals):
            steps, last = counted[n], ends[interval]
            edges, below, passed = [], interval.bytes_before, interval.rows_before
            for least, _, size, count in steps:
                edges.append(Cut((*interval.fixed, least), below, passed))
                below, passed = below + size, passed + count
            edges.append(last)
            tops = [e.bytes_before * parts for e in edges[1:]]
            for g in open_goals[interval]:
                at = min(bisect_left(tops, goals[g]), len(steps) - 1)
                before, after, (least, most, _, count) = edges[at], edges[at + 1], steps[at]
                if least < most:
                    inner = Interval(interval.fixed, least, most, before.bytes_before, before.rows_before)
                else:
                    nearest = before if _nearer(before.bytes_before, after.bytes_before, goals[g], parts) else after
                    close = abs(nearest.bytes_before * parts - goals[g]) <= tolerance * (total or 0)
                    if count == 1 or close and not interval.fixed:
                        found[g] = nearest
                        continue
                    inner = Interval((*interval.fixed, least), 0, LARGEST, before.bytes_before, before.rows_before)
                following[inner].append(g)
                ends[inner] = after
        open_goals = following
    return [found.get(g, end) for g in sorted(goals)]


def _below(cut: Cut) -> Column:
    """Whether a row lies left of a cut."""
    *equal, last = list(zip(ORDER, cut.at))
    less = F.col(last[0]) < _number(last[1])
    for c, v in reversed(equal):
        less = (F.col(c) < _number(v)) | ((F.col(c) == _number(v)) & less)
    return less


def part_of(found: list[Cut], first: int = 0) -> Column:
    """The number of cuts that a row does not lie left of, by halving."""
    if not found:
        return F.lit(first)
    half = len(found) // 2
    return F.when(_below(found[half]), part_of(found[:half], first)).otherwise(part_of(found[half + 1:], first + half + 1))


def sharded(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, probes: int = PROBES,
            part_rows: int = PART_ROWS) -> DataFrame:
    """Adds shard and slot to rows with size and the order columns; rows are read several times, so have them written."""
    a_shard = max(1, ceil(rows.count() / (shards * part_rows)))
    found = cuts(rows, shards * a_shard, tolerance / a_shard, probes)
    starts = [0, *(c.rows_before for c in found)]
    # rows of the shard in its earlier parts
    offsets = [starts[p] - starts[p - p % a_shard] for p in range(len(starts))]
    placed = rows.withColumn("part", part_of(found))
    number = F.row_number().over(Window.partitionBy("part").orderBy(*ORDER)) - 1
    offset = F.element_at(F.array(*(_number(o) for o in offsets)), F.col("part") + 1)
    return placed.withColumns({"shard": F.expr(f"CAST(part DIV {a_shard} AS INT)"), "slot": (offset + number).cast("long")}).drop("part")


def document_shards(documents: DataFrame, **options) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    spark = documents.sparkSession
    path = scratch_path(spark, "histogram-sort")
    keyed(documents).write.parquet(path)
    return sharded(spark.read.parquet(path), **options).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
