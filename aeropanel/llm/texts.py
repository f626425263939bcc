"""Whole texts as arrays of code points: words, their hashes and word shingles, without a Python loop per word.

A word is a maximal run of letters, marks and digits of the lower-cased text. A shingle is five words in a row; a
text of one to four words is one shingle, a text without words has none.
"""

from __future__ import annotations

import ctypes
import sys
import unicodedata
from collections.abc import Callable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SHINGLE_WORDS = 5
SLICE_CHARS = 1_000_000
#: Arrays over words take some 100 bytes a character.
WORD_SLICE_CHARS = 200_000
BATCH_ROWS = 1000
LETTER, NUMBER, MARK, SPACE, OTHER = 1, 2, 3, 4, 0
WORD_SQL = r"[\p{L}\p{M}\p{N}]+"


class Slice(NamedTuple):
    """Neighbouring texts of a batch: texts `first` to `last` - 1, their code points and where each begins."""

    first: int
    last: int
    points: np.ndarray
    bounds: np.ndarray


@cache
def class_table() -> np.ndarray:
    """Class of every code point by its Unicode category."""
    kinds = {"L": LETTER, "N": NUMBER, "M": MARK, "Z": SPACE}
    table = np.fromiter((kinds.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
    table[[*range(0x09, 0x0E), 0x1C, 0x1D, 0x1E, 0x1F, 0x85]] = SPACE
    return table


@cache
def _word_table() -> np.ndarray:
    table = class_table()
    return (table >= LETTER) & (table <= MARK)


def word_members(points: np.ndarray) -> np.ndarray:
    """Whether each code point belongs to a word."""
    return _word_table()[points]


@cache
def _point_values() -> np.ndarray:
    return mixed(np.arange(1, 0x110001, dtype=np.uint64))


_BASE = 0x9E3779B97F4A7C15 | 1
_powers: dict[str, np.ndarray] = {}


def _power(inverse: bool, n: int) -> np.ndarray:
    """Powers of the base, or of its inverse, modulo 2**64."""
    key = "inverse" if inverse else "base"
    if key not in _powers or len(_powers[key]) < n:
        base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        steps = np.full(max(n, SLICE_CHARS if n > WORD_SLICE_CHARS else WORD_SLICE_CHARS), base, np.uint64)
        steps[0] = 1
        _powers[key] = np.multiply.accumulate(steps)
    return _powers[key][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (the finisher of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(texts: list[str], most: int = SLICE_CHARS) -> Iterator[Slice]:
    """Cuts a batch between texts, so that arrays stay small; a longer text is a slice of its own, never cut."""
    first, size = 0, 0
    lengths = [len(t) for t in texts]
    for i, n in enumerate([*lengths, most + 1]):
        if size and size + n > most or i == len(texts):
            if i > first:
                joined = "".join(texts[first:i]).encode("utf-32-le", "surrogatepass")
                bounds = np.zeros(i - first + 1, np.int64)
                np.cumsum(lengths[first:i], out=bounds[1:])
                yield Slice(first, i, np.frombuffer(joined, np.uint32), bounds)
            first, size = i, 0
        size += n


def runs(member: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of members; no run crosses a bound."""
    n = len(member)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[bounds] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = member[:-1], member[1:]
    return np.flatnonzero(member & (~before | cut[:-1])), np.flatnonzero(member & (~after | cut[1:])) + 1


def running_hashes(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all prefixes, and the factors that make the difference of two of them independent of the place."""
    total = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(_point_values()[points] * _power(False, len(points)), out=total[1:])
    return total, _power(True, len(points) + 1)


def span_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of code points, by a polynomial over random values per code point."""
    total, inverse = running_hashes(points)
    return mixed((total[ends] - total[starts]) * inverse[starts])


def word_hashes(texts: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, hashes of the words, where each text's words begin) for slices of the batch."""
    for part in slices([t.lower() for t in texts], WORD_SLICE_CHARS):
        starts, ends = runs(word_members(part.points), part.bounds)
        yield part.first, part.last, span_hashes(part.points, starts, ends), np.searchsorted(starts, part.bounds)


def shingle_hashes(texts: list[str], size: int = SHINGLE_WORDS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, hashes of the shingles in text order, where each text's shingles begin) for slices of the batch."""
    for first, last, words, bounds in word_hashes(texts):
        n_words = np.diff(bounds)
        counts = np.where(n_words >= size, n_words - size + 1, np.minimum(n_words, 1))
        at = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=at[1:])
        whole = np.zeros(max(0, len(words) - size + 1), np.uint64)
        for k in range(size):
            whole += words[k:k + len(whole)] * _power(False, size)[k]
        inside = np.ones(len(whole), bool)
        for k in range(1, size):
            late = bounds[1:-1] - k
            inside[late[(late >= 0) & (late < len(whole))]] = False
        found = np.zeros(at[-1], np.uint64)
        short = np.flatnonzero((n_words > 0) & (n_words < size))
        is_short = np.zeros(at[-1], bool)
        is_short[at[short]] = True
        found[~is_short] = mixed(whole[inside])
        for k in range(size - 1):
            longer = short[n_words[short] > k]
            found[at[longer]] += words[bounds[longer] + k] * _power(False, size + 1)[k + 1]
        found[at[short]] = mixed(found[at[short]])
        yield first, last, found, at


def window_hashes(words: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every `size` words in a row and the text each is in; the hash is that of a text of just these words."""
    n_words = np.diff(bounds)
    owner = np.repeat(np.arange(len(n_words)), np.maximum(0, n_words - size + 1))
    counts = np.maximum(0, n_words - size + 1)
    starts = bounds[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    total = np.zeros(len(owner), np.uint64)
    for k in range(size):
        total += words[starts + k] * _power(False, size + 1)[k + 1]
    return mixed(total), owner


def words_of(text: str | None) -> list[str]:
    """The words of one text."""
    lowered = (text or "").lower()
    points = np.frombuffer(lowered.encode("utf-32-le", "surrogatepass"), np.uint32)
    return [lowered[a:b] for a, b in zip(*runs(word_members(points), np.array([0, len(points)])), strict=True)]


def shingles_of(text: str | None, size: int = SHINGLE_WORDS) -> list[tuple[str, ...]]:
    """The shingles of one text, in order."""
    words = words_of(text)
    return [tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


@cache
def _trim() -> Callable[[int], int] | None:
    """What returns the C library's free memory to the system; only glibc has it."""
    return getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None


def release_memory() -> None:
    """Returns what this process has freed to the system."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


def small_batches(spark: SparkSession) -> None:
    """Has Spark send BATCH_ROWS rows at a time to Python, unless the session has its own value."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, str(BATCH_ROWS))


def map_batches(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """`mapInArrow` by pieces of a batch, so that few texts at a time are Python objects; none is empty.

    Workers live on after a task, through stages of other operators and stages without Python, so each task gives back its memory.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from function(b.slice(at, BATCH_ROWS) for b in batches for at in range(0, b.num_rows, BATCH_ROWS))
        finally:
            release_memory()

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def column_texts(column: pa.Array) -> list[str]:
    """A text column as a list; a missing text is empty."""
    return [t or "" for t in column.to_pylist()]


def ddl(df: DataFrame) -> str:
    """The schema of a frame as text."""
    return ", ".join(f"`{name.replace('`', '``')}` {kind}" for name, kind in df.dtypes)
