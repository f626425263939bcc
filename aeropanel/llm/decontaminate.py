"""Test items inside documents, by size-partitioned MinHash containment search and exact verification.

A containment of a short item in a long document is a tiny Jaccard similarity, so a sketch of one size for all would
miss it. Documents are therefore partitioned by size (powers of two), items too, and the number of MinHash bins follows
both: a document of x shingles and an item of q share a level of 2**(log2 x + depth(q)) bins of the hash range, and
match where both have the same smallest hash in a bin. `depth` is chosen so that an item with at least the wanted share
of its shingles in the document has no matching bin with a probability of 2**-30 only.

All levels are read off the sorted hashes at once: a hash is the smallest of its bin from that level on at which its
predecessor falls into another bin. Most documents hold no hash of any item; a bit array of fixed size, filled from the
items' hashes, lets tasks skip them. Documents that do hold one are joined with the items by hash, and every pair with a
matching bin is verified on the words themselves.

An item of one to four words is a single shingle of its own length, which no shingle of five words can meet. For the
lengths that occur among the items, documents list their windows of so many words too; as such an item is either whole
in a document or not there, its hash is compared at every level.

Defined cases: missing and empty texts hold nothing; an item of one to four words is found in every document that has
these words in a row, an item without words in none; repeated rows of documents or items are separate rows; other columns pass through `without_items`.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeropanel.llm import texts
from aeropanel.session import scratch_path, written

CONTAINMENT = 0.8
MISS_BITS = 30
MOST_FILTER_BITS = 27  # the bit array takes 16 MB at most, however many items there are


def bit_lengths(x: np.ndarray) -> np.ndarray:
    """Bits that 64-bit values take."""
    high, low = (x >> np.uint64(32)).astype(np.float64), (x & np.uint64(0xFFFFFFFF)).astype(np.float64)
    return np.where(high > 0, np.frexp(high)[1] + 32, np.frexp(low)[1]).astype(np.int32)


def smallest_from(hashes: np.ndarray) -> np.ndarray:
    """For rising distinct hashes the level (bits of the bin number) from which each is the smallest of its bin."""
    levels = np.zeros(len(hashes), np.int32)
    levels[1:] = 65 - bit_lengths(hashes[1:] ^ hashes[:-1])
    return levels


def depth(n_shingles: int, containment: float) -> int:
    """Levels beyond the document's size class at which items of this size are compared."""
    return ceil(MISS_BITS / max(1, ceil(containment * n_shingles))) + 2


def _item_sketches(containment: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column("_item").to_pylist()
            values = texts.column_texts(batch.column("text"))
            for (first, last, hashes, at), (*_, bounds) in zip(texts.shingle_hashes(values), texts.word_hashes(values), strict=True):
                for i in range(first, last):
                    own = np.unique(hashes[at[i - first]:at[i - first + 1]])
                    n, n_words = len(own), int(bounds[i - first + 1] - bounds[i - first])
                    yield pa.record_batch(
                        [pa.array(np.full(n, items[i], np.int64)), pa.array(own.view(np.int64)), pa.array(smallest_from(own)),
                         pa.array(np.full(n, depth(n, containment), np.int32)), pa.array(np.full(n, n_words, np.int64))],
                        names=["_item", "hash", "item_level", "depth", "n_words"])
    return run


def _probes(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    second = hashes * np.uint64(0xD6E8FEB86659FD93)
    return hashes >> np.uint64(64 - bits), second >> np.uint64(64 - bits)


def _filter_words(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column("hash").to_numpy().view(np.uint64)
            spots = np.concatenate(_probes(hashes, bits))
            yield pa.record_batch([pa.array((spots >> np.uint64(6)).astype(np.int64)),
                                   pa.array((np.uint64(1) << (spots & np.uint64(63))).view(np.int64))], names=["word", "mask"])
    return run


def item_filter(sketches: DataFrame) -> tuple[np.ndarray, int]:
    """Bit array of the items' hashes, at most 2**21 words, and the bits of a place in it."""
    entries = sketches.count()
    bits = int(min(MOST_FILTER_BITS, max(16, np.ceil(np.log2(entries + 1)) + 11)))
    words = texts.map_batches(sketches.select("hash"), _filter_words(bits), "word long, mask long")
    found = words.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    array = np.zeros(1 << (bits - 6), np.int64)
    array[found.column("word").to_numpy()] = found.column("mask").to_numpy()
    return array.view(np.uint64), bits


def _hits(shared, bits: int, short: list[int]):
    """Rows whose text holds hashes of items: with these and the levels from which they are smallest of their bins.

    Windows of the `short` lengths are compared at level 0.
    """
    def known(array: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        held = np.ones(len(hashes), bool)
        for spots in _probes(hashes, bits):
            held &= (array[(spots >> np.uint64(6)).astype(np.int64)] >> (spots & np.uint64(63)) & np.uint64(1)).astype(bool)
        return held

    def windows(array: np.ndarray, values: list[str]) -> dict[int, list[int]]:
        found: dict[int, list[int]] = {}
        for first, _, words, bounds in texts.word_hashes(values):
            for size in short:
                hashes, owner = texts.window_hashes(words, bounds, size)
                held = known(array, hashes)
                for i, h in set(zip(owner[held].tolist(), hashes[held].view(np.int64).tolist())):
                    found.setdefault(first + i, []).append(h)
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = shared.value
        for batch in batches:
            values = texts.column_texts(batch.column("text"))
            rows, sizes, found, levels = [], [], [], []
            whole = windows(array, values) if short else {}
            for first, last, hashes, at in texts.shingle_hashes(values):
                held = known(array, hashes)
                holders = set((np.searchsorted(at, np.flatnonzero(held), "right") - 1).tolist())
                for i in sorted(holders | {i - first for i in whole if first <= i < last}):
                    own = np.unique(hashes[at[i]:at[i + 1]])
                    wanted = np.unique(hashes[at[i]:at[i + 1]][held[at[i]:at[i + 1]]])
                    rows.append(first + i)
                    sizes.append(len(own))
                    more = whole.get(first + i, [])
                    found.append(wanted.view(np.int64).tolist() + more)
                    levels.append(smallest_from(own)[np.searchsorted(own, wanted)].tolist() + [0] * len(more))
            if rows:
                kept = batch.take(pa.array(rows))
                yield pa.record_batch(
                    [*kept.columns, pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int64())),
                     pa.array(levels, pa.list_(pa.int32()))], names=[*kept.schema.names, "_size", "_hashes", "_levels"])
    return run


def _verified(containment: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, sizes = [], []
            for text, item in zip(batch.column("text").to_pylist(), batch.column("item_text").to_pylist()):
                size = max(1, min(texts.SHINGLE_WORDS, len(texts.words_of(item))))
                wanted = set(texts.shingles_of(item, size))
                shared.append(len(wanted.intersection(texts.shingles_of(text, size))))
                sizes.append(len(wanted))
            whole = pa.record_batch([*batch.columns, pa.array(shared, pa.int64()), pa.array(sizes, pa.int64())],
                                    names=[*batch.schema.names, "shared", "item_shingles"])
            keep = np.array(shared) / np.maximum(1, sizes) >= containment
            yield whole.filter(pa.array(keep & (np.array(sizes) > 0))).drop_columns(["text", "item_text"])
    return run


def find_items(documents: DataFrame, items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """Pairs of documents (doc_id, text) and items (item_id, text) of which at least this share is in the document.

    -> doc_id, text_hash, item_id, shared, item_shingles: item shingles found, and all of them.
    """
    spark = documents.sparkSession
    path = scratch_path(spark, "decontaminate")
    items = written(items.select(F.monotonically_increasing_id().alias("_item"), "item_id", "text"), f"{path}/items")
    sketches = texts.map_batches(items.select("_item", "text"), _item_sketches(containment),
                                 "_item long, hash long, item_level int, depth int, n_words long")
    array, bits = item_filter(sketches)
    # at most four lengths
    few = sketches.filter(F.col("n_words") < texts.SHINGLE_WORDS).select("n_words").distinct().collect()
    short = sorted(row.n_words for row in few)
    given = documents.select("doc_id", "text")
    held = texts.map_batches(given, _hits(spark.sparkContext.broadcast(array), bits, short),
                             f"{texts.ddl(given)}, _size long, _hashes array<long>, _levels array<int>")
    held = written(held.withColumn("_row", F.monotonically_increasing_id()), f"{path}/held")

    hits = held.select("_row", F.floor(F.log2("_size")).cast("int").alias("_class"), F.inline(F.arrays_zip(
        F.col("_hashes").alias("hash"), F.col("_levels").alias("level"))))
    level = F.col("_class") + F.col("depth")
    met = hits.join(sketches, "hash").filter((F.col("level") <= level) & (F.col("item_level") <= level))
    candidates = met.groupBy("_row", "_item").agg(F.count("*").alias("_bins"))
    pairs = candidates.join(items.withColumnRenamed("text", "item_text"), "_item").join(
        held.select("_row", "doc_id", "text", F.xxhash64("text").alias("text_hash")), "_row")
    pairs = pairs.select("doc_id", "text_hash", "item_id", "text", "item_text")
    kept = pairs.drop("text", "item_text")
    return texts.map_batches(pairs, _verified(containment), f"{texts.ddl(kept)}, shared long, item_shingles long")


def contaminated(documents: DataFrame, items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """doc_id, item_id, shared, item_shingles, containment of every pair found."""
    return find_items(documents, items, containment).select(
        "doc_id", "item_id", "shared", "item_shingles", (F.col("shared") / F.col("item_shingles")).alias("containment"))


def without_items(documents: DataFrame, items: DataFrame, containment: float = CONTAINMENT) -> DataFrame:
    """The documents that hold no item, with their columns."""
    found = find_items(documents, items, containment).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    same = F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("row.text") == F.col("_hash"))
    return documents.select(F.struct("*").alias("row")).join(found, same, "left_anti").select("row.*")
