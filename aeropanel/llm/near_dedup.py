"""Near copies by improved consistent weighted sampling over TF-IDF shingles.

A document is the set of its five-word shingles, each weighted by its count times its inverse document frequency. A
weighted sample of it is one shingle and a quantised weight; two documents agree on a sample with a probability equal to
their weighted Jaccard similarity. 64 samples are cut into 16 bands of 4; documents that agree on a band are candidates,
and candidates are verified by the weighted Jaccard similarity of their texts.

Document frequencies come from a count-min sketch of fixed size over all documents. It tells frequencies apart down to a
fixed share of the documents, whatever their number (about their mean number of shingles over 2**20). The inverse
frequency is 1 + ln((N + 1) / (df + 1)) / (4 ln(N + 1)), between 1 and 1.25: with a wider range, the shingles that the
members of a large group share would weigh little against their edits, and its members would no longer resemble each other.

The random variables of a sample are drawn by hash from a fixed pool of 2**16 triples, which replaces logarithms per
shingle and sample by look-ups.

Documents of equal words are one class from the start and are never paired. The others are compared in four rounds, whatever
the size of a bucket (documents of equal samples in a band): each with the most central member of its largest bucket; then
those of different components with the central members of all their buckets, or with all members of small ones; then the
members of buckets that are still open by two of their open bands, where texts that resemble each other meet again and those
that share a passage hardly do. At last what is left of open buckets is compared in blocks of signatures; the members that agree
often enough with one of another component come with their texts, and the block verifies pairs itself, skips what its links
have joined, and gives out one link per join. So no table holds pairs that fail, and a group gives at most a link per member
and block. No pair that shares a band is passed over; the comparison in blocks is quadratic in what is left of a bucket, in
numbers per pair of different components.

Defined cases: documents without words resemble nothing and each is its own class; missing ids sort after all others;
repeated rows are copies; without documents there are no classes. Other columns pass through `without_copies`.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeropanel.llm import texts
from aeropanel.llm.components import components, with_links
from aeropanel.session import scratch_path, written

SIMILARITY = 0.8
BANDS, ROWS = 16, 4
BAND_BITS = 4
SAMPLES = BANDS * ROWS
SKETCH_BITS = 20
SKETCH_ROWS = 2
CHUNK_BITS = 14
IDF_SPREAD = 0.25
POOL_BITS = 16
FEW_MEMBERS = 8
NEXT_BANDS = 2
BLOCK_SHINGLES = 8192
BLOCK_MEMBERS = 2048
BLOCK_BYTES = 16 << 20
#: A pair whose samples agree less than this is below the similarity but for a chance of about 3e-5; that such a pair shares no
#: band, and is not a candidate at all, has a chance of 2e-4.
LEAST_AGREEMENT = 0.6


class Frequencies(NamedTuple):
    """Number of documents, and the sketch: SKETCH_ROWS rows of counts."""

    documents: int
    counts: np.ndarray


def _sketch_places(hashes: np.ndarray, row: int) -> np.ndarray:
    spread = hashes if row == 0 else hashes * np.uint64(0xD6E8FEB86659FD93)
    return (spread >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def weighted_shingles(values: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first, last, distinct shingles by text, their counts, where each text's begin) for slices of a batch."""
    for first, last, hashes, at in texts.shingle_hashes(values):
        owner = np.repeat(np.arange(last - first), np.diff(at))
        order = np.lexsort((hashes, owner))
        hashes, owner = hashes[order], owner[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
        begins = np.flatnonzero(new)
        counts = np.diff(begins, append=len(hashes))
        yield first, last, hashes[begins], counts, np.searchsorted(owner[begins], np.arange(last - first + 1))


def _count_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((SKETCH_ROWS, 1 << SKETCH_BITS), np.int32)
    documents = 0
    for batch in batches:
        documents += batch.num_rows
        for _, _, hashes, _, _ in weighted_shingles(texts.column_texts(batch.column("text"))):
            for row in range(SKETCH_ROWS):
                counts[row] += np.bincount(_sketch_places(hashes, row), minlength=1 << SKETCH_BITS).astype(np.int32)
    chunks = counts.reshape(-1, 1 << CHUNK_BITS)
    for chunk, part in enumerate(chunks):
        held = np.flatnonzero(part)
        yield pa.record_batch(
            [pa.array([chunk]), pa.array([documents if chunk == 0 else 0]), pa.array([held.astype("<u2").tobytes()]),
             pa.array([part[held].astype("<u4").tobytes()])], names=["chunk", "documents", "places", "counts"])


def _add_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    documents: dict[int, int] = {}
    for batch in batches:
        for row in batch.to_pylist():
            chunk = row["chunk"]
            own = total.setdefault(chunk, np.zeros(1 << CHUNK_BITS, np.int64))
            own[np.frombuffer(row["places"], "<u2")] += np.frombuffer(row["counts"], "<u4")
            documents[chunk] = documents.get(chunk, 0) + row["documents"]
    for chunk, counts in total.items():
        yield pa.record_batch([pa.array([chunk]), pa.array([documents[chunk]]), pa.array([counts.astype("<f4").tobytes()])],
                              names=["chunk", "documents", "counts"])


def document_frequencies(documents: DataFrame) -> Frequencies:
    """The sketch over all documents; tasks send sparse counts, and what reaches the driver has a fixed size."""
    parts = texts.map_batches(documents.select("text"), _count_shingles, "chunk long, documents long, places binary, counts binary")
    chunks = SKETCH_ROWS << (SKETCH_BITS - CHUNK_BITS)
    added = texts.map_batches(parts.repartition("chunk"), _add_chunks, "chunk long, documents long, counts binary")
    counts = np.zeros((chunks, 1 << CHUNK_BITS), np.float32)
    n = 0
    # of a fixed size, and in one job: an iterator runs one per partition
    for row in added.collect():
        counts[row.chunk] = np.frombuffer(row.counts, "<f4")
        n += row.documents
    return Frequencies(n, counts.reshape(SKETCH_ROWS, -1))


def inverse_frequency(hashes: np.ndarray, known: Frequencies) -> np.ndarray:
    """Inverse document frequency of shingles, between 1 and 1 + IDF_SPREAD."""
    df = known.counts[0][_sketch_places(hashes, 0)]
    for row in range(1, SKETCH_ROWS):
        df = np.minimum(df, known.counts[row][_sketch_places(hashes, row)])
    n = known.documents
    return 1 + IDF_SPREAD * np.log((n + 1) / (np.minimum(df, n).astype(np.float64) + 1)) / log(n + 1)


@cache
def _pool() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pool of the variables of a sample: r, 1 / r, beta, and ln c - r + 64 with r and c from Gamma(2, 1)."""
    rng = np.random.default_rng(20240101)
    r, c = rng.gamma(2, 1, 1 << POOL_BITS), rng.gamma(2, 1, 1 << POOL_BITS)
    r = np.maximum(r, 1e-3)
    return tuple(a.astype(np.float32) for a in (r, 1 / r, rng.random(1 << POOL_BITS), np.log(np.maximum(c, 1e-6)) - r + 64))


@cache
def _multipliers() -> list[np.uint64]:
    return [np.uint64(m | 1) for m in texts.mixed(np.arange(101, 101 + SAMPLES, dtype=np.uint64)).tolist()]


def samples(hashes: np.ndarray, log_weights: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(texts, SAMPLES) sample numbers of 32 bits; texts without shingles must be left out of `at`."""
    r, one_by_r, beta, log_c = _pool()
    n = len(at) - 1
    found = np.zeros((n, SAMPLES), np.uint32)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + BLOCK_SHINGLES, "right")) - 1)
        own, weight, starts = hashes[at[first]:at[last]], log_weights[at[first]:at[last]], at[first:last] - at[first]
        place = np.arange(len(own), dtype=np.int64)
        for k, multiplier in enumerate(_multipliers()):
            draw = ((own * multiplier) >> np.uint64(64 - POOL_BITS)).astype(np.int32)
            step = np.floor(weight * one_by_r[draw] + beta[draw])
            # ln a = ln c - ln y - r with ln y = r (step - beta); 64 keeps it positive, so its bits sort as it does
            score = log_c[draw] - r[draw] * (step - beta[draw])
            best = np.minimum.reduceat((score.view(np.int32).astype(np.int64) << 32) | place, starts) & 0xFFFFFFFF
            found[first:last, k] = (texts.mixed(own[best] + step[best].astype(np.int64).astype(np.uint64)) >> np.uint64(32))
        first = last
    return found


def _signatures(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            values = texts.column_texts(batch.column("text"))
            content, signed, rows = [], [], []
            for first, last, hashes, counts, at in weighted_shingles(values):
                held = np.flatnonzero(np.diff(at))
                bounds = np.append(at[held], len(hashes))
                weights = np.log(counts * inverse_frequency(hashes, known)).astype(np.float32)
                rows.extend((held + first).tolist())
                signed.extend(s.tobytes() for s in samples(hashes, weights, bounds))
            # equal words in equal order are equal content
            for first, last, words, at in texts.word_hashes(values):
                place = np.arange(len(words)) - np.repeat(at[:-1], np.diff(at))
                held = np.flatnonzero(np.diff(at))
                for seed in (1, 2):
                    spread = texts.mixed(words + texts.mixed(place.astype(np.uint64) + np.uint64(seed << 60)))
                    content.append(np.add.reduceat(spread, at[held]) if len(held) else np.zeros(0, np.uint64))
            keys = [f"{a:016x}{b:016x}" for one, two in zip(content[::2], content[1::2]) for a, b in zip(one.tolist(), two.tolist())]
            # texts without words come last, without content
            wordless = np.setdiff1d(np.arange(len(values)), rows).tolist()
            kept = batch.select(["doc_id", "text_hash"]).take(pa.array(rows + wordless, pa.int64()))
            none = [None] * len(wordless)
            yield pa.record_batch([*kept.columns, pa.array(keys + none, pa.string()), pa.array(signed + none, pa.binary())],
                                  names=["doc_id", "text_hash", "content", "signature"])
    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        signatures = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, BANDS, ROWS)
        band = np.arange(BANDS, dtype=np.uint64)
        keys = np.broadcast_to(band, signatures.shape[:2]).copy()
        for row in range(ROWS):
            keys = texts.mixed(keys * np.uint64(0x9E3779B97F4A7C15) + signatures[:, :, row])
        # the keys of a node sort by band
        keys = keys >> np.uint64(BAND_BITS) | band << np.uint64(64 - BAND_BITS)
        nodes = np.repeat(batch.column("node").to_numpy(), BANDS)
        yield pa.record_batch([pa.array(keys.ravel().view(np.int64)), pa.array(nodes)], names=["key", "node"])


def _agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures agree often enough to be worth their texts."""
    for batch in batches:
        one, two = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, SAMPLES) for c in ("sig_a", "sig_b"))
        keep = (one == two).mean(axis=1) >= LEAST_AGREEMENT
        yield batch.select(["a", "b"]).filter(pa.array(keep))


def _by_block(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[list[tuple]]:
    """The rows of each block, from batches in order of blocks; the block comes first in `names`."""
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in names)):
            if rows and rows[-1][0] != row[0]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _block_pairs(rows: list[tuple]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, rows of the other side and of other labels that it agrees with often enough, how much) of a block's rows."""
    low = np.array([r[1] for r in rows])
    label = np.array([r[3] for r in rows], np.int64)
    signature = np.frombuffer(b"".join(r[4] for r in rows), np.uint32).reshape(-1, SAMPLES)
    # a block of one part has no other side
    within = low.all()
    one, two = np.flatnonzero(low), np.flatnonzero(low if within else ~low)
    # members of one component are not compared: only those of the labels before and behind, when sorted by it
    two = two[np.argsort(label[two], kind="stable")]
    others, other_labels = signature[two], label[two]
    if within:
        one = two
    for at in one:
        low_end, high_end = np.searchsorted(other_labels, label[at], "left"), np.searchsorted(other_labels, label[at], "right")
        for begin, end in ([(high_end, len(two))] if within else [(0, low_end), (high_end, len(two))]):
            agreed = (others[begin:end] == signature[at]).mean(axis=1)
            met = agreed >= LEAST_AGREEMENT
            if met.any():
                yield int(at), two[begin:end][met], agreed[met]


def _candidates_in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of a block that agree often enough with one of another label, once each."""
    for rows in _by_block(batches, ["block", "low", "node", "label", "signature"]):
        held = np.zeros(len(rows), bool)
        for at, others, _ in _block_pairs(rows):
            held[at] = True
            held[others] = True
        kept = [rows[i][:4] for i in np.flatnonzero(held)]
        if kept:
            yield pa.record_batch([pa.array(c) for c in zip(*kept)], names=["block", "low", "node", "label"])


def _linked_in_blocks(shared, similarity: float):
    """Members of a block with their texts -> links that join components: fewer than the block has members."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_block(batches, ["block", "low", "node", "label", "signature", "text"]):
            weighed = _weighed([r[5] for r in rows], shared.value)
            totals = [weights.sum() for _, weights in weighed]
            above = {r[3]: r[3] for r in rows}

            def root(label: int) -> int:
                while above[label] != label:
                    above[label] = label = above[above[label]]
                return label

            found = []
            for at, others, agreed in _block_pairs(rows):
                for other in others[np.argsort(-agreed, kind="stable")].tolist():
                    one, two = root(rows[at][3]), root(rows[other][3])
                    # what is joined needs no other link, and the smaller text bounds what both can share
                    if one == two or min(totals[at], totals[other]) < similarity * max(totals[at], totals[other]):
                        continue
                    if _similarity(weighed[at], weighed[other]) >= similarity:
                        above[max(one, two)] = min(one, two)
                        found.append(sorted((rows[at][2], rows[other][2])))
            if found:
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])
    return run


def _weighed(values: list[str], known: Frequencies) -> list[tuple[np.ndarray, np.ndarray]]:
    """Distinct shingles of each text and their weights."""
    own: list[tuple[np.ndarray, np.ndarray]] = []
    for first, last, hashes, counts, at in weighted_shingles(values):
        weights = counts * inverse_frequency(hashes, known)
        own.extend((hashes[at[i]:at[i + 1]], weights[at[i]:at[i + 1]]) for i in range(last - first))
    return own


def _similarity(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    (a, weight_a), (b, weight_b) = one, two
    _, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    shared = np.minimum(weight_a[in_a], weight_b[in_b]).sum()
    total = weight_a.sum() + weight_b.sum() - shared
    return shared / total if total else 0.0


def weighted_jaccard(one: list[str], two: list[str], known: Frequencies) -> np.ndarray:
    """Weighted Jaccard similarity of texts pair by pair; 0 for texts without words."""
    return np.array([_similarity(a, b) for a, b in zip(_weighed(one, known), _weighed(two, known))], float)


def _similar(shared, similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = weighted_jaccard(*(texts.column_texts(part.column(c)) for c in ("text_a", "text_b")), shared.value)
                yield part.select(["a", "b"]).filter(pa.array(found >= similarity))
    return run


def _members(keyed: DataFrame, path: str) -> DataFrame:
    """key, node, n of the buckets with more than one member."""
    # written, so that the join reads both sides by plain exchanges and a frequent key can be split
    sizes = written(keyed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > 1), f"{path}-sizes")
    return written(keyed.join(sizes, "key"), path)


def _redealt(active: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of large buckets that are still open -> key, node by each two of their open bands that follow each other.

    Members of different components that were not compared share open large buckets only: in small ones all were. So other
    bands need not be looked at, and a member gives at most NEXT_BANDS rows per open bucket.
    """
    placed = active.select("key", "node").join(labels.withColumnRenamed("label", "_label"), "node", "left")
    placed = placed.withColumn("_label", F.coalesce("_label", "node"))
    open_ = placed.groupBy("key").agg(F.min("_label").alias("low"), F.max("_label").alias("high")).filter("low <> high").select("key")
    inside = placed.join(open_, "key", "left_semi").select("key", "node")
    # at most BANDS keys, in the order of bands; the last is followed by the first
    keys = inside.groupBy("node").agg(F.sort_array(F.collect_set("key")).alias("keys")).filter(F.size("keys") > 1)

    def with_next(step: int) -> Column:
        def both(key: Column, at: Column) -> Column:
            other = F.get("keys", (at + step) % F.size("keys"))
            return F.when(key != other, F.xxhash64(F.least(key, other), F.greatest(key, other)))
        return F.transform("keys", both)

    pairs = [with_next(step) for step in range(1, NEXT_BANDS + 1)]
    return keys.select(F.explode(F.array_distinct(F.array_compact(F.concat(*pairs)))).alias("key"), "node")


def _left_over(members: DataFrame, labels: DataFrame, signatures: DataFrame, words: DataFrame, shared, similarity: float, path: str) -> DataFrame:
    """a, b of links between different labels in the large buckets among `members`, found and verified block by block."""
    large = members.filter(F.col("n") > FEW_MEMBERS).join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    large = large.join(words.select("node", F.octet_length("text").cast("long").alias("bytes")), "node")
    open_ = large.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.sum("bytes").alias("held")).filter("low <> high")
    # written, so that the join reads both sides by plain exchanges and a frequent key can be split
    open_ = written(open_.select("key", "held"), f"{path}/left-keys")
    parts = F.ceil(F.col("n") / BLOCK_MEMBERS + F.col("held") / BLOCK_BYTES)
    placed = large.join(open_, "key").withColumn("part", F.pmod(F.xxhash64("node", F.lit(1)), parts))
    placed = placed.select("key", "node", "label", "part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("other"))
    block = F.xxhash64("key", F.least("part", "other"), F.greatest("part", "other")).alias("block")
    placed = placed.select(block, (F.col("part") <= F.col("other")).alias("low"), "node", "label").join(signatures, "node")
    in_order = lambda df: df.repartition("block").sortWithinPartitions("block")
    # only members that agree with another are sent with their texts
    wanted = texts.map_batches(in_order(placed), _candidates_in_blocks, "block long, low boolean, node long, label long")
    wanted = written(wanted, f"{path}/left-wanted").join(signatures, "node").join(words, "node")
    return texts.map_batches(in_order(wanted), _linked_in_blocks(shared, similarity), "a long, b long")


def _central(members: DataFrame, path: str) -> DataFrame:
    """Members with `pivot`: whether others of the bucket are compared with them; `best`: whether it is the node's largest bucket.

    A bucket of few members compares all of them, a larger one compares all with its most central member: the one that meets
    most others in its bands. What copies have in common puts the least edited ones into large buckets everywhere, so one
    comparison links most of a group, whatever its size.
    """
    of_node = members.groupBy("node").agg(F.sum("n").alias("central"), F.max(F.struct("n", "key")).alias("largest"))
    placed = written(members.join(of_node, "node").select("key", "node", "n", "central", (F.col("key") == F.col("largest.key")).alias("best")),
                      f"{path}-placed")
    # written, so that the join reads both sides by plain exchanges and a frequent key can be split
    centre = written(placed.groupBy(F.col("key").alias("_key")).agg(F.max(F.struct("central", "node"))["node"].alias("centre")), f"{path}-centres")
    pivot = (F.col("node") == F.col("centre")) | (F.col("n") <= FEW_MEMBERS)
    return written(placed.join(centre, F.col("key") == F.col("_key")).select("key", "node", "n", "best", "centre", pivot.alias("pivot")), path)


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members with the label of their component, so far the node itself where it has no link."""
    if labels is None:
        return members.withColumn("label", F.col("node"))
    return members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def _open_pairs(members: DataFrame, labels: DataFrame, path: str) -> DataFrame:
    """a, b: members of different components and the pivots of their buckets."""
    placed = written(_labelled(members, labels), f"{path}-labelled")
    chosen = placed.filter("pivot").select(F.col("key").alias("_key"), F.col("node").alias("_node"), F.col("label").alias("_label"))
    return placed.join(chosen, (F.col("key") == F.col("_key")) & (F.col("label") != F.col("_label"))).select(
        F.least("node", "_node").alias("a"), F.greatest("node", "_node").alias("b")).distinct()


def _links(spark: SparkSession, nodes: DataFrame, documents: DataFrame, shared, similarity: float, path: str) -> DataFrame:
    """node, label of all nodes (node, signature, doc_id, text_hash) that resemble another one."""
    members = _members(texts.map_batches(nodes.select("node", "signature"), _bands, "key long, node long"), f"{path}/members")
    signatures = nodes.select("node", "signature")
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select(
        "node", F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    given = documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    # rows of equal id and text are one text
    words = written(given.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
                     .groupBy("node").agg(F.max("text").alias("text")), f"{path}/texts")
    tested: list[DataFrame] = []

    def compared(pairs: DataFrame, name: str, labels: DataFrame | None = None) -> DataFrame:
        """Labels after the links among `pairs` that were not compared before."""
        for before in tested:
            pairs = pairs.join(before, ["a", "b"], "left_anti")
        pairs = written(pairs, f"{path}/pairs-{name}")
        tested.append(pairs)
        signed = pairs.join(signatures.toDF("a", "sig_a"), "a").join(signatures.toDF("b", "sig_b"), "b")
        near = texts.map_batches(signed, _agreeing, "a long, b long")
        whole = near.join(words.toDF("a", "text_a"), "a").join(words.toDF("b", "text_b"), "b")
        # read once, by the table that labels are made from
        return relabelled(labels, texts.map_batches(whole, _similar(shared, similarity), "a long, b long"), name)

    def relabelled(labels: DataFrame | None, links: DataFrame, name: str) -> DataFrame:
        after = components(links) if labels is None else with_links(labels, links)
        return labels if after is labels else written(after, f"{path}/labels-{name}")

    # four rounds, however large the buckets: each node in its largest bucket, all buckets, open members dealt again, the rest
    central = _central(members, f"{path}/central")
    largest = central.filter("best AND node <> centre").select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
    labels = compared(largest.distinct(), "largest")
    labels = compared(_open_pairs(central, labels, f"{path}/all"), "all", labels)
    large = members.filter(F.col("n") > FEW_MEMBERS)
    redealt = written(_redealt(large, labels), f"{path}/redealt")
    again = _central(_members(redealt, f"{path}/members-again"), f"{path}/central-again")
    labels = compared(_open_pairs(again, labels, f"{path}/again"), "again", labels)
    return relabelled(labels, _left_over(members, labels, signatures, words, shared, similarity, path), "left")


def _classified(documents: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """doc_id, text_hash of every document with words, and the id and hash that stand for its class; ids of those without words."""
    spark = documents.sparkSession
    path = scratch_path(spark, "near")
    shared = spark.sparkContext.broadcast(document_frequencies(documents))
    given = documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    signed = texts.map_batches(given, _signatures(shared), f"doc_id {dict(given.dtypes)['doc_id']}, text_hash long, content string, signature binary")
    signed = written(signed, f"{path}/signed")
    worded = signed.filter(F.col("content").isNotNull())
    # missing ids sort after all others
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    classes = worded.groupBy("content").agg(first, F.min("signature").alias("signature"))
    nodes = written(classes.select(F.monotonically_increasing_id().alias("node"), "content", "first", "signature"), f"{path}/nodes")
    told = nodes.select("node", "signature", "first.doc_id", "first.text_hash")
    labels = _links(spark, told, documents, shared, similarity, path)
    shared.destroy()  # all that needs it is written
    named = nodes.join(labels, "node", "left").select("content", "first", F.coalesce("label", "node").alias("label"))
    best = named.groupBy("label").agg(F.min("first").alias("best"))
    by_content = named.join(best, "label").select("content", F.col("best.doc_id").alias("class_id"), F.col("best.text_hash").alias("class_hash"))
    return worded.select("doc_id", "text_hash", "content").join(by_content, "content").drop("content"), \
        signed.filter(F.col("content").isNull()).select("doc_id")


def near_copies(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id of every document: the smallest id of those it is linked with, directly or through others."""
    found, wordless = _classified(documents, similarity)
    return found.select("doc_id", "class_id").unionByName(wordless.select("doc_id", F.col("doc_id").alias("class_id")))


def without_copies(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents without near copies, one of each class, with their columns."""
    classes, _ = _classified(documents, similarity)
    path = scratch_path(documents.sparkSession, "near")
    classes = written(classes, f"{path}/classes")
    own = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_hash") == F.col("class_hash"))
    rows = documents.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("row.text") == F.col("_hash"))
    dropped = classes.filter(~own).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    kept = rows.join(dropped, same, "left_anti")
    # a class's own row may be repeated as it is; only then rows of equal id and text are dropped too
    repeated = classes.filter(own).groupBy("doc_id", "text_hash").count().filter("count > 1").select("doc_id", "text_hash")
    if not repeated.isEmpty():
        again = repeated.toDF("_id", "_hash")
        once = kept.join(again, same, "left_semi").groupBy("row.doc_id", "row.text").agg(F.first("row").alias("row")).select("row")
        kept = kept.join(again, same, "left_anti").union(once)
    return kept.select("row.*")
