"""Token ids in files compressed by Re-Pair, with random access.

Documents are encoded in the order of their ids and cut into shards of neighbouring documents. In a shard, the most
frequent pairs of neighbouring symbols are replaced by new symbols, again and again: each round counts all pairs, takes
those that are at least a quarter as frequent as the best one, and replaces their occurrences from left to right. No
pair crosses the end of a document. A shard stores its rules, the number of ids each rule stands for, where every
document begins, and its symbols in 16 bits; so any stretch of ids is decoded without what stands before it.

Only distinct pieces of text are handed to the tokenizer, once per task; the tokenizer encodes pieces independently of
each other. Texts with other than plain characters, or with what could be a special token, are handed over whole.

Shards are rows of Parquet files, written by Spark to any file system it reaches: partition and place tell their order,
`data` is the shard in the layout of `pack_shard`. Where a shard's ids begin follows from the sizes of those before.

Defined cases: a missing text is an empty one, its document is the end id alone; missing ids come last; rows of equal
id are separate documents, ordered by the hash of their text; no documents make no shards.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aeropanel.llm import pieces, texts
from aeropanel.session import scratch_path

END_ID = 2
SHARD_IDS = 1 << 20
LEAST_USES = 64
ROUND_SHARE = 4
SYMBOLS = 1 << 16  # symbols of a shard are stored in 16 bits
KNOWN_PIECES = 1_000_000
KNOWN_IDS = 8_000_000
SLOT_BITS = 22
PAIR_BITS = 18  # counts that fit a cache
MAGIC = b"RPID0001"
MISSING_ID = -(1 << 63)


class PieceEncoder:
    """Encodes texts with one tokenizer file, every distinct piece once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.size = self.library.get_vocab_size()
        ends = np.zeros(self.size, bool)
        for token, number in self.library.get_vocab(with_added_tokens=False).items():
            ends[number] = token.endswith("</w>")
        self.ends = ends
        self._forget()

    def _forget(self) -> None:
        """Empties the store of pieces: by the top bits of its hash, the last piece learned there; hash and ids of every piece."""
        self._learned, self._used = 0, 0
        self._place = np.full(1 << SLOT_BITS, -1, np.int32)
        self._hash, self._begin, self._size = np.zeros(1 << 12, np.uint64), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int32)
        self._pool = np.zeros(1 << 16, np.int32)

    def _whole(self, values: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(values, add_special_tokens=False)]

    def _pieces(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of many pieces and how many each has; a piece ends where a token ends a word."""
        ids = np.array(self._whole([" ".join(names)])[0], np.int32)
        sizes = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
        if len(sizes) != len(names):  # not expected of plain pieces
            found = self._whole(names)
            return np.array([i for f in found for i in f], np.int32), np.array([len(f) for f in found])
        return ids, sizes

    def _learn(self, hashes: np.ndarray, names: list[str]) -> np.ndarray:
        """Stores pieces and gives their places."""
        before = self._learned
        for at in range(0, len(names), 2000):
            ids, sizes = self._pieces(names[at:at + 2000])
            first = self._learned
            begins = self._used + np.cumsum(sizes) - sizes
            self._pool = held(self._pool, self._used, ids)
            self._hash = held(self._hash, first, hashes[at:at + 2000])
            self._begin, self._size = held(self._begin, first, begins), held(self._size, first, sizes)
            self._used += len(ids)
            self._learned += len(sizes)
        places = np.arange(before, self._learned, dtype=np.int32)
        # a piece takes the slot of another one, which is learned again if it comes again
        self._place[_slots(hashes)] = places
        return places

    def _places(self, joined: str, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        hashes = texts.span_hashes(points, starts, ends)
        places = self._place[_slots(hashes)]
        new = np.flatnonzero((places < 0) | (self._hash[places] != hashes))
        if not len(new):
            return places
        code, distinct = pd.factorize(hashes[new])
        if self._learned and (self._learned + len(distinct) > KNOWN_PIECES or self._used > KNOWN_IDS):
            self._forget()
            return self._places(joined, points, starts, ends)
        first = np.zeros(len(distinct), np.int64)
        first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
        where = new[first]
        names = [joined[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist())]
        places[new] = self._learn(distinct, names)[code]
        return places

    def encode(self, values: list[str]) -> Iterator[np.ndarray]:
        """Ids of each text, in order."""
        lowered = [t.lower() for t in values]
        for part in texts.slices(lowered, texts.WORD_SLICE_CHARS):
            plain = pieces.plain_texts(part) & np.array(["<|" not in t for t in values[part.first:part.last]])
            starts, ends = pieces.cut(part.points, part.bounds, pieces.BARE)
            owner = np.searchsorted(part.bounds, starts, "right") - 1
            own = plain[owner]
            starts, ends, owner = starts[own], ends[own], owner[own]
            ids, at = np.zeros(0, np.int32), np.zeros(len(plain) + 1, np.int64)
            if len(starts):
                places = self._places("".join(lowered[part.first:part.last]), part.points, starts, ends)
                sizes = self._size[places]
                ids = pieces.gather(self._pool, self._begin[places], sizes)
                at[1:] = np.cumsum(np.bincount(owner, sizes, len(plain)))
            for i, is_plain in enumerate(plain.tolist()):
                if is_plain:
                    yield ids[at[i]:at[i + 1]]
                else:
                    yield np.array(self._whole([values[part.first + i]])[0], np.int32)


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def held(pool: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """The pool with `more` behind its used part, larger if it was full."""
    if used + len(more) > len(pool):
        pool = np.concatenate([pool[:used], np.zeros(used + 2 * len(more), pool.dtype)])
    pool[used:used + len(more)] = more
    return pool


@cache
def encoder(path: str) -> PieceEncoder:
    return PieceEncoder(path)


class Grammar(NamedTuple):
    """Symbols of all documents, where each begins, and the rules; symbol `first + i` stands for rule i."""

    symbols: np.ndarray
    starts: np.ndarray
    rules: np.ndarray
    first: int


def compress(ids: np.ndarray, starts: np.ndarray, first: int, least_uses: int = LEAST_USES) -> Grammar:
    """Re-Pair over the documents that begin at `starts` (with the end as last entry); ids are below `first`."""
    symbols, last = ids.astype(np.int32), np.zeros(len(ids), bool)
    last[starts[1:][starts[1:] > 0] - 1] = True
    rules: list[np.ndarray] = []
    n_rules = 0
    bits = max(10, min(PAIR_BITS, int(len(ids)).bit_length()))
    while len(symbols) > 1 and first + n_rules < SYMBOLS:
        # symbols have 16 bits
        halves = symbols.view(np.uint32)
        pairs = halves[:-1] << np.uint32(16) | halves[1:]
        # a count per hash is no less than that of its pairs, so it leaves out most that are too rare before exact counting
        spots = ((pairs * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)).astype(np.int64)
        counts = np.bincount(spots, minlength=1 << bits)
        # the best pair has no fewer uses than any pair of the fullest hash
        fullest = np.flatnonzero(spots == counts.argmax())
        fullest = np.unique(pairs[fullest[~last[fullest]]], return_counts=True)[1].max(initial=0)
        often = np.flatnonzero((counts >= max(least_uses, -(-int(fullest) // ROUND_SHARE)))[spots])
        often = often[~last[often]]
        if not len(often):
            break
        code, distinct = pd.factorize(pairs[often])
        uses = np.bincount(code)
        best = int(uses.max())
        if best < least_uses:
            break
        chosen = np.flatnonzero(uses >= max(least_uses, -(-best // ROUND_SHARE)))
        chosen = chosen[np.argsort(-uses[chosen], kind="stable")][:SYMBOLS - first - n_rules]
        number = np.full(len(distinct), -1, np.int32)
        number[chosen] = np.arange(len(chosen))
        at, rule = often, number[code]
        at, rule = at[rule >= 0], rule[rule >= 0]
        # of occurrences that overlap, every second one is replaced
        fresh = np.ones(len(at), bool)
        fresh[1:] = at[1:] != at[:-1] + 1
        run = np.flatnonzero(fresh)
        even = (np.arange(len(at)) - np.repeat(run, np.diff(run, append=len(at)))) % 2 == 0
        at, rule = at[even], rule[even]
        pair = distinct[chosen]
        rules.append(np.stack([pair >> np.uint32(16), pair & np.uint32(0xFFFF)], 1).astype(np.int32))
        symbols[at] = first + n_rules + rule
        n_rules += len(chosen)
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        last[at] = last[at + 1]
        symbols, last = symbols[keep], last[keep]
    ends = np.concatenate([[0], np.flatnonzero(last) + 1])
    at = np.zeros(len(starts), np.int64)
    # documents without ids begin where the next one does
    at[1:] = ends[np.cumsum(np.diff(starts) > 0)]
    return Grammar(symbols, at, np.concatenate(rules) if rules else np.zeros((0, 2), np.int32), first)


def expansion_sizes(rules: np.ndarray, first: int) -> np.ndarray:
    """Number of ids of every symbol."""
    sizes = [1] * first
    for left, right in rules.tolist():
        sizes.append(sizes[left] + sizes[right])
    return np.array(sizes, np.int64)


def pack_shard(grammar: Grammar, doc_ids: np.ndarray, starts: np.ndarray) -> bytes:
    """Layout, little endian: the magic; numbers of documents, rules and symbols and the first rule's symbol (64 bits
    each); rules (two 16-bit symbols each); ids per rule (32 bits); document ids (64 bits); first id and first symbol of
    each document, and the ends (64 bits); symbols (16 bits)."""
    sizes = expansion_sizes(grammar.rules, grammar.first)[grammar.first:]
    head = struct.pack("<4q", len(doc_ids), len(grammar.rules), len(grammar.symbols), grammar.first)
    return b"".join([MAGIC, head, grammar.rules.astype("<u2").tobytes(), sizes.astype("<u4").tobytes(), doc_ids.astype("<i8").tobytes(),
                     starts.astype("<i8").tobytes(), grammar.starts.astype("<i8").tobytes(), grammar.symbols.astype("<u2").tobytes()])


class Shard:
    """Reads a packed shard; nothing is decoded before it is asked for."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a shard of token ids")
        n_docs, n_rules, n_symbols, self.first = struct.unpack_from("<4q", data, 8)
        at = 40

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, count, at)
            at += found.nbytes
            return found

        self.rules = take("<u2", 2 * n_rules).reshape(-1, 2)
        self.sizes = np.concatenate([np.ones(self.first, np.int64), take("<u4", n_rules)])
        self.doc_ids = take("<i8", n_docs)
        self.starts, self.symbol_starts = take("<i8", n_docs + 1), take("<i8", n_docs + 1)
        self.symbols = take("<u2", n_symbols)

    @property
    def _expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all symbols one after another, and where each begins."""
        if not hasattr(self, "_expanded"):
            begins = np.concatenate([[0], np.cumsum(self.sizes)])
            pool = np.zeros(begins[-1], np.uint32)
            pool[:self.first] = np.arange(self.first)
            for i, (left, right) in enumerate(self.rules.tolist()):
                at, cut = begins[self.first + i], begins[self.first + i] + self.sizes[left]
                pool[at:cut] = pool[begins[left]:begins[left + 1]]
                pool[cut:begins[self.first + i + 1]] = pool[begins[right]:begins[right + 1]]
            self._expanded = pool, begins[:-1]
        return self._expanded

    def ids(self, first: int, last: int) -> np.ndarray:
        """Ids of documents `first` to `last` - 1."""
        symbols = self.symbols[self.symbol_starts[first]:self.symbol_starts[last]]
        pool, begins = self._expansions
        return pieces.gather(pool, begins[symbols], self.sizes[symbols])

    def stretch(self, document: int, first: int, last: int) -> np.ndarray:
        """Ids `first` to `last` - 1 of one document, from the symbols that cover them only."""
        symbols = self.symbols[self.symbol_starts[document]:self.symbol_starts[document + 1]]
        ends = np.cumsum(self.sizes[symbols])
        a, b = np.searchsorted(ends, first, "right"), np.searchsorted(ends, last, "left") + 1
        pool, begins = self._expansions
        covered = pieces.gather(pool, begins[symbols[a:b]], self.sizes[symbols[a:b]])
        skipped = int(ends[a - 1]) if a else 0
        return covered[first - skipped:last - skipped]


def _packed(path: str, end_id: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, partition, place = encoder(path), TaskContext.get().partitionId(), 0
        doc_ids: list[int] = []
        encoded: list[np.ndarray] = []
        end, size = np.array([end_id], np.int32), 0

        def shard() -> pa.RecordBatch:
            starts = np.concatenate([[0], np.cumsum([len(e) + 1 for e in encoded])])
            ids = np.concatenate([part for e in encoded for part in (e, end)])
            data = pack_shard(compress(ids, starts, max(known.size, end_id + 1)), np.array(doc_ids, np.int64), starts)
            return pa.record_batch([pa.array([partition], pa.int32()), pa.array([place], pa.int32()), pa.array([len(doc_ids)]),
                                    pa.array([len(ids)]), pa.array([data], pa.binary())], names=["partition", "place", "n_docs", "n_ids", "data"])

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for doc_id, tokens in zip(ids, known.encode(texts.column_texts(batch.column("text")))):
                doc_ids.append(MISSING_ID if doc_id is None else doc_id)
                encoded.append(tokens)
                size += len(tokens) + 1
                if size >= shard_ids:
                    yield shard()
                    doc_ids, encoded, size, place = [], [], 0, place + 1
        if doc_ids:
            yield shard()
    return run


def write_shards(documents: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS) -> None:
    """Encodes documents (doc_id, text) in the order of their ids and writes their shards below `path`."""
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    ordered = documents.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    texts.map_batches(ordered, _packed(tokenizer, end_id, shard_ids),
                      "partition int, place int, n_docs long, n_ids long, data binary").write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards below `path`, with `start`: the number of ids in all shards before."""
    shards = spark.read.parquet(path)
    sizes = shards.groupBy("partition").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("partition").rowsBetween(Window.unboundedPreceding, -1)
    partitions = sizes.select(F.col("partition").alias("_partition"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("partition").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    starts = shards.select("partition", "place", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("_within")) \
        .join(partitions, F.col("partition") == F.col("_partition")).select(
            F.col("partition").alias("_partition"), F.col("place").alias("_place"), (F.col("_before") + F.col("_within")).alias("start"))
    return shards.join(starts, (F.col("partition") == F.col("_partition")) & (F.col("place") == F.col("_place"))).drop("_partition", "_place")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for data, start in zip(batch.column("data"), batch.column("start").to_pylist()):
            shard = Shard(data.as_py())
            n, starts = len(shard.doc_ids), shard.starts
            ids = shard.ids(0, n).astype("<u4")
            if len(ids) != starts[-1]:
                raise ValueError("a shard decodes to another number of ids than it tells")
            raw, at = memoryview(ids.tobytes()), (4 * starts).tolist()
            sums = [zlib.crc32(raw[a:b]) for a, b in zip(at, at[1:])]
            yield pa.record_batch(
                [pa.array(shard.doc_ids, mask=shard.doc_ids == MISSING_ID), pa.array(start + starts[:-1]), pa.array(np.diff(starts)),
                 pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def document_digests(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the decoded shards."""
    return texts.map_batches(shards.select("data", "start"), _digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encoded(documents: DataFrame, tokenizer: str) -> DataFrame:
    """Writes the documents' ids to shards and reads them back."""
    spark = documents.sparkSession
    path = scratch_path(spark, "token-ids")
    write_shards(documents, tokenizer, path)
    return document_digests(read_shards(spark, path))
