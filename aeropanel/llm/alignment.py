"""Alignment of the tokens of two tokenizers over the same text, in Arrow arrays from end to end.

Tokenizer A is a byte-level BPE over space + text, tokenizer B a piece BPE over text, which sets the space itself. A batch of
texts is one buffer of bytes. It is cut into units before each blank that follows a visible character; no token of either
vocabulary crosses such a place, so a unit's tokens do not depend on what is around it, and each distinct unit of a
batch is encoded once. Lists of token ids per unit are taken for all units of the batch and flattened, parent indices give each token its
document, and cumulative sums of token bytes, segmented by document, give the byte at which it ends. Two tokens that end at
the same byte of a document end a group: a hash join of A's and B's ends on (document, end). The full outer join of the same
keys, filled backward, holds the pair of tokens that covers each stretch of bytes, which is one row per overlapping pair.

How often an id pair is linked is counted per document, per chunk of documents and then by Spark over all chunks. The pairs of
a chunk are numbered; documents keep numbers and counts, so that only a chunk's distinct pairs are joined with the totals.

Defined cases: a text that is missing, empty or not given back by both tokenizers byte by byte has no tokens and zeros. A
chunk is closed after the text at which it has `CHUNK_LINKS` distinct links of documents, so a longer text is a chunk of its
own, never cut. Repeated rows and missing ids are documents of their own. Ties: every pair with the highest count of its B
id counts as best. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import gc
import hashlib
import json
import uuid
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from aeropanel.llm.texts import map_batches
from aeropanel.session import scratch_path

CHUNK_LINKS = 600_000
BATCH_BYTES = 500_000
MOST_UNITS = 150_000
B_IDS = 1 << 32
BLANK, SHIFT = 0x20, 40
# fixed value: how a byte-level tokenizer parts text
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# printable ASCII and the Latin letters with marks, which no two versions of Unicode class differently
USUAL = "^[ -~À-ÿ]+$"
NOTHING = pa.scalar(b"", pa.large_binary())
COMMA, BAR, SEMICOLON = (pa.scalar(c, pa.large_string()) for c in ",|;")
WRITTEN = ("chunk string, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pair_numbers array<int>, "
           "pair_links array<int>, pairs array<long>, pair_totals array<long>")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in the entries of a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers with the byte length of every id; encodes units."""

    def __init__(self, a_path: str, b_path: str):
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        with open(a_path, encoding="utf-8") as told:
            added = {t["content"] for t in json.load(told)["added_tokens"]}
        alphabet = byte_alphabet()
        entries = sorted((i, entry) for entry, i in self.a.get_vocab().items())
        a_bytes = [b""] * (entries[-1][0] + 1)
        for i, entry in entries:
            a_bytes[i] = entry.encode() if entry in added else bytes(alphabet[c] for c in entry)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        special = {t: self.a.token_to_id(t) for t in added}
        # ids of a byte-level vocabulary are the ranks of its merges; this library is faster, and equal where both know the characters
        ranks = {entry: i for i, entry in enumerate(a_bytes) if i not in special.values()}
        self.a_ranks = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.blank = self.b.piece_to_id("▁")
        self.a_bytes, self.b_bytes = (pa.array(of, pa.large_binary()) for of in (a_bytes, b_bytes))
        self.a_lengths, self.b_lengths = (pc.binary_length(of).cast(pa.int64()) for of in (self.a_bytes, self.b_bytes))
        self.a_names, self.b_names = (pa.array(map(str, range(len(of))), pa.large_string()) for of in (a_bytes, b_bytes))

        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        nothing = _lists(np.zeros(0, np.int64), pa.array([], pa.int32()))
        self.stored = (nothing, nothing, pa.array([], pa.bool_()))

    def lists(self, units: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array]:
        """A's ids, B's ids, and whether both give the unit back, for units that begin with a blank. Common units are remembered."""
        if len(self.known) > MOST_UNITS:
            self._forget()
        found = units.to_pylist()
        new = [u for u in found if u not in self.known]
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        if new:
            self.stored = tuple(pa.concat_arrays(pair) for pair in zip(self.stored, self._encoded(new)))
        at = pa.array(np.fromiter(map(self.known.__getitem__, found), np.int64, len(found)))
        return tuple(column.take(at) for column in self.stored)

    def _encoded(self, units: list[bytes]) -> tuple[pa.Array, pa.Array, pa.Array]:
        gc.disable()  # a million short lists are made and dropped, none of them in a cycle
        try:
            texts = [u.decode("utf-8", "replace") for u in units]
            usual = pc.match_substring_regex(pa.array(texts, pa.large_string()), USUAL).to_pylist()
            rest = iter(self.a.encode_batch([t for t, u in zip(texts, usual) if not u], add_special_tokens=False))
            ranks = self.a_ranks.encode_ordinary
            a = _flat([ranks(t) if u else next(rest).ids for t, u in zip(texts, usual)])
            # the library sets the first blank of B, but gives nothing at all for an empty text
            b = _flat([ids or [self.blank] for ids in self.b.encode([t[1:] for t in texts], num_threads=1)])
        finally:
            gc.enable()
        whole = pa.array(units, pa.large_binary())
        back = [pc.equal(pc.binary_join(pa.LargeListArray.from_arrays(of.offsets, by.take(of.values)), NOTHING), whole)
                for of, by in ((a, self.a_bytes), (b, self.b_bytes))]
        return a, b, pc.and_(*back)


def _flat(lists: list[list[int]]) -> pa.Array:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return _lists(counts, pa.array(np.fromiter(chain.from_iterable(lists), np.int32, int(counts.sum()))))


def units_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The units of all texts with a blank before each, and how many each text has; an empty text has none."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    spaced = pc.if_else(pc.equal(pc.binary_length(texts), 0), pa.scalar(b"", pa.large_binary()),
                        pc.binary_join_element_wise(pa.scalar(b" ", pa.large_binary()), texts, pa.scalar(b"", pa.large_binary())))
    spaced = pa.concat_arrays([spaced])
    bounds = np.frombuffer(spaced.buffers()[1], np.int64)[spaced.offset:spaced.offset + len(spaced) + 1]
    data = np.frombuffer(spaced.buffers()[2], np.uint8)[:bounds[-1]] if bounds[-1] else np.zeros(0, np.uint8)
    cut = np.zeros(len(data) + 1, bool)
    if len(data) > 1:
        # a visible character before the blank: one byte, or a letter of two bytes from the Latin letters with marks
        before, earlier = data[:-1], np.zeros(len(data) - 1, np.uint8)
        earlier[1:] = data[:-2]
        visible = ((before > BLANK) & (before < 0x7F)) | ((before >= 0x80) & (earlier == 0xC3))
        cut[1:-1] = (data[1:] == BLANK) & visible
    cut[bounds] = True
    starts = np.flatnonzero(cut)
    counts = np.diff(np.searchsorted(starts, bounds))
    units = pa.Array.from_buffers(pa.large_binary(), max(0, len(starts) - 1), [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)])
    return units, counts


def _lists(counts: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int64()), values)


def _tokens(of_units: pa.Array, codes: pa.Array, unit_docs: pa.Array, lengths: pa.Array, doc_bytes: np.ndarray, name: str) -> pa.Table:
    """end (document and byte), id of every token of the batch, in text order."""
    taken = of_units.take(codes)
    ids = taken.flatten()
    docs = unit_docs.take(pc.list_parent_indices(taken))
    # the sum runs over the batch; a document's own begins where the bytes of all before it end
    before = pa.array(np.concatenate([[0], np.cumsum(doc_bytes)])[:-1], pa.int64())
    ends = pc.subtract(pc.cumulative_sum(lengths.take(ids)), before.take(docs))
    return pa.table({"end": pc.bit_wise_or(pc.shift_left(docs, SHIFT), ends), name: ids})


def align(tokenizers: Tokenizers, texts: pa.Array) -> tuple[pa.Table, pa.Table]:
    """Per text n_a, n_b, n_groups, n_links, groups_sha256; and per text and id pair the number of links: doc, pair, links."""
    units, counts = units_of(texts)
    coded = units.dictionary_encode()
    a_lists, b_lists, same = tokenizers.lists(coded.dictionary)
    codes = coded.indices.cast(pa.int64())
    docs = pa.array(np.repeat(np.arange(len(counts), dtype=np.int64), counts))
    # a text with one unit that is not given back has no tokens
    wrong = pc.unique(docs.filter(pc.invert(same.take(codes))))
    kept = pc.invert(pc.is_in(docs, wrong))
    unit_bytes = pc.binary_length(units).filter(kept).to_numpy(zero_copy_only=False)
    codes, docs = codes.filter(kept), docs.filter(kept)
    doc_bytes = np.bincount(docs.to_numpy(), unit_bytes, len(counts)).astype(np.int64)
    a = _tokens(a_lists, codes, docs, tokenizers.a_lengths, doc_bytes, "a")
    b = _tokens(b_lists, codes, docs, tokenizers.b_lengths, doc_bytes, "b")

    links = a.join(b, "end", join_type="full outer", use_threads=False).combine_chunks().sort_by("end")
    both = pc.and_(pc.is_valid(links["a"]), pc.is_valid(links["b"]))
    link_docs = pc.shift_right(links["end"], SHIFT)
    # bytes up to an end belong to the next token that ends
    pair = pc.add(pc.multiply(pc.fill_null_backward(links["a"]).cast(pa.int64()), B_IDS), pc.fill_null_backward(links["b"]).cast(pa.int64()))
    of_docs = pa.table({"doc": link_docs, "pair": pair}).group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")]) \
        .rename_columns(["doc", "pair", "links"]).sort_by("doc")

    groups = links.filter(both)["end"].combine_chunks()
    number = lambda column: np.bincount(np.asarray(column), minlength=len(counts)).astype(np.int64)
    n_groups = number(pc.shift_right(groups, SHIFT))
    texts_of = [_grouped(t["end"], t[name], groups, names) for t, name, names in ((a, "a", tokenizers.a_names), (b, "b", tokenizers.b_names))]
    lines = pc.binary_join(_lists(n_groups, pc.binary_join_element_wise(*texts_of, BAR)), SEMICOLON)
    digests = [hashlib.sha256(line.as_buffer()).hexdigest() if n else "" for line, n in zip(lines, n_groups, strict=True)]
    return pa.table({
        "n_a": number(pc.shift_right(a["end"], SHIFT)), "n_b": number(pc.shift_right(b["end"], SHIFT)), "n_groups": n_groups,
        "n_links": number(link_docs), "groups_sha256": digests}), of_docs


def _grouped(ends: pa.ChunkedArray, ids: pa.ChunkedArray, groups: pa.Array, names: pa.Array) -> pa.Array:
    """The ids of each group, parted by commas."""
    last = np.searchsorted(np.asarray(ends), np.asarray(groups), side="right")
    offsets = pa.array(np.concatenate([[0], last]), pa.int64())
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, names.take(ids.combine_chunks())), COMMA)


def _parts(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Neighbouring rows of about BATCH_BYTES."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < len(sizes):
        begun = sizes[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sizes, begun + BATCH_BYTES, side="right")))
        yield first, last
        first = last


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _chunk(ids: list[pa.Array], facts: list[pa.Table], links: list[pa.Table], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The documents of a chunk with numbered pairs, and a row with the pairs."""
    name, n = uuid.uuid4().hex, sum(len(i) for i in ids)
    bases = np.cumsum([0, *(len(i) for i in ids)])
    of_docs = pa.concat_tables([t.set_column(0, "doc", pc.add(t["doc"], pa.scalar(base, pa.int64()))) for t, base in zip(links, bases)])
    coded = of_docs["pair"].combine_chunks().dictionary_encode()
    counts = np.bincount(of_docs["doc"].to_numpy(), minlength=n)
    totals = np.bincount(coded.indices.to_numpy(), of_docs["links"].to_numpy(), len(coded.dictionary)).astype(np.int64)
    told = pa.concat_tables(facts)
    offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, v.cast(pa.int32())) for v in (coded.indices, of_docs["links"].combine_chunks())]
    documents = pa.table({"chunk": pa.array([name] * n, pa.string()), "doc_id": pa.concat_arrays(ids),
                          **{c: told[c] for c in told.column_names}, "pair_numbers": lists[0], "pair_links": lists[1]})
    pairs = pa.table({"chunk": pa.array([name]), "pairs": _one_list(coded.dictionary), "pair_totals": _one_list(pa.array(totals))})
    for table in (documents, pairs):
        columns = [table[f.name].cast(f.type).combine_chunks() if f.name in table.column_names else pa.nulls(len(table), f.type) for f in schema]
        yield from pa.table(columns, schema=schema).to_batches(max_chunksize=1000)


_loaded: dict[tuple[str, str], Tokenizers] = {}


def aligned(a_path: str, b_path: str, chunk_links: int = CHUNK_LINKS) -> Callable:
    """The function that tasks run over batches of doc_id and text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = {"pair_numbers": pa.int32(), "pair_links": pa.int32(), "pairs": pa.int64(), "pair_totals": pa.int64()}
        plain = {"chunk": pa.string(), "groups_sha256": pa.string()}
        names = [part.split()[0] for part in WRITTEN.split(", ")]
        schema = pa.schema([(n, pa.list_(lists[n]) if n in lists else plain.get(n, pa.int64())) for n in names])
        if (a_path, b_path) not in _loaded:
            _loaded[a_path, b_path] = Tokenizers(a_path, b_path)
        tokenizers = _loaded[a_path, b_path]
        ids, facts, links = [], [], []
        for batch in batches:
            for first, last in _parts(batch.column(1)):
                part = batch.slice(first, last - first)
                told, of_docs = align(tokenizers, part.column(1))
                ids.append(part.column(0).cast(pa.int64()))
                facts.append(told)
                links.append(of_docs)
                if sum(len(t) for t in links) >= chunk_links:
                    yield from _chunk(ids, facts, links, schema)
                    ids, facts, links = [], [], []
        if ids:
            yield from _chunk(ids, facts, links, schema)

    return run


def _scored(key: tuple, documents: pa.Table, pairs: pa.Table) -> pa.Table:
    """n_best and count_sum of a chunk's documents."""
    count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    at = pairs["number"].to_numpy()
    count[at], best[at] = pairs["count"].to_numpy(), pairs["best"].to_numpy()
    out = documents.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    numbers = documents["pair_numbers"].combine_chunks()
    at, links = numbers.flatten().to_numpy(), documents["pair_links"].combine_chunks().flatten().to_numpy()
    of = pc.list_parent_indices(numbers).to_numpy()

    def summed(values: np.ndarray) -> pa.Array:
        each = np.zeros(len(out), np.int64)
        np.add.at(each, of, values)
        return pa.array(each)

    return out.append_column("n_best", summed(links * best[at])).append_column("count_sum", summed(links * count[at]))


def pair_counts(written: DataFrame) -> DataFrame:
    """pair, count (links of the pair over all documents), best (1 if no pair of its B id has more)."""
    each = written.filter(F.col("pairs").isNotNull()).select(F.explode(F.arrays_zip("pairs", "pair_totals")).alias("p"))
    counted = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.pair_totals").alias("count"))
    # a B id has at most as many pairs as A has ids
    most = F.max("count").over(Window.partitionBy(F.col("pair") % B_IDS))
    return counted.select("pair", "count", (F.col("count") == most).cast("long").alias("best"))


def document_alignment(documents: DataFrame, a_path: str, b_path: str, chunk_links: int = CHUNK_LINKS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    spark = documents.sparkSession
    path = scratch_path(spark, "alignment")
    map_batches(documents.select(F.col("doc_id").cast("long"), "text"), aligned(a_path, b_path, chunk_links), WRITTEN) \
        .withColumn("kind", F.when(F.col("pairs").isNull(), "documents").otherwise("pairs")).write.partitionBy("kind").parquet(path)
    # read twice, so that the columns of both sides are told apart
    written, of_pairs = (spark.read.schema(WRITTEN + ", kind string").parquet(path).filter(F.col("kind") == kind) for kind in ("documents", "pairs"))
    of_chunks = of_pairs.select("chunk", F.posexplode("pairs").alias("number", "pair"))
    # a pair is in a chunk once
    told = of_chunks.join(pair_counts(of_pairs), "pair").select("chunk", "number", "count", "best")
    rows = written.drop("kind", "pairs", "pair_totals")
    scored = rows.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        _scored, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
