"""Exact token counts of every prefix of a text under a byte-level BPE tokenizer.

The encoding of a prefix ends in exactly one token: the one that fits its bytes, and that stays unmerged beside the
last token of what remains. So the count of a prefix is one more than that of the prefix before its last token, and one
pass over a piece of text fills the counts of all its prefixes. Whether two neighbouring tokens stay unmerged is
decided once per pair of tokens, by merging their bytes. Distinct pieces are worked on once per task, in sorted order,
so that a piece reuses the counts of the prefix it shares with the one before it.

`prefix_counts` stores, per text, the change of the count at each code point; the column answers later questions
without encoding again: `counts_at` (tokens of any prefix) and `truncated` (the longest prefix within a budget).

Defined cases: a missing text is an empty one with no tokens. Strings of special tokens inside a text are one token, as
in the library; a prefix that ends inside such a string sees ordinary text. Rows, ids and other columns pass through.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain
from operator import sub

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeropanel.llm import pieces, texts

BUDGET = 512
KNOWN_PIECES = 1_000_000


def byte_letters() -> dict[str, int]:
    """Letter that stands for each byte in byte-level vocabularies: itself if printable, else the next from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(0x100) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def _held(pool: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """The pool with `more` behind its used part, twice as large if it was full."""
    if used + len(more) > len(pool):
        pool = np.concatenate([pool[:used], np.zeros(used + 2 * len(more), pool.dtype)])
    pool[used:used + len(more)] = more
    return pool


class PrefixCounter:
    """Counts of all prefixes of a piece, for one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        letters = byte_letters()
        as_bytes = lambda token: bytes(letters[c] for c in token)
        self.special = [t["content"] for t in told["added_tokens"]]
        # tokens are numbered by age: the bytes, then the merged ones in the order of their merges
        self.tokens = {bytes([b]): b for b in range(256)}
        self.parts = [(b, b) for b in range(256)]
        self.joins: dict[int, int] = {}
        for left, right in told["model"]["merges"]:
            pair = self.tokens[as_bytes(left)], self.tokens[as_bytes(right)]
            self.joins[pair[0] << 20 | pair[1]] = self.tokens[as_bytes(left + right)] = len(self.parts)
            self.parts.append(pair)
        self.longest = max(map(len, self.tokens))
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self._apart: dict[int, bool] = {}
        self._known: dict[int, int] = {}
        self._pool, self._used = np.zeros(1 << 20, np.int16), 0
        self._begin, self._total = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self._past: tuple[bytes, list[int], list[int], list[int]] = (b"", [-1], [0], [0])

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens in a row are encoded as just these two.

        Undoes the merges of both, the youngest first, and asks at each step whether an older merge would have joined
        what then stood on the two sides of the border.
        """
        key = left << 20 | right
        if (apart := self._apart.get(key)) is not None:
            return apart
        if len(self._apart) > KNOWN_PIECES:
            self._apart.clear()
        parts, joins = self.parts, self.joins
        limit = len(parts)
        a, b = left, right
        while True:
            if joins.get(a << 20 | b, limit) < limit:
                apart = False
                break
            if a < 256 and b < 256:
                apart = True
                break
            # of the two sides the younger token was made later; at equal age the left one is merged first
            if a > b:
                limit, a = a, parts[a][1]
            else:
                limit, b = b + 1, parts[b][0]
        self._apart[key] = apart
        return apart

    def byte_counts(self, data: bytes) -> list[int]:
        """Tokens of data[:0], data[:1], ..., data[:len(data)]."""
        before, last, begins, count = self._past
        shared, most = 0, min(len(before), len(data))
        if before[:most] == data[:most]:
            shared = most
        else:
            while before[shared] == data[shared]:
                shared += 1
        last, begins, count = last[:shared + 1], begins[:shared + 1], count[:shared + 1]
        tokens, known, decide = self.tokens, self._apart.get, self.stay_apart
        for end in range(shared + 1, len(data) + 1):
            # mostly the last token grows, else a short one begins
            for begin in chain((begins[end - 1],), range(end - 1, max(-1, end - self.longest - 1), -1)):
                token = tokens.get(data[begin:end])
                if token is None:
                    continue
                if begin:
                    apart = known(last[begin] << 20 | token)
                    if not (decide(last[begin], token) if apart is None else apart):
                        continue
                last.append(token)
                begins.append(begin)
                count.append(count[begin] + 1)
                break
        self._past = (data, last, begins, count)
        return count

    def piece_counts(self, piece: str) -> list[int]:
        """Tokens of the prefixes of 1, 2, ... code points of one piece."""
        data = piece.encode("utf-8", "surrogatepass")
        counts = self.byte_counts(data)
        if len(data) == len(piece):
            found = counts[1:]
        else:
            found = [counts[i] for i in range(1, len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80]
        if len(piece) == 3 and piece[0] == "'" and piece[1:] in pieces.LONG_ENDINGS:
            # an ending that is not complete yet is an apostrophe and a word
            found = [found[0], found[0] + self.byte_counts(data[1:2])[-1], found[2]]
        return found

    def _learn(self, hashes: np.ndarray, names: list[str]) -> None:
        steps: list[int] = []
        begins, totals, first = [], [], len(self._known)
        for piece, value in sorted(zip(names, hashes.tolist(), strict=True)):
            counts = self.piece_counts(piece)
            self._known[value] = len(self._known)
            begins.append(self._used + len(steps))
            totals.append(counts[-1])
            steps.append(counts[0])
            steps.extend(map(sub, counts[1:], counts))
        self._pool = _held(self._pool, self._used, np.array(steps, np.int16))
        self._begin, self._total = _held(self._begin, first, np.array(begins)), _held(self._total, first, np.array(totals))
        self._used += len(steps)

    def places(self, joined: str, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places of the pieces among the known ones; new ones are worked out."""
        code, distinct = pd.factorize(texts.span_hashes(points, starts, ends))
        known = self._known
        new = [i for i, h in enumerate(distinct.tolist()) if h not in known]
        if new and len(known) + len(new) > KNOWN_PIECES:
            known.clear()
            self._used, new = 0, list(range(len(distinct)))
        if new:
            first = np.full(len(distinct), -1, np.int64)
            first[code[::-1]] = np.arange(len(code) - 1, -1, -1)
            where = first[new]
            self._learn(distinct[new], [joined[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist())])
        return np.array([self._known[h] for h in distinct.tolist()], np.int64)[code]

    def steps(self, joined: str, points: np.ndarray, bounds: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Change of the count at every code point, from the pieces of ordinary texts."""
        places = self.places(joined, points, starts, ends)
        found = pieces.gather(self._pool, self._begin[places], ends - starts).astype(np.int32)
        # a prefix that ends in white space ends in one piece of it, though its last blank belongs to the next word
        blank = texts.class_table()[points] == texts.SPACE
        gap_start, gap_end = texts.runs(blank, bounds)
        inside = np.zeros(len(points) + 1, bool)
        inside[bounds[:-1]] = True
        long = (gap_end - gap_start > 1) & (gap_end < len(points)) & ~inside[gap_end]
        gap_start, gap_end = gap_start[long], gap_end[long]
        if len(gap_start):
            whole = self._totals(joined, points, gap_start, gap_end)
            parted = np.add.reduceat(found, np.stack([gap_start, gap_end], 1).ravel())[::2]
            found[gap_end - 1] += whole - parted
            found[gap_end] -= whole - parted
        return found

    def _totals(self, joined: str, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        places = self.places(joined, points, starts, ends)
        return self._total[places]

    def text_steps(self, text: str) -> np.ndarray:
        """Change of the count at every code point of any text, cut by the library itself."""
        found, at = [], 0
        while at < len(text):
            place, special = min(((p, s) for s in self.special if (p := text.find(s, at)) >= 0), default=(len(text), ""))
            ordinary = text[at:place + len(special)]
            points = np.frombuffer(ordinary.encode("utf-32-le", "surrogatepass"), np.uint32)
            spans = [span for _, span in self.splitter.pre_tokenize_str(ordinary)]
            starts, ends = np.array(spans, np.int64).reshape(-1, 2).T
            steps = self.steps(ordinary, points, np.array([0, len(points)]), starts, ends)
            if special:
                # the string is complete: one token after what stands before it
                steps[-1] = steps[:place - at].sum() + 1 - steps[:-1].sum()
            found.append(steps)
            at = place + len(special)
        return np.concatenate(found) if found else np.zeros(0, np.int32)

    def batch_steps(self, values: list[str]) -> Iterator[np.ndarray]:
        """Change of the count at every code point, text by text."""
        for part in texts.slices(values):
            plain = pieces.plain_texts(part)
            own = values[part.first:part.last]
            plain &= np.array([not any(s in t for s in self.special) for t in own])
            kept = [t for t, p in zip(own, plain) if p]
            joined = "".join(kept)
            points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
            bounds = np.zeros(len(kept) + 1, np.int64)
            np.cumsum([len(t) for t in kept], out=bounds[1:])
            steps = self.steps(joined, points, bounds, *pieces.cut(points, bounds, pieces.SPACED)) if joined else np.zeros(0, np.int32)
            at = 0
            for text, is_plain in zip(own, plain):
                if is_plain:
                    yield steps[bounds[at]:bounds[at + 1]]
                    at += 1
                else:
                    yield self.text_steps(text)


@cache
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def pack(steps: np.ndarray) -> bytes:
    return zlib.compress(steps.astype("<i2").tobytes(), 1)


def counts_at(packed: bytes) -> np.ndarray:
    """Tokens of the prefixes of 0, 1, 2, ... code points, from the stored column."""
    steps = np.frombuffer(zlib.decompress(packed), "<i2")
    return np.concatenate([[0], np.cumsum(steps, dtype=np.int64)])


def prefix_counts(documents: DataFrame, path: str, name: str = "prefix_counts", total: str = "n_tokens") -> DataFrame:
    """Adds the stored counts of all prefixes of `text` and the count of the whole text."""
    kept = documents.drop(name, total)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(path)
        for batch in batches:
            stored, totals = [], []
            for steps in known.batch_steps(texts.column_texts(batch.column("text"))):
                stored.append(pack(steps))
                totals.append(int(steps.sum()))
            yield pa.record_batch([*batch.columns, pa.array(stored, pa.binary()), pa.array(totals, pa.int64())],
                                  names=[*batch.schema.names, name, total])

    return texts.map_batches(kept, counted, f"{texts.ddl(kept)}, `{name}` binary, `{total}` long")


def truncated(counted: DataFrame, budget: int, name: str = "prefix_counts") -> DataFrame:
    """The longest prefix of each text with at most `budget` tokens -> the columns, `text` cut, and its `n_tokens`."""
    kept = counted.drop("n_tokens")

    def shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cut, tokens = [], []
            for text, packed in zip(texts.column_texts(batch.column("text")), batch.column(name).to_pylist()):
                counts = counts_at(packed)
                end = int(np.flatnonzero(counts <= budget)[-1])
                cut.append(text[:end])
                tokens.append(int(counts[end]))
            at = batch.schema.get_field_index("text")
            changed = batch.set_column(at, batch.schema.field(at), pa.array(cut, batch.schema.field(at).type))
            yield pa.record_batch([*changed.columns, pa.array(tokens, pa.int64())], names=[*batch.schema.names, "n_tokens"])

    return texts.map_batches(kept, shortened, f"{texts.ddl(kept)}, n_tokens long")


def document_tokens(documents: DataFrame, path: str, budget: int = BUDGET) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document."""
    counted = prefix_counts(documents.select("doc_id", "text"), path)
    return counted.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                          "n_tokens", (F.col("n_tokens") > budget).alias("over_limit"))
