"""Alignment of two tokenizers against loops over the tokens of whole texts as the libraries give them."""

import hashlib
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from conftest import CHECK
from tokenizers import Tokenizer

from aeropanel.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, chunk int, kind string, pairs int, number string"
ODD = ["", None, " ", "  ", "a", "word ", " word", "two  blanks   three", "line\nbreak \n and\ttab\r\n x", "   x  y", "<|endoftext|> <s></s> <unk> <0x41>",
       "don't I'LL we've", "12 345,67 $8%", "中文字 和 한국어 عربى", "é é ÀÿŒ × ÷", "a▁b", "� x", "👩‍👩‍👧 🎈", "\x00\x01\x1c \x85 x", "x" * 3000,
       "lorem ipsum " * 2000, "a b " * 50 + "▁", "end.\n\n", "\U00010570 \U0001e4d0 \U0002ebf0", "ab᠎ cd﻿ ef"]


def spans(ids, pieces):
    found, at = [], 0
    for i in ids:
        found.append((at, at + len(pieces[i]), i))
        at += len(pieces[i])
    return found


def by_loop(texts):
    told = alignment.Tokenizers(A, B)
    a_bytes, b_bytes = told.a_bytes.to_pylist(), told.b_bytes.to_pylist()
    library, pieces = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    library.encode_special_tokens = True
    facts, counts = [], Counter()
    for text in texts:
        want = (" " + text).encode() if text else b""
        a = library.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        if b"".join(a_bytes[i] for i in a) != want or b"".join(b_bytes[i] for i in b) != want:
            a, b = [], []
        a, b = spans(a, a_bytes), spans(b, b_bytes)
        links, first = [], 0
        for start, end, i in a:
            while first < len(b) and b[first][1] <= start:
                first += 1
            at = first
            while at < len(b) and b[at][0] < end:
                links.append((i, b[at][2]))
                at += 1
        both = sorted({e for _, e, _ in a} & {e for _, e, _ in b})
        groups = [[[], []] for _ in both]
        for side, tokens in enumerate((a, b)):
            at = 0
            for _, end, i in tokens:
                while both[at] < end:
                    at += 1
                groups[at][side].append(str(i))
        line = ";".join(",".join(x) + "|" + ",".join(y) for x, y in groups)
        counts.update(links)
        facts.append((len(a), len(b), len(both), links, hashlib.sha256(line.encode()).hexdigest() if a else ""))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [(na, nb, ng, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), digest)
            for na, nb, ng, links, digest in facts]


@pytest.mark.parametrize("chunk_links", [1, 4_000_000])
def test_odd_texts(spark, chunk_links):
    texts = ODD + ODD[7:12]
    df = spark.createDataFrame([(i, t, 1, "k", 1, "n") for i, t in enumerate(texts)], SCHEMA).repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in alignment.document_alignment(df, A, B, chunk_links).collect()}
    assert [got[i] for i in range(len(texts))] == by_loop(texts)


def test_whole_table(spark):
    df = spark.read.parquet(f"{CHECK}/documents.parquet")
    rows = df.collect()
    got = {r.doc_id: tuple(r)[1:] for r in alignment.document_alignment(df, A, B).collect()}
    assert [got[r.doc_id] for r in rows] == by_loop([r.text for r in rows]) and sum(g[0] == 0 for g in got.values()) < 10


def test_repeated_rows_missing_ids_and_no_rows(spark):
    df = spark.createDataFrame([(None, "one two", 1, "k", 1, "n"), (3, "one two", 1, "k", 1, "n"), (3, "one two", 1, "k", 1, "n")], SCHEMA)
    got = alignment.document_alignment(df, A, B).collect()
    assert Counter(r.doc_id for r in got) == Counter([None, 3, 3]) and len({tuple(r)[1:] for r in got}) == 1
    assert alignment.document_alignment(df.limit(0), A, B).collect() == []


def test_units_are_the_text():
    texts = pa.array([None, *ODD], pa.string())
    units, counts = alignment.units_of(texts)
    assert len(counts) == len(texts) and sum(counts) == len(units)
    assert b"".join(units.to_pylist()) == b"".join((" " + t).encode() for t in texts.to_pylist() if t)
    assert all(u.startswith(b" ") for u in units.to_pylist())


def test_a_task_holds_few_texts_and_links_at_a_time(monkeypatch):
    texts = pq.read_table(f"{CHECK}/documents.parquet", columns=["doc_id", "text"]).combine_chunks()
    parts, held = [], []
    plain, chunk = alignment.align, alignment._chunk

    def align(tokenizers, column):
        parts.append(column.nbytes)
        return plain(tokenizers, column)

    def chunked(ids, facts, links, schema):
        held.append(sum(t.nbytes for t in links))
        return chunk(ids, facts, links, schema)

    monkeypatch.setattr(alignment, "align", align)
    monkeypatch.setattr(alignment, "_chunk", chunked)
    rows = sum(len(b) for b in alignment.aligned(A, B)(iter(pa.concat_tables([texts] * 4).to_batches())))
    assert rows == 4 * len(texts) + len(held)
    assert max(parts) < 600_000 and max(held) < 20_000_000
