"""Suffix orders and repeated strings against brute force."""

import hashlib
import random
import uuid
from collections import Counter

import numpy as np
import pytest

from aeropanel.llm import induced, suffix_dedup


def in_common(a: list, b: list) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


@pytest.mark.parametrize("memory, block, frequent", [(1 << 30, 1 << 18, 512), (1, 1, 512), (100, 3, 1), (1 << 30, 1000, 1)])
def test_order_and_common_prefixes(memory, block, frequent, monkeypatch):
    monkeypatch.setattr(induced, "BLOCK", block)
    monkeypatch.setattr(induced, "FREQUENT", frequent)
    rnd = random.Random(3)
    for turn in range(60):
        text = [rnd.randint(1, rnd.choice([1, 2, 3, 30])) for _ in range(rnd.randint(1, 60))]
        if turn % 4 == 0:
            text = [1, 2, 1] * rnd.randint(1, 15) + [rnd.randint(1, 3)]
        text.append(0)
        got = list(induced.descending(np.array(text, np.int32), 1000, memory))
        order = sorted(range(len(text) - 1), key=lambda i: text[i:], reverse=True)
        assert [int(i) for block_ in got for i in block_[0]] == order
        assert [int(i) for block_ in got for i in block_[1]] == [0] + [in_common(text[a:], text[b:]) for a, b in zip(order, order[1:])]


def test_empty_string():
    assert list(induced.descending(np.array([0], np.int32), 10)) == []


def brute(documents, length):
    given = [(i, (t or "").encode()) for i, t in documents]
    seen = Counter(b[k:k + length] for _, b in given for k in range(len(b) - length + 1))
    rows = []
    for doc_id, data in given:
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            if seen[data[k:k + length]] > 1:
                gone[k:k + length] = b"\1" * length
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        kept = bytes(c for c, g in zip(data, gone) if not g)
        rows.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(rows, key=repr)


@pytest.mark.parametrize("length, gram", [(20, 8), (400, 128)])
def test_documents_equal_brute_force(spark, length, gram):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdeé ") for _ in range(rnd.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(150)
    rows = [(i, text(rnd.randint(0, 120)) + (passage[rnd.randint(0, 300):] if i % 3 == 0 else "")) for i in range(40)]
    rows += [rows[1], rows[2], (None, rows[4][1]), (90, None), (91, ""), (92, "a" * (length - 1)), (93, "a" * length), (94, "a" * 900),
             (95, "ab" * length), (96, passage), (97, "x" + passage), (98, text(9000)), (99, "é" * length)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = suffix_dedup.document_repeats(df, length=length, gram=gram, shard_bytes=2000).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, length)


def test_texts_without_repeats_keep_columns(spark):
    line = "".join(chr(97 + i * i % 23) for i in range(450))
    df = spark.createDataFrame([(1, "x" + line + "y", 7), (2, line, 8), (3, "alone", 9)], "doc_id long, text string, removed int")
    got = {r.doc_id: (r.text, r.removed) for r in suffix_dedup.without_repeats(df).collect()}
    assert got == {1: ("xy", 7), 2: ("", 8), 3: ("alone", 9)}


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.document_repeats(empty).count() == 0
    assert suffix_dedup.without_repeats(empty).count() == 0


@pytest.mark.parametrize("length, gram, shared", [(20, 8, 10), (20, 8, 19), (20, 8, 24), (400, 128, 150), (400, 128, 395)])
def test_no_task_sorts_more_of_a_frequent_anchor_than_a_shard(spark, length, gram, shared, tmp_path, monkeypatch):
    rnd = random.Random(6)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage, around = text(shared), [text(length) for _ in range(4)]
    # texts with a few of the same strings around the passage among many others of the same anchor
    rows = [(i, text(2 * length) + passage + text(2 * length)) for i in range(60)]
    rows += [(100 + i, text(9) + a[-rnd.randint(1, length):] + passage + b[:rnd.randint(1, length)] + text(9))
             for i, (a, b) in enumerate((a, b) for a in around for b in around for _ in range(2))]
    rows += [rows[0], (200, rows[1][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    most, shards = 8 * length, suffix_dedup._sorted_shards

    def telling(*options):
        run = shards(*options)

        def told(batches):
            batches, sizes = list(batches), Counter()
            for batch in batches:
                for anchor, data in zip(batch.column("anchor").to_pylist(), batch.column("data").to_pylist()):
                    sizes[anchor] += len(data)
            if sizes:
                (tmp_path / uuid.uuid4().hex).write_text(str(max(sizes.values())))
            return run(iter(batches))
        return told

    monkeypatch.setattr(suffix_dedup, "_sorted_shards", telling)
    got = suffix_dedup.document_repeats(df, length=length, gram=gram, shard_bytes=most).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, length)
    assert max([int(p.read_text()) for p in tmp_path.iterdir()], default=0) <= most
