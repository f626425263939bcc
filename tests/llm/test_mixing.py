"""Targets, quotas and taken words."""

import heapq
from collections import Counter

import pytest
from pyspark.sql import functions as F

from aeropanel.llm import mixing

SCHEMA = "doc_id long, text string, source string, n_chars long, size int"


def filled(sizes, weights, share=1.5, most=2):
    """Targets by sharing again what is above the stop, until nothing is."""
    target, stopped = dict.fromkeys(sizes, 0.0), set()
    total = share * sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in stopped)
        free = sum(weights[s] for s in sizes if s not in stopped)
        target = {s: most * sizes[s] if s in stopped else rest * weights[s] / free for s in sizes}
        above = {s for s in sizes if s not in stopped and target[s] > most * sizes[s]}
        if not above:
            return target
        stopped |= above


def corpus():
    words = lambda n, k: " ".join(f"v{k}x{i}" for i in range(n))
    rows = [(i, words(37 * i % 400, i), ["b", "a", "hot", None, "é"][0 if i % 9 == 0 else 1 if i % 9 == 1 else 3 if i % 9 == 2 else 4 if i % 9 == 3 else 2], 5, 0)
            for i in range(400)]
    return rows + [(900, None, "a", None, 0), (901, "", "empty", 0, 0), (None, "x y", "a", 3, 0), (5, rows[5][1], "hot", 1, 0), (902, words(30_000, 9), "b", 1, 0)]


def test_targets_and_taken_words(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = mixing.mix(df, shard_words=20_000).collect()
    assert len(got) == len(rows)
    by_source = Counter()
    for _, text, source, _, _ in rows:
        by_source[source] += len((text or "").split())
    order = sorted(by_source, key=lambda s: (s is None, s or ""))
    target = filled(by_source, {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)})
    sizes = {r[0]: len((r[1] or "").split()) for r in rows}
    assert all(r.taken <= 2 * r.size and r.size == sizes[r.doc_id] for r in got)
    source_of = {r[0]: r[2] for r in rows}
    taken = Counter()
    for r in got:
        assert r.source_size == by_source[source_of[r.doc_id]] and r.target == pytest.approx(target[source_of[r.doc_id]])
        taken[source_of[r.doc_id]] += r.taken
    for s in by_source:
        assert abs(taken[s] - target[s]) <= 3 * mixing.BLOCK_WORDS
    again = mixing.mix(df.repartition(7), shard_words=20_000).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_small_sources_come_near_their_targets(spark):
    sizes = {"a": 97, "b": 160, "c": 20, "d": 40, "e": 12, "f": 60_000, "g": 1}
    rows = [(i * 10_000 + j, " ".join(["w"] * min(30, n - j * 30)), s, 0, 0) for i, (s, n) in enumerate(sizes.items()) for j in range(-(-n // 30))]
    got = mixing.mix(spark.createDataFrame(rows, SCHEMA)).collect()
    target = filled(sizes, {s: (3, 1, 2)[i % 3] for i, s in enumerate(sizes)})
    taken = Counter()
    for r in got:
        taken["abcdefg"[r.doc_id // 10_000]] += r.taken
        assert r.taken <= 2 * r.size
    for s in sizes:
        assert taken[s] > 0 and abs(taken[s] - target[s]) <= max(2, 0.01 * target[s]), (s, taken[s], target[s])


def test_mixed_texts_hold_the_taken_words(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    taken = Counter()
    for r in mixing.mix(df).collect():
        taken[r.doc_id] += r.taken
    kept = mixing.mixed(df)
    assert kept.columns == df.columns
    words, texts_of = Counter(), {r[0]: r[1] for r in rows}
    for r in kept.collect():
        words[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text) and set(r.text.split()) <= set(texts_of[r.doc_id].split())
    assert words == Counter({k: v for k, v in taken.items() if v})


@pytest.mark.parametrize("seats", [0, 1, 7, 100, 12345])
def test_quotas_are_those_of_highest_quotients(spark, seats):
    sizes = {f"s{i}": s for i, s in enumerate([500, 500, 31, 1, 0, 7, 123_456, 999])}
    groups = spark.createDataFrame([(k, float(v)) for k, v in sizes.items()], "name string, size double")
    got = {r.name: r.quota for r in mixing.apportion(groups, "size", F.lit(seats).cast("long"), [], ["name"]).collect()}
    heap = [(-v, k, 0) for k, v in sizes.items() if v]
    heapq.heapify(heap)
    want = dict.fromkeys(sizes, 0)
    for _ in range(seats):
        _, name, held = heapq.heappop(heap)
        want[name] += 1
        heapq.heappush(heap, (-sizes[name] / (2 * held + 3), name, held + 1))
    assert got == want


def test_no_words_and_no_documents(spark):
    blank = spark.createDataFrame([(1, " \n", "a", 1, 0), (2, None, None, 1, 0)], SCHEMA)
    assert {(r.taken, r.target) for r in mixing.mix(blank).collect()} == {(0, 0.0)}
    assert mixing.mixed(blank).count() == 0
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0
