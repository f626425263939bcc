"""Cuts of the histogram sort against sums over sorted rows."""

import zlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aeropanel.llm import histogram_sort as hs

SCHEMA = "doc_id long, text string, part int, key string, row int, size string"


def expected_cuts(rows, parts, tolerance):
    """Bytes below each cut; rows are (size, key, tie, row)."""
    rows = sorted(rows, key=lambda r: r[1:])
    tops, total = [], 0
    for r in rows:
        total += r[0]
        tops.append(total)
    found = []
    for g in range(1, parts):
        at = next(i for i, t in enumerate(tops) if t * parts >= g * total)
        of_key = [i for i, r in enumerate(rows) if r[1] == rows[at][1]]
        near = lambda a, b: a if abs(a * parts - g * total) <= abs(b * parts - g * total) else b
        cut = near(tops[of_key[0]] - rows[of_key[0]][0], tops[of_key[-1]])
        if abs(cut * parts - g * total) > tolerance * total:
            cut = near(tops[at] - rows[at][0], tops[at])
        found.append(cut)
    return found


big = st.integers(0, (1 << 60) - 1)
few = st.sampled_from([0, 1, 2, 5, 1 << 40, (1 << 60) - 1])


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 50), big | few, big | few), min_size=1, max_size=60), st.integers(1, 7), st.sampled_from([0.0, 0.3, 1.0]),
       st.sampled_from([2, 7, 256]))
def test_cuts_equal_sums(spark, rows, parts, tolerance, probes):
    rows = [(s, k, t, n) for n, (s, k, t) in enumerate(rows)]
    df = spark.createDataFrame(rows, "size long, key long, tie long, row long")
    found = hs.cuts(df, parts, tolerance, probes)
    assert [c.bytes_before for c in found] == expected_cuts(rows, parts, tolerance)
    for c in found:
        left = [r for r in rows if r[1:1 + len(c.at)] < c.at]
        assert (sum(r[0] for r in left), len(left)) == (c.bytes_before, c.rows_before)


def shards_of(spark, rows, **options):
    return hs.document_shards(spark.createDataFrame(rows, SCHEMA).repartition(3), **options).collect()


def check(got, rows, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    slots = {}
    for r in got:
        assert 0 <= r.shard < shards and r.law == "bytes" and r.grown_shard is None
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("rows", [
    [], [(1, "a", 1, "k", 1, "s")], [(None, None, 1, "k", 1, "s")] * 90, [(7, "same", 1, "k", 1, "s")] * 100 + [(i, "é" * i, 1, None, 1, None) for i in range(100)],
    [(1, "x" * 200_000, 1, "k", 1, "s")] + [(i, "", 1, "k", 1, "s") for i in range(60)]])
def test_odd_rows(spark, rows):
    check(shards_of(spark, rows), rows, hs.SHARDS)


def test_a_hot_text_is_dealt_and_others_stay_together(spark):
    hot = [(i, "hot text", 1, "k", 1, "s") for i in range(400)]
    groups = [(1000 + i, f"group {i // 2}", 1, "k", 1, "s") for i in range(800)]
    got = shards_of(spark, hot + groups, shards=8, tolerance=0.05)
    check(got, hot + groups, 8)
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r.size
    mean = sum(sizes.values()) / 8
    assert len(sizes) == 8 and all(abs(s - mean) <= 0.1 * mean for s in sizes.values())
    where = {}
    for r in got:
        where.setdefault(r.text_crc32, set()).add(r.shard)
    assert len(where.pop(zlib.crc32(b"hot text"))) >= 3 and all(len(s) == 1 for s in where.values())


def test_parts_of_a_shard_share_its_slots(spark):
    rows = [(i, f"text {i} " * (i % 7), 1, "k", 1, "s") for i in range(500)]
    whole, parted = (shards_of(spark, rows, shards=5, tolerance=0.0, part_rows=n) for n in (10_000, 30))
    check(parted, rows, 5)
    assert Counter(r.shard for r in whole) == Counter(r.shard for r in parted)
    assert {(r.doc_id, r.shard, r.slot) for r in whole} == {(r.doc_id, r.shard, r.slot) for r in parted}


def test_partitioning_does_not_matter(spark):
    df = spark.createDataFrame([(i, f"text {i % 40}", 1, "k", 1, "s") for i in range(300)], SCHEMA)
    one, many = (set(map(tuple, hs.document_shards(df.repartition(n)).collect())) for n in (1, 9))
    assert one == many


def test_no_python_on_the_way(spark):
    df = hs.sharded(hs.keyed(spark.createDataFrame([(1, "a", 1, "k", 1, "s")], SCHEMA)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow")) and plan.count("Exchange") == 1
    assert df.agg(F.count("*")).first()[0] == 1
