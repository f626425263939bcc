"""Classes of near copies against all pairs."""

from collections import Counter, defaultdict
from math import log

import numpy as np
import pytest

from aeropanel.llm import components as components_module
from aeropanel.llm import near_dedup, texts
from aeropanel.llm.components import components


def brute_classes(rows, similarity=0.8):
    sets = [Counter(texts.shingles_of(t)) for _, t in rows]
    df, n = Counter(s for own in sets for s in own), len(rows)
    weight = lambda s: 1 + 0.25 * log((n + 1) / (df[s] + 1)) / log(n + 1)
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(set)
    for i, own in enumerate(sets):
        for s in own:
            holders[s].add(i)
    for a, b in {(a, b) for held in holders.values() for a in held for b in held if a < b}:
        one, two = sets[a], sets[b]
        both = set(one) | set(two)
        found = sum(min(one[s], two[s]) * weight(s) for s in both) / sum(max(one[s], two[s]) * weight(s) for s in both)
        if found >= similarity:
            parent[root(a)] = root(b)
    members = defaultdict(list)
    for i in range(n):
        members[root(i)].append(rows[i][0])
    named = [(d, min((m for m in own if m is not None), default=None)) for own in members.values() for d in own]
    return sorted(named, key=repr), len(members)


def documents():
    rng = np.random.default_rng(7)
    words = [f"w{i}" for i in range(2000)]
    rows = []
    for i in range(40):
        base = list(rng.choice(words, int(rng.integers(30, 400))))
        rows.append((10 * i, " ".join(base)))
        for k in range(i % 4):
            copy = base.copy()
            for at in rng.integers(0, len(copy), 1 + k * len(copy) // 60):
                copy[at] = str(rng.choice(words))
            rows.append((10 * i + k + 1, " ".join(copy)))
    rows += [rows[0], (None, rows[1][1].upper() + "!"), (None, "quite alone here"), (900, None), (901, ""), (902, "?!"), (903, "one two"),
             (904, "One. Two."), (905, " ".join(rng.choice(words, 20_000)))]
    return rows


def test_classes_equal_all_pairs(spark):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want, n_classes = brute_classes(rows)
    assert sorted(map(tuple, near_dedup.near_copies(df).collect()), key=repr) == want
    extra = df.selectExpr("*", "1 AS _id", "2 AS row", "3 AS content")
    kept = near_dedup.without_copies(extra)
    assert kept.columns == extra.columns and kept.count() == n_classes


def test_words_that_two_libraries_see_differently_are_documents_once(spark):
    """Letters of Unicode versions that the JVM and Python need not share."""
    rows = [(1, "\U00010570 \U00010571"), (2, "\U0001e4d0 \U0001e4d1"), (3, "\U0002ebf0"), (4, "plain words")]
    got = near_dedup.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == [(1, 1), (2, 2), (3, 3), (4, 4)]


def test_a_group_whose_similarities_lie_around_the_threshold(spark):
    """Copies with few and with many edits of one text; not all resemble its most central one."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(260):
        copy = base.copy()
        for at in rng.choice(300, int(rng.integers(1, 9)), replace=False):
            copy[at] = f"e{i}x{at}"
        rows.append((i, " ".join(copy)))
    got = dict(map(tuple, near_dedup.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    want = dict(brute_classes(rows)[0])
    assert sum(got[i] == want[i] for i in got) >= 0.99 * len(rows)


def test_one_large_group_with_rare_edits(spark):
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*base[:i % 190], f"edit{i}", *base[i % 190 + 1:]])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.class_id for r in near_dedup.near_copies(df).collect()} == {0}
    assert [r.doc_id for r in near_dedup.without_copies(df).collect()] == [0]


def test_a_passage_that_many_documents_share_links_none_of_them(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "FEW_MEMBERS", 2)
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(5000)]
    passage = " ".join(rng.choice(words, 80))
    own = lambda: list(rng.choice(words, 40))
    rows = [(i, f"{passage} {' '.join(own())}") for i in range(150)]
    for i in range(0, 30, 3):
        edited = rows[i][1].split()
        edited[100] = "edited"
        rows.append((1000 + i, " ".join(edited)))
    got = sorted(map(tuple, near_dedup.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == brute_classes(rows)[0]
    assert len({c for _, c in got}) == 150


@pytest.mark.parametrize("members", [2048, 7])
def test_pairs_that_share_only_a_large_bucket_are_compared(spark, monkeypatch, members):
    def one_bucket(batches):
        import pyarrow as pa
        for batch in batches:
            yield pa.record_batch([pa.array([1] * batch.num_rows), batch.column("node")], names=["key", "node"])

    monkeypatch.setattr(near_dedup, "_bands", one_bucket)
    monkeypatch.setattr(near_dedup, "BLOCK_MEMBERS", members)
    rng = np.random.default_rng(13)
    words = [f"w{i}" for i in range(5000)]
    passage = list(rng.choice(words, 60))
    rows = []
    for i in range(0, 80, 2):
        base = passage + list(rng.choice(words, 60))
        rows += [(i, " ".join(base)), (i + 1, " ".join([*base[:-3], "edited", *base[-2:]]))]
    got = sorted(map(tuple, near_dedup.near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == brute_classes(rows)[0]
    assert len({c for _, c in got}) == 40


def test_members_of_open_buckets_are_dealt_again_by_few_rows_each(spark):
    """300 nodes with 16 open buckets, 2 with one, and a bucket whose members are joined already."""
    key = lambda band, bucket: band << 60 | bucket if band < 8 else (band - 16) << 60 | bucket
    rows = [(key(band, (i // 2) % 3 if band % 2 else 0), i) for i in range(300) for band in range(16)]
    rows += [(key(0, 5), 300), (key(0, 5), 301), (key(0, 6), 400), (key(1, 6), 400), (key(0, 6), 401), (key(1, 6), 401)]
    labels = spark.createDataFrame([(400, 400), (401, 400)], "node long, label long")
    found = near_dedup._redealt(spark.createDataFrame(rows, "key long, node long"), labels).collect()
    assert len(found) <= near_dedup.NEXT_BANDS * len(rows) and {r.node for r in found} == set(range(300))
    met = {}
    for r in found:
        met.setdefault(r.key, set()).add(r.node)
    # equal keys: together everywhere
    assert all((2 * i in held) == (2 * i + 1 in held) for held in met.values() for i in range(150))


def test_a_block_compares_different_labels_only_and_all_of_them():
    rng = np.random.default_rng(17)
    signatures = rng.integers(0, 2, (30, near_dedup.SAMPLES)).astype(np.uint32)
    labels = rng.integers(0, 4, 30)
    for lows in (np.ones(30, bool), rng.random(30) < 0.4):
        rows = [(1, bool(lows[i]), i, int(labels[i]), signatures[i].tobytes()) for i in range(30)]
        got = [tuple(sorted((at, int(o)))) for at, others, _ in near_dedup._block_pairs(rows) for o in others]
        agree = lambda i, j: (signatures[i] == signatures[j]).mean() >= near_dedup.LEAST_AGREEMENT
        want = {(i, j) for i in range(30) for j in range(i + 1, 30)
                if labels[i] != labels[j] and agree(i, j) and (lows.all() or lows[i] != lows[j])}
        assert want and sorted(got) == sorted(want)


def test_samples_agree_as_often_as_the_weighted_jaccard_similarity():
    rng = np.random.default_rng(3)
    hashes = texts.mixed(np.arange(1, 3001, dtype=np.uint64))
    one, two = np.arange(0, 2000), np.arange(500, 2500)
    weights = 1 + rng.random(3000)
    shared = weights[500:2000].sum()
    want = shared / (weights[:2500].sum())
    hits = []
    for turn in range(12):
        spread = texts.mixed(hashes + np.uint64(turn * 10_007))
        signatures = [near_dedup.samples(spread[i], np.log(weights[i]).astype(np.float32), np.array([0, len(i)])) for i in (one, two)]
        hits.append((signatures[0] == signatures[1]).mean())
    assert abs(np.mean(hits) - want) < 0.06


def test_frequencies_of_a_small_corpus_are_exact(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e"), (3, "a b c d e"), (4, None)]
    known = near_dedup.document_frequencies(spark.createDataFrame(rows, "doc_id long, text string"))
    hashes = np.concatenate([h for _, _, h, _ in texts.shingle_hashes(["a b c d e f"])])
    assert known.documents == 4
    assert near_dedup.inverse_frequency(hashes, known) == pytest.approx([1 + log(5 / 4) / log(5) / 4, 1 + log(5 / 2) / log(5) / 4])


def test_no_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_dedup.near_copies(empty).count() == 0 and near_dedup.without_copies(empty).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = np.random.default_rng(1)
    chain = [(i, i + 1) for i in range(100, 140)]
    star = [(1, i) for i in range(2, 60)]
    edges = [*chain, *star, (300, 300), (7, 5000), (5000, 7)]
    order = rng.permutation(len(edges))
    df = spark.createDataFrame([edges[i] for i in order], "a long, b long")
    got = {r.node: r.label for r in components(df).collect()}
    want = dict.fromkeys(range(100, 141), 100) | dict.fromkeys(range(1, 60), 1) | {5000: 1}
    assert got == want


def test_labels_after_more_links_equal_those_of_all_links(spark):
    rng = np.random.default_rng(3)
    before, more = rng.integers(0, 400, (150, 2)).tolist(), rng.integers(0, 600, (120, 2)).tolist()
    as_links = lambda rows: spark.createDataFrame(rows, "a long, b long")
    labels_of = lambda df: {r.node: r.label for r in df.collect()}
    labels = components(as_links(before)).persist()
    got = components_module.with_links(labels, as_links(more))
    rows = got.collect()
    assert len(rows) == len({r.node for r in rows}) and labels_of(got) == labels_of(components(as_links(before + more)))
    assert components_module.with_links(labels, as_links(before + [[700, 700]])) is labels
    labels.unpersist()


def test_stars_need_no_step(spark, monkeypatch):
    monkeypatch.setattr(components_module, "_star", None)
    df = spark.createDataFrame([(1, i) for i in range(2, 60)] + [(90, 80), (80, 90), (95, 80)], "a long, b long")
    assert {r.node: r.label for r in components(df).collect()} == dict.fromkeys(range(1, 60), 1) | dict.fromkeys((80, 90, 95), 80)


def test_frequencies_reach_the_driver_in_few_jobs(spark):
    options = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    kept = {k: spark.conf.get(k) for k in options}
    tracker = spark.sparkContext.statusTracker()
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        before = len(tracker.getJobIdsForGroup(None))
        near_dedup.document_frequencies(spark.createDataFrame(documents()[:20], "doc_id long, text string"))
        assert len(tracker.getJobIdsForGroup(None)) - before <= 4
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_tables_in_between_are_written_and_read_in_few_jobs(spark):
    """A table is read by the schema it was written with, and links are written once."""
    tracker = spark.sparkContext.statusTracker()
    df = spark.createDataFrame(documents()[:60], "doc_id long, text string").repartition(2)
    before = len(tracker.getJobIdsForGroup(None))
    near_dedup.near_copies(df)
    found = len(tracker.getJobIdsForGroup(None)) - before
    assert 0 < found <= 115, found
