"""Held-out quality, interactions of terms, and odd inputs."""

import zlib

import numpy as np
from conftest import CHECK

from aeropanel.llm import toxicity

DOCS, LABELS = "doc_id long, text string, score int", "doc_id long, toxic int"


def made_up(n, seed):
    rng = np.random.default_rng(seed)
    common = [f"common{i}" for i in range(200)]
    insults = ["vilex", "scumzz", "trashq"]
    docs, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.2)
        words = list(rng.choice(common, 60)) + (list(rng.choice(insults, 2)) if toxic else [])
        docs.append((i, " ".join(rng.permutation(words)), 1))
        labels.append((i, toxic))
    return docs, labels


def test_held_out_documents(spark):
    docs, labels = made_up(1500, 1)
    got = toxicity.toxic_documents(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    truth = dict(labels)
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    assert all(r.predicted == int(r.score >= 0.3) for r in got)
    held = [(truth[r.doc_id], r.predicted) for r in got if r.held_out]
    assert len(held) > 250 and np.mean([a == b for a, b in held]) > 0.98


def test_labels_that_are_held_out_are_not_learned_from(spark):
    docs, labels = made_up(600, 2)
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels]
    one, two = ({r.doc_id: r.score for r in toxicity.toxic_documents(spark.createDataFrame(docs, DOCS), spark.createDataFrame(ls, LABELS)).collect()}
                for ls in (labels, flipped))
    assert one == two


def test_pairs_of_terms_weigh_more_than_the_terms():
    """Neither term alone is toxic, both together are: additive weights cannot tell."""
    rng = np.random.default_rng(5)
    has = rng.random((4000, 2)) < 0.5
    toxic = (has[:, 0] & has[:, 1]).astype(float)
    rows = [np.flatnonzero(h) for h in has]
    owner, terms = np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.concatenate(rows)
    weights, vectors, intercept = toxicity.train(owner, terms, toxic, 2, epochs=30)
    odds, _ = toxicity._scores(weights, vectors, intercept, np.array([0, 1, 2, 2]), np.array([0, 1, 0, 1]), 4)
    assert odds[0] < 0 and odds[1] < 0 and odds[2] > 0 and odds[3] < 0
    assert vectors[0] @ vectors[1] > 0.5


def test_terms_that_tell_only_beside_an_insult_are_learned(spark):
    """A group mention is as common in clean texts as in toxic ones, but decides beside one of two insults."""
    rng = np.random.default_rng(6)
    common = [f"common{i}" for i in range(60)]
    docs, labels = [], []
    for i in range(4000):
        insult, group, slur = rng.random() < 0.3, rng.random() < 0.5, rng.random() < 0.15
        toxic = int((insult and group) or (slur and not group))
        words = [*rng.choice(common, 10), *["vilex"] * insult, *["mention"] * group, *["zslur"] * slur]
        docs.append((i, " ".join(rng.permutation(words)), 1))
        labels.append((i, toxic))
    share = np.mean([t for (_, text, _), (_, t) in zip(docs, labels) if "mention" in text])
    assert abs(share - np.mean([t for _, t in labels])) < 0.12
    model = toxicity.fit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS))
    probes = ["common1 vilex mention", "common1 vilex", "common1 mention", "zslur common1", "zslur mention common1"]
    df = spark.createDataFrame([(i, p, 1) for i, p in enumerate(probes)], DOCS)
    chance = {r.doc_id: r.chance for r in toxicity.score(df, model, "chance").collect()}
    assert chance[0] > 0.5 > chance[1] and chance[2] < 0.3 and chance[3] > 0.5 > chance[4]


def test_given_documents(spark):
    docs, labels = (spark.read.parquet(f"{CHECK}/{n}.parquet") for n in ("documents", "labels"))
    rows = toxicity.toxic_documents(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    flagged = [r.toxic for r in rows if r.predicted]
    assert np.mean(flagged) >= 0.85 and sum(flagged) >= 0.5 * sum(r.toxic for r in rows)


def test_odd_rows_and_columns(spark):
    docs, labels = made_up(400, 3)
    docs += [(900, None, 1), (901, "", 1), (None, "vilex scumzz", 1), (902, "vilex scumzz trashq " * 20_000, 1), (5, docs[5][1], 1), (5, docs[5][1], 1)]
    labels += [(900, 1), (901, None), (None, 1), (5, 1), (5, 0)]
    df, told = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    got = toxicity.toxic_documents(df, told).collect()
    assert len(got) == len(docs) and not any(r.score is None or r.held_out is None for r in got)
    assert {r.predicted for r in got if r.doc_id in (None, 902)} == {1}
    kept = toxicity.without_toxic(df, told)
    assert kept.columns == df.columns and {902, None}.isdisjoint({r.doc_id for r in kept.collect()})


def test_without_labels_and_without_documents(spark):
    docs, labels = made_up(20, 4)
    df, told = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    nothing = told.limit(0)
    assert {r.score for r in toxicity.toxic_documents(df, nothing).collect()} == {0.0}
    assert toxicity.without_toxic(df, nothing).count() == 20
    assert {r.score for r in toxicity.toxic_documents(df, told.selectExpr("doc_id", "1 AS toxic")).collect()} == {1.0}
    assert toxicity.toxic_documents(df.limit(0), told).count() == 0


def test_only_terms_that_speak_for_toxic_texts_reach_the_driver(spark, tmp_path):
    docs, labels = made_up(400, 8)
    truth = dict(labels)
    sample = spark.createDataFrame([(t, truth[i]) for i, t, _ in docs], "text string, toxic int")
    # a greeting that clean texts alone hold
    sample = sample.selectExpr("if(toxic = 0, concat(text, ' greetings'), text) AS text", "toxic")
    got = toxicity._tested(sample, f"{tmp_path}/terms").column("term").to_pylist()
    numbers = lambda word: {int(n) for _, _, found, _ in toxicity.text_terms([word]) for n in found}
    assert numbers("vilex") <= set(got) and not numbers("greetings") & set(got)
