"""Registered queries of the subpackage, whole tables: against SQL or against plain loops; the pipeline end to end."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from compare import differences
from conftest import CHECK
from tokenizers import Tokenizer

import corpus_pipeline
from aeropanel.llm import oracle, queries, repair, texts
from aeropanel.llm.mixing import BLOCK_WORDS

QUERIES = queries.all_queries()


def test_thirteen_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(oracle.all_sql()))
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, CHECK), duck, oracle.all_sql()[name]) == []


def test_token_files_equal_the_library(spark):
    rows = spark.read.parquet(f"{CHECK}/documents.parquet").orderBy("doc_id").select("doc_id", "text").collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op2_repair_token_ids"](spark, CHECK).collect()}
    start = 0
    for row, found in zip(rows, library.encode_batch([r.text or "" for r in rows], add_special_tokens=False)):
        ids = np.array([*found.ids, 2], "<u4")
        assert got[row.doc_id] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_mix_covers_every_document(spark):
    rows = QUERIES["op6_sainte_lague_mix"](spark, CHECK).join(spark.read.parquet(f"{CHECK}/documents.parquet"), "doc_id").collect()
    taken, target = Counter(), {}
    for r in rows:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert len(rows) == 1000 and all(abs(taken[s] - target[s]) < 2 * BLOCK_WORDS for s in target)


def stage_by_stage(spark):
    docs, found = spark.read.parquet(f"{CHECK}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        found[name] = docs = stage(spark, docs, CHECK).persist()
    return found


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{CHECK}/documents.parquet")
    by_stage = stage_by_stage(spark)
    assert list(by_stage) == ["toxicity", "near copies", "benchmark", "mixing", "token ids"]
    names = list(by_stage)
    for before, after in zip([docs, *by_stage.values()], names[:-1]):
        assert by_stage[after].columns == docs.columns
        if after != "mixing":
            assert by_stage[after].exceptAll(before).count() == 0
    texts_of = [r.text for r in by_stage["near copies"].collect()]
    words = Counter(" ".join(texts.words_of(t)) for t in texts_of)
    assert max(words.values()) == 1
    items = [set(texts.shingles_of(r.text)) for r in spark.read.parquet(f"{CHECK}/benchmark.parquet").collect()]
    left = [set(texts.shingles_of(r.text)) for r in by_stage["benchmark"].collect()]
    assert not any(len(i & d) >= 0.8 * len(i) for i in items for d in left)
    mixed, sizes = by_stage["mixing"].collect(), Counter()
    for r in by_stage["benchmark"].collect():
        sizes[r.source] += len(r.text.split())
    taken = Counter()
    for r in mixed:
        taken[r.source] += len(r.text.split())
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.01)
    tokens = by_stage["token ids"]
    library = repair.encoder(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter((r.doc_id, len(i) + 1) for r, i in zip(mixed, library.encode([m.text for m in mixed])))
    assert Counter((r.doc_id, r.n_tokens) for r in tokens.collect()) == want
    for frame in by_stage.values():
        frame.unpersist()


def test_run_equals_its_stages(spark):
    got = corpus_pipeline.run(spark, CHECK)
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert got.count() == stage_by_stage(spark)["token ids"].count()


def test_stages_with_odd_rows_and_no_rows(spark):
    docs = spark.read.parquet(f"{CHECK}/documents.parquet").limit(60).selectExpr(
        "*", "1 AS _id", "2 AS row", "3 AS size", "4 AS score", "5 AS once", "6 AS content")
    missing = docs.limit(1).selectExpr(*(f"CAST(NULL AS {kind}) AS {name}" for name, kind in docs.dtypes))
    odd = docs.unionByName(missing).unionByName(missing).unionByName(docs.limit(3))
    for given in (odd, odd.limit(0)):
        n = given.count()
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, given, CHECK)
            assert name == "token ids" or found.columns == odd.columns
            assert found.count() == n if name == "token ids" else found.count() <= 2 * n
