"""Graph search: recall, exact scores, and rows that take no part."""

import numpy as np
import pytest

from aeropanel.llm import hnsw

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(ids, vectors, query, k):
    score = vectors @ vectors[query]
    others = np.flatnonzero(ids != ids[query])
    order = others[np.lexsort((ids[others], -score[others]))][:k]
    return ids[order], score[order]


def rows_of(ids, vectors):
    return [(int(i), [float(x) for x in v], 0) for i, v in zip(ids, vectors)]


@pytest.mark.parametrize("kind", ["random", "clusters", "norms"])
def test_recall_and_scores(spark, kind):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(2000, 24))
    if kind == "clusters":
        vectors = rng.normal(size=(5, 24))[rng.integers(0, 5, 2000)] + 0.01 * vectors
    if kind == "norms":
        vectors *= rng.random((2000, 1)) * 5
    vectors, ids = vectors.astype(np.float32).astype(np.float64), np.arange(2000)
    df = spark.createDataFrame(rows_of(ids, vectors), SCHEMA)
    got = hnsw.nearest_rows(df).toPandas()
    recall = []
    for query, found in got.groupby("query_id"):
        found = found.sort_values("rank")
        want, _ = exact(ids, vectors, query, 20)
        assert found["rank"].tolist() == list(range(1, 21))
        assert np.allclose(found["score"], vectors[found["vec_id"]] @ vectors[query], rtol=1e-12)
        assert (np.diff(found["score"]) <= 0).all()
        recall.append(len(set(want) & set(found["vec_id"])) / 20)
    assert len(recall) == 100 and np.mean(recall) >= 0.9


def test_equal_vectors_and_ties_go_to_smaller_ids(spark):
    rng = np.random.default_rng(2)
    ids = np.arange(0, 600)
    vectors = rng.normal(size=(600, 8)).astype(np.float32).astype(np.float64)
    vectors[100:400] = vectors[100]
    got = hnsw.nearest_rows(spark.createDataFrame(rows_of(ids, vectors), SCHEMA)).toPandas()
    for query in (100, 120, 380):
        found = got[got.query_id == query].sort_values("rank").vec_id.tolist()
        assert found == exact(ids, vectors, query, 20)[0].tolist()


def test_rows_that_take_no_part(spark):
    bad = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [-1.0, 0.0], 1), (20, None, 1), (40, [0.0, 0.0], 1), (60, [bad[0], 1.0], 1),
            (80, [1.0, bad[1]], 1), (100, [1.0, None], 1), (None, [1.0, 1.0], 1), (120, [], 1), (140, [1.0, 2.0, 3.0], 1), (1, [0.5, 0.5], 2)]
    got = hnsw.nearest_rows(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 0.5), (0, 2, 2, -1.0)]


def test_no_vectors(spark):
    assert hnsw.nearest_rows(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_stored_graph_is_read_back_as_it_was(spark, tmp_path):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(300, 5)).astype(np.float32).astype(np.float64)
    df = hnsw.usable(spark.createDataFrame(rows_of(range(300), vectors), SCHEMA))
    hnsw.write_index(df, str(tmp_path / "i"), least_shards=2)
    stored = [hnsw.StoredShard(r.asDict(), r.dim) for r in spark.read.parquet(str(tmp_path / "i")).collect()]
    assert sorted(i for s in stored for i in s.ids.tolist()) == list(range(300))
    for shard in stored:
        again = hnsw.build(shard.graph.vectors)
        assert all(np.array_equal(a, b) for a, b in zip(again.links, shard.graph.links))
