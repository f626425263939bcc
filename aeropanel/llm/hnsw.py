"""Nearest neighbours by inner product, from one hierarchical navigable small-world graph per shard.

Vectors are dealt to shards by hash. A task builds the graph of its shard and stores it as flat arrays: per layer the
nodes and a table of their neighbours, beside the vectors and their ids. Vectors get one more component that makes all
norms of the shard equal, so that the largest inner product is also the nearest vector, for any norms.

Nodes are inserted in batches: candidates are found by beam search in the graph so far and among the nodes of the same
batch, the neighbours are chosen among them so that none is closer to a chosen one than to the node, and the links back
are pruned the same way. All queries of a block walk a shard's graph in step, as numpy arrays.

Every block of queries meets every shard; a shard returns its k nearest per query and the results are merged per query. A
shard is sent to a task once and stays in its memory while up to 64 blocks of queries pass by, one after another.
Equal vectors are one node that holds the smallest k + 1 of their ids, more than which no query can return, so a vector
that a third of all rows share costs one node.

Defined cases: vectors that are missing, zero, or hold missing or infinite components take no part, nor do rows without
an id; of rows with the same id the one with the smallest vector counts; vectors meet vectors of the same length only; a
query has no more neighbours than there are others. Other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aeropanel.llm import texts
from aeropanel.session import scratch_path

NEAREST = 20
EVERY = 20
LINKS = 16
BUILD_BEAM = 96
SEARCH_BEAM = 128
UPPER_BEAM = 8
SHARD_ROWS = 50_000
LEAST_SHARDS = 12
BATCH = 1024
WALKERS = 512
STRIDE = 4
QUERY_BLOCK = 4096
BLOCKS_PER_COPY = 64


class Graph:
    """Graph of one shard: `vectors` of equal norm, and per layer its nodes and their neighbours (-1: none)."""

    def __init__(self, vectors: np.ndarray, nodes: list[np.ndarray], links: list[np.ndarray]):
        self.vectors, self.nodes, self.links = vectors, nodes, links
        self.place = []
        for own in nodes:
            place = np.full(len(vectors), -1, np.int32)
            place[own] = np.arange(len(own))
            self.place.append(place)

    def walk(self, queries: np.ndarray, entries: np.ndarray, layer: int, beam: int, n_seen: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of all queries in one layer -> (nodes, similarities), best first; -1 where there are fewer.

        `entries` are rows of start nodes (-1: none). Only nodes below `n_seen` are in the graph yet.
        """
        n = len(queries)
        rows = np.arange(n)[:, None]
        seen = np.zeros((n, n_seen + 1), bool)  # the last column stands for no node
        seen[:, n_seen] = True
        nodes = np.full((n, beam), -1, np.int32)
        near = np.full((n, beam), -np.inf, np.float32)
        open_ = np.zeros((n, beam), bool)
        width = entries.shape[1]
        fresh = np.where(entries < 0, n_seen, entries)
        active = np.arange(n)
        while True:
            # duplicates among the fresh nodes of a row count once
            fresh = np.sort(fresh, axis=1)
            fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = n_seen
            at = active[:, None]
            known = seen[at, fresh]
            seen[at, fresh] = True
            score = np.einsum("ij,ikj->ik", queries[active], self.vectors[np.minimum(fresh, len(self.vectors) - 1)])
            score[known] = -np.inf
            both = np.concatenate([near[active], score], axis=1)
            all_nodes = np.concatenate([nodes[active], np.where(known, -1, fresh).astype(np.int32)], axis=1)
            all_open = np.concatenate([open_[active], ~known], axis=1)
            best = np.argpartition(-both, beam - 1, axis=1)[:, :beam] if both.shape[1] > beam else np.argsort(-both, axis=1)
            inner = rows[:len(active)]
            near[active], nodes[active], open_[active] = both[inner, best], all_nodes[inner, best], all_open[inner, best]
            # the most promising nodes that have not been walked from; a row without one is done
            waiting = np.where(open_[active] & (nodes[active] >= 0), near[active], -np.inf)
            stride = min(STRIDE, beam)
            turn = np.argpartition(-waiting, stride - 1, axis=1)[:, :stride] if beam > stride else np.argsort(-waiting, axis=1)
            go = np.isfinite(waiting[inner, turn])
            going = go.any(axis=1)
            if not going.any():
                break
            active, turn, go = active[going], turn[going], go[going]
            at = active[:, None]
            from_ = np.where(go, nodes[at, turn], -1)
            open_[at, turn] = open_[at, turn] & ~go
            links = self.links[layer][self.place[layer][from_]]
            links = np.where((from_ >= 0)[:, :, None] & (links >= 0), links, n_seen)
            fresh = links.reshape(len(active), -1)
        order = np.argsort(-near, axis=1, kind="stable")
        return nodes[rows, order], near[rows, order]

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The `beam` nearest nodes found for each query, best first."""
        n = len(self.vectors)
        found, scores = [], []
        for at in range(0, len(queries), WALKERS):
            part = queries[at:at + WALKERS]
            entries = np.full((len(part), 1), self.nodes[-1][0], np.int64)
            for layer in range(len(self.nodes) - 1, 0, -1):
                entries, _ = self.walk(part, entries, layer, UPPER_BEAM, n)
            nodes, near = self.walk(part, entries, 0, beam, n)
            found.append(nodes)
            scores.append(near)
        return np.concatenate(found), np.concatenate(scores)


def choose(vectors: np.ndarray, own: np.ndarray, candidates: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Up to `most` of each row's candidates (best first, -1: none), none of them closer to a chosen one than to `own`.

    Places that stay free are filled with the best of the others, so that dense groups stay connected.
    """
    n, width = candidates.shape
    chosen = np.full((n, most), -1, np.int32)
    picked = np.zeros((n, most, vectors.shape[1]), np.float32)
    used = np.zeros((n, width), bool)
    count = np.zeros(n, np.int64)
    for k in range(width):
        node = candidates[:, k]
        fits = np.flatnonzero((node >= 0) & (node != own) & (count < most))
        if not len(fits):
            continue
        vector = vectors[node[fits]]
        rival = np.einsum("imj,ij->im", picked[fits], vector)
        rival[np.arange(most) >= count[fits][:, None]] = -np.inf
        good = fits[rival.max(axis=1) < near[fits, k]]
        chosen[good, count[good]] = node[good]
        picked[good, count[good]] = vectors[node[good]]
        used[good, k] = True
        count[good] += 1
    for k in range(width):
        node = candidates[:, k]
        fill = np.flatnonzero((node >= 0) & (node != own) & (count < most) & ~used[:, k])
        chosen[fill, count[fill]] = node[fill]
        count[fill] += 1
    return chosen


def _link_back(graph: Graph, layer: int, new: np.ndarray, chosen: np.ndarray, most: int) -> None:
    """Adds the links back to the new nodes, pruning the lists that overflow."""
    target, source = chosen.ravel(), np.repeat(new, chosen.shape[1])
    source, target = source[target >= 0], target[target >= 0]
    near = np.einsum("ij,ij->i", graph.vectors[source], graph.vectors[target])
    order = np.lexsort((-near, target))
    target, source = target[order], source[order]
    first = np.flatnonzero(np.diff(target, prepend=-1))
    at, sizes = target[first], np.diff(first, append=len(target))
    rank = np.arange(len(target)) - np.repeat(first, sizes)
    width = min(int(sizes.max(initial=0)), most)
    added = np.full((len(at), width), -1, np.int32)
    keep = rank < width
    added[np.repeat(np.arange(len(at)), sizes)[keep], rank[keep]] = source[keep]
    place = graph.place[layer][at]
    whole = np.concatenate([graph.links[layer][place], added], axis=1)
    score = np.einsum("ij,ikj->ik", graph.vectors[at], graph.vectors[np.maximum(whole, 0)])
    score[whole < 0] = -np.inf
    order = np.argsort(-score, axis=1, kind="stable")
    rows = np.arange(len(at))[:, None]
    whole, score = whole[rows, order], score[rows, order]
    over = (whole >= 0).sum(axis=1) > most
    kept = whole[:, :most].copy()
    if kept.shape[1] < most:
        kept = np.pad(kept, ((0, 0), (0, most - kept.shape[1])), constant_values=-1)
    if over.any():
        kept[over] = choose(graph.vectors, at[over], whole[over], score[over], most)
    graph.links[layer][place] = kept


def build(vectors: np.ndarray, links: int = LINKS, beam: int = BUILD_BEAM, seed: int = 5) -> Graph:
    """Graph over vectors of equal norm; layer 0 keeps twice as many links as the others."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    level = np.minimum((-np.log(1 - rng.random(n)) / np.log(links)).astype(np.int64), 8)
    level[0] = level.max(initial=0)  # the first node is in every layer, and the entry
    nodes = [np.flatnonzero(level >= k) for k in range(int(level.max(initial=0)) + 1)]
    graph = Graph(vectors, nodes, [np.full((len(own), 2 * links if k == 0 else links), -1, np.int32) for k, own in enumerate(nodes)])
    first, size = 0, 64
    while first < n:
        last = min(n, first + size)
        for start in range(first, last, WALKERS):
            _insert(graph, np.arange(start, min(last, start + WALKERS)), level, links, beam)
        first, size = last, min(BATCH, 2 * size)
    return graph


def _insert(graph: Graph, new: np.ndarray, level: np.ndarray, links: int, beam: int) -> None:
    n_seen = int(new[0])
    queries = graph.vectors[new]
    entries = np.zeros((len(new), 1), np.int64) if n_seen else np.full((len(new), 1), -1, np.int64)
    among = queries @ queries.T
    # a node may choose among the nodes of its own batch that come before it
    among[np.triu_indices(len(new))] = -np.inf
    for layer in range(len(graph.nodes) - 1, -1, -1):
        most = 2 * links if layer == 0 else links
        width = beam if layer == 0 else UPPER_BEAM * 2
        if n_seen:
            found, near = graph.walk(queries, entries, layer, width, n_seen)
            entries = found[:, :UPPER_BEAM]
        else:
            found, near = np.full((len(new), 1), -1, np.int32), np.full((len(new), 1), -np.inf, np.float32)
        here = np.flatnonzero(level[new] >= layer)
        if not len(here):
            continue
        mates = among[np.ix_(here, here)]
        best = np.argsort(-mates, axis=1, kind="stable")[:, :width]
        score = np.take_along_axis(mates, best, axis=1)
        both = np.concatenate([found[here], np.where(np.isfinite(score), new[here][best], -1).astype(np.int32)], axis=1)
        similar = np.concatenate([near[here], score], axis=1)
        order = np.argsort(-similar, axis=1, kind="stable")[:, :width]
        both, similar = np.take_along_axis(both, order, axis=1), np.take_along_axis(similar, order, axis=1)
        chosen = choose(graph.vectors, new[here], both, similar, links)
        graph.links[layer][graph.place[layer][new[here]], :links] = chosen
        if (chosen >= 0).any():
            _link_back(graph, layer, new[here], chosen, most)


def _level_norms(vectors: np.ndarray, norm: float) -> np.ndarray:
    """Vectors with one more component that gives all the same norm."""
    rest = np.sqrt(np.maximum(0.0, norm ** 2 - (vectors.astype(np.float64) ** 2).sum(axis=1)))
    return np.concatenate([vectors, rest[:, None]], axis=1).astype(np.float32)


def _pack_lists(lists: list[np.ndarray]) -> tuple[bytes, list[int]]:
    return b"".join(a.astype("<i4").tobytes() for a in lists), [len(a) for a in lists]


def _build_shard(group: pa.Table) -> pa.Table:
    ids = group.column("ids").combine_chunks()
    if isinstance(ids, pa.ChunkedArray):
        ids = ids.chunk(0)
    dim = group.column("dim")[0].as_py()
    vectors = np.array(group.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)
    graph = build(_level_norms(vectors, float(np.sqrt((vectors ** 2).sum(axis=1).max()))))
    nodes, sizes = _pack_lists(graph.nodes)
    links, _ = _pack_lists([a.ravel() for a in graph.links])
    counts = np.diff(ids.offsets.to_numpy())
    return pa.table({
        "dim": [dim], "shard": [group.column("shard")[0].as_py()], "vectors": [vectors.astype("<f8").tobytes()], "id_counts": [counts.astype("<i4").tobytes()],
        "ids": [ids.flatten().to_numpy().astype("<i8").tobytes()], "layer_sizes": [sizes], "nodes": [nodes], "links": [links]}, _SCHEMA)


_SCHEMA = pa.schema([("dim", pa.int32()), ("shard", pa.int32()), ("vectors", pa.binary()), ("id_counts", pa.binary()), ("ids", pa.binary()),
                     ("layer_sizes", pa.list_(pa.int32())), ("nodes", pa.binary()), ("links", pa.binary())])
INDEX = "dim int, shard int, vectors binary, id_counts binary, ids binary, layer_sizes array<int>, nodes binary, links binary"


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (array<double>) and dim of the rows that take part, one per id."""
    as_double = F.col("embedding").cast("array<double>")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = vectors.select("vec_id", as_double.alias("embedding")).filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(finite & some)
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumn("dim", F.size("embedding"))


def write_index(vectors: DataFrame, path: str, k: int = NEAREST, shard_rows: int = SHARD_ROWS, least_shards: int = LEAST_SHARDS) -> None:
    """Builds and stores the graphs of all shards of usable vectors."""
    by_vector = Window.partitionBy("embedding").orderBy("vec_id")
    fewest = vectors.withColumn("_rank", F.row_number().over(by_vector)).filter(F.col("_rank") <= k + 1)
    distinct = fewest.groupBy("dim", "embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    shards = max(least_shards, ceil(vectors.count() / shard_rows))
    dealt = distinct.withColumn("shard", F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(shards)).cast("int"))
    built = dealt.select("dim", "shard", "embedding", "ids").groupBy("dim", "shard").applyInArrow(_build_shard, INDEX)
    built.write.parquet(path)


class StoredShard:
    """A shard read back from its flat arrays."""

    def __init__(self, row: dict, dim: int):
        self.vectors = np.frombuffer(row["vectors"], "<f8").reshape(-1, dim)
        n = len(self.vectors)
        sizes = row["layer_sizes"]
        nodes, links = np.frombuffer(row["nodes"], "<i4"), np.frombuffer(row["links"], "<i4")
        at = np.concatenate([[0], np.cumsum(sizes)])
        cuts = np.concatenate([[0], np.cumsum([s * (2 * LINKS if i == 0 else LINKS) for i, s in enumerate(sizes)])])
        self.norm = float(np.sqrt((self.vectors ** 2).sum(axis=1).max()))
        self.graph = Graph(_level_norms(self.vectors, self.norm), [nodes[a:b] for a, b in zip(at, at[1:])],
                           [links[a:b].reshape(sizes[i], -1) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))])
        counts = np.frombuffer(row["id_counts"], "<i4").astype(np.int64)
        self.id_starts, self.ids = np.concatenate([[0], np.cumsum(counts)]), np.frombuffer(row["ids"], "<i8")
        assert n == len(counts)

    def nearest(self, query_ids: np.ndarray, queries: np.ndarray, k: int, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of the k nearest rows per query, the query's own left out; scores in double precision."""
        flat = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1).astype(np.float32)
        nodes, _ = self.graph.search(flat, min(beam, max(2, len(self.vectors))))
        query, at = np.nonzero(nodes >= 0)
        node = nodes[query, at]
        score = np.einsum("ij,ij->i", queries[query], self.vectors[node])
        sizes = self.id_starts[node + 1] - self.id_starts[node]
        row = np.repeat(np.arange(len(node)), sizes)
        ids = self.ids[self.id_starts[node][row] + np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
        query, score = query[row], score[row]
        other = ids != query_ids[query]
        query, ids, score = query[other], ids[other], score[other]
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        first = np.searchsorted(query, np.arange(len(query_ids)))
        keep = np.arange(len(query)) - first[query] < k
        return query_ids[query[keep]], ids[keep], score[keep]


def _pack_queries(group: pa.Table) -> pa.Table:
    flat = group.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    whole = {"dim": [group.column("dim")[0].as_py()], "block": [group.column("block")[0].as_py()],
             "query_ids": [group.column("vec_id").to_numpy().astype("<i8").tobytes()], "queries": [flat.astype("<f8").tobytes()]}
    kinds = [("dim", pa.int32()), ("block", pa.int32()), ("query_ids", pa.binary()), ("queries", pa.binary())]
    return pa.table(whole, pa.schema(kinds))


def _search(k: int, beam: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, shard = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                if row["query_ids"] is None:
                    held, shard = (row["dim"], row["shard"], row["part"]), StoredShard(row, row["dim"])
                    continue
                assert held == (row["dim"], row["shard"], row["part"])
                ids = np.frombuffer(row["query_ids"], "<i8")
                found = shard.nearest(ids, np.frombuffer(row["queries"], "<f8").reshape(len(ids), -1), k, beam)
                yield pa.record_batch([pa.array(a) for a in found], names=["query_id", "vec_id", "score"])
    return run


def search(queries: DataFrame, index: DataFrame, k: int = NEAREST, beam: int = SEARCH_BEAM) -> DataFrame:
    """The k nearest indexed rows of every query (vec_id, embedding, dim) -> query_id, rank, vec_id, score."""
    blocks = max(1, ceil(queries.count() / QUERY_BLOCK))
    packed = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")) \
        .select("dim", "block", "vec_id", "embedding").groupBy("dim", "block") \
        .applyInArrow(_pack_queries, "dim int, block int, query_ids binary, queries binary")
    # every block of queries goes to every shard
    shards = index.select("dim", "shard").groupBy("dim").agg(F.collect_set("shard").alias("shards"))
    part = F.floor(F.col("block") / BLOCKS_PER_COPY).cast("int").alias("part")
    sent = packed.join(shards, "dim").select("dim", F.explode("shards").alias("shard"), part, "query_ids", "queries")
    parts = ceil(blocks / BLOCKS_PER_COPY)
    copies = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    # a task per shard and part, in which the shard comes before its queries
    tasks = max(1, index.count() * parts)
    dealt = copies.unionByName(sent, allowMissingColumns=True).repartition(tasks, "dim", "shard", "part").sortWithinPartitions(
        "dim", "shard", "part", F.col("query_ids").isNotNull())
    found = texts.map_batches(dealt, _search(k, beam), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest_rows(embeddings: DataFrame, every: int = EVERY, k: int = NEAREST) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for every row whose id is divisible by `every`."""
    spark = embeddings.sparkSession
    path = scratch_path(spark, "hnsw")
    usable(embeddings).write.parquet(f"{path}/vectors")
    vectors = spark.read.parquet(f"{path}/vectors")
    write_index(vectors, f"{path}/index", k)
    queries = vectors.filter(F.pmod(F.col("vec_id"), F.lit(every)) == 0)
    return search(queries, spark.read.parquet(f"{path}/index"), k)
