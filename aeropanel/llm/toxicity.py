"""Toxicity of texts by a factorization machine over hashed terms.

The terms of a text are its words and their first 4, 5 and 6 characters, hashed to 2**20 numbers; a term counts once
per text. Beside a weight, every term has a small vector, and the inner product of two terms' vectors is added to the
score of a text that holds both, so an insult next to the mention of a group can weigh more than the two alone.

Terms that do not separate the labels are left out first, in two steps. One grouping over the sample counts, per term, the
toxic and the other texts with it, and a chi-square test keeps what is more frequent in toxic ones. The same counts among
only the texts that hold a strong term then keep what is far more frequent in toxic ones there, so a term as common in
clean texts as in toxic ones is learned if it makes an insult worse. Left out are terms that speak for clean texts, and
pairs of which neither term is more frequent in toxic texts. What the driver sees is bounded: `max_labelled` rows with the few
terms that were kept, and at most 2**20 terms.

Defined cases: a missing text is an empty one; a text without known terms gets the score of the intercept; labels that
are missing are no labels, a document with several is toxic if one says so; without a toxic or without another label
every score is the share of toxic labels, 0 without any. Other columns pass through `score`.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aeropanel.llm import texts
from aeropanel.session import scratch_path, written

TERM_BITS = 20
PREFIXES = (4, 5, 6)
MAX_LABELLED = 20_000
MIN_CHI2 = 6.0
STRONG_CHI2 = 33.0  # one of 10**8 unrelated terms, so none of the 2**20
THRESHOLD = 0.3


class Model(NamedTuple):
    """Numbers of the terms in rising order, their weights and vectors, and the intercept."""

    terms: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray
    intercept: float


def text_terms(values: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, term numbers, index of the text that holds each) for slices of a batch, with repeats."""
    for part in texts.slices([t.lower() for t in values], texts.WORD_SLICE_CHARS):
        starts, ends = texts.runs(texts.word_members(part.points), part.bounds)
        owner = np.searchsorted(part.bounds, starts, "right") - 1 + part.first
        hashes = [texts.span_hashes(part.points, starts, ends)]
        hashes += [texts.mixed(texts.span_hashes(part.points, starts, np.minimum(ends, starts + n)) + np.uint64(n))
                   for n in PREFIXES]
        numbers = (np.concatenate(hashes) >> np.uint64(64 - TERM_BITS)).astype(np.int64)
        yield part.first, part.last, numbers, np.tile(owner, len(hashes))


def _distinct(owner: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique((owner << TERM_BITS) | numbers)
    return both >> TERM_BITS, both & ((1 << TERM_BITS) - 1)


ALL_TEXTS = -1


def _count_terms(among: np.ndarray | None = None):
    """Toxic and other texts per term, and of all texts as ALL_TEXTS; with `among` only of texts that hold one of these terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, 1 << TERM_BITS), np.int64)
        whole = np.zeros(2, np.int64)
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
            counted = np.zeros(batch.num_rows, bool)
            for first, last, numbers, owner in text_terms(texts.column_texts(batch.column("text"))):
                owner, numbers = _distinct(owner, numbers)
                if among is None:
                    counted[first:last] = True
                else:
                    counted[owner[np.isin(numbers, among)]] = True
                kept = counted[owner]
                for label in (0, 1):
                    counts[label] += np.bincount(numbers[kept & (toxic[owner] == label)], minlength=1 << TERM_BITS)
            whole += np.bincount(toxic[counted], minlength=2)
        seen = np.flatnonzero(counts.sum(0))
        yield pa.record_batch([pa.array([ALL_TEXTS]), pa.array(whole[1:]), pa.array(whole[:1])], names=["term", "toxic", "other"])
        for at in range(0, len(seen), 100_000):
            part = seen[at:at + 100_000]
            yield pa.record_batch([pa.array(part), pa.array(counts[1][part]), pa.array(counts[0][part])],
                                  names=["term", "toxic", "other"])
    return run


def _tested(sample: DataFrame, path: str, among: np.ndarray | None = None) -> pa.Table:
    """term, chi2 of terms that speak for toxic with a chi-square of MIN_CHI2 or more; at most 2**20 rows."""
    counts = texts.map_batches(sample.select("text", "toxic"), _count_terms(among), "term long, toxic long, other long")
    per_term = written(counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")), path)
    whole = per_term.filter(F.col("term") == ALL_TEXTS).first()
    chi2 = chi_square(F.col("toxic"), F.col("other"), whole.toxic, whole.other)
    speaks = F.col("toxic") * (whole.toxic + whole.other) > (F.col("toxic") + F.col("other")) * whole.toxic
    tested = per_term.filter((F.col("term") != ALL_TEXTS) & speaks).select("term", chi2.alias("chi2"))
    return tested.filter(F.col("chi2") >= MIN_CHI2).toArrow()


def chi_square(toxic: Column, other: Column, all_toxic: int, all_other: int) -> Column:
    """Chi-square with continuity correction of the 2 x 2 table of a term; null if all texts hold it."""
    n = float(all_toxic + all_other)
    with_term, gap = toxic + other, F.abs(toxic * F.lit(float(all_other)) - other * F.lit(float(all_toxic)))
    return F.try_divide(F.pow(F.greatest(F.lit(0.0), gap - n / 2), 2) * n,
                        with_term * (F.lit(n) - with_term) * float(all_toxic) * float(all_other))


def _lookup(terms: np.ndarray) -> np.ndarray:
    table = np.full(1 << TERM_BITS, -1, np.int64)
    table[terms] = np.arange(len(terms))
    return table


def _known_terms(values: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, place of the term in the model) once per text and term, ordered by text."""
    found = [np.zeros((2, 0), np.int64)]
    for _, _, numbers, owner in text_terms(values):
        known = table[numbers] >= 0
        found.append(np.stack(_distinct(owner[known], numbers[known])))
    owner, numbers = np.concatenate(found, axis=1)
    return owner, table[numbers]


def train(owner: np.ndarray, terms: np.ndarray, toxic: np.ndarray, n_terms: int, factors: int = 4, epochs: int = 10,
          rate: float = 0.1, decay: float = 1e-3, batch: int = 64, seed: int = 1) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights, vectors and intercept by stochastic gradients with adaptive rates; `owner` must not fall."""
    rng = np.random.default_rng(seed)
    weights, vectors = np.zeros(n_terms), rng.normal(0, 0.01, (n_terms, factors))
    intercept = float(np.log(toxic.mean() / (1 - toxic.mean())))
    past_w, past_v, past_b = np.full(n_terms, 0.1), np.full((n_terms, factors), 0.1), 1.0
    bounds = np.searchsorted(owner, np.arange(len(toxic) + 1, dtype=owner.dtype))
    order = np.arange(len(toxic))
    for _ in range(epochs):
        rng.shuffle(order)
        for at in range(0, len(order), batch):
            rows = order[at:at + batch]
            sizes = bounds[rows + 1] - bounds[rows]
            row = np.repeat(np.arange(len(rows)), sizes)
            held = terms[np.arange(sizes.sum()) + np.repeat(bounds[rows] - np.cumsum(sizes) + sizes, sizes)]
            score, sums = _scores(weights, vectors, intercept, row, held, len(rows))
            error = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - toxic[rows]
            used, back = np.unique(held, return_inverse=True)
            step_w = np.bincount(back, error[row], len(used)) + decay * weights[used]
            pull = error[row, None] * (sums[row] - vectors[held])
            step_v = np.stack([np.bincount(back, p, len(used)) for p in pull.T], 1) + decay * vectors[used]
            past_w[used] += step_w ** 2
            past_v[used] += step_v ** 2
            past_b += error.sum() ** 2
            weights[used] -= rate * step_w / np.sqrt(past_w[used])
            vectors[used] -= 0.3 * rate * step_v / np.sqrt(past_v[used])
            intercept -= rate * error.sum() / np.sqrt(past_b)
    return weights, vectors, float(intercept)


def _scores(weights: np.ndarray, vectors: np.ndarray, intercept: float, row: np.ndarray, held: np.ndarray,
            n: int) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of n texts, and per text the sum of its terms' vectors."""
    own = vectors[held]
    sums = np.stack([np.bincount(row, v, n) for v in own.T], 1)
    squares = np.bincount(row, (own ** 2).sum(1), n)
    return intercept + np.bincount(row, weights[held], n) + ((sums ** 2).sum(1) - squares) / 2, sums


def fit(documents: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Learns from `labels` (doc_id, toxic) of `documents` (doc_id, text).

    Of more than `max_labelled` labels those with the smallest hash of their id are used. That bounds the labels that
    are broadcast, the texts that are read for learning, and the rows that reach the driver.
    """
    spark: SparkSession = documents.sparkSession
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    one = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    # a document id may be repeated; its rows are then learned from once
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(
        F.max("text").alias("text"))
    path = scratch_path(spark, "labelled")
    sample = written(rows, path)
    n, n_toxic = sample.agg(F.count("*"), F.sum("toxic")).first()
    if not n or not n_toxic or n_toxic == n:
        share = (n_toxic or 0) / n if n else 0.0
        return Model(np.zeros(0, np.int64), np.zeros(0), np.zeros((0, 1)), float("inf") if share else float("-inf"))
    telling = _tested(sample, f"{path}-terms")
    terms = np.sort(telling.column("term").to_numpy())
    strong = telling.filter(pc.field("chi2") >= STRONG_CHI2).column("term").to_numpy()
    if len(strong):
        beside = _tested(sample, f"{path}-pairs", strong).filter(pc.field("chi2") >= STRONG_CHI2)
        terms = np.union1d(terms, beside.column("term").to_numpy())

    def held_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _lookup(terms)
        for batch in batches:
            owner, places = _known_terms(texts.column_texts(batch.column("text")), table)
            cuts = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            held = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(places.astype(np.int32)))
            yield pa.record_batch([batch.column("doc_id"), batch.column("toxic"), held], names=["doc_id", "toxic", "terms"])

    schema = f"doc_id {dict(sample.dtypes)['doc_id']}, toxic int, terms array<int>"
    learned = texts.map_batches(sample, held_terms, schema).toArrow().sort_by("doc_id").combine_chunks()
    sizes = np.array(pc.list_value_length(learned.column("terms")))
    flat = np.array(pc.list_flatten(learned.column("terms")), np.int32)
    toxic = np.array(learned.column("toxic"), float)
    del learned
    pa.default_memory_pool().release_unused()  # training needs the arrays only
    return Model(terms, *train(np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), flat, toxic, len(terms)))


def score(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Adds the probability that a text is toxic."""
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _lookup(shared.value.terms)
        _, weights, vectors, intercept = shared.value
        for batch in batches:
            owner, places = _known_terms(texts.column_texts(batch.column("text")), table)
            odds, _ = _scores(weights, vectors, intercept, owner, places, batch.num_rows)
            with np.errstate(over="ignore"):
                chance = 1 / (1 + np.exp(-odds))
            yield pa.record_batch([*batch.columns, pa.array(chance)], names=[*batch.schema.names, name])

    kept = documents.drop(name)
    return texts.map_batches(kept, scored, f"{texts.ddl(kept)}, {name} double")


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Whether a document's labels are kept from learning: crc32 of its id as text, modulo 4, is 2."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def toxic_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document; only labels that are not held out are learned from."""
    model = fit(documents, labels.filter(~held_out()))
    scored = score(documents.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not toxic, with their columns."""
    model = fit(documents, labels.filter(~held_out()))
    name = "_toxicity" + "_" * max(map(len, documents.columns))  # a name no column has
    scored = score(documents, model, name)
    return scored.filter(F.col(name) < THRESHOLD).drop(name)
