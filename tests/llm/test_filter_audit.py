"""Filters in every order against a loop over documents and orders."""

from collections import Counter, defaultdict
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from aeropanel.llm import filter_audit

WORDS = " ".join(f"w{i}" for i in range(250))
SCHEMA = "doc_id long, text string, lang string, mask int, part string, n int, digest int"


def by_loop(documents, labels):
    import re
    labels = [row for row in labels if row[0] is not None]
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, t in labels if t == 1}
    least = {}
    for d, text, *_ in documents:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    found = defaultdict(Counter)
    fails = []
    for d, text, lang, *_ in documents:
        text, part = text or "", lang or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failing = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                   "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
                   "E": d is not None and d > least.get(text, d)}
        fails.append((d, part, {f for f, x in failing.items() if x}))
    for order in map("".join, permutations("ABCDE")):
        for d, part, failing in fails:
            gone = False
            for k, f in enumerate(order, 1):
                row = found[part, order, k]
                row["unique_fails"] += failing == {f}
                row["redundant"] += gone and f in failing
                if f in failing and not gone:
                    gone = True
                    row["removed"] += 1
                    row["good_lost"] += d in good
                    row["toxic_lost"] += d in toxic
                row["kept"] += not gone
    shapley = Counter()
    for (part, order, k), row in found.items():
        shapley[part, order[k - 1]] += row["removed"]
    return {(p, o, k, *(row[c] for c in filter_audit.COUNTS), shapley[p, o[k - 1]]) for (p, o, k), row in found.items()}


ROWS = [
    (1, WORDS, "en", 1, "x", 1, 1), (2, WORDS, "en", 1, "x", 1, 1), (2, WORDS, "en", 1, "x", 1, 1), (1, WORDS, "en", 1, "x", 1, 1),
    (3, "a b " * 300, "en", 1, "x", 1, 1), (4, None, None, 1, "x", 1, 1), (5, "", "", 1, "x", 1, 1), (None, WORDS, "de", 1, "x", 1, 1),
    (None, "", None, 1, "x", 1, 1), (6, "LOUD # words", "de", 1, "x", 1, 1), (7, "é\x0b\x1c| x " + WORDS, "de", 1, "x", 1, 1),
    (8, "word " * 50_000, "fr", 1, "x", 1, 1), (9, "word " * 50_000, "en", 1, "x", 1, 1)]
LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (4, None, None), (None, 1, 1), (9, 1, 1), (77, 1, 1)]


@pytest.mark.parametrize("n", [0, 1, len(ROWS)])
def test_audit_equals_loop(spark, n):
    documents = spark.createDataFrame(ROWS[:n], SCHEMA)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(documents, labels).collect()
    assert len(got) == len(set(got)) and set(map(tuple, got)) == by_loop(ROWS[:n], LABELS)


def test_no_labels(spark):
    documents = spark.createDataFrame(ROWS, SCHEMA)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    total = filter_audit.audit(documents, labels).agg(F.sum("good_lost"), F.sum("toxic_lost"), F.count("*")).first()
    assert tuple(total) == (0, 0, 4 * 600)


def test_cells_are_few(spark):
    """A part sends at most 32 cells to the fold, whatever it holds."""
    documents = spark.createDataFrame(ROWS * 50, SCHEMA)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert filter_audit.cells(documents, labels).groupBy("part").count().agg(F.max("count")).first()[0] <= 32
