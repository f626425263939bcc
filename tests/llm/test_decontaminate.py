"""Containment search against all pairs."""

import numpy as np
import pytest

from aeropanel.llm import decontaminate, texts

ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def brute(documents, items, share=0.8):
    found = []
    for doc_id, text in documents:
        lists = {size: set(texts.shingles_of(text, size)) for size in range(1, 6)}
        for item_id, item in items:
            size = max(1, min(5, len(texts.words_of(item))))
            wanted, held = set(texts.shingles_of(item, size)), lists[size]
            if wanted and len(wanted & held) / len(wanted) >= share:
                found.append((doc_id, item_id, len(wanted & held), len(wanted)))
    return sorted(found, key=repr)


def frames(spark, documents, items):
    return (spark.createDataFrame(documents, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))


def test_equals_all_pairs(spark):
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(300)]
    filler = lambda n: " ".join(rng.choice(words, n))
    items = [(i, filler(int(rng.integers(1, 60)))) for i in range(40)] + [(100, ITEM), (100, ITEM), (101, None), (102, ""), (103, "one two")]
    documents = [(i, f"{filler(int(rng.integers(0, 3000)))} {items[i % 40][1]} {filler(5)}") for i in range(60)]
    documents += [(200, None), (201, ""), (202, "One, two!"), (None, ITEM.upper()), (203, ITEM), (203, ITEM),
                  (204, " ".join(ITEM.split()[:17])), (205, " ".join(ITEM.split()[:16])), (206, f"{filler(20_000)} {ITEM}")]
    given = frames(spark, documents, items)
    got = [(r.doc_id, r.item_id, r.shared, r.item_shingles) for r in decontaminate.contaminated(*given).collect()]
    assert sorted(got, key=repr) == brute(documents, items)
    ids = sorted((r.doc_id for r in decontaminate.without_items(*given).collect()), key=repr)
    held = {repr(f[0]) for f in brute(documents, items)}
    assert ids == sorted((d for d, _ in documents if repr(d) not in held), key=repr)


def test_short_items_are_found_inside_long_documents(spark):
    rng = np.random.default_rng(4)
    filler = lambda n: " ".join(rng.choice([f"w{i}" for i in range(50)], n))
    items = [(1, "needle"), (2, "two needles"), (3, "Three sharp needles!"), (4, "a b c d"), (5, "w1 w2"), (6, "a b c d e"), (7, "...")]
    documents = [(1, f"{filler(5000)} needle {filler(5000)}"), (2, f"{filler(900)} two, NEEDLES {filler(9)}"), (3, "three sharp needles"),
                 (4, f"a b c d {filler(300)}"), (5, f"{filler(300)} a b c d"), (6, "needles two needles"), (7, "b c d"), (8, f"a b c d e {filler(8)}"),
                 (9, "two"), (10, "needles"), (11, ""), (12, None), (13, filler(20_000))]
    given = frames(spark, documents, items)
    got = [(r.doc_id, r.item_id, r.shared, r.item_shingles) for r in decontaminate.contaminated(*given).collect()]
    assert sorted(got, key=repr) == brute(documents, items)
    assert {(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 2), (8, 4), (8, 6), (13, 5)} <= {g[:2] for g in got}


def test_levels_tell_from_where_a_hash_is_the_smallest_of_its_bin():
    hashes = np.unique(np.random.default_rng(2).integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2))
    levels = decontaminate.smallest_from(hashes)
    for level in (0, 1, 3, 7, 12):
        bins = hashes >> np.uint64(64 - level) if level else np.zeros(len(hashes), np.uint64)
        first = np.append(True, bins[1:] != bins[:-1])
        assert np.array_equal(levels <= level, first)


@pytest.mark.parametrize("documents, items", [([], [(1, ITEM)]), ([(1, ITEM)], []), ([], [])])
def test_empty_tables(spark, documents, items):
    given = frames(spark, documents, items)
    assert decontaminate.contaminated(*given).count() == 0
    assert decontaminate.without_items(*given).count() == len(documents)
