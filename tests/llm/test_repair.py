"""Token files: round trips, random access, digests."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from aeropanel.llm import repair

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_grammar_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    for n_docs, alphabet in ((1, 2), (30, 3), (50, 200), (5, 1)):
        docs = [rng.integers(0, alphabet, int(rng.integers(1, 400))).astype(np.int32) for _ in range(n_docs)] + [np.full(1000, 1, np.int32)]
        starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        grammar = repair.compress(np.concatenate(docs), starts, 1000, least_uses=4)
        shard = repair.Shard(repair.pack_shard(grammar, np.arange(len(docs)), starts))
        assert len(grammar.rules) and len(shard.symbols) < starts[-1]
        for i, doc in enumerate(docs):
            assert np.array_equal(shard.ids(i, i + 1), doc)
            a, b = sorted(rng.integers(0, len(doc) + 1, 2).tolist())
            if a < b:
                assert np.array_equal(shard.stretch(i, a, b), doc[a:b])


def plain_rules(docs, first, least_uses):
    """The rules by exact counts of all pairs, with loops."""
    docs, rules = [d.tolist() for d in docs], []
    while True:
        uses = Counter(pair for d in docs for pair in zip(d, d[1:]))
        best = max(uses.values(), default=0)
        if best < least_uses:
            return rules
        # a counter keeps the order of first uses, which the sort keeps among equal counts
        chosen = [pair for pair, n in uses.most_common() if n >= max(least_uses, -(-best // repair.ROUND_SHARE))]
        number = {pair: first + len(rules) + i for i, pair in enumerate(chosen)}
        rules += chosen
        for k, d in enumerate(docs):
            # of chosen pairs that overlap, every second one is replaced
            taken, i = set(), 0
            while i < len(d) - 1:
                if (d[i], d[i + 1]) in number:
                    taken.add(i)
                    i += 1
                i += 1
            docs[k] = [number[(x, d[i + 1])] if i in taken else x for i, x in enumerate(d) if i - 1 not in taken]


def test_rules_equal_those_of_exact_counts(monkeypatch):
    rng = np.random.default_rng(3)
    docs = [rng.zipf(1.5, 300).clip(0, 400).astype(np.int32) for _ in range(20)]
    starts = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    for bits in (10, repair.PAIR_BITS):
        monkeypatch.setattr(repair, "PAIR_BITS", bits)
        grammar = repair.compress(np.concatenate(docs), starts, 401, least_uses=8)
        assert grammar.rules.tolist() == [list(pair) for pair in plain_rules(docs, 401, 8)] and len(grammar.rules) > 20


def test_pieces_that_share_a_slot_and_long_ones(monkeypatch):
    monkeypatch.setattr(repair, "SLOT_BITS", 3)
    monkeypatch.setattr(repair, "KNOWN_IDS", 2000)
    rng = np.random.default_rng(5)
    values = [" ".join(f"{chr(97 + int(x) % 26) * (1 + int(x) % 5)}q" for x in rng.integers(0, 130, 200)) for _ in range(20)]
    values += ["".join(chr(97 + x) for x in rng.integers(0, 26, 3000)) + " end" for _ in range(20)]
    known, library = repair.PieceEncoder(PATH), Tokenizer.from_file(PATH)
    for value in [*values, *values[::-1]]:
        assert next(known.encode([value])).tolist() == library.encode(value, add_special_tokens=False).ids
        # what is kept is bounded by ids too, but for the last text's
        assert known._used <= 2000 + 3000


def test_symbols_stay_within_16_bits():
    ids = np.tile(np.arange(300, dtype=np.int32), 50)
    grammar = repair.compress(ids, np.array([0, len(ids)]), repair.SYMBOLS - 10, least_uses=2)
    assert len(grammar.rules) <= 10 and grammar.symbols.max() < repair.SYMBOLS


def test_digests_equal_the_library(spark):
    rows = [(5, "The quick brown fox. " * 300), (None, "last"), (2, None), (3, ""), (1, "日本 <|endoftext|> x"), (3, "twin"), (4, "A b " * 4000),
            (3, "twin"), (-7, "first")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, repair.encoded(df, PATH).collect()), key=lambda r: r[1])
    assert [g[0] for g in got] == [-7, 1, 2, 3, 3, 3, 4, 5, None]
    library, start, by_id = Tokenizer.from_file(PATH), 0, {}
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        by_id.setdefault(doc_id, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    for doc_id, at, n, crc in got:
        assert at == start and (n, crc) in by_id[doc_id]
        by_id[doc_id].remove((n, crc))
        start += n
    assert not any(by_id.values())


def test_shards_are_cut_and_counted_on(spark, tmp_path):
    df = spark.createDataFrame([(i, f"word{i % 7} " * (i % 50)) for i in range(300)], "doc_id long, text string")
    repair.write_shards(df, PATH, str(tmp_path / "s"), shard_ids=500)
    shards = repair.read_shards(spark, str(tmp_path / "s"))
    assert shards.count() > 10
    rows = sorted(map(tuple, repair.document_digests(shards).collect()))
    assert [r[0] for r in rows] == list(range(300))
    assert [r[1] for r in rows] == np.concatenate([[0], np.cumsum([r[2] for r in rows])[:-1]]).tolist()


def test_no_documents(spark):
    assert repair.encoded(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
