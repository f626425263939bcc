"""Words, shingles and pieces found on arrays equal those found one by one."""

import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from aeropanel.llm import pieces, repair, texts, token_counts

ODD = ["", "a", "Don't WE'VE I'LL they're 're 'r 'll'l  x", " a  b\n\n c\t\t\td   ", "foo!!'s 's '''s", "12345 6",
       "x<|endoftext|>y  <|endoftext|><|endof <|startoftext|>", "日本語 テキスト  é́ naïve — “q” İ Σας K", "    ", "\n\n\n'tis",
       "a" * 300, "hello   \n  world 've\n'vex 've"]


def noise(n: int, seed: int = 1) -> list[str]:
    rnd = random.Random(seed)
    return ["".join(rnd.choice("ab'stvelrSTL \n\t1!éÉ<|日") for _ in range(rnd.randint(1, 40))) for _ in range(n)]


def test_words_are_runs_of_letters_marks_and_digits():
    assert texts.words_of("Ünï-Çod 12x, a_b ÉÉ!") == ["ünï", "çod", "12x", "a", "b", "éé"]
    plain = ["".join(c for c in t if ord(c) < 128) for t in noise(50)]
    assert [texts.words_of(t) for t in plain] == [re.findall(r"[a-z0-9]+", t.lower()) for t in plain]


@pytest.mark.parametrize("slice_chars", [1, 50, 10_000])
def test_shingle_hashes_tell_shingles_apart(slice_chars, monkeypatch):
    values = [*ODD, "one", "a b c d", "a b c d e", "a b c d e f", *noise(100)]
    monkeypatch.setattr(texts, "slices", lambda v, most=slice_chars, f=texts.slices: f(v, slice_chars))
    by_hash, n = {}, 0
    for first, last, hashes, at in texts.shingle_hashes(values):
        for i in range(first, last):
            own, want = hashes[at[i - first]:at[i - first + 1]].tolist(), texts.shingles_of(values[i])
            assert len(own) == len(want)
            for h, shingle in zip(own, want):
                assert by_hash.setdefault(h, shingle) == shingle
            n += 1
    assert n == len(values) and len(set(by_hash.values())) == len(by_hash)


def test_encoder_equals_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    library, values = Tokenizer.from_file(path), [*ODD, *noise(300)]
    got = [ids.tolist() for ids in repair.PieceEncoder(path).encode(values)]
    assert got == [e.ids for e in library.encode_batch(values, add_special_tokens=False)]


def test_every_prefix_count_equals_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, values = Tokenizer.from_file(path), [*ODD, *noise(150, 2)]
    for value, steps in zip(values, token_counts.PrefixCounter(path).batch_steps(values)):
        got = token_counts.counts_at(token_counts.pack(steps)).tolist()
        assert got == [len(library.encode(value[:i], add_special_tokens=False).ids) for i in range(len(value) + 1)]


def test_pieces_of_a_forgotten_cache_are_learned_again(monkeypatch):
    monkeypatch.setattr(token_counts, "KNOWN_PIECES", 20)
    monkeypatch.setattr(repair, "KNOWN_PIECES", 20)
    values = noise(60, 3)
    byte_path, word_path = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
    counter, encoder = token_counts.PrefixCounter(byte_path), repair.PieceEncoder(word_path)
    for value in values:
        assert sum(len(e.ids) for e in [Tokenizer.from_file(byte_path).encode(value)]) == next(counter.batch_steps([value])).sum()
        assert Tokenizer.from_file(word_path).encode(value, add_special_tokens=False).ids == next(encoder.encode([value])).tolist()


def test_plain_texts_leave_out_what_unicode_versions_differ_on():
    part = next(texts.slices(["plain é ß", "no ", "日", ""]))
    assert pieces.plain_texts(part).tolist() == [True, False, False, True]
    assert np.array_equal(pieces.gather(np.arange(10), np.array([3, 0]), np.array([2, 3])), [3, 4, 0, 1, 2])


def test_words_are_hashed_by_small_slices():
    values = [f"own{i} " + "word other " * 5000 for i in range(40)]
    parts = list(texts.word_hashes(values))
    assert max(last - first for first, last, _, _ in parts) <= 3
    alone = [h for v in values for _, _, hashes, _ in texts.word_hashes([v]) for h in hashes.tolist()]
    assert [h for _, _, hashes, _ in parts for h in hashes.tolist()] == alone


def test_a_task_reads_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            # the whole buffer, of which the batch may be a slice
            yield pa.record_batch([pa.array([batch.column(0).buffers()[1].size])], names=["size"])

    got = [r["size"] for r in texts.map_batches(spark.range(0, 5000, 1, 1), sizes, "size long").collect()]
    assert len(got) == 5 and max(got) <= 8 * texts.BATCH_ROWS + 64


def test_a_task_gives_its_memory_back(spark, monkeypatch):
    class Given:
        sparkSession = spark

        def mapInArrow(self, run, schema):
            return run

    calls = []
    monkeypatch.setattr(texts, "release_memory", lambda: calls.append(1))
    run = texts.map_batches(Given(), lambda batches: iter(batches), "id long")
    batches = [pa.record_batch([pa.array(range(1500))], names=["id"])]
    assert [b.num_rows for b in run(batches)] == [1000, 500] and calls == [1]
