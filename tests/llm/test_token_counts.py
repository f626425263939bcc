"""Stored prefix counts answer budget questions without encoding."""

import time

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from aeropanel.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
ROWS = [(1, "The quick brown fox isn't here.\n\n  End", 1), (2, None, 2), (3, "", 3), (4, "<|endoftext|>x" * 5, 4), (4, "<|endoftext|>x" * 5, 4),
        (None, "日本語 " * 30, 5), (5, "word " * 60_000, 6), (6, "a" * 2000, 7)]


def test_counts_of_whole_texts(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, n_tokens int").repartition(3)
    library = Tokenizer.from_file(PATH)
    counts = {t: len(library.encode(t or "", add_special_tokens=False).ids) for _, t, _ in ROWS}
    got = token_counts.document_tokens(df, PATH).collect()
    want = [(i, len((t or "").encode()), counts[t], counts[t] > 512) for i, t, _ in ROWS]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_truncation_keeps_the_longest_prefix_within_the_budget(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, other int")
    library = Tokenizer.from_file(PATH)
    size = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    texts = {r[2]: r[1] or "" for r in ROWS}
    got = token_counts.truncated(token_counts.prefix_counts(df, PATH), 7).collect()
    assert len(got) == len(ROWS)
    for row in got:
        whole = texts[row.other]
        assert whole.startswith(row.text) and row.n_tokens == size(row.text) <= 7
        assert row.text == whole or all(size(whole[:len(row.text) + k]) > 7 for k in (1, 2, 3))


@pytest.mark.parametrize("text", ["QUJD" * 250_000, "aB3+/" * 40_000, "é" * 50_000])
def test_a_long_text_without_blanks(text):
    """The time is in proportion to the text, and the count is the library's."""
    counter = token_counts.PrefixCounter(PATH)
    begun = time.thread_time()
    counts = counter.byte_counts(text.encode())
    assert time.thread_time() - begun < 30
    library = Tokenizer.from_file(PATH)
    library.pre_tokenizer = None
    letters = {b: c for c, b in token_counts.byte_letters().items()}
    assert counts[-1] == len(library.encode("".join(letters[b] for b in text.encode()), add_special_tokens=False).ids)


def test_no_documents(spark):
    assert token_counts.document_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
