"""Counts at every prefix against the library; budgets; odd rows."""

import random

import numpy as np
import pytest

from tests.llm.conftest import prose
from ticksmith.llm import tokens as tk


@pytest.fixture(scope="module")
def counter():
    return tk.PrefixCounter(tk.tokenizer_path())


@pytest.fixture(scope="module")
def count():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tk.tokenizer_path())
    return lambda t: len(library.encode(t, add_special_tokens=False).ids)


def cases():
    fixed = ["", "it'll we're  ok\n\n  x 'll", "a\n b", "  lead", "trail  ", "naïve – café 123,456 <|endoftext|> z <|endof", "<|endoftext|>",
             "日本語 テスト 🙂🙂  é", "'re've'l 're", "x" * 40 + " " * 20 + "!!! --'s", "a  b　c", "!'s 's it'S", "\x1c \x85 q", "end.\nNext, one.\n'll"]
    rng, letters = random.Random(5), list("ab'rel \n\t sdé1,.!🙂 <|")
    return fixed + ["".join(rng.choice(letters) for _ in range(30)) for _ in range(80)] + [prose(3, 30)]


def test_every_prefix(counter, count):
    for text in cases():
        got = np.cumsum(np.frombuffer(counter.deltas(text), "<i2")).tolist()
        assert got == [count(text[:i]) for i in range(1, len(text) + 1)], text


def test_budgets(counter, count):
    text = prose(8, 60)
    d = counter.deltas(text)
    for budget in (0, 1, 7, 50):
        n = tk.longest_prefix(d, budget)
        assert count(text[:n]) <= budget and tk.count_at(d, n) == count(text[:n])
        assert all(count(text[:k]) > budget for k in range(n + 1, min(len(text), n + 20)))


def test_odd_rows(spark, make_docs, odd_docs, odd_rows, count):
    got = tk.prefix_counts(odd_docs, tk.tokenizer_path(), budget=512).collect()
    assert sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in got) == sorted((i or 0, len((t or "").encode()), count(t or "")) for i, t, _ in odd_rows)
    long = next(r for r in got if r["doc_id"] == 9)
    assert long["n_tokens"] > 512 and count(dict((i, t) for i, t, _ in odd_rows)[9][: long["fit_chars"]]) <= 512
    assert tk.prefix_counts(make_docs([]), tk.tokenizer_path()).count() == 0


def test_query_counts_the_given_texts(spark, count):
    from ticksmith.llm.queries import op10_prefix_token_counts

    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in op10_prefix_token_counts(spark, sf).collect()}
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        n = count(r["text"])
        assert (got[r["doc_id"]]["n_tokens"], got[r["doc_id"]]["over_limit"], got[r["doc_id"]]["n_bytes"]) == (n, n > 512, len(r["text"].encode()))
