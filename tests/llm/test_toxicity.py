"""Marginals against plain forward-backward; held-out accuracy; odd rows."""

import zlib

import numpy as np
import pytest

from tests.llm.conftest import prose
from ticksmith.llm import toxicity as tx

SF = "/root/testdata/sf0.01"


def test_marginals_are_exact():
    c = tx.Chain(3)
    c.emit, c.move = np.array([[0, -2.0], [-1, 2], [0, 0.5]]), np.array([[0.5, -0.5], [-0.2, 0.8]])
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 60):
        codes = rng.choice([0, 0, 0, 0, 1, 2], n)
        codes[n // 2] = 1
        e, m = np.exp(c.emit[codes]), np.exp(c.move)
        f, b = np.zeros((n, 2)), np.ones((n, 2))
        f[0] = e[0]
        for t in range(1, n):
            f[t] = (f[t - 1] @ m) * e[t]
        for t in range(n - 2, -1, -1):
            b[t] = m @ (e[t + 1] * b[t + 1])
        p = f * b
        at, q = c.marginals(codes)
        assert np.allclose((p[:, 1] / p.sum(axis=1))[at], q)


def test_gradient_fits_labels():
    rows = [([0, 1, 0, 0], 1), ([0, 0, 0], 0), ([0, 1], 1), ([2, 0, 0], 0)] * 20
    chain = tx.Chain(3).fit(rows)
    assert chain.marginals(np.array([0, 1, 0]))[1].max() > 0.9
    assert chain.marginals(np.array([0, 2, 0]))[1].max() < 0.2


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = {r["doc_id"]: r for r in tx.toxicity(docs, labels).collect()}
    assert len(out) == docs.count()
    gold = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    for i, r in out.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(out[i]["predicted"], y) for i, y in gold.items() if out[i]["held_out"]]
    assert sum(p == y for p, y in held) / len(held) > 0.93
    assert not any(p for p, y in held if y == 0)


def test_spans_and_odd_rows(spark, make_docs, odd_docs, odd_rows):
    empty = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    out = tx.toxicity(odd_docs, empty)
    assert {r["score"] for r in out.collect()} == {0.0} and out.count() == len(odd_rows)
    rows = [(k, prose(k, 40).replace("\n", " ") + (" you blockhead! again" if k % 4 == 0 else ""), "s") for k in range(200)]
    labels = spark.createDataFrame([(k, 1, int(k % 4 == 0)) for k in range(200)], "doc_id bigint, quality int, toxic int")
    docs = make_docs([*rows, *odd_rows])
    got = tx.toxicity(docs, labels).collect()
    assert len(got) == 200 + len(odd_rows)
    by = {r["doc_id"]: r for r in got}
    text = rows[4][1]
    span = by[104]["spans"][0]
    assert rows[104][1].encode()[span["start"] : span["end"]].lower().find(b"blockhead") >= 0 and by[104]["predicted"] == 1
    assert by[101]["predicted"] == 0 and text
    kept = tx.without_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert kept.where("text like '%blockhead%'").count() == 0
    assert tx.toxicity(make_docs([]), labels).count() == 0


@pytest.mark.parametrize("text,words,toxic,runs", [(b"A bad  word\nbad bad", 5, [1, 3, 4], [(2, 5), (12, 19)])])
def test_byte_spans(text, words, toxic, runs):
    tokens = text.lower().split()
    assert len(tokens) == words
    assert [(s["start"], s["end"]) for s in tx.byte_spans(text, tokens, np.array(toxic))] == runs


def test_fit_does_not_depend_on_partitions(spark, make_docs):
    """Of documents with one opening and different labels the same one counts, however the table is dealt."""
    rows = [(k, f"same ten words open each of these twenty documents here {'blockhead' if k % 3 else 'garden'} {prose(k, 20)}", "s") for k in range(20)]
    rows += [(100 + k, prose(200 + k, 40) + (" you utter blockhead" if k % 2 else " a quiet garden"), "s") for k in range(40)]
    labels = spark.createDataFrame([(i, 1, int("blockhead" in t)) for i, t, _ in rows], "doc_id bigint, quality int, toxic int")
    docs = make_docs(rows)
    first, second = ({r["doc_id"]: r["score"] for r in tx.toxicity(docs.repartition(n, c), labels).collect()} for n, c in ((1, "doc_id"), (7, "text")))
    assert first == pytest.approx(second, abs=1e-9)
