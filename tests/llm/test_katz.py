"""The model against a plain one in dictionaries; probabilities after a history sum to one; odd rows."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ticksmith.llm import katz as kz

SF = "/root/testdata/sf0.001"


class Plain:
    """The model in dictionaries, by recursion over histories (tuples of words, oldest first)."""

    def __init__(self, texts, order):
        self.order = order
        self.grams = [Counter() for _ in range(order + 1)]
        self.history = Counter()
        for w in texts:
            line = ["<b>"] * (order - 1) + w
            for k in range(order - 1, len(line)):
                for n in range(1, order + 1):
                    gram = tuple(line[k - n + 1 : k + 1])
                    self.grams[n][gram] += 1
                    self.history[gram[:-1]] += 1
        self.uni = {g[0]: c for g, c in self.grams[1].items()}
        self.n = sum(self.uni.values())
        self.d = [None] + [kz.good_turing([sum(v == r for v in c.values()) for r in range(1, kz.GT_MAX + 2)]) for c in self.grams[1:]]
        self.unknown = 1 - sum(self.cut(1, c) for c in self.uni.values()) / self.n
        self.after = defaultdict(list)
        for n in range(2, order + 1):
            for g in self.grams[n]:
                self.after[g[:-1]].append(g[-1])
        self.back = {}

    def cut(self, n, c):
        return self.d[n][min(c, kz.GT_MAX + 1)] * c

    def weights(self, h):
        if h not in self.back:
            n = len(h) + 1
            seen = sum(self.cut(n, self.grams[n][*h, w]) for w in self.after[h]) / self.history[h]
            free = 1 if seen < 1 - 1e-12 else self.history[h] / (self.history[h] + 1)
            self.back[h] = free, (1 - free * seen) / (1 - sum(self.p(h[1:], w) for w in self.after[h]))
        return self.back[h]

    def p(self, h, w):
        n = len(h) + 1
        c = self.grams[n][*h, w]
        if n == 1:
            return self.cut(1, c) / self.n if c else self.unknown
        if c:
            return self.weights(h)[0] * self.cut(n, c) / self.history[h]
        return (self.weights(h)[1] if self.history[h] else 1) * self.p(h[1:], w)

    def score(self, words):
        line = ["<b>"] * (self.order - 1) + words
        return sum(math.log10(self.p(tuple(line[k - self.order + 1 : k]), line[k])) for k in range(self.order - 1, len(line)))


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_against_dictionaries(spark, order):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: [*r["text"].encode().lower().split(), "<e>"] for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    model = Plain([w for i, w in texts.items() if not held[i]], order)
    # many small blocks and buckets, so that every exchange is used
    got = kz.katz(docs, order=order, buckets=7, block_tokens=5000).collect()
    assert len(got) == len(texts)
    for r in got:
        w = texts[r["doc_id"]]
        assert r["held_out"] == held[r["doc_id"]] and r["train_tokens"] == model.n
        assert r["n_tokens"] == len(w) and r["n_known"] == sum(x in model.uni for x in w)
        base = sum(math.log10((model.uni.get(x, 0) + 0.1) / (model.n + 0.1 * (len(model.uni) + 1))) for x in w)
        assert r["base_score"] == pytest.approx(base)
        assert r["score"] == pytest.approx(model.score(w))
    assert sum(r["score"] for r in got if r["held_out"]) > sum(r["base_score"] for r in got if r["held_out"])
    for h in [h for h in model.back if h][:200]:
        total = sum(model.p(h, w) for w in model.uni) + model.unknown * math.prod(model.weights(h[k:])[1] for k in range(len(h)))
        assert total == pytest.approx(1)


def test_packing_of_arrays():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2))
    assert (kz.expand_sorted(kz.squeeze_sorted(keys)) == keys).all()
    small = rng.integers(0, 300, 1000).astype(np.uint32)
    assert (kz.expand(kz.squeeze(small), np.uint32) == small).all()
    assert (np.diff(kz.bucket_of(keys, 13)) >= 0).all()


def test_odd_rows(spark, make_docs, odd_docs, odd_rows):
    got = kz.katz(odd_docs).collect()
    assert len(got) == len(odd_rows)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["n_tokens"] == by[2]["n_tokens"] == by[3]["n_tokens"] == 1
    assert by[1]["score"] == pytest.approx(by[2]["score"])
    assert all(math.isfinite(r["score"]) and r["score"] <= 0 for r in got) and not by[None]["held_out"]
    assert kz.katz(make_docs([])).count() == 0
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    (only,) = kz.katz(make_docs([(held, "never seen", "s")])).collect()
    assert (only["held_out"], only["train_tokens"], only["n_known"], only["score"]) == (True, 0, 0, 0.0)
