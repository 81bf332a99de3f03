"""Hard negatives by one-bit codes against plain scoring of all pairs."""

import math
import random

import numpy as np
import pytest

from ticksmith.llm.negatives import Index, mine

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, width string, pack string, positives string"


def brute(rows, every=100, n_pos=5, n_neg=10):
    part = {}
    for vec_id, e, label in rows:
        if vec_id is None or label is None or e is None or any(x is None or not math.isfinite(x) for x in e):
            continue
        ints = tuple(math.floor(256 * float(np.float32(x))) for x in e)
        if any(abs(x) > math.sqrt(2**62 / len(e)) - 1 for x in ints):
            continue
        part[vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, ints] = None
    out = []
    for a, la, ea in part:
        if a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(ea, e)), i, lab) for i, lab, e in part if i != a and len(e) == len(ea)]
        for ps, p, _ in sorted(s for s in scored if s[2] == la)[:n_pos]:
            found = [s for s in sorted(scored) if s[2] != la and 30 * -ps <= 100 * -s[0] <= 90 * -ps]
            out += [(a, p, r + 1, i, -ps, -s) for r, (s, i, _) in enumerate(found[:n_neg])]
    return sorted(out)


def run(spark, rows, **kw):
    return sorted(map(tuple, mine(spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA), **kw).collect()))


def clustered(rng, n, width, labels=10):
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    return [(i, [c + rng.gauss(0, 0.5) for c in rng.choice(centres)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("width", [3, 64, 70])
def test_equals_plain_scoring(spark, width):
    rows = clustered(random.Random(width), 500, width)
    expected = brute(rows, every=20)
    assert len(expected) > 500
    assert run(spark, rows, every=20, block_rows=90, anchor_rows=8) == expected


def test_odd_rows(spark):
    rng = random.Random(2)
    rows = clustered(rng, 150, 4, 2)
    rows += rows[100:130]  # repeated rows
    rows += [(300, rows[0][1], None), (400, None, 1), (500, [1.0, None, 2.0, 3.0], 1), (600, [1.0, float("nan"), 1.0, 1.0], 0), (700, [float("inf")] * 4, 0)]
    rows += [(None, rows[0][1], 1), (800, [0.0] * 4, 1), (900, [], 0), (901, [], 0), (902, [], 1), (1000, [1e30, 0.0, 0.0, 0.0], 0), (1100, [4e6, -3e6, 1e6, 5e6], 1), (1101, [4e6, -3e6, 1e6, 4e6], 1), (1102, [3e6, -3e6, 0.0, 1e6], 0)]
    rows += [(1200 + i, [0.5, 0.5, 0.25], i % 3) for i in range(30)]  # ties, another length
    assert run(spark, rows, block_rows=50) == brute(rows)


def test_one_label_and_empty_tables(spark):
    rows = [(i, [float(i % 5), 1.0], 3) for i in range(1, 220) if i % 7]
    assert run(spark, rows) == brute(rows) == []
    assert run(spark, []) == []


def test_intervals_hold_and_filter():
    rng = np.random.default_rng(1)
    ints = rng.integers(-300, 300, (2000, 64))
    index = Index.build(np.arange(2000), rng.integers(0, 5, 2000), np.arange(2000), ints)
    for q in ints[:50]:
        low, high = index.intervals(q, slice(0, 2000))
        score = index.ints @ q
        assert (low <= score).all() and (score <= high).all()
        assert (high - low).mean() < 2 * np.sqrt((q**2).sum()) * np.sqrt((ints**2).sum(1)).mean() * 0.75
