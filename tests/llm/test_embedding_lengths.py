"""A table with vectors of two lengths: each length against all its pairs."""

import numpy as np

from tests.llm.test_embeddings import brute, frame
from ticksmith.llm import embeddings as em


def test_two_lengths(spark):
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for width, first, n in ((16, 0, 90), (24, 1000, 60), (5, 2000, 6)):
        centre = rng.normal(size=(6, width))
        x = np.array([centre[k % 6] + 0.02 * rng.normal(size=width) for k in range(n)]).astype(np.float32).astype(float)
        ids = list(range(first, first + n))
        rows += zip(ids, x)
        want |= brute(ids, x)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in em.near_vectors(frame(spark, rows), cell=10).collect()}
    assert got == want and sum(n for n, _ in got.values()) > 1000
