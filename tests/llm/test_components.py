"""Components of chains, stars, rings and random graphs against a plain search."""

import random

import pytest

from ticksmith.llm.common import components


def plain(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


CASES = {
    "none": [], "loop": [(3, 3)], "chain": [(k, k + 1) for k in range(40)], "long_chain": [(k * 7919 % 3001, (k + 1) * 7919 % 3001) for k in range(3000)], "star": [(0, k) for k in range(1, 30)], "hub_last": [(99, k) for k in range(30)],
    "ring": [(k, (k + 7) % 23) for k in range(23)], "twice": [(1, 2), (2, 1), (1, 2), (5, 4), (4, 6)],
    "random": [(random.Random(k).randrange(60), random.Random(k + 500).randrange(60)) for k in range(45)],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_components(spark, name):
    edges = [(a, b) for a, b in CASES[name]]
    got = components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect()
    want = plain([(a, b) for a, b in edges if a != b])
    assert {r["node"]: r["component"] for r in got} == want and len(got) == len(want)
