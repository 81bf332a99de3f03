"""Vectors against all pairs in double precision, recall at the threshold, odd rows."""

import numpy as np

from ticksmith.llm import embeddings as em

SCHEMA = "vec_id bigint, embedding array<float>, label int, node string, cell string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "x", "x") for i, v in vectors], SCHEMA)


def brute(ids, x):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    parent = list(range(len(ids)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a, b in zip(*np.nonzero(np.triu(near))):
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: (int(near[k].sum()), ids[root(k)]) for k, i in enumerate(ids)}


def test_recall_at_the_threshold(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 32))
    # partners at cosines just above the threshold, the hardest case for cells
    noise = rng.normal(size=x.shape)
    noise -= x * ((noise * x).sum(1) / (x * x).sum(1))[:, None]
    cos = rng.uniform(0.901, 0.93, len(x))[:, None]
    y = cos * x / np.linalg.norm(x, axis=1, keepdims=True) + np.sqrt(1 - cos**2) * noise / np.linalg.norm(noise, axis=1, keepdims=True)
    every = np.concatenate([x, y]).astype(np.float32).astype(float)
    want = brute(list(range(600)), every)
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in em.near_vectors(frame(spark, enumerate(every)), cell=20).collect()}
    links = sum(n for n, _ in want.values())
    assert sum(n for n, _ in got.values()) >= 0.95 * links and all(got[i][0] <= want[i][0] for i in want)


def test_copies_groups_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(em, "BLOCK", 16)
    rng = np.random.default_rng(4)
    centre = rng.normal(size=(5, 16))
    x = np.concatenate([centre[k % 5][None] + 0.03 * rng.normal(size=(1, 16)) for k in range(120)] + [centre[:1]] * 30).astype(np.float32).astype(float)
    rows = list(enumerate(x))
    odd = [(500, None), (501, []), (502, [0.0] * 16), (503, [float("nan")] + [1.0] * 15), (504, [None] + [1.0] * 15), (505, [float("inf")] * 16), (506, [1.0, 2.0])]
    got = {r["vec_id"]: r for r in em.near_vectors(frame(spark, rows + odd), cell=10).collect()}
    assert {i: (r["n_links"], r["component_id"]) for i, r in got.items() if i < 500} == brute(list(range(150)), x)
    assert all((got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True) for i, _ in odd)
    empty = em.near_vectors(frame(spark, []))
    assert empty.count() == 0 and empty.columns == ["vec_id", "n_links", "component_id", "kept"]
    nulls = em.near_vectors(frame(spark, [(None, [1.0, 0.0]), (3, [1.0, 0.0])])).collect()
    assert sorted((r["vec_id"] or 0, r["n_links"], r["kept"]) for r in nulls) == [(0, 1, True), (3, 1, True)]
