"""MinHash against all pairs of full sets, and a group whose members aren't all alike."""

from collections import Counter

from tests.llm.conftest import edited, prose
from ticksmith.llm import minhash as mh


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def test_against_all_pairs(spark, make_docs):
    base = prose(11, 110)
    rows = [(k, edited(base, *sorted({(k * 7) % 20 + 2, (k * 13) % 20 + 2, (k * 3) % 20 + 1})), "s") for k in range(2, 60)]
    rows += [(100 + k, prose(50 + k, 30 + 5 * k), "s") for k in range(20)]
    rows += [(200, "short text", "s"), (201, "Short  TEXT", "s"), (202, "short", "s"), (203, None, "s")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in mh.near_duplicates(make_docs(rows)).collect()}
    assert got == brute([(i, t) for i, t, _ in rows])


def test_odd_rows(spark, make_docs, odd_docs, odd_rows):
    out = mh.near_duplicates(odd_docs).collect()
    assert len(out) == len(odd_rows)
    got = {r["doc_id"]: r for r in out}
    assert got[1]["n_shingles"] == got[2]["n_shingles"] == got[3]["n_shingles"] == 0
    assert all(got[i]["component_id"] == i and got[i]["kept"] for i in (1, 2, 3, 4, 5, 9))
    assert {got[i]["component_id"] for i in (6, 7, 8)} == {6}
    assert got[14]["component_id"] == 13
    assert got[None]["component_id"] is None and got[None]["kept"]
    kept = mh.keep_one_per_group(odd_docs)
    assert kept.columns == odd_docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(i for i in got if i not in (7, 8, 14))
    assert mh.near_duplicates(make_docs([])).count() == 0


def test_blocks_find_the_links_that_a_plain_comparison_finds(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(mh, "BLOCK", 4)
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(15)]
    rows = [(bytes([k]) * 16, s.tobytes()) for k, s in enumerate(sets)]
    frame = spark.createDataFrame(rows, "node binary, shingles binary")
    members = spark.createDataFrame([(b, n, n) for b in (1, 2) for n, _ in rows], "bucket bigint, node binary, comp binary")
    links = [tuple(sorted((bytes(r["a"])[0], bytes(r["b"])[0]))) for r in mh.links_within(members, frame, 50).collect()]

    def groups(pairs):
        parent = list(range(15))

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            parent[max(root(a), root(b))] = min(root(a), root(b))
        return [root(k) for k in range(15)]

    every = [(a, b) for a in range(15) for b in range(a + 1, 15) if mh.similar(rows[a][1], rows[b][1], 50)]
    assert groups(links) == groups(every) and len(set(groups(every))) > 1
    assert mh.common_counts(sets[:3], sets[3:5]).tolist() == [[len(np.intersect1d(a, b)) for b in sets[3:5]] for a in sets[:3]]


def test_rows_are_judged_by_id_and_text(spark, make_docs):
    """Repeated ids lose no unique text; exact copies, repeated rows included, stay once."""
    t, other, third = prose(71, 60), prose(72, 60), prose(73, 60)

    def kept(rows):
        return sorted(((r["doc_id"], r["text"]) for r in mh.keep_one_per_group(make_docs([(i, x, "s") for i, x in rows])).collect()), key=str)

    assert kept([(1, t), (2, t), (2, other)]) == sorted([(1, t), (2, other)], key=str)
    assert kept([(1, t), (1, t), (2, t)]) == [(1, t)]
    assert kept([(None, t), (3, t), (None, third)]) == sorted([(3, t), (None, third)], key=str)
    assert kept([(1, t), (1, edited(t, 30)), (1, edited(t, 40)), (5, None), (5, None), (6, ""), (7, other)]) == sorted(
        [r for r in [(1, t), (1, edited(t, 30)), (1, edited(t, 40))] if r == kept([(1, t), (1, edited(t, 30)), (1, edited(t, 40))])[0]]
        + [(5, None), (5, None), (6, ""), (7, other)], key=str)
