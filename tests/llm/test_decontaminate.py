"""String tiling: reordered passages, ties, blocks of items, odd rows; coverage against a plain count."""

from collections import defaultdict

from tests.llm.conftest import prose
from ticksmith.llm import decontaminate as dc

SF = "/root/testdata/sf0.01"
BENCH = "item_id bigint, text string, tiles string"


def bench(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], BENCH)


def test_reordered_repeated_and_partial(spark, make_docs):
    item = " ".join(f"w{k}" for k in range(40))
    w = item.split()
    reordered = "intro " + " ".join(w[20:]) + " middle words here " + " ".join(w[:20]) + " end"
    docs = make_docs([
        (1, f"before {item.upper()} after", "s"), (2, reordered, "s"), (3, " ".join(w[:20]) + " other " * 50, "s"),
        (4, (item + " filler ") * 300, "s"), (5, prose(1, 300), "s"), (6, "two words", "s"), (7, "Two  WORDS", "s"),
    ])
    items = bench(spark, [(10, item), (11, "two words"), (12, ""), (13, None), (10, item)])
    got = defaultdict(list)
    for r in dc.contaminated(docs, items, block_words=10).collect():
        got[r["doc_id"]].append((r["item_id"], r["covered_words"], [tuple(t) for t in r["tiles"]]))
    assert set(got) == {1, 2, 4, 6, 7}
    assert got[1] == [(10, 40, [(1, 0, 40)])] * 2
    assert got[2][0] == (10, 40, [(1, 20, 20), (24, 0, 20)])
    assert got[4][0][1] == 40 and [i for i, *_ in got[6]] == [11] == [i for i, *_ in got[7]]
    left = dc.without_benchmark(docs, items)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [3, 5]


def test_given_tables_against_counted_coverage(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r["doc_id"], r["item_id"]) for r in dc.contaminated(docs, items, block_words=500).collect()}
    tokens = {r["item_id"]: r["text"].encode().lower().split() for r in items.collect()}
    seeds = defaultdict(set)
    for i, w in tokens.items():
        for k in range(len(w) - 4):
            seeds[tuple(w[k : k + 5])].add((i, k))
    want = set()
    for r in docs.collect():
        w, covered = r["text"].encode().lower().split(), defaultdict(set)
        for k in range(len(w) - 4):
            for i, at in seeds.get(tuple(w[k : k + 5]), ()):
                covered[i].update(range(at, at + 5))
        want |= {(r["doc_id"], i) for i, c in covered.items() if len(c) >= 0.75 * len(tokens[i])}
    assert got == want and want


def test_repetitive_words_stay_linear():
    import numpy as np

    from ticksmith.llm.common import word_hashes

    block = dc.Items([(1, b"a " * 60)])
    ((_, tiles, covered),) = block.matches(b"a " * 50_000, word_hashes())
    assert covered == 60 and len(tiles) == 1
    assert dc.free_parts(np.array([True, False, False, True, False])) == [(1, 2), (4, 1)]


def test_odd_rows(spark, make_docs, odd_docs, odd_rows):
    assert dc.contaminated(odd_docs, bench(spark, [])).count() == 0
    assert dc.contaminated(make_docs([]), bench(spark, [(1, "a b c d e f")])).count() == 0
    hits = dc.contaminated(odd_docs, bench(spark, [(1, "a text without an id of its own here"), (None, odd_rows[5][1])])).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"] or 0) for r in hits) == [(0, 1), (6, 0), (7, 0), (7, 0), (8, 0)]
    assert dc.without_benchmark(odd_docs, bench(spark, [(1, "a text without an id of its own here")])).where("doc_id is null").count() == 0
