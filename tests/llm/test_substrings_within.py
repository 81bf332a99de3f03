"""Passages repeated only inside one text, as the registered query reports them."""

import random

import numpy as np

from ticksmith.llm import substrings as ss
from ticksmith.llm.queries import QUERIES


def test_repeated_inside_one_text(spark, make_docs, tmp_path):
    def own(seed, n):
        rng = np.random.default_rng(seed)
        return " ".join("".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 9))) for _ in range(n))

    inner = own(77, 60)
    text = " ".join([inner, own(78, 40), inner, own(79, 40), inner])
    docs = make_docs([(1, text, "s"), (2, own(80, 200), "s")])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op6_chunked_substring_dedup"](spark, str(tmp_path)).collect()
    assert {(r["doc_id"], r["first_doc_id"]) for r in got} == {(1, 1)}
    kept = [r for r in got if r["kept"]]
    gone = sorted((r["start"], r["end"]) for r in got if not r["kept"])
    assert len(kept) == 1 and kept[0]["end"] <= len(inner) + 8 and len(gone) == 2
    for (a, b), at in zip(gone, (text.index(inner, 1), text.rindex(inner))):
        assert b - a >= 200 and at <= a and b <= at + len(inner) + 8
        assert text[a + 8 : b - 8] in inner
    assert ss.repeated_passages(docs).count() == 0


def plain(rows, least=128):
    """The passages by plain loops over the chunks of all texts; texts in order of their ids, null last."""
    from collections import defaultdict

    gear, places, chunks = ss.gear_table(), defaultdict(list), {}
    ordered = sorted(enumerate(rows), key=lambda r: (r[1][0] is None, r[1][0] or 0, r[0]))
    for n, (_, (doc_id, text)) in enumerate(ordered):
        data = (text or "").encode()
        ends = ss.cuts(data, gear) if data else []
        chunks[n] = [(a, b, data[a:b]) for a, b in zip([0, *ends], ends)]
        for k, (_, _, c) in enumerate(chunks[n]):
            places[c].append((n, k))
    out = []
    for n, (_, (doc_id, _)) in enumerate(ordered):
        run = []
        for k, (a, b, c) in enumerate([*chunks[n], (0, 0, None)]):
            if c is not None and len(places[c]) > 1:
                run.append((a, b, places[c][0] == (n, k), ordered[places[c][0][0]][1][0]))
                continue
            if sum(b - a for a, b, *_ in run) >= least:
                part = []
                for x in [*run, (0, 0, None, None)]:
                    if part and x[2] != part[-1][2]:
                        firsts = [p[3] for p in part if p[3] is not None]
                        out.append((doc_id, part[0][0], part[-1][1], part[0][2], min(firsts, default=None)))
                        part = []
                    part.append(x)
            run = []
    return sorted(out, key=str)


def test_equals_plain_loops(spark, make_docs):
    """Random texts with shared, repeated and shifted parts; null and empty texts; repeated rows."""
    rng = random.Random(8)
    parts = ["".join(rng.choice("abcdefghij ") for _ in range(rng.randint(40, 600))) for _ in range(25)]
    rows = [(k, "".join(rng.choice(parts)[rng.choice((0, 0, 7)) :] for _ in range(rng.randint(1, 6)))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, rows[0][1]), (102, rows[0][1]), (None, rows[3][1]), (103, "ü" * 900)]
    got = ss.repeated_passages(make_docs([(i, t, "s") for i, t in rows]).coalesce(1), within=True).collect()
    assert sorted(((r["doc_id"], r["start"], r["end"], r["kept"], r["first_doc_id"]) for r in got), key=str) == plain(rows)
