"""Content-defined chunks: the rolling hash, resistance to shifts, long passages found, clean texts left alone."""

import numpy as np

from tests.llm.conftest import prose
from ticksmith.llm import substrings as ss


def test_gear_hash_and_cuts():
    gear = ss.gear_table()
    data = np.frombuffer(prose(1, 200).encode(), np.uint8)
    h = ss.gear_hashes(data, gear)
    for i in (0, 5, 31, 32, 400):
        plain = sum(int(gear[data[i - j]]) << j for j in range(min(32, i + 1))) % (1 << 32)
        assert int(h[i]) == plain
    ends = ss.cuts(data.tobytes(), gear)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(data) and sizes.max() <= ss.MAX_CHUNK and sizes[:-1].min() >= ss.MIN_CHUNK
    assert ss.cuts(b"x" * 1000, gear)[-1] == 1000 and ss.cuts(b"ab", gear) == [2]


def test_chunks_resist_insertions():
    gear, text = ss.gear_table(), prose(2, 1000).encode()

    def chunks(t):
        e = ss.cuts(t, gear)
        return {t[a:b] for a, b in zip([0, *e], e)}

    shifted = b"inserted " + text[:2000] + b" more " + text[2000:]
    assert len(chunks(text) - chunks(shifted)) <= 12


def test_passages(spark, make_docs):
    # words that don't recur by chance
    def own(seed, n):
        rng = np.random.default_rng(seed)
        return " ".join("".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 9))) for _ in range(n))

    rows, planted = [], set()
    for k in range(40):
        passage = own(1000 + k, 52)
        for c in range(3):
            i = 10 * k + c
            rows.append((i, own(20_000 + 3 * i, 30 + c) + " " + passage + " " + own(20_001 + 3 * i, 25), "s"))
            planted.add(i)
    rows += [(5000 + k, own(9000 + k, 150), "s") for k in range(60)]
    inner = own(77, 40)
    rows.append((6000, inner + " " + inner, "s"))
    got = ss.repeated_passages(make_docs(rows)).collect()
    assert {r["doc_id"] for r in got} == planted
    text = {i: t.encode() for i, t, _ in rows}
    dropped = dict.fromkeys(planted, 0)
    for r in got:
        first = 10 * (r["doc_id"] // 10)
        assert first <= r["first_doc_id"] <= r["doc_id"]
        if r["kept"]:
            assert r["first_doc_id"] == r["doc_id"]
        else:
            dropped[r["doc_id"]] += r["end"] - r["start"]
            # but for a few bytes that follow it alike by chance
            assert text[r["doc_id"]][r["start"] + 8 : r["end"] - 8] in own(1000 + r["doc_id"] // 10, 52).encode()
    # nearly all of a repeated passage (about 280 bytes) is found in each copy but the first
    assert all((n == 0) if i % 10 == 0 else n >= 150 for i, n in dropped.items())


def test_odd_rows(spark, make_docs, odd_docs):
    got = ss.repeated_passages(odd_docs).collect()
    assert {r["doc_id"] for r in got} == {6, 7, 8}
    assert sum(r["kept"] for r in got if r["doc_id"] == 6) == len([r for r in got if r["doc_id"] == 6])
    assert not any(r["kept"] for r in got if r["doc_id"] != 6)
    assert ss.repeated_passages(make_docs([])).count() == 0
    nulls = make_docs([(None, prose(5, 60), "s"), (3, prose(5, 60), "s")])
    assert {(r["doc_id"], r["kept"]) for r in ss.repeated_passages(nulls).collect()} == {(3, True), (None, False)}
