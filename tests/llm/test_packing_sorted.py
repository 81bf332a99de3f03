"""Documents stored by source: the windows of every lot and group meet the shares of the corpus."""

from collections import defaultdict

from tests.llm.conftest import prose
from tests.llm.test_packing import check, library  # noqa: F401
from ticksmith.llm import packing as pk
from ticksmith.llm.tokens import tokenizer_path


def test_sorted_by_source(spark, make_docs, library):  # noqa: F811
    rows = [(k, prose(k, 300), "a" if k < 60 else "b" if k < 90 else None) for k in range(100)]
    pieces = pk.pack(make_docs(rows).coalesce(1), tokenizer_path(), window_sequences=2, lot_tokens=30_000).collect()
    check(pieces, [(i, t) for i, t, _ in rows], library)
    total, full, by_seq = defaultdict(int), defaultdict(lambda: defaultdict(int)), defaultdict(int)
    for r in pieces:
        total[r["source"]] += r["length"]
        by_seq[r["sequence_id"]] += r["length"]
        full[r["sequence_id"] >> 20, (r["sequence_id"] & (1 << 20) - 1) // 2][r["source"]] += r["length"]
    every = sum(total.values())
    windows = [w for w in full.values() if sum(w.values()) == 2 * pk.SEQUENCE]
    assert len({s >> 20 for s in by_seq}) > 2 and len(windows) > 8
    for w in windows:
        assert all(abs(w[s] - 2 * pk.SEQUENCE * n / every) <= 3 for s, n in total.items())
