"""Packing round trip: every id in one piece, sequences gapless and unpadded, the mixture kept; odd rows."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import prose
from ticksmith.llm import packing as pk
from ticksmith.llm.tokens import tokenizer_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def ids_of(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, pk.END_ID], "<u4")


def check(pieces, docs, library):
    """docs: list of (doc_id, text); repeated rows are told apart by their pieces' order only, so compare sums."""
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_seq[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    for parts in by_seq.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at == pk.SEQUENCE or at & (at - 1) == 0 and at < pk.SEQUENCE
    texts = defaultdict(list)
    for i, t in docs:
        texts[i].append(t)
    assert set(by_doc) == set(texts)
    for i, parts in by_doc.items():
        ids = ids_of(library, texts[i][0])
        assert sorted((r["start"] for r in parts)) and sum(r["length"] for r in parts) == len(ids) * len(texts[i])
        for r in parts:
            assert r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
        if len(texts[i]) == 1:
            at = 0
            for r in sorted(parts, key=lambda r: r["start"]):
                assert r["start"] == at
                at += r["length"]


def test_round_trip_and_odd_rows(spark, make_docs, odd_docs, odd_rows, library):
    pieces = pk.pack(odd_docs, tokenizer_path(), lot_tokens=1500).collect()
    check(pieces, [(i, t) for i, t, _ in odd_rows], library)
    assert pk.pack(make_docs([]), tokenizer_path()).count() == 0


def test_words_are_encoded_as_the_library_does(library):
    import random

    rng = random.Random(3)
    letters = [*"ab'rel \n\t \x0bsdé1,.!🙂 <|", "<|endoftext|>", "\x00"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(1500)] + [prose(4, 300)]
    words = pk.WordIds(tokenizer_path())
    assert words.ranked is not None
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [a.tolist() for a in words.ids(pa.array(texts))] == want
    words.ranked = None
    words.others.clear()
    assert [a.tolist() for a in words.ids(pa.array(texts))] == want


def test_windows_keep_the_mixture():
    avail = np.array([60_000, 30_000, 10_000])
    share = avail / avail.sum()
    given = np.array(list(pk.fill_windows(avail, share, np.zeros(3), 1000)))
    assert (given.sum(axis=1) == 1000).all() and (given.sum(axis=0) == avail).all()
    assert np.abs(np.cumsum(given, axis=0) - np.outer(np.arange(1, 101) * 1000, share)).max() <= 2
    # a debt from earlier lots is paid first; an empty queue's turn goes to the others
    given = np.array(list(pk.fill_windows(np.array([5000, 5000]), np.array([0.5, 0.5]), np.array([400.0, -400.0]), 1000)))
    assert given[0].tolist() == [900, 100] and given.sum() == 10_000
    given = np.array(list(pk.fill_windows(np.array([500, 5000]), np.array([0.5, 0.5]), np.zeros(2), 1000)))
    assert (given.sum(axis=1)[:-1] == 1000).all() and given.sum(axis=0).tolist() == [500, 5000]


def test_sequences_of_the_rest():
    assert pk.sequence_lengths(4096, 2048) == [2048, 2048]
    assert pk.sequence_lengths(2048 + 1300, 2048) == [2048, 1024, 256, 16, 4]
    assert pk.sequence_lengths(0, 2048) == []
