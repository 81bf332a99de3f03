"""Directly addressable codes: round trips against the library, random access, odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ticksmith.llm.codes import END_ID, Codes, WordTokens, image, read_documents, tokens_at, write_codes
from ticksmith.llm.queries import op13_direct_codes
from ticksmith.llm.tokens import tokenizer_path

ODD = [*"abzABZéÉßİıΣσς 019 \t\n\r\x0b\x0c\x1c\x85\xa0 　.,!'<|>́̈日本🙂ǅﬁ가ᄀ", "'s", "'re", " the", "<|endoftext|>", "<|ENDOFTEXT|>"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids + [END_ID]


def expected(rows, library):
    out, start = [], 0
    for doc_id, text in rows:
        ids = library(text)
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("widths", [(8, 8, 16), (16, 16), (32,), (8, 8, 8, 8)])
def test_every_place_is_addressable(widths):
    rng = random.Random(3)
    for n in (0, 1, 511, 512, 513, 3000):
        ids = np.array([rng.choice([0, 255, 256, 65535, 65536, 2**32 - 1, rng.randrange(49408)]) for _ in range(n)], np.uint32)
        codes = Codes(image(ids, widths))
        assert (codes.all() == ids).all()
        assert (codes.take(np.arange(n)) == ids).all()
        with pytest.raises(IndexError):
            codes.take([n])


def test_words_give_the_ids_of_whole_texts(library):
    words, rng = WordTokens(tokenizer_path("word_bpe_49k.json")), random.Random(9)
    for _ in range(40):
        texts = ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 40))) for _ in range(30)] + [None, "", "x" * 5000]
        flat, counts = words.ids(pa.array(texts))
        ends = np.cumsum(counts)
        for t, a, b in zip(texts, ends - counts, ends):
            assert [*flat[a:b].tolist(), END_ID] == library(t)


def test_documents_read_back(spark, odd_docs, odd_rows, library):
    rows = [(i, t) for i, t, _ in odd_rows]
    store = write_codes(odd_docs, tokenizer_path("word_bpe_49k.json"), segment_ids=500)
    got = sorted(map(tuple, read_documents(spark, store).collect()), key=lambda r: r[1])
    # rows of one id are equal here, so their order doesn't show
    assert got == expected(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), library)
    assert spark.read.parquet(store).count() > 3


def test_single_tokens(spark, odd_docs, odd_rows, library):
    texts = {i: t for i, t, _ in odd_rows if i is not None}
    store = write_codes(odd_docs.where("doc_id <> 7"), tokenizer_path("word_bpe_49k.json"), segment_ids=500)
    ids = {i: library(t) for i, t in texts.items() if i != 7}
    asked = [(i, k) for i in ids for k in (0, len(ids[i]) // 2, len(ids[i]) - 1, len(ids[i]), -1)] + [(99, 0), (9, 0)]
    got = {(r.doc_id, r.k): r.token for r in tokens_at(spark, store, spark.createDataFrame(asked, "doc_id long, k long")).collect()}
    assert got == {(i, k): ids[i][k] for i, k in asked if i in ids and 0 <= k < len(ids[i])}


def test_empty_table(spark, odd_docs):
    store = write_codes(odd_docs.limit(0), tokenizer_path("word_bpe_49k.json"))
    assert read_documents(spark, store).collect() == []


def test_query_over_the_given_table(spark, library):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    df = op13_direct_codes(spark, sf)
    assert df.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, df.collect())) == expected(map(tuple, rows), library)
