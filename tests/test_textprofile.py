"""Text profiles: character facts, block rule, both R9/R10 paths, R8 folding, URL cases."""

import random

import pytest
from pyspark.sql import functions as F

from ticksmith.operators import textprofile as tp
from ticksmith.operators.urls import normalise_urls

SF = "/root/testdata/sf0.001"


def test_char_facts():
    e = dict(zip([c.split(" ")[0] for c in tp.CHAR_DDL.split(", ")], tp.char_facts("é", "Latin-1 Supplement")))
    assert e["is_alpha"] and e["accentuated"] and e["latin"] and e["base_ch"] == "e" and not e["punct"]
    d = dict(zip([c.split(" ")[0] for c in tp.CHAR_DDL.split(", ")], tp.char_facts("$", "Basic Latin")))
    assert d["sym"] and not d["punct"] and not d["latin"]
    c = dict(zip([c.split(" ")[0] for c in tp.CHAR_DDL.split(", ")], tp.char_facts(",", "Basic Latin")))
    assert c["punct"] and c["safe_ascii"]
    n = dict(zip([c.split(" ")[0] for c in tp.CHAR_DDL.split(", ")], tp.char_facts("\n", "Control character")))
    assert not n["is_printable"] and not n["unprintable"] and n["is_space"]


def test_blocks(spark):
    blocks = tp.unicode_blocks(spark)
    names = {b[2] for b in blocks}
    assert (0, 31, "Control character") in blocks and (32, 127, "Basic Latin") in blocks
    assert {"Latin-1 Supplement", "Emoticons", "CJK Unified Ideographs", "Hiragana"} <= names
    assert all(a[1] < b[0] for a, b in zip(blocks, blocks[1:]))
    assert {"Latin Extended-A", "Arabic Presentation Forms-A", "CJK Unified Ideographs Extension A",
            "Miscellaneous Mathematical Symbols-B", "Latin Extended Additional"} <= names
    assert len(blocks) == len(names) == 347  # 346 blocks, and the control characters apart
    assert {"Greek and Coptic", "Superscripts and Subscripts", "CJK Symbols and Punctuation", "Linear A", "Phags-pa", "NKo",
            "Symbols for Legacy Computing", "CJK Unified Ideographs Extension J", "Beria Erfe"} <= names
    assert not names & {"Greek", "Linear-A", "Cyrillic Supplementary", "Combining Marks for Symbols", "Sutton Signwriting"}


def test_block_lookup(spark):
    table = tp.BlockTable(tp.unicode_blocks(spark))
    at = {0: "Control character", 31: "Control character", 32: "Basic Latin", 0x370: "Greek and Coptic", 0x3FF: "Greek and Coptic",
          0x400: "Cyrillic", 0x2070: "Superscripts and Subscripts", 0x2FE0: None, 71503: "Ahom", 78943: "Egyptian Hieroglyph Format Controls",
          101759: "Tangut Supplement", 101760: "Tangut Components Supplement", 0x10FFFF: "Supplementary Private Use Area-B", 0x2FFFF: None}
    assert {cp: table[cp] for cp in at} == at


PAIRS = [("Basic Latin", "Latin-1 Supplement"), ("Basic Latin", "Cyrillic"), ("Hiragana", "Katakana"),
         ("CJK Unified Ideographs", "Hiragana"), ("Emoticons", "Cyrillic"), ("Cyrillic", "Cyrillic Supplement"),
         ("Greek and Coptic", "Cyrillic"), (None, "Basic Latin"), ("Hangul Syllables", "Basic Latin"),
         ("CJK Symbols and Punctuation", "Arabic"), ("Latin Extended-A", "Arabic Presentation Forms-A"),
         ("Greek and Coptic", "Superscripts and Subscripts")]


EXPECTED = [False, True, False, False, False, False, True, True, False, False, True, False]


def test_suspicious_rule(spark):
    df = spark.createDataFrame(PAIRS, "a string, b string")
    got = [r[0] for r in df.select(tp.suspicious_pair(F.col("a"), F.col("b"))).collect()]
    assert got == EXPECTED
    flagged = tp.suspicious_block_pairs(spark, ["Basic Latin", "Cyrillic", None])
    assert ("Basic Latin", "Cyrillic") in flagged and ("Basic Latin", "Basic Latin") not in flagged
    assert (None, "Basic Latin") in flagged
    kindred = tp.kindred_blocks(spark)
    assert "Superscripts and Subscripts" in kindred["Greek and Coptic"] and "Cyrillic" not in kindred["Basic Latin"]


def test_neighbours_in_blocks_that_share_a_word(spark):
    """Greek letters beside superscripts are no jump; beside Cyrillic ones they are."""
    docs = spark.createDataFrame([(1, "αⁱ" * 10), (2, "αж" * 10)], "doc_id int, text string")
    got = {r["doc_id"]: r["range_ratio"] for r in tp.noise_neighbours(spark, docs).collect()}
    assert got == {1: 0.0, 2: pytest.approx(19 * 2 / 20)}


def test_layers_of_a_long_text(spark):
    """Counts of pieces meet before ranking; layers go by first appearance; letters in no block are left out."""
    text = "bБa" * 6000 + "\U0002fffdЁéé"
    rows = tp.letter_ranks(spark, spark.createDataFrame([(1, text), (2, ""), (3, None)], "doc_id int, text string")).collect()
    got = sorted((r["layer"], r["rank"], r["ch"], r["n"], r["first_pos"]) for r in rows)
    assert got == [("Basic Latin", 0, "b", 6000, 0), ("Basic Latin", 1, "a", 6000, 2), ("Basic Latin", 2, "é", 2, 18_002),
                   ("Cyrillic", 0, "б", 6000, 1), ("Cyrillic", 1, "ё", 1, 18_001)]


def test_many_languages_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(tp, "LANGUAGES_PER_BLOCK", 2)
    text = "the quick brown fox jumps over the lazy dog again and again and once more "
    docs = spark.createDataFrame([(k, text * 3, f"l{k}") for k in range(7)] + [(9, "тот же текст " * 9, None)], "doc_id int, text string, lang string")
    prof = tp.CorpusProfile(spark, docs)
    assert prof.profiles.count() > 2
    got = prof.candidates().groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in got} == {k: 14 for k in range(7)}
    ratios = {r["ratio"] for r in prof.coherence().collect()}
    assert len(ratios) == 1 and min(ratios) > 0.8


def _approved_plainly(common, size, letters):
    """The rule with each letter held against all others."""
    n_ok = 0
    for r, lr in common:
        gap = abs(int(r * (size / letters)) - lr)
        before = sum(o_lr < lr and o_r < r for o_r, o_lr in common)
        after = sum(o_lr >= lr and o_r >= r for o_r, o_lr in common)
        if size <= 26 and gap > 4:
            continue
        n_ok += (size > 26 and gap < size / 3 or lr == 0 and before <= 4 or lr > 0 and before / lr >= 0.4 or after / (size - lr) >= 0.4)
    return n_ok


def test_approved_letters_against_plain_loops():
    rng = random.Random(7)
    for size in (1, 5, 26, 27, 60) * 40:
        letters = rng.randint(1, 80)
        k = rng.randint(1, min(size, letters))
        common = list(zip(sorted(rng.sample(range(letters), k)), rng.sample(range(size), k)))
        assert tp.approved_letters(common, size, letters) == _approved_plainly(common, size, letters)
    assert tp.approved_letters([], 5, 40) == 0


def test_approved_letters_of_a_wide_alphabet_are_not_held_against_all_others():
    seen = [0]

    class Rank(int):
        def __lt__(self, other):
            seen[0] += 1
            return int(self) < int(other)

    k = 4000
    ranks = range(k)[::-1]
    got = tp.approved_letters([(r, Rank(lr)) for r, lr in enumerate(ranks)], k, k)
    assert 0 < got < k and seen[0] < 4 * k * k.bit_length()
    assert got == _approved_plainly(list(enumerate(ranks)), k, k)


def test_letters_of_a_language_are_summed_where_the_text_is_read(spark):
    """A row per language and letter of a batch, not of each chunk; letters in no block and texts of no language are left out."""
    docs = spark.range(200, numPartitions=1).selectExpr("id as doc_id", "repeat('aÀé\U0002fffd1 ', 20) as text", "if(id % 4 = 3, null, concat('l', id % 2)) as lang")
    letters = tp.language_letters(spark, docs)
    want = [("l0", "a", 2000, False), ("l0", "à", 2000, True), ("l0", "é", 2000, True), ("l1", "a", 1000, False), ("l1", "à", 1000, True), ("l1", "é", 1000, True)]
    assert sorted(tuple(r) for r in letters.collect()) == want
    got = {r["language"]: (r["alphabet"], r["has_accents"]) for r in tp.learn_profiles(letters).collect()}
    assert got == dict.fromkeys(["l0", "l0—", "l1", "l1—"], (["a", "à", "é"], True))
    assert tp.language_letters(spark, docs.drop("lang")).count() == 0


def test_long_alphabets_make_smaller_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "".join(chr(0x4E00 + 300 * k + i % 300) for i in range(900)), f"l{k}") for k in range(4)], "doc_id int, text string, lang string")

    def found():
        prof = tp.CorpusProfile(spark, docs)
        return prof.profiles.agg(F.max("blocks")).first()[0], _rows(prof.candidates()), _rows(prof.coherence())

    whole = found()
    monkeypatch.setattr(tp, "LETTERS_PER_BLOCK", 600)
    cut = found()
    assert (whole[0], cut[0]) == (1, 4) and cut[1:] == whole[1:] and len(whole[1]) == 8


@pytest.fixture(scope="module")
def corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    extra = spark.createDataFrame(
        [(10_001, "ÉÉ éé ÀÀ ee $$ %%! ab\u0001cd Привет мир hello, world ++ ÉÊ ÊÉ abПривет", "fr"),
         (10_002, "", "en")], "doc_id bigint, text string, lang string")
    docs = docs.unionByName(extra)
    return docs, tp.char_table(spark, docs).cache()


def _rows(df):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect())


def test_noise_of_special_characters(spark, corpus):
    docs, facts = corpus
    special = [r for r in _rows(tp.noise_neighbours(spark, docs, facts)) if r[0] == 10_001][0]
    assert special[2] > 0 and special[3] > 0  # Latin/Cyrillic jumps, accent pairs


def test_noise_with_a_large_alphabet_and_a_long_text(spark):
    """30,000 distinct characters and 100,000 characters in one text, against a plain loop."""
    wide = "".join(chr(c) for c in range(0x4E00, 0x4E00 + 20_000)) + "".join(chr(c) for c in range(0xAC00, 0xAC00 + 10_000))
    long = "Éé, à b! " * 12_000
    docs = spark.createDataFrame([(1, wide), (2, long), (3, None)], "doc_id int, text string")
    got = {r[0]: r for r in tp.noise_counts(spark, docs).collect()}
    for i, text in ((1, wide), (2, long)):
        letters = [c for c in text if c.isalpha()]
        accented = [c for c in letters if any(k in tp.unicodedata.name(c, "") for k in tp.ACCENT_KEYWORDS)]
        share = len(accented) / len(letters)
        assert got[i]["accent_ratio"] == pytest.approx(share if share >= 0.35 else 0.0)
    assert got[3]["accent_ratio"] == 0.0
    ranks = tp.letter_ranks(spark, docs.where("doc_id = 2"))
    assert {r["ch"]: r["n"] for r in ranks.collect()} == {"é": 24_000, "à": 12_000, "b": 12_000}


def test_lang_best_folds_only_with_duplicates(spark):
    m = spark.createDataFrame([(1, 0, "fr", 0.5), (1, 0, "fr—", 0.9), (2, 0, "en", 0.7), (2, 0, "de", 0.2)],
                              "doc_id int, chunk int, language string, ratio double")
    got = sorted(tuple(r) for r in tp.lang_best(m).collect())
    assert got == [(1, 0, "fr", 0.9), (2, 0, "de", 0.2), (2, 0, "en", 0.7)]


def test_lang_best_reads_the_ratios_once(spark):
    ratios = spark.range(40).selectExpr("id % 7 as doc_id", "0 as chunk", "concat('l', id % 5, if(id % 3 = 0, '—', '')) as language", "id / 40D as ratio")
    for folded in (tp.lang_best(ratios), tp.lang_merge(tp.lang_best(ratios))):
        plan = folded._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Range (") == 1 and "Join" not in plan and "Union" not in plan


def test_lang_best_without_repeated_names_keeps_them(spark):
    m = spark.createDataFrame([(1, 0, "fr—", 0.5), (1, 0, "de", 0.9), (1, 1, "fr", 0.2), (1, 1, "fr", 0.4), (None, 0, "fr", 0.9)],
                              "doc_id int, chunk int, language string, ratio double")
    got = sorted(tuple(r) for r in tp.lang_best(m).collect())
    assert got == [(1, 0, "de", 0.9), (1, 0, "fr—", 0.5), (1, 1, "fr", 0.4)]


def test_chunks_are_folded_before_they_are_averaged(spark):
    m = spark.createDataFrame([(1, 0, "a", "fr", 0.9), (1, 0, "b", "fr—", 0.2), (1, 1, "a", "fr", 0.2), (1, 1, "a", "fr—", 0.9)],
                              "doc_id int, chunk int, layer string, language string, ratio double")
    assert [tuple(r) for r in tp.lang_merge(tp.lang_best(m)).collect()] == [(1, "fr", 0.9)]


def test_round4_half_even(spark):
    df = spark.createDataFrame([(1, 32), (3, 32), (2, 3), (0, 5)], "a long, b long")
    got = [r[0] for r in df.select(tp.round4(F.col("a"), F.col("b"))).collect()]
    assert got == [0.0312, 0.0938, 0.6667, 0.0]


URLS = {
    "HTTP://Ex.COM/mail/": "http://ex.com/mail/",
    "google.com:80": "google.com:80",
    "/foo?bar": "/foo?bar",
    "http://h/a/./b/../c": "http://h/a/c",
    "http://h/%7e%c3%a9": "http://h/%7E%C3%A9",
    "http://h:/x": "http://h/x",
    "/överö.": "/%C3%B6ver%C3%B6.",
    "ftp://Host/a/../b": "ftp://Host/a/../b",
    "http://h/a/..": "http://h/",
}


HOSTS = {
    "http://[1:2]/": None, "http://[:::::]/": None, "http://[1::2::3]/": None,
    "http://[FE80::1%25EN0]/": "[fe80::1%EN0]", "http://[::1]:80/": "[::1]",
    "http://[1:2:3:4:5:6:1.2.3.4]/": "[1:2:3:4:5:6:1.2.3.4]", "http://[fe80::1%25]/": "[fe80::1%25]",
    "http://" + "H" * 100_000 + "/": "h" * 100_000,
}


def test_url_hosts(spark):
    df = spark.createDataFrame([(u,) for u in HOSTS], "url string")
    got = {r["url"]: (r["host"], r["parse_error"]) for r in normalise_urls(df).collect()}
    assert got == {u: (h, h is None) for u, h in HOSTS.items()}


def test_url_cases(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "i int, url string")
    got = {r["url"]: r["normalised_url"] for r in normalise_urls(df).collect()}
    assert got == URLS
    bad = spark.createDataFrame([(0, "http://h:99999/x"), (1, "%zz/x")], "i int, url string")
    assert [r["parse_error"] for r in normalise_urls(bad).orderBy("i").collect()] == [True, True]
