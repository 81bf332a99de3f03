"""Character and language profiling of a text corpus.

The character-level checks of the HTTP stack's charset detector, re-aimed
as table jobs over ``documents``:

* R3  ``char_blocks``      characters per Unicode block, per document
* R4  ``char_rank``        letters per chunk/layer ranked by count, ties by first appearance
* R5  ``lang_candidates``  languages whose alphabet the chunk covers (share >= 0.2)
* R6  ``lang_coherence``   how well the chunk's letter ranking fits each candidate
* R7  ``lang_merge``       mean coherence per document over its chunks
* R8  ``lang_best``        best of a language's alternative profiles
* R9  ``noise_counts``     order-free noise ratios (accents, unprintables)
* R10 ``noise_neighbours`` neighbour-based noise ratios (symbols, block jumps, accents)

Design (Spark-first):
* a text becomes letter counts, layers and ranks inside the row it came in
  (``mapInArrow`` over pieces of bounded length; facts of a character are
  remembered per worker), so the language checks on chunks need no exchange
  and keep nothing of the corpus's size; whole documents (R4) take one, by
  document, for the partial counts of their pieces;
* the Unicode block of a code point is found by bisection in one sorted table
  of intervals; which blocks may stand side by side is decided once per pair
  of names by the column rule ``suspicious_pair``;
* language profiles are learned from the corpus itself (documents with a
  known ``lang``), not copied from frequency tables; their letters are summed
  where the text is read, so a batch of pieces leaves a row per language and letter;
* a language's alphabet is one array in rank order, which meets a layer's
  letters in the row: no row per letter and language, no pair rows; ranks are
  compared by bisection in a sorted list, not each with all others.
  Profiles are stored, so Spark broadcasts them only below its threshold;
* R9 and R10 are regexes over the whole text with classes made of ranges
  of the corpus's characters, whose facts are computed once per distinct
  character.
Texts are processed whole; the detector's early stop is not reproduced.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticksmith.functions.columns import fence

# --- fixed values ---------------------------------------------------------------
ACCENT_KEYWORDS = ("WITH GRAVE", "WITH ACUTE", "WITH CEDILLA", "WITH DIAERESIS", "WITH CIRCUMFLEX",
                   "WITH TILDE", "WITH MACRON", "WITH RING ABOVE")
SECONDARY_RANGE_KEYWORDS = ["Supplement", "Extended", "Extensions", "Modifier", "Marks", "Punctuation",
                            "Symbols", "Forms", "Operators", "Miscellaneous", "Drawing", "Block", "Shapes",
                            "Supplemental", "Tags"]
COMMON_SAFE_ASCII = {"<", ">", "=", ":", "/", "&", ";", "{", "}", "[", "]", ",", "|", '"', "-", "(", ")"}
CONTROL_BLOCK = "Control character"   # code points 0-31 get this name
TOO_SMALL_SEQUENCE = 32               # layers of at most this many letters are skipped
MIN_CANDIDATE_SHARE = 0.2             # alphabet share for a candidate language
COHERENCE_THRESHOLD = 0.1             # coherence ratios below are dropped
CHUNK_CHARS = 8192                    # default chunk of the language checks (R5-R8), an argument of CorpusProfile
PROFILE_SHARE = 1000                  # a language's alphabet: its letters with at least 1/1000 of its text
ALT_PROFILE_SHARE = 10_000            # the alternative ("—") profile: at least 1/10000

ARROW_ROWS = 500                      # pieces of text that go to a Python worker at once
LANGUAGES_PER_BLOCK = 64              # language profiles that are compared with a layer in one row
LETTERS_PER_BLOCK = 8192              # and the letters that they have together, about

_BLOCK_CACHE: dict[str, list[tuple[int, int, str]]] = {}


def round4(num: Column, den: Column) -> Column:
    """``num / den`` (non-negative integers) rounded to 4 decimals, half to
    even, computed exactly with integer arithmetic so the result does not
    depend on floating-point summation order."""
    scaled = num.cast("long") * 10000
    d = den.cast("long")
    rem = scaled % d
    k = ((scaled - rem) / d).cast("long")
    up = F.when(rem * 2 > d, 1).when(rem * 2 < d, 0).otherwise(k % 2)
    return F.when(d > 0, (k + up) / F.lit(10000.0))


# --- Unicode blocks (from the JDK) ----------------------------------------------------

# Blocks that the rule below spells otherwise, and those younger than Unicode 13 (Java 17);
# first code point, last code point, official name.
OFFICIAL_BLOCKS = [
    (880, 1023, "Greek and Coptic"),
    (1280, 1327, "Cyrillic Supplement"),
    (1984, 2047, "NKo"),
    (2160, 2207, "Arabic Extended-B"),
    (8400, 8447, "Combining Diacritical Marks for Symbols"),
    (43072, 43135, "Phags-pa"),
    (66928, 67007, "Vithkuqi"),
    (67008, 67071, "Todhri"),
    (67072, 67455, "Linear A"),
    (67456, 67519, "Latin Extended-F"),
    (67904, 67935, "Sidetic"),
    (68928, 69007, "Garay"),
    (69312, 69375, "Arabic Extended-C"),
    (69488, 69551, "Old Uyghur"),
    (70528, 70655, "Tulu-Tigalari"),
    (71376, 71423, "Myanmar Extended-C"),
    (71424, 71503, "Ahom"),
    (72368, 72383, "Unified Canadian Aboriginal Syllabics Extended-A"),
    (72448, 72543, "Devanagari Extended-A"),
    (72544, 72575, "Sharada Supplement"),
    (72640, 72703, "Sunuwar"),
    (73136, 73199, "Tolong Siki"),
    (73472, 73567, "Kawi"),
    (77712, 77823, "Cypro-Minoan"),
    (78896, 78943, "Egyptian Hieroglyph Format Controls"),
    (78944, 82943, "Egyptian Hieroglyphs Extended-A"),
    (90368, 90431, "Gurung Khema"),
    (92784, 92879, "Tangsa"),
    (93504, 93567, "Kirat Rai"),
    (93856, 93919, "Beria Erfe"),
    (101632, 101759, "Tangut Supplement"),
    (101760, 101887, "Tangut Components Supplement"),
    (110576, 110591, "Kana Extended-B"),
    (117760, 118463, "Symbols for Legacy Computing Supplement"),
    (118464, 118527, "Miscellaneous Symbols Supplement"),
    (118528, 118735, "Znamenny Musical Notation"),
    (119488, 119519, "Kaktovik Numerals"),
    (120832, 121519, "Sutton SignWriting"),
    (122624, 122879, "Latin Extended-G"),
    (122928, 123023, "Cyrillic Extended-D"),
    (123536, 123583, "Toto"),
    (124112, 124159, "Nag Mundari"),
    (124368, 124415, "Ol Onal"),
    (124608, 124671, "Tai Yo"),
    (124896, 124927, "Ethiopic Extended-B"),
    (191472, 192095, "CJK Unified Ideographs Extension I"),
    (201552, 205743, "CJK Unified Ideographs Extension H"),
    (205744, 210047, "CJK Unified Ideographs Extension J"),
]

_ACRONYMS = {"CJK", "IPA"}
_SMALL_WORDS = {"AND": "and", "FOR": "for"}


def _display_name(java_name: str) -> str:
    """The official spelling: the JDK writes every separator as one underscore, and all in capitals."""
    words = [w if w in _ACRONYMS else _SMALL_WORDS.get(w, w.capitalize()) for w in java_name.split("_")]
    if words[:2] == ["Latin", "1"]:
        return "Latin-1 " + " ".join(words[2:])
    # a last letter numbers a part of a block family, except in "Extension A"
    if len(words) > 1 and len(words[-1]) == 1 and words[-2] != "Extension":
        words[-2:] = [f"{words[-2]}-{words[-1]}"]
    return " ".join(words)


def _scan_jdk_blocks(spark: SparkSession) -> list[tuple[int, int, str]]:
    """Walk the 16-aligned code points: a named block is one contiguous
    range, so its end is found by galloping + bisection; unassigned gaps are
    stepped through (a gap can hide a block behind it)."""
    ub = getattr(spark.sparkContext._jvm.java.lang, "Character$UnicodeBlock")
    seen: dict[int, str | None] = {}

    def name_at(cp: int) -> str | None:
        if cp not in seen:
            blk = ub.of(cp)
            seen[cp] = None if blk is None else blk.toString()
        return seen[cp]

    spans: list[tuple[int, int, str]] = []
    for lo_range, hi_range in ((0, 0x40000), (0xE0000, 0x110000)):
        cp = lo_range
        while cp < hi_range:
            n = name_at(cp)
            if n is None:
                cp += 16
                continue
            lo, step = cp, 16
            while lo + step < hi_range and name_at(lo + step) == n:
                lo += step
                step *= 2
            hi = min(lo + step, hi_range)
            while hi - lo > 16:
                mid = lo + ((hi - lo) // 32) * 16
                if name_at(mid) == n:
                    lo = mid
                else:
                    hi = mid
            spans.append((cp, lo + 15, n))
            cp = lo + 16
    return spans


def unicode_blocks(spark: SparkSession) -> list[tuple[int, int, str]]:
    """``(start, end, name)`` of every block of Unicode 17, sorted, with 0-31
    named ``Control character``: the JDK's intervals under their official
    spelling, and the fixed values above in their place, so that any JDK from
    17 on gives the same table.  Computed once and kept as JSON in the shared
    checkpoint folder (keyed by JDK version) for later runs."""
    key = spark.sparkContext.applicationId
    if key in _BLOCK_CACHE:
        return _BLOCK_CACHE[key]
    import json

    from ticksmith.session import checkpoint_root

    jvm = spark.sparkContext._jvm
    version = str(jvm.java.lang.System.getProperty("java.version"))
    fs_path = f"{checkpoint_root(spark).rstrip('/')}/ticksmith/unicode-17-blocks-{version}.json"
    hadoop_path = jvm.org.apache.hadoop.fs.Path(fs_path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    blocks = None
    if fs.exists(hadoop_path):
        stream = fs.open(hadoop_path)
        try:
            text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            blocks = [tuple(b) for b in json.loads(text)]
        finally:
            stream.close()
    if not blocks:
        blocks = []
        for s, e, n in _scan_jdk_blocks(spark):
            label = _display_name(n)
            if s == 0:
                blocks.append((0, 31, CONTROL_BLOCK))
                blocks.append((32, e, label))
            else:
                blocks.append((s, e, label))
        official = [first for first, _, _ in OFFICIAL_BLOCKS]
        covered = [(s, e) for s, e, _ in OFFICIAL_BLOCKS]
        blocks = [b for b in blocks if b[0] not in official and not any(s <= b[0] <= e for s, e in covered)]
        blocks = sorted(blocks + OFFICIAL_BLOCKS)
        out = fs.create(hadoop_path, True)
        try:
            out.write(bytearray(json.dumps(blocks).encode("utf-8")))
        finally:
            out.close()
    _BLOCK_CACHE[key] = blocks
    return blocks


class BlockTable:
    """The block of a code point by bisection in the sorted intervals."""

    def __init__(self, blocks: list[tuple[int, int, str]]):
        self.blocks = blocks
        self.starts = [b[0] for b in blocks]

    def __getitem__(self, cp: int) -> str | None:
        k = bisect_right(self.starts, cp) - 1
        return self.blocks[k][2] if k >= 0 and cp <= self.blocks[k][1] else None


# --- per-character facts ------------------------------------------------------------------

CHAR_DDL = ("ch string, cp int, block string, is_alpha boolean, is_upper boolean, is_lower boolean, "
            "is_space boolean, is_digit boolean, is_printable boolean, lower_ch string, accentuated boolean, "
            "latin boolean, base_ch string, punct boolean, sym boolean, emoticon boolean, unprintable boolean, "
            "safe_ascii boolean")


def char_facts(ch: str, block: str | None) -> tuple:
    """Facts of one character, with Python's ``str`` and ``unicodedata``
    semantics (the detector's own definitions): accent and Latin flags only
    for letters, punctuation and symbol flags only for printable characters."""
    name = unicodedata.name(ch, "")
    cat = unicodedata.category(ch)
    alpha, printable = ch.isalpha(), ch.isprintable()
    decomposition = unicodedata.decomposition(ch)
    if decomposition and not decomposition.startswith("<"):
        base = chr(int(decomposition.split(" ")[0], 16))
    else:
        base = ch
    blk = block or ""
    punct = printable and ("P" in cat or "Punctuation" in blk)
    sym = printable and ("S" in cat or "N" in cat or ("Forms" in blk and cat != "Lo"))
    return (
        ch, ord(ch), block, alpha, ch.isupper(), ch.islower(), ch.isspace(), ch.isdigit(),
        printable, ch.lower(), alpha and any(k in name for k in ACCENT_KEYWORDS), alpha and "LATIN" in name,
        base, punct, sym, "Emoticons" in blk or "Pictographs" in blk,
        (not ch.isspace()) and (not printable) and ch not in ("\x1a", "\ufeff"),
        ch in COMMON_SAFE_ASCII,
    )


def _facts_batches(blocks: BlockTable):
    def run(batches):
        import pandas as pd

        cols = [c.split(" ")[0] for c in CHAR_DDL.split(", ")]
        for pdf in batches:
            yield pd.DataFrame([char_facts(c, blocks[ord(c)]) for c in pdf["ch"]], columns=cols)
    return run


def char_table(spark: SparkSession, texts: DataFrame, text: str = "text") -> DataFrame:
    """Facts for every distinct character of ``texts`` (and its lower-case
    form): distinct per row in place, one small shuffle to dedupe, then
    Python on the distinct set only."""
    both = F.concat(F.col(text), F.lower(F.col(text)))
    distinct = texts.select(F.explode(F.array_distinct(F.split(both, "", -1))).alias("ch"))
    return char_table_of(spark, distinct)


def char_table_of(spark: SparkSession, chars: DataFrame, ch: str = "ch") -> DataFrame:
    """Facts for the distinct single characters of column ``ch`` (their
    lower-case forms included)."""
    from ticksmith.session import ship_package

    ship_package(spark)
    c = F.col(ch)
    distinct = chars.select(F.explode(F.array_distinct(F.array(c, F.lower(c)))).alias("ch")) \
        .where(F.length("ch") == 1).distinct()
    return distinct.mapInPandas(_facts_batches(BlockTable(unicode_blocks(spark))), CHAR_DDL)


# --- chunks ------------------------------------------------------------------

def chunk_texts(docs: DataFrame, text: str = "text", size: int = CHUNK_CHARS) -> DataFrame:
    """``(doc_id, lang, chunk, offset, piece)``: each text cut into pieces
    of ``size`` characters, so even a very long text is profiled in bounded
    pieces."""
    n = F.ceil(F.length(F.col(text)) / F.lit(size)).cast("int")
    pieces = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1),
                                       lambda i: F.substring(F.col(text), i * size + 1, size)))
    lang = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    return docs.select("doc_id", lang.alias("lang"), F.posexplode(pieces).alias("chunk", "piece")).select(
        "doc_id", "lang", "chunk", (F.col("chunk") * size).cast("bigint").alias("offset"), "piece")


# --- letters of a piece of text, in the row ----------------------------------------------

def tally(piece: str) -> list[tuple[str, int]]:
    """Each character of a piece and its count, by code point: the code points are sorted as one array."""
    import numpy as np

    codes, n = np.unique(np.frombuffer(piece.encode("utf-32-le"), np.dtype("<u4")), return_counts=True)
    return list(zip(map(chr, codes.tolist()), n.tolist()))


class Letters:
    """What a worker knows about characters: block, lower case, and which blocks go together."""

    def __init__(self, blocks: BlockTable, kindred: dict[str, set[str]]):
        self.blocks, self.kindred = blocks, kindred
        self.known: dict[str, tuple[str, str] | None] = {}
        self.accents: dict[str, bool] = {}

    def letter(self, ch: str) -> tuple[str, str] | None:
        """(block, lower case) of a letter; letters outside every block are skipped, as by the detector."""
        if ch not in self.known:
            block = self.blocks[ord(ch)] if ch.isalpha() else None
            self.known[ch] = None if block is None else (block, ch.lower())
        return self.known[ch]

    def accented(self, ch: str) -> bool:
        if ch not in self.accents:
            self.accents[ch] = len(ch) == 1 and ch.isalpha() and any(k in unicodedata.name(ch, "") for k in ACCENT_KEYWORDS)
        return self.accents[ch]

    def count(self, piece: str, offset: int) -> list[tuple[str, str, int, int]]:
        """(block, lower-case letter, count, first position) of a piece."""
        found: dict[tuple[str, str], list[int]] = {}
        for ch, n in tally(piece):
            if (key := self.letter(ch)) is not None:
                at = offset + piece.index(ch)
                if key in found:
                    found[key] = [found[key][0] + n, min(found[key][1], at)]
                else:
                    found[key] = [n, at]
        return [(*key, n, at) for key, (n, at) in found.items()]

    def layers(self, letters: list[tuple[str, str, int, int]]) -> dict[str, list[tuple[str, int, int]]]:
        """Letters by layer, ranked by count, ties by first appearance.

        Blocks come in order of first appearance; each joins the first earlier
        layer it may stand next to.
        """
        first: dict[str, int] = {}
        for block, _, _, at in letters:
            first[block] = min(at, first.get(block, at))
        layer_of: dict[str, str] = {}
        for block in sorted(first, key=lambda b: (first[b], b)):
            layer_of[block] = next((layer for layer in dict.fromkeys(layer_of.values()) if block in self.kindred[layer]), block)
        merged: dict[str, dict[str, list[int]]] = defaultdict(dict)
        for block, ch, n, at in letters:
            layer = merged[layer_of[block]]
            layer[ch] = [n + layer[ch][0], min(at, layer[ch][1])] if ch in layer else [n, at]
        return {name: sorted(((ch, n, at) for ch, (n, at) in layer.items()), key=lambda x: (-x[1], x[2])) for name, layer in merged.items()}


_KINDRED: dict[str, dict[str, set[str]]] = {}


def kindred_blocks(spark: SparkSession) -> dict[str, set[str]]:
    """For each block, those the successive-range rule lets stand next to it; decided once per session."""
    key = spark.sparkContext.applicationId
    if key not in _KINDRED:
        names = [b[2] for b in unicode_blocks(spark)]
        every = spark.createDataFrame([(n,) for n in names], "a string").select("a", F.explode(F.array(*map(F.lit, names))).alias("b"))
        pairs = every.where(~suspicious_pair(F.col("a"), F.col("b"))).groupBy("a").agg(F.collect_list("b").alias("b"))
        _KINDRED[key] = {r.a: set(r.b) for r in pairs.collect()}
    return _KINDRED[key]


def _batch_rows(batch, names: list[str]):
    """The rows of an Arrow batch as tuples of the named columns."""
    return zip(*(batch.column(n).to_pylist() for n in names))


def _arrow_batches(make, target):
    """A ``mapInArrow`` function; ``make`` gives a worker's function from a batch to rows."""
    def run(batches):
        import pyarrow as pa

        step = make()
        for batch in batches:
            if rows := step(batch):
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), target)], schema=target)
    return run


def _map_batches(df: DataFrame, make, names: list[str], ddl: str) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    from ticksmith.session import ship_package

    ship_package(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    return df.select(*names).mapInArrow(_arrow_batches(make, to_arrow_schema(StructType.fromDDL(ddl))), ddl)


def _map_rows(df: DataFrame, make, names: list[str], ddl: str) -> DataFrame:
    """``_map_batches`` where ``make`` gives a function from a row's named columns to rows."""
    def by_row():
        step = make()
        return lambda batch: [out for row in _batch_rows(batch, names) for out in step(*row)]
    return _map_batches(df, by_row, names, ddl)


# --- R3 -----------------------------------------------------------------------------------

def char_blocks(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``(doc_id, block, chars)`` characters per Unicode block; counted per
    piece in the row, summed per document."""
    blocks = BlockTable(unicode_blocks(spark))

    def make():
        known: dict[str, str | None] = {}

        def step(doc_id, piece):
            found: Counter = Counter()
            for ch, n in Counter(piece).items():
                if ch not in known:
                    known[ch] = blocks[ord(ch)]
                found[known[ch]] += n
            return [(doc_id, block, n) for block, n in found.items()]
        return step

    pieces = chunk_texts(docs)
    key = pieces.schema["doc_id"].dataType.simpleString()
    counted = _map_rows(pieces, make, ["doc_id", "piece"], f"doc_id {key}, block string, chars bigint")
    return counted.groupBy("doc_id", "block").agg(F.sum("chars").alias("chars"))


# --- successive-range rule -----------------------------------------------------------------

def suspicious_pair(a: Column, b: Column) -> Column:
    """Whether two Unicode block names seen next to each other are suspicious."""
    secondary = F.array(*[F.lit(k) for k in SECONDARY_RANGE_KEYWORDS])
    wa, wb = F.split(a, " "), F.split(b, " ")
    shared_word = F.exists(wa, lambda w: ~F.array_contains(secondary, w) & F.array_contains(wb, w))
    jp = F.array(F.lit("Hiragana"), F.lit("Katakana"))
    a_jp, b_jp = F.array_contains(jp, a), F.array_contains(jp, b)

    def has(x, k):
        return F.instr(x, k) > 0

    cjk = has(a, "CJK") | has(b, "CJK")
    basic = (a == "Basic Latin") | (b == "Basic Latin")
    return (
        F.when(a.isNull() | b.isNull(), True)
        .when(a == b, False)
        .when(has(a, "Latin") & has(b, "Latin"), False)
        .when(has(a, "Emoticons") | has(b, "Emoticons"), False)
        .when((has(a, "Latin") | has(b, "Latin")) & (has(a, "Combining") | has(b, "Combining")), False)
        .when(shared_word, False)
        .when((a_jp | b_jp) & cjk, False)
        .when(a_jp & b_jp, False)
        .when((has(a, "Hangul") | has(b, "Hangul")) & (cjk | basic), False)
        .when((cjk | (a_jp & b_jp)) & (has(a, "Punctuation") | has(b, "Punctuation") | has(a, "Forms")
                                       | has(b, "Forms") | basic), False)
        .otherwise(True)
    )


# --- R4: layers and ranks ---------------------------------------------------------------------

def letter_ranks(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``(doc_id, layer, ch, n, first_pos, rank)`` of whole documents.

    Letters are split into layers by Unicode block (a block joins the first
    earlier layer it is not suspicious next to), lower-cased, and ranked by
    count, ties by first appearance.  Pieces are counted in the row; their
    counts meet by one exchange on the document, which the sums, the layers
    and the ranks share.
    """
    blocks, kindred = BlockTable(unicode_blocks(spark)), kindred_blocks(spark)

    def count():
        known = Letters(blocks, kindred)

        def step(doc_id, offset, piece):
            return [(doc_id, *letter) for letter in known.count(piece, offset)]
        return step

    def rank():
        known = Letters(blocks, kindred)

        def step(doc_id, letters):
            rows = [(x["block"], x["ch"], x["n"], x["first_pos"]) for x in letters]
            return [(doc_id, layer, ch, n, at, k) for layer, ls in known.layers(rows).items() for k, (ch, n, at) in enumerate(ls)]
        return step

    pieces = chunk_texts(docs)
    key = pieces.schema["doc_id"].dataType.simpleString()
    counted = _map_rows(pieces, count, ["doc_id", "offset", "piece"], f"doc_id {key}, block string, ch string, n bigint, first_pos bigint")
    summed = counted.repartition("doc_id").groupBy("doc_id", "block", "ch").agg(F.sum("n").alias("n"), F.min("first_pos").alias("first_pos"))
    letters = summed.groupBy("doc_id").agg(F.collect_list(F.struct("block", "ch", "n", "first_pos")).alias("letters"))
    return _map_rows(letters, rank, ["doc_id", "letters"], f"doc_id {key}, layer string, ch string, n bigint, first_pos bigint, rank bigint")


def chunk_layers(spark: SparkSession, docs: DataFrame, size: int = CHUNK_CHARS) -> DataFrame:
    """``(doc_id, lang, chunk, layer, letters, counts, accents)``: the ranked
    letters of each layer of each chunk, narrow from the text on."""
    blocks, kindred = BlockTable(unicode_blocks(spark)), kindred_blocks(spark)

    def make():
        known = Letters(blocks, kindred)

        def step(doc_id, lang, chunk, piece):
            out = []
            for layer, ls in known.layers(known.count(piece, 0)).items():
                letters = [x[0] for x in ls]
                out.append((doc_id, lang, chunk, layer, letters, [x[1] for x in ls], [known.accented(c) for c in letters]))
            return out
        return step

    pieces = chunk_texts(docs, size=size)
    key = pieces.schema["doc_id"].dataType.simpleString()
    return _map_rows(pieces, make, ["doc_id", "lang", "chunk", "piece"],
                     f"doc_id {key}, lang string, chunk int, layer string, letters array<string>, counts array<bigint>, accents array<boolean>")


# --- language profiles -------------------------------------------------------------------------

def language_letters(spark: SparkSession, docs: DataFrame, size: int = CHUNK_CHARS) -> DataFrame:
    """``(lang, ch, n, accent)``: lower-case letters of the documents with a
    ``lang``, summed over each batch of pieces that a worker reads."""
    blocks, kindred = BlockTable(unicode_blocks(spark)), kindred_blocks(spark)

    def make():
        known = Letters(blocks, kindred)

        def step(batch):
            found: dict[str, Counter] = defaultdict(Counter)
            for lang, piece in _batch_rows(batch, ["lang", "piece"]):
                counts = found[lang]
                for ch, n in tally(piece):
                    if (key := known.letter(ch)) is not None:
                        counts[key[1]] += n
            return [(lang, ch, n, known.accented(ch)) for lang, counts in found.items() for ch, n in counts.items()]
        return step

    pieces = chunk_texts(docs, size=size).where(F.col("lang").isNotNull())
    return _map_batches(pieces, make, ["lang", "piece"], "lang string, ch string, n bigint, accent boolean")


def learn_profiles(letters: DataFrame, share: int = PROFILE_SHARE, alt_share: int | None = ALT_PROFILE_SHARE) -> DataFrame:
    """``(language, alphabet, has_accents)``: all lower-case letters with at
    least one in ``share`` of a ``lang``'s letters, as one array ranked by
    count; and an alternative profile ``<lang>—`` that also has its rare
    letters (one in ``alt_share``).  ``letters`` is what ``language_letters`` gives."""
    counts = letters.groupBy("lang", "ch").agg(F.sum("n").alias("n"), F.max("accent").alias("accent"))
    total = F.sum("n").over(Window.partitionBy("lang"))
    order = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "ch", "accent")))
    out = None
    for name, k in [(F.col("lang"), share), *([(F.concat("lang", F.lit("—")), alt_share)] if alt_share else [])]:
        part = counts.withColumn("total", total).where(F.col("n") * k >= F.col("total")).groupBy(name.alias("language")).agg(order.alias("a"))
        out = part if out is None else out.unionByName(part)
    return out.select("language", F.col("a.ch").alias("alphabet"), F.exists("a.accent", lambda x: x).alias("has_accents"))


def profile_blocks(profiles: DataFrame) -> DataFrame:
    """Profiles in blocks of about ``LANGUAGES_PER_BLOCK`` languages ``(block, blocks, profiles)``, or fewer
    where their alphabets are long, stored in the shared folder."""
    from ticksmith.session import shared_dir

    spark = profiles.sparkSession
    path = shared_dir(spark, "profiles")
    profiles.write.parquet(f"{path}/languages")
    kept = spark.read.parquet(f"{path}/languages")
    languages, letters = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("alphabet")), F.lit(0))).first()
    n = max(1, -(-languages // LANGUAGES_PER_BLOCK), -(-letters // LETTERS_PER_BLOCK))
    blocks = kept.groupBy(F.pmod(F.hash("language"), F.lit(n)).alias("block")).agg(F.collect_list(F.struct("language", "alphabet", "has_accents")).alias("profiles"))
    blocks.withColumn("blocks", F.lit(n)).coalesce(n).write.parquet(f"{path}/blocks")
    return spark.read.parquet(f"{path}/blocks")


# --- R5, R6 -----------------------------------------------------------------------------------

def approved_letters(common: list[tuple[int, int]], size: int, letters: int) -> int:
    """How many of the letters that a layer and a language share are ranked
    alike, of ``(rank in the layer, rank in the language)`` in the layer's order.

    Approved is a letter close to its rank projected onto the profile length,
    or with enough agreement in the letters ranked before/after it in both
    orderings.  Those before it are found by bisection among the language
    ranks seen so far; those after follow from them and the sorted ranks:
    #(lr >= lr_c) - (#(r < r_c) - before)."""
    n_ok, large, scale = 0, size > 26, size / letters
    lrs, seen = sorted(lr for _, lr in common), []
    for nth, (r, lr) in enumerate(common):
        before = bisect_left(seen, lr)
        seen.insert(before, lr)
        gap, after_len = abs(int(r * scale) - lr), size - lr
        if not large and gap > 4:
            continue
        if large and gap < size / 3 or lr == 0 and before <= 4 or lr > 0 and before / lr >= 0.4:
            n_ok += 1
            continue
        after = len(common) - bisect_left(lrs, lr) - (nth - before)
        n_ok += after / after_len >= 0.4  # a profile's last letter has itself after it
    return n_ok


def _compared(layers: DataFrame, profiles: DataFrame, judge, ddl: str) -> DataFrame:
    """``(doc_id, chunk, layer, language, ...)`` with what ``judge`` finds, for share >= 0.2.

    Layers of more than 32 letters meet all languages, a block of them at a
    time; a language without accented letters is skipped when the layer has
    any.  ``judge`` gets the ranks of the letters in common, the profile's
    length and the layer's.  A worker reads the alphabets of a block once."""
    n = profiles.agg(F.coalesce(F.max("blocks"), F.lit(0))).first()[0]
    large = layers.where(F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, x: a + x) > TOO_SMALL_SEQUENCE)
    large = large.select("doc_id", "chunk", "layer", "letters", F.exists("accents", lambda x: x).alias("source_accents"),
                         F.explode(F.array(*map(F.lit, range(n))).cast("array<int>")).alias("block"))
    names = ["doc_id", "chunk", "layer", "letters", "source_accents", "block"]

    def make():
        known: dict[int, list[tuple[str, dict[str, int], bool]]] = {}

        def step(batch):
            out = []
            for i, (doc_id, chunk, layer, letters, source_accents, block) in enumerate(_batch_rows(batch, names)):
                if block not in known:
                    known[block] = [(p["language"], {ch: k for k, ch in enumerate(p["alphabet"])}, p["has_accents"])
                                    for p in batch.column("profiles")[i].as_py()]
                for language, ranks, has_accents in known[block]:
                    if source_accents and not has_accents:
                        continue
                    common = [(r, ranks[ch]) for r, ch in enumerate(letters) if ch in ranks]
                    if len(common) / len(ranks) >= MIN_CANDIDATE_SHARE:
                        out.append((doc_id, chunk, layer, language, *judge(common, len(ranks), len(letters))))
            return out
        return step

    key = layers.schema["doc_id"].dataType.simpleString()
    met = large.join(profiles.select("block", "profiles"), "block")
    return _map_batches(met, make, [*names, "profiles"], f"doc_id {key}, chunk int, layer string, language string, {ddl}")


def lang_candidates(layers: DataFrame, profiles: DataFrame) -> DataFrame:
    """``(doc_id, chunk, layer, language, share)``: languages of whose
    alphabet the layer has at least 0.2.  ``profiles`` is what ``profile_blocks`` gives."""
    return _compared(layers, profiles, lambda common, size, letters: (len(common) / size,), "share double")


def lang_coherence(layers: DataFrame, profiles: DataFrame) -> DataFrame:
    """``(doc_id, chunk, layer, language, ratio)`` rounded to 4, ratios
    below 0.1 dropped: the layer's letters that are ranked as in the language,
    for each candidate (R5), over all the layer's letters."""
    judged = _compared(layers, profiles, lambda common, size, letters: (approved_letters(common, size, letters), letters),
                       "n_ok bigint, layer_letters bigint")
    # fenced so the threshold filter does not re-evaluate the ratio
    out = fence(judged.select("doc_id", "chunk", "layer", "language", round4(F.col("n_ok"), F.col("layer_letters")).alias("ratio")))
    return out.where(F.col("ratio") >= COHERENCE_THRESHOLD)


# --- R7, R8 -----------------------------------------------------------------------------------

def lang_merge(coherence: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Mean ratio per language over the chunks, rounded to 4; chunks are folded (R8) before."""
    ticks = F.round(F.col("ratio") * 10000).cast("long")  # ratios are exact multiples of 1e-4
    agg = coherence.groupBy(*keys, "language").agg(F.sum(ticks).alias("_s"), F.count(F.lit(1)).alias("_n"))
    return agg.select(*keys, "language", (round4(F.col("_s"), F.col("_n") * 10000)).alias("ratio"))


def lang_best(coherence: DataFrame, keys: tuple[str, ...] = ("doc_id", "chunk")) -> DataFrame:
    """Within a chunk, over its layers, alternative profiles (``—`` in the
    name) fold into their language with the best ratio, but only where some
    name occurs twice in the chunk; otherwise its results stay as they are."""
    # grouped and judged by the chunk after one exchange: ``coherence`` is read once
    found = coherence.dropna(subset=list(keys)).repartition(*keys)
    named = found.groupBy(*keys, F.regexp_replace("language", "—", "").alias("base_language")).agg(
        F.count(F.lit(1)).alias("k"), F.max("language").alias("language"), F.max("ratio").alias("ratio"))
    has_dup = F.max("k").over(Window.partitionBy(*keys)) > 1
    # where no name occurs twice, each group is one row and keeps its own name
    return named.select(*keys, F.when(has_dup, F.col("base_language")).otherwise(F.col("language")).alias("language"), "ratio")


# --- R9 / R10 as character-class regexes over the whole text -----------------------------


class Alphabet:
    """Regex classes over the corpus's characters, in code point order.

    A class is written as ranges that may cover code points the corpus
    doesn't hold, so its length follows the alternations between classes
    (scripts come in blocks), not the number of characters.
    """

    def __init__(self, rows: list):
        self.rows = sorted(rows, key=lambda r: r.cp)

    def cls(self, inside) -> str | None:
        out, start, last = [], None, None
        for r in self.rows:
            if inside(r):
                start, last = (r.cp if start is None else start), r.cp
            elif start is not None:
                out.append((start, last))
                start = None
        if start is not None:
            out.append((start, last))
        if not out:
            return None
        return "[" + "".join(f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in out) + "]"


def suspicious_block_pairs(spark: SparkSession, names: list[str | None]) -> set[tuple[str | None, str | None]]:
    """The ordered pairs of the given block names (the few blocks present in
    the corpus) that ``suspicious_pair`` flags, evaluated by Spark."""
    pairs = [(a, b) for a in names for b in names]
    if not pairs:
        return set()
    df = spark.createDataFrame(pairs, "a string, b string")
    return {(r.a, r.b) for r in df.where(suspicious_pair(F.col("a"), F.col("b"))).collect()}


def alphabet(facts: DataFrame) -> Alphabet:
    """The facts of the distinct characters on the driver: never more rows
    than Unicode has characters, whatever the corpus."""
    return Alphabet(facts.drop("lower_ch").collect())


def _count(text: Column, pattern: str | None) -> Column:
    if pattern is None:
        return F.lit(0).cast("bigint")
    return F.regexp_count(text, F.lit(pattern)).cast("bigint")


def noise_counts(spark: SparkSession, docs: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """``(doc_id, accent_ratio, unprintable_ratio)`` over the whole text.

    accent: accented / letters, 0 unless at least 8 letters and >= 0.35;
    unprintable: 8 x unprintable / (characters + the closing newline).
    Counted with character-class regexes per document (narrow, no shuffle)."""
    facts = facts if facts is not None else char_table(spark, docs)
    cls = alphabet(facts).cls
    text = F.coalesce(F.col("text"), F.lit(""))
    letters = _count(text, cls(lambda r: r.is_alpha))
    accented = _count(text, cls(lambda r: r.is_alpha and r.accentuated))
    unprintable = _count(text, cls(lambda r: r.unprintable))
    chars = F.length(text).cast("bigint")
    acc = F.try_divide(accented, letters)
    return docs.select(
        "doc_id",
        F.when((letters >= 8) & (acc >= 0.35), acc).otherwise(F.lit(0.0)).alias("accent_ratio"),
        F.try_divide(unprintable * 8, chars + 1).alias("unprintable_ratio"))


def noise_neighbours(spark: SparkSession, docs: DataFrame, facts: DataFrame | None = None) -> DataFrame:
    """``(doc_id, symbol_ratio, range_ratio, accent_pair_ratio)``.

    * symbols: over printable characters, punctuation + 2 x other symbols
      (digits and emoticons excluded), a repeat of the previous printable
      character and the common ASCII separators not counted; 0 below 0.3
    * block jumps: printable characters whose previous printable character
      (a space, punctuation or separator cuts the chain) sits in a
      suspiciously different block, x 2 / printable; 0 up to 13 characters
    * accent pairs: over Latin letters, an accented letter after an
      accented letter counts 1 if both are upper case and 1 if they share
      the base letter, x 2 / Latin letters

    Each is a regex over the document's text (narrow: no explode, sort or
    shuffle): non-printable characters are removed (so neighbours are
    neighbours among printable ones), runs of one character collapsed for
    the repeat rule, and pairs counted with a one-character lookahead."""
    facts = facts if facts is not None else char_table(spark, docs)
    chars = alphabet(facts)
    rows, cls = chars.rows, chars.cls
    text = F.coalesce(F.col("text"), F.lit(""))
    nonprint = cls(lambda r: not r.is_printable)
    printable_text = F.regexp_replace(text, nonprint, "") if nonprint else text
    collapsed = F.regexp_replace(printable_text, r"(?s)(.)\1+", "$1")
    punct = cls(lambda r: r.is_printable and r.punct and not r.safe_ascii)
    sym = cls(lambda r: r.is_printable and not r.punct and not r.is_digit and r.sym and not r.emoticon and not r.safe_ascii)
    sym_points = _count(collapsed, punct) + 2 * _count(collapsed, sym)

    # block jumps between neighbouring printable non-separators: one alternative per block
    def counts(r):
        return r.is_printable and not (r.is_space or r.punct or r.safe_ascii)

    blocks = list(dict.fromkeys(r.block for r in rows if counts(r)))
    flagged = suspicious_block_pairs(spark, blocks)
    alts = []
    for a in blocks:
        after = {b for b in blocks if (a, b) in flagged}
        if after:
            alts.append(f"{cls(lambda r, a=a: counts(r) and r.block == a)}(?={cls(lambda r, after=after: counts(r) and r.block in after)})")
    jumps = _count(printable_text, "(?:" + "|".join(alts) + ")" if alts else None)

    # accent pairs along the Latin letters
    latin_cls = cls(lambda r: r.is_alpha and r.latin)
    latin_text = F.regexp_replace(text, "[^" + latin_cls[1:], "") if latin_cls else F.lit("")

    def accent(r):
        return r.is_alpha and r.latin and r.accentuated

    acc_up = cls(lambda r: accent(r) and r.is_upper)
    both_upper = _count(latin_text, f"(?={acc_up}{acc_up})" if acc_up else None)
    bases = list(dict.fromkeys(r.base_ch for r in rows if accent(r)))
    same = "|".join(f"{c}{c}" for c in (cls(lambda r, v=v: accent(r) and r.base_ch == v) for v in bases))
    same_base = _count(latin_text, f"(?=(?:{same}))" if same else None)

    printable = F.length(printable_text).cast("bigint")
    latin_letters = F.length(latin_text).cast("bigint")
    sym_ratio = F.try_divide(sym_points, printable)
    return docs.select(
        "doc_id",
        F.when((printable > 0) & (sym_ratio >= 0.3), sym_ratio).otherwise(F.lit(0.0)).alias("symbol_ratio"),
        F.when(printable > 13, F.try_divide(jumps * 2, printable)).otherwise(F.lit(0.0)).alias("range_ratio"),
        F.when(latin_letters > 0, F.try_divide((both_upper + same_base) * 2, latin_letters))
        .otherwise(F.lit(0.0)).alias("accent_pair_ratio"),
    )


# --- one corpus profile, materialised ----------------------------------------------------

def materialise_table(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder, computed once
    (persisted while the checkpoint is written, then released)."""
    from pyspark import StorageLevel

    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()


class CorpusProfile:
    """The language checks of a corpus (R5, R6) under the profiles learned from it.

    Only the profiles are stored (languages x alphabets).  The letters of a
    chunk are counted from its text where they are needed, once for the profiles
    and once for the checks: narrow, and cheaper than keeping them.
    """

    def __init__(self, spark: SparkSession, docs: DataFrame, chunk_chars: int = CHUNK_CHARS):
        self.layers = chunk_layers(spark, docs, chunk_chars)
        self.profiles = profile_blocks(learn_profiles(language_letters(spark, docs, chunk_chars)))

    def candidates(self) -> DataFrame:
        return lang_candidates(self.layers, self.profiles)

    def coherence(self) -> DataFrame:
        return lang_coherence(self.layers, self.profiles)
