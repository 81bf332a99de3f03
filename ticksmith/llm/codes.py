"""Token ids of documents as directly addressable codes.

An id is cut into chunks from its lowest bits on.  Level 0 holds the first
chunk of every id, level 1 the second chunk of those ids that have one, and so
on; a continuation bitmap per level tells which ids go on, and a rank directory
counts the set bits before every ``RANK_BITS`` of them.  Id number i is read by
following its ranks from level to level: a few bytes at computed places,
without decoding anything around it.

``write_codes`` sorts the documents by doc_id (range partitions, so no task
holds more than its share, however often one id occurs), encodes them once and
writes segments of whole documents: a Parquet row holds one segment's image and
its directory of documents.  Parquet is only the container, uncompressed, so a
lost executor costs a rerun of its tasks and no half-written file is ever read.
``read_documents`` gives back every document's place and ids' digest,
``tokens_at`` single tokens.

A null text counts as empty and has its end id alone.  Null doc_ids come first;
rows of one doc_id are ordered by a hash of their text, so equal rows each have
their own range of ids.  An empty table gives an empty result.  Extra columns
are ignored.
"""

from __future__ import annotations

import json
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticksmith.llm.common import WordMemo, arrow_schema, map_batches, prepare, record_batch
from ticksmith.llm.tokens import byte_alphabet
from ticksmith.session import shared_dir

END_ID = 1
#: chunk widths by level, in bits; together they hold any 32-bit id
WIDTHS = (8, 8, 16)
#: bits of a continuation bitmap per entry of its rank directory
RANK_BITS = 512
#: ids after which a segment ends with the document at hand
SEGMENT_IDS = 1 << 20
#: words outside of Western letters whose ids a worker keeps
MEMO_WORDS = 100_000

MAGIC = b"DACS"
HEAD = struct.Struct("<4sIQ")
LEVEL = struct.Struct("<IIQQQQ")
CHUNK = {8: np.dtype("<u1"), 16: np.dtype("<u2"), 32: np.dtype("<u4")}

SEGMENT_SCHEMA = "part int, segment int, n_ids long, doc_ids array<bigint>, lengths array<bigint>, image binary"


def image(ids: np.ndarray, widths: tuple[int, ...] = WIDTHS) -> bytes:
    """The file image of a sequence of ids: header, level table, then each level's chunks, bitmap and rank directory."""
    if sum(widths) < 32:
        raise ValueError("the widths must add up to 32 bits")
    left, levels = ids.astype(np.uint64), []
    for depth, width in enumerate(widths):
        chunks = (left & np.uint64((1 << width) - 1)).astype(CHUNK[width])
        left = left >> np.uint64(width)
        more = left > 0 if depth < len(widths) - 1 else np.zeros(len(left), bool)
        bits = np.packbits(more, bitorder="little")
        ones = np.add.reduceat(more, np.arange(0, len(more), RANK_BITS)) if len(more) else np.zeros(0, np.int64)
        ranks = (np.cumsum(ones) - ones).astype("<u4")
        levels.append((width, [chunks.tobytes(), bits.tobytes(), ranks.tobytes()], len(chunks)))
        left = left[more]
    out = [HEAD.pack(MAGIC, len(widths), len(ids))]
    at = HEAD.size + LEVEL.size * len(widths)
    body = []
    for width, sections, n in levels:
        places = []
        for s in sections:
            places.append(at)
            s += bytes(-len(s) % 8)
            body.append(s)
            at += len(s)
        out.append(LEVEL.pack(width, 0, n, *places))
    return b"".join(out + body)


class Codes:
    """Random access to the ids of one image."""

    def __init__(self, data: bytes):
        magic, n_levels, self.n = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not an image of directly addressable codes")
        self.levels = []
        for k in range(n_levels):
            width, _, n, at, bits_at, ranks_at = LEVEL.unpack_from(data, HEAD.size + LEVEL.size * k)
            chunks = np.frombuffer(data, CHUNK[width], n, at)
            bits = np.frombuffer(data, np.uint8, -(-n // 8), bits_at)
            ranks = np.frombuffer(data, "<u4", -(-n // RANK_BITS), ranks_at)
            self.levels.append((width, chunks, bits, ranks))

    def take(self, places) -> np.ndarray:
        """The ids at some places, each by its own path through the levels."""
        at = np.asarray(places, np.int64)
        if len(at) and (at.min() < 0 or at.max() >= self.n):
            raise IndexError("place outside of the sequence")
        out = np.zeros(len(at), np.uint64)
        open_, shift = np.arange(len(at)), 0
        for width, chunks, bits, ranks in self.levels:
            out[open_] |= chunks[at].astype(np.uint64) << np.uint64(shift)
            shift += width
            goes_on = (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            if not goes_on.any():
                break
            open_, at = open_[goes_on], self._rank(bits, ranks, at[goes_on])
        return out.astype(np.uint32)

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Set bits before each place: the directory's entry and the bytes between it and the place."""
        block = at // RANK_BITS
        first, here = block * (RANK_BITS // 8), at >> 3
        within = np.arange(RANK_BITS // 8)
        near = first[:, None] + within
        full = np.bitwise_count(bits[np.minimum(near, len(bits) - 1)]) * (near < here[:, None])
        part = np.bitwise_count(bits[here] & ((1 << (at & 7)) - 1).astype(np.uint8))
        return ranks[block].astype(np.int64) + full.sum(1, dtype=np.int64) + part

    def all(self) -> np.ndarray:
        """Every id in order."""
        out, open_, shift = np.zeros(self.n, np.uint32), np.arange(self.n), 0
        for width, chunks, bits, _ in self.levels:
            out[open_] |= chunks.astype(np.uint32) << np.uint32(shift)
            shift += width
            open_ = open_[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)]
        return out


def ranked_words(path: str):
    """The vocabulary for the faster of the two libraries, whose merges go by rank alone.

    A word's end is a line feed here, which no word holds.  Ids must follow the
    order of merges, after the bytes and the bytes that end a word; where they
    don't, there is none.  Beside it, for each id, whether it ends a word.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    alphabet, suffix = byte_alphabet(), model["end_of_word_suffix"]
    merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:])) or merged[0] != 512:
        return None
    ranks: dict[bytes, int] = {}
    for token, k in model["vocab"].items():
        if k <= merged[-1]:
            stem = token.removesuffix(suffix)
            data = bytes(alphabet[c] for c in stem)
            if b"\n" not in data:
                ranks[data + b"\n" * (stem != token)] = k
    if len(ranks) != 512 + len(merged) - 2:
        return None
    ends = np.zeros(max(model["vocab"].values()) + 2, bool)
    ends[[k for data, k in ranks.items() if data.endswith(b"\n")]] = True
    ranks[b"\n"] = len(ends) - 1
    return tiktoken.Encoding("words", pat_str=r"[^\n]+\n", mergeable_ranks=ranks, special_tokens={}), ends


class WordTokens:
    """Ids of texts under a vocabulary whose words end at white space.

    White space is dropped and no id spans it, so the ids of a text are those
    of its words, and each distinct word of a batch is encoded once.  Words of
    Western letters are cut into pieces and encoded side by side; others, and
    texts that hold a special string, go to the library as they are.
    """

    #: words that normalisation changes in nothing but their case, and whose pieces are runs of letters, single digits, and runs of the rest
    PLAIN = r"^[\x21-\x26\x28-\x7e\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]+$"
    LETTER, DIGIT, REST, END = range(4)

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranked = ranked_words(path)
        self.kind = np.full(256, self.REST, np.uint8)
        self.kind[ord("a") : ord("z") + 1] = self.kind[0x80:] = self.LETTER
        self.kind[ord("0") : ord("9") + 1] = self.DIGIT
        self.kind[ord("\n")] = self.END
        self.others = WordMemo(lambda w: np.array(self.tokenizer.encode(w, add_special_tokens=False).ids, np.uint32), MEMO_WORDS)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some distinct words, and where each word's ids begin (and the last one's end)."""
        fast = pc.match_substring_regex(words, self.PLAIN) if self.ranked else pa.array(np.zeros(len(words), bool))
        is_fast = fast.to_numpy(zero_copy_only=False)
        slow = np.flatnonzero(~is_fast)
        counts, flat = np.zeros(len(words), np.int64), np.zeros(0, np.uint32)
        if is_fast.any():
            encoding, ends = self.ranked
            some = pc.utf8_lower(words.filter(fast))
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some), "\n")
            data = np.frombuffer(joined[0].as_buffer().to_pybytes() + b"\n", np.uint8)
            kind = self.kind[data]
            cut = (kind[1:] != kind[:-1]) | (kind[1:] == self.DIGIT)
            cut &= (kind[1:] != self.END) & (kind[:-1] != self.END)
            marked = np.insert(data, np.flatnonzero(cut) + 1, 10).tobytes().decode()
            flat = np.array(encoding.encode_ordinary(marked), np.uint32)
            # the last id of each word, from the number of pieces up to its end
            pieces = np.cumsum(np.append(cut, False) | (kind == self.END))[kind == self.END]
            counts[is_fast] = np.diff(np.flatnonzero(ends[flat])[pieces - 1], prepend=-1)
        if len(slow):
            found = [self.others[w] for w in words.take(pa.array(slow)).to_pylist()]
            at = np.repeat(np.cumsum(counts)[slow], [len(x) for x in found])
            counts[slow] = [len(x) for x in found]
            flat = np.insert(flat, at, np.concatenate(found))
        return flat, np.concatenate([[0], np.cumsum(counts)])

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch in one array, and the count of each text."""
        texts = pc.fill_null(texts, "")
        odd = np.zeros(len(texts), bool)
        for s in self.special:
            odd |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        lists = pc.ascii_split_whitespace(plain)
        words = pc.list_flatten(lists).dictionary_encode()
        flat, starts = self._words(words.dictionary)
        place = words.indices.to_numpy(zero_copy_only=False)
        n = np.diff(starts)[place]
        ends = np.cumsum(n)
        flat = flat[np.arange(len(place) and ends[-1]) + np.repeat(starts[place] - (ends - n), n)]
        per_text = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text)]).astype(np.int64)]
        counts = np.diff(bounds)
        if odd.any():
            pieces = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            for k in np.flatnonzero(odd):
                pieces[k] = np.array(self.tokenizer.encode(texts[int(k)].as_py(), add_special_tokens=False).ids, np.uint32)
                counts[k] = len(pieces[k])
            flat = np.concatenate(pieces)
        return flat, counts


def with_end(flat: np.ndarray, counts: np.ndarray, end_id: int) -> np.ndarray:
    """The ids of a batch with the end id after each text."""
    out = np.full(len(flat) + len(counts), end_id, np.uint32)
    ends = np.cumsum(counts + 1) - 1
    mask = np.ones(len(out), bool)
    mask[ends] = False
    out[mask] = flat
    return out


def write_codes(docs: DataFrame, path: str, end_id: int = END_ID, widths: tuple[int, ...] = WIDTHS, segment_ids: int = SEGMENT_IDS, store: str | None = None) -> str:
    """Write the ids of all documents in ascending doc_id order; returns the folder."""
    spark = prepare(docs.sparkSession)
    store = store or shared_dir(spark, "codes")
    target = arrow_schema(spark, SEGMENT_SCHEMA)

    def run(batches):
        words, part, made = WordTokens(path), TaskContext.get().partitionId(), 0
        held, doc_ids, lengths, size = [], [], [], 0

        def segment():
            nonlocal held, doc_ids, lengths, size, made
            row = {"part": [part], "segment": [made], "n_ids": [size], "doc_ids": [doc_ids], "lengths": [lengths], "image": [image(np.concatenate(held), widths)]}
            held, doc_ids, lengths, size, made = [], [], [], 0, made + 1
            return record_batch(row, target)

        for batch in batches:
            flat, counts = words.ids(batch.column(1))
            ids, counts = with_end(flat, counts, end_id), counts + 1
            names, ends = batch.column(0).to_pylist(), np.cumsum(counts)
            done = 0
            while done < len(names):
                # whole documents up to the first that fills the segment
                before = int(ends[done - 1]) if done else 0
                last = min(int(np.searchsorted(ends, before + segment_ids - size)), len(names) - 1)
                held.append(ids[before : int(ends[last])])
                doc_ids += names[done : last + 1]
                lengths += counts[done : last + 1].tolist()
                size += int(ends[last]) - before
                done = last + 1
                if size >= segment_ids:
                    yield segment()
        if doc_ids:
            yield segment()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.mapInArrow(run, SEGMENT_SCHEMA).write.option("compression", "uncompressed").parquet(store)
    return store


def segment_starts(spark: SparkSession, store: str) -> DataFrame:
    """part, segment, start: the ids before each segment, from totals per part and running sums inside a part."""
    sizes = spark.read.parquet(store).select("part", "segment", "n_ids")
    before = W.rowsBetween(W.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("of_part"))
    parts = parts.select("part", F.coalesce(F.sum("of_part").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    inside = F.coalesce(F.sum("n_ids").over(W.partitionBy("part").orderBy("segment").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return sizes.withColumn("inside", inside).join(parts, "part").select("part", "segment", (F.col("base") + F.col("inside")).alias("start"))


def read_documents(spark: SparkSession, store: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the images."""
    schema = "part int, segment int, doc_id long, inside long, n_tokens long, ids_crc32 long"

    def make():
        def step(batch: pa.RecordBatch):
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                ids, n = Codes(row["image"]).all().astype("<u4"), np.array(row["lengths"], np.int64)
                ends = np.cumsum(n)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(ends - n, ends)]
                yield {"part": [row["part"]] * len(n), "segment": [row["segment"]] * len(n), "doc_id": row["doc_ids"], "inside": ends - n, "n_tokens": n, "ids_crc32": crc}

        return step

    docs = map_batches(prepare(spark).read.parquet(store), make, schema)
    return docs.join(segment_starts(spark, store), ["part", "segment"]).select("doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def tokens_at(spark: SparkSession, store: str, wanted: DataFrame) -> DataFrame:
    """doc_id, k, token: token k (from 0, the end id included) of the documents asked for in ``wanted`` (doc_id, k).

    Only the segments asked for travel, once per 4,096 places of them; places
    outside of a document, and doc_ids not stored, give no row.
    """
    segments = prepare(spark).read.parquet(store)
    docs = segments.select("part", "segment", F.posexplode("doc_ids").alias("p", "doc_id"), "lengths")
    docs = docs.select("part", "segment", "doc_id", F.expr("lengths[p]").alias("n"), F.expr("aggregate(slice(lengths, 1, p), 0L, (a, x) -> a + x)").alias("first"))
    found = wanted.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("k").cast("long").alias("k")).distinct().join(docs, "doc_id").where("k >= 0 and k < n")
    found = found.withColumn("place", F.col("first") + F.col("k"))
    asked = found.groupBy("part", "segment", F.floor(F.col("place") / 4096).alias("block")).agg(F.collect_list(F.struct("doc_id", "k", "place")).alias("asked"))

    def make():
        def step(batch: pa.RecordBatch):
            for row in batch.to_pylist():
                token = Codes(row["image"]).take([a["place"] for a in row["asked"]])
                yield {"doc_id": [a["doc_id"] for a in row["asked"]], "k": [a["k"] for a in row["asked"]], "token": token.astype(np.int64)}

        return step

    joined = asked.join(segments.select("part", "segment", "image"), ["part", "segment"]).select("asked", "image")
    return map_batches(joined, make, "doc_id long, k long, token long")
