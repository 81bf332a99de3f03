"""Mixture-controlled packing of documents into training sequences.

Documents are token queues by source.  Windows of ``WINDOW_SEQUENCES``
sequences are filled by deficit round-robin: in every window each source is
owed its share of the corpus's tokens plus what earlier windows still owe it,
and what it can't deliver is carried on.  Windows are filled from groups of about
``LOT_TOKENS`` tokens, each of which holds an equal range of every source's
tokens, whatever the order in which the table holds its documents; so the
groups are packed side by side, and the mixture holds in each full window.

1. Lots of consecutive documents are tokenised once; ids are stored compressed
   in the shared folder.
2. Prefix sums of the stored totals per lot and source tell which tokens of a
   source belong to which group; lots are cut there and dealt to the groups.
3. Each group is packed; only the last tokens of a group form sequences shorter
   than ``SEQUENCE``, cut at powers of two, so nothing is padded.

A null text counts as empty and packs as its end id alone.  A null source is a
queue of its own.  Repeated rows and null ids are packed row by row.  An empty
table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticksmith.llm.common import WordMemo, arrow_schema, map_batches, prepare, record_batch, stored
from ticksmith.llm.tokens import PIECES, byte_alphabet

SEQUENCE = 2048
WINDOW_SEQUENCES = 32
LOT_TOKENS = 3_000_000
END_ID = 1
#: words encoded one by one whose ids a worker keeps
MEMO_IDS = 100_000

LOT_SCHEMA = "lot long, totals array<struct<source:string,tokens:bigint>>, names array<string>, queue array<int>, doc_ids array<bigint>, lengths array<int>, ids binary"
PART_SCHEMA = "group long, lot long, source string, share double, doc_ids array<bigint>, starts array<bigint>, lengths array<bigint>, doc_tokens array<bigint>, ids binary"
PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"


def ranked_encoding(path: str):
    """The same vocabulary for the faster of the two libraries, where ids follow the order of merges; else none."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    alphabet = byte_alphabet()
    ids = {bytes(alphabet[c] for c in t): i for t, i in model["vocab"].items()}
    merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if any(a >= b for a, b in zip(merged, merged[1:])) or len(ids) != len(merged) + 256:
        return None
    return tiktoken.Encoding("vocabulary", pat_str=PIECES, mergeable_ranks=ids, special_tokens={})


class WordIds:
    """Token ids of texts by the library; each distinct word of a batch is encoded once.

    A single space between two words always begins a new piece, so a word and
    the space before it encode alone.  Words are encoded side by side, parted
    by a control character that is always a piece of its own; words it could
    touch, and other texts, are encoded one by one.
    """

    PART = "\x0b"
    #: words that the control character and the space before leave as they are
    PLAIN = r"^[^\s\x0b]$|^[^\s\x0b][^\x0b]*[^\s\x0b]$"
    #: white space, and a space that isn't alone between two words
    SPACE = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    LOOSE = f" {SPACE}|{SPACE} |^ | $"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranked = ranked_encoding(path)
        (self.part_id,) = self._encode(self.PART)
        self.others = WordMemo(lambda t: np.array(self._encode(t), np.uint32), MEMO_IDS)

    def _encode(self, text: str) -> list[int]:
        if self.ranked is None or any(s in text for s in self.special):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.ranked.encode_ordinary(text)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some distinct words, each after a space, and where each begins (and the last ends)."""
        # Python's and the pattern's white space beyond ASCII differ in nothing but a few characters, which go one by one
        plain = pc.and_(pc.match_substring_regex(words, self.PLAIN), pc.string_is_ascii(words))
        latin = pc.match_substring_regex(words, r"^[\x21-\x7e\x{a1}-\x{17f}]+$")
        good = pc.or_(plain, latin).to_numpy(zero_copy_only=False)
        counts, flat = np.zeros(len(words), np.int64), np.zeros(0, np.uint32)
        if good.any():
            some = words.filter(pa.array(good))
            joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some), self.PART + " ")
            ids = np.array(self._encode(" " + joined[0].as_py()), np.uint32)
            ends = np.append(np.flatnonzero(ids == self.part_id), len(ids))
            flat, counts[good] = ids[ids != self.part_id], np.diff(ends, prepend=-1) - 1
        rest = np.flatnonzero(~good)
        if len(rest):
            found = [self.others[" " + w] for w in words.take(pa.array(rest)).to_pylist()]
            flat = np.insert(flat, np.repeat(np.cumsum(counts)[rest], [len(x) for x in found]), np.concatenate(found))
            counts[rest] = [len(x) for x in found]
        return flat, np.concatenate([[0], np.cumsum(counts)])

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring_regex(texts, self.LOOSE).to_numpy(zero_copy_only=False).copy()
        for s in self.special:
            whole |= pc.match_substring(texts, s).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(pc.if_else(pa.array(whole), "", texts), " ")
        offsets = lists.offsets.to_numpy()
        words = pc.list_flatten(lists).dictionary_encode()
        flat, starts = self._words(words.dictionary)
        # the first word of a text has no space before it
        place = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        firsts, code = np.unique(place[offsets[:-1]], return_inverse=True)
        bare = [self.others[w] for w in words.dictionary.take(pa.array(firsts)).to_pylist()]
        place[offsets[:-1]] = len(words.dictionary) + code
        starts = np.concatenate([starts, starts[-1] + np.cumsum([len(x) for x in bare])])
        flat = np.concatenate([flat, *bare])
        n = np.diff(starts)[place]
        ends = np.cumsum(n)
        flat = flat[np.arange(ends[-1]) + np.repeat(starts[place] - (ends - n), n)]
        bounds = np.concatenate([[0], ends])[offsets]
        out = [flat[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
        for k in np.flatnonzero(whole):
            out[k] = np.array(self._encode(texts[int(k)].as_py()), np.uint32)
        return out


def tokenised_lots(docs: DataFrame, path: str, end_id: int = END_ID, lot_tokens: int = LOT_TOKENS) -> DataFrame:
    """Lots of consecutive documents with their ids; a retried task makes the same lots."""

    def run(batches):
        words, squeeze, task = WordIds(path), zstandard.ZstdCompressor(level=1), TaskContext.get().partitionId()
        held: list[tuple] = []
        tokens = made = 0

        def lot():
            nonlocal held, tokens, made
            names = sorted({s for _, s, _ in held}, key=lambda s: (s is not None, s))
            code = {s: k for k, s in enumerate(names)}
            totals = defaultdict(int)
            for _, s, ids in held:
                totals[s] += len(ids)
            row = {
                "lot": [task << 24 | made], "totals": [[{"source": s, "tokens": n} for s, n in totals.items()]], "names": [names],
                "queue": [[code[s] for _, s, _ in held]], "doc_ids": [[d for d, _, _ in held]], "lengths": [[len(i) for _, _, i in held]],
                "ids": [squeeze.compress(np.concatenate([i for _, _, i in held]).astype("<u4").tobytes())],
            }
            held, tokens, made = [], 0, made + 1
            return record_batch(row, target)

        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), words.ids(batch.column(2)))
            for doc_id, source, ids in rows:
                held.append((doc_id, source, np.append(ids, np.uint32(end_id))))
                tokens += len(ids) + 1
                if tokens >= lot_tokens:
                    yield lot()
        if held:
            yield lot()

    target = arrow_schema(docs.sparkSession, LOT_SCHEMA)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text").mapInArrow(run, LOT_SCHEMA)


def fill_windows(avail: np.ndarray, share: np.ndarray, owed: np.ndarray, window: int):
    """Deficit round-robin: yields the tokens each queue delivers to one window after the other."""
    avail, owed = avail.astype(np.int64).copy(), owed.astype(np.float64).copy()
    while (left := int(avail.sum())) > 0:
        room = min(window, left)
        owed += share * room
        give = np.minimum(np.maximum(np.floor(owed), 0).astype(np.int64), avail)
        over = int(give.sum()) - room
        if over > 0:
            # more is owed than fits: each queue waits for its part of the excess
            cut = np.minimum(give, np.ceil(give * (over / give.sum())).astype(np.int64))
            give -= cut
        for k in np.argsort(give - owed, kind="stable"):
            # the rest goes to the queues that are owed most and still hold tokens
            more = min(room - int(give.sum()), int(avail[k] - give[k]))
            if more > 0 and owed[k] > give[k]:
                give[k] += min(more, max(1, int(owed[k] - give[k])))
        if (rest := room - int(give.sum())) > 0:
            for k in np.argsort(give - avail, kind="stable"):
                more = min(rest, int(avail[k] - give[k]))
                give[k] += more
                rest -= more
        owed -= give
        avail -= give
        yield give


def sequence_lengths(tokens: int, sequence: int) -> list[int]:
    """Whole sequences, then powers of two for the rest: nothing is padded."""
    lengths = [sequence] * (tokens // sequence)
    rest = tokens % sequence
    return lengths + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


def cut_lot(row: dict) -> list[dict]:
    """A lot's documents by source and group, cut where a group ends: group g has the tokens from T g // G to T (g + 1) // G of a source of T."""
    ids = np.frombuffer(zstandard.ZstdDecompressor().decompress(row["ids"]), "<u4")
    squeeze = zstandard.ZstdCompressor(level=1)
    lengths, queue, doc_ids = np.array(row["lengths"], np.int64), np.array(row["queue"], np.int64), row["doc_ids"]
    begin = np.cumsum(lengths) - lengths
    plan, out = {p["source"]: p for p in row["plan"]}, []
    for k, source in enumerate(row["names"]):
        line, p = np.flatnonzero(queue == k), plan[source]
        every, groups = p["of_source"], p["groups"]
        n = lengths[line]
        own = np.concatenate([ids[begin[d] : begin[d] + lengths[d]] for d in line])
        ends = np.cumsum(n)
        at, total = 0, int(ends[-1])
        while at < total:
            # the group that holds this token, and where it ends
            group = ((p["before"] + at + 1) * groups - 1) // every
            stop = min(total, every * (group + 1) // groups - p["before"])
            a, b = int(np.searchsorted(ends, at, "right")), int(np.searchsorted(ends, stop, "left"))
            starts, parts = np.zeros(b - a + 1, np.int64), n[a : b + 1].copy()
            parts[-1] = stop - (ends[b] - n[b])
            starts[0] = at - (ends[a] - n[a])
            parts[0] -= starts[0]
            part = {"group": group, "lot": row["lot"], "source": source, "share": every / p["of_all"], "ids": squeeze.compress(own[at:stop].tobytes())}
            out.append(part | {"doc_ids": [doc_ids[d] for d in line[a : b + 1]], "starts": starts, "lengths": parts, "doc_tokens": n[a : b + 1]})
            at = stop
    return out


def pack_group(parts: list[dict], sequence: int, window: int) -> dict:
    """Pieces of one group, column by column."""
    expand = zstandard.ZstdDecompressor()
    parts = sorted(parts, key=lambda p: (p["source"] is not None, p["source"] or "", p["lot"]))
    names = list(dict.fromkeys(p["source"] for p in parts))
    share = {p["source"]: p["share"] for p in parts}
    queue = np.repeat([names.index(p["source"]) for p in parts], [len(p["lengths"]) for p in parts])
    doc_ids = [d for p in parts for d in p["doc_ids"]]
    starts, lengths, doc_tokens = (np.array([x for p in parts for x in p[c]], np.int64) for c in ("starts", "lengths", "doc_tokens"))
    ids = np.concatenate([np.frombuffer(expand.decompress(p["ids"]), "<u4") for p in parts])
    begin = np.cumsum(lengths) - lengths
    line = [np.flatnonzero(queue == k) for k in range(len(names))]
    head, used = [0] * len(names), [0] * len(names)
    avail = np.array([lengths[q].sum() for q in line], np.int64)
    sizes = iter(sequence_lengths(int(avail.sum()), sequence))
    out = {c: [] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source")}
    number, size, offset = parts[0]["group"] << 20, next(sizes, 0), 0
    turns = 0
    for give in fill_windows(avail, np.array([share[s] for s in names]), np.zeros(len(names)), window):
        for k in np.roll(np.arange(len(names)), -turns):
            due = int(give[k])
            while due:
                d, start = line[k][head[k]], used[k]
                n = min(due, int(lengths[d]) - start, size - offset)
                at = int(begin[d]) + start
                out["doc_id"].append(doc_ids[d])
                out["start"].append(int(starts[d]) + start)
                out["length"].append(n)
                out["ids_crc32"].append(zlib.crc32(ids[at : at + n].tobytes()))
                out["doc_tokens"].append(int(doc_tokens[d]))
                out["sequence_id"].append(number)
                out["offset"].append(offset)
                out["source"].append(names[k])
                due, offset, used[k] = due - n, offset + n, start + n
                if used[k] == lengths[d]:
                    head[k], used[k] = head[k] + 1, 0
                if offset == size:
                    number, size, offset = number + 1, next(sizes, 0), 0
        turns += 1
    return out


def pack(docs: DataFrame, path: str, sequence: int = SEQUENCE, window_sequences: int = WINDOW_SEQUENCES, lot_tokens: int = LOT_TOKENS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source."""
    spark = prepare(docs.sparkSession)
    lots = stored(tokenised_lots(docs, path, lot_tokens=lot_tokens), "packing-lots")
    per = lots.select("lot", F.inline("totals"))
    every = per.agg(F.sum("tokens").alias("of_all")).withColumn("groups", F.ceil(F.col("of_all") / lot_tokens).cast("long"))
    sources = per.groupBy("source").agg(F.sum("tokens").alias("of_source")).crossJoin(every)
    before = W.partitionBy("source").orderBy("lot").rowsBetween(W.unboundedPreceding, -1)
    own = per.select("lot", "source", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("before"))
    plan = own.join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    plan = stored(plan.groupBy("lot").agg(F.collect_list(F.struct("source", "of_source", "of_all", "groups", "before")).alias("plan")), "packing-plan")

    def make():
        def step(batch: pa.RecordBatch):
            for k in range(batch.num_rows):
                for part in cut_lot(batch.slice(k, 1).to_pylist()[0]):
                    yield {c: [v] for c, v in part.items()}

        return step

    target = arrow_schema(spark, PIECE_SCHEMA)

    def packed(group: pa.Table) -> pa.Table:
        return pa.Table.from_batches([record_batch(pack_group(group.to_pylist(), sequence, sequence * window_sequences), target)])

    parts = map_batches(lots.drop("totals").join(plan, "lot"), make, PART_SCHEMA)
    return parts.groupBy("group").applyInArrow(packed, PIECE_SCHEMA)
