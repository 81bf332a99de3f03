"""Katz backoff language model: training counts, discounts, backoff weights and scores.

Tokens are words (A-Z lower-cased, split at white space) and one end per text;
the first token's histories are begin symbols.  A token seen c times after its
history h of up to ``order`` - 1 tokens (c > 0) has probability
g(h) * d(c) * c / c(h); any other gets alpha(h) times its probability after the
history without its first token, and so on down to single tokens, where the
one unknown event gets what the discounted counts leave.  d is Good-Turing for
c up to ``GT_MAX``; alpha(h) makes the probabilities after h sum to exactly
one.  Where no mass is left for unseen tokens (all counts above ``GT_MAX``),
g(h) = c(h) / (c(h) + 1) frees some.

Counts never pass through one task or the driver.  Texts are cut into blocks
of tokens; a block sends each of its distinct n-grams once, as sorted hashes
in buckets of a hash range, with its training count.  A bucket adds up the
counts of all blocks and answers each block with the totals of its n-grams,
which of them it owns (each n-gram has one owner) and which other blocks hold.  Owners sum the
discounted mass and the lower-order mass per history; histories that occur in
one block only are finished there, the others are added up in buckets the same
way, which answer with the backoff weight; this goes from the lowest order up,
as a history's lower-order mass needs the weights below.  The model tables (n-gram counts and
backoff weights per bucket) are written as Parquet in the shared folder.  Only counts of counts, the number of training
tokens and of types reach the driver.

``order`` is a parameter; the query's is ``ORDER``.  What is stored and shuffled
grows with it, as most longer n-grams are distinct: at order 3 the check tool
stopped the query for its disk (figures in the README).

Null or empty texts hold the end token alone.  Without training rows every
token is unknown with probability one (score 0).  Repeated rows are scored row
by row; a null doc_id counts as training (its remainder isn't 0).  Extra columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.common import ODD, U64, arrow_schema, hashed_words, map_batches, mix64, prepare, raw_texts, record_batch, stored, word_hashes

ORDER = 2
GT_MAX = 5
BLOCK_TOKENS = 1_500_000
#: expected n-grams of one order in a bucket
BUCKET_GRAMS = 1_000_000
#: flags of an answer: this block owns the n-gram; other blocks hold it too
OWNED, SHARED = 1, 2
END = U64(xxhash.xxh64_intdigest(b"end of text", 1))
BEGIN = U64(xxhash.xxh64_intdigest(b"begin of text", 2))

BLOCK_SCHEMA = "block long, doc_ids array<bigint>, rows array<bigint>, held_out array<boolean>, lengths array<int>, words binary, codes binary"
GRAM_SCHEMA = "block long, level int, bucket int, keys binary, counts binary"


def squeeze(a: np.ndarray) -> bytes:
    """Bytes of an integer array, plane by plane, compressed; planes of zeros cost nothing."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def expand(data: bytes, dtype) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).reshape(-1)


def squeeze_sorted(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=U64(0)))


def expand_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(expand(data, U64), dtype=U64)


def begins(length: int) -> np.uint64:
    """The hash of a history of begin symbols alone."""
    h = BEGIN
    for _ in range(length - 1):
        h = mix64(np.array([h * ODD + BEGIN]))[0]
    return h


class Level:
    """The distinct n-grams of one length in a block.

    ``at`` is each token's place among them (the n-gram that ends with it),
    ``shown`` a token that shows each, ``history`` each token's history among
    the n-grams one shorter; the place after the last is the begin history.
    ``total``, ``free`` and ``alpha`` belong to the histories that end with an
    n-gram of this level.
    """

    def __init__(self, keys, shown, at, history=None):
        self.keys, self.shown, self.at, self.history = keys, shown, at, history
        self.counts = self.owned = self.shared = self.total = self.free = self.alpha = None


class Block:
    """One block's tokens as codes into its sorted distinct words, and its n-grams up to ``order``."""

    def __init__(self, words: np.ndarray, codes: np.ndarray, lengths: np.ndarray, held_out: np.ndarray, order: int):
        self.held_out = held_out
        self.starts = np.cumsum(lengths) - lengths
        self.train = np.repeat(~held_out, lengths)
        token, run = words[codes], words[codes]
        self.end = int(np.searchsorted(words, END))
        self.levels = [Level(words, np.unique(codes, return_index=True)[1], codes)]
        for n in range(2, order + 1):
            shorter, before = self.levels[-1], np.roll(run, 1)
            before[self.starts] = begins(n - 1)
            run = mix64(before * ODD + token)
            history = np.roll(shorter.at, 1)
            history[self.starts] = len(shorter.keys)
            self.levels.append(Level(*np.unique(run, return_index=True, return_inverse=True), history))

    def asked(self, n: int):
        """The trained histories of n tokens that other blocks hold too: sorted hashes, and their places."""
        level = self.levels[n - 1]
        place = np.flatnonzero(level.shared & (level.total > 0))
        keys = np.append(level.keys, begins(n))[place]
        order = np.argsort(keys, kind="stable")
        return keys[order], place[order]


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the key, so sorted keys stay sorted across them."""
    return ((keys >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)


def make_blocks(docs: DataFrame, block_tokens: int) -> DataFrame:
    """Blocks of consecutive texts as codes into their distinct words; a retried task makes the same blocks."""
    target = arrow_schema(docs.sparkSession, BLOCK_SCHEMA)

    def run(batches):
        memo, task = word_hashes(), TaskContext.get().partitionId()
        held: list[tuple] = []
        tokens = made = row_no = 0

        def block():
            nonlocal held, tokens, made
            words, codes = np.unique(np.concatenate([h for *_, h in held]), return_inverse=True)
            row = {
                "block": [task << 24 | made], "doc_ids": [[d for _, d, _, _ in held]], "rows": [[r for r, *_ in held]], "held_out": [[o for _, _, o, _ in held]],
                "lengths": [[len(h) for *_, h in held]], "words": [squeeze_sorted(words)], "codes": [squeeze(codes.astype(np.uint32))],
            }
            held, tokens, made = [], 0, made + 1
            return record_batch(row, target)

        for batch in batches:
            for doc_id, out, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw_texts(batch.column(2))):
                h = np.append(hashed_words(text, memo), END)
                held.append((task << 40 | row_no, doc_id, out, h))
                row_no += 1
                tokens += len(h)
                if tokens >= block_tokens:
                    yield block()
        if held:
            yield block()

    return docs.mapInArrow(run, BLOCK_SCHEMA)


def open_block(row: dict, order: int) -> Block:
    words, codes = expand_sorted(row["words"]), expand(row["codes"], np.uint32).astype(np.int64)
    return Block(words, codes, np.array(row["lengths"], np.int64), np.array(row["held_out"], bool), order)


def grams_of(blocks: DataFrame, buckets: int, order: int) -> DataFrame:
    """What each block sends to the buckets: its distinct n-grams and their training counts."""

    def make():
        def step(batch: pa.RecordBatch):
            for row in batch.to_pylist():
                b, out = open_block(row, order), []
                for level, grams in enumerate(b.levels, 1):
                    keys = grams.keys
                    counts = np.bincount(grams.at, weights=b.train, minlength=len(keys)).astype(np.uint32)
                    cuts = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1))
                    for k in np.flatnonzero(np.diff(cuts)):
                        s = slice(cuts[k], cuts[k + 1])
                        out.append((row["block"], level, int(k), squeeze_sorted(keys[s]), squeeze(counts[s])))
                yield {c: list(v) for c, v in zip(("block", "level", "bucket", "keys", "counts"), zip(*out))}

        return step

    return map_batches(blocks, make, GRAM_SCHEMA)


def answer_buckets(grams: DataFrame) -> DataFrame:
    """Totals per bucket: each block's answer (totals and ownership of its n-grams), and a row of statistics."""
    schema = "block long, level int, bucket int, totals binary, owned binary, stats array<bigint>"
    target = arrow_schema(grams.sparkSession, schema)

    def add_up(group: pa.Table) -> pa.Table:
        rows = group.select(["block", "level", "bucket", "keys", "counts"]).to_pylist()
        rows.sort(key=lambda r: r["block"])
        keys = [expand_sorted(r["keys"]) for r in rows]
        counts = np.concatenate([expand(r["counts"], np.uint32) for r in rows])
        every = np.concatenate(keys)
        _, at = np.unique(every, return_inverse=True)
        totals = np.bincount(at, weights=counts).astype(np.uint64)
        # the first block that trains on an n-gram owns it
        trained = np.flatnonzero(counts)
        owned = np.zeros(len(at), np.uint8)
        owned[trained[np.unique(every[trained], return_index=True)[1]]] = OWNED
        owned[np.bincount(at)[at] > 1] |= SHARED
        spread, out, p = totals[at], [], 0
        level, bucket = rows[0]["level"], rows[0]["bucket"]
        for r, k in zip(rows, keys):
            s = slice(p, p + len(k))
            p += len(k)
            out.append({"block": r["block"], "level": level, "bucket": bucket, "totals": squeeze(spread[s]), "owned": squeeze(owned[s]), "stats": None})
        of = np.bincount(np.minimum(totals, GT_MAX + 2).astype(np.int64), minlength=GT_MAX + 3)
        stats = [int(totals.sum()), int((totals > 0).sum()), *map(int, of[1 : GT_MAX + 2])]
        out.append({"block": -1, "level": level, "bucket": bucket, "totals": None, "owned": None, "stats": stats})
        return pa.Table.from_pylist(out, schema=target)

    return grams.groupBy("level", "bucket").applyInArrow(add_up, schema)


def good_turing(of: list[int]) -> np.ndarray:
    """d(0..GT_MAX+1): the factor for each count, 1 above GT_MAX; ``of[r - 1]`` n-grams occur r times."""
    d = np.ones(GT_MAX + 2)
    n = [0, *of, 0, 0]
    common = (GT_MAX + 1) * n[GT_MAX + 1] / n[1] if n[1] else 1.0
    for r in range(1, GT_MAX + 1):
        if n[r] and n[r + 1] and common < 1:
            value = ((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common)
            if 0 < value < 1:
                d[r] = value
                continue
        d[r] = 1 - 0.5 / r  # too few counts for the estimate: an absolute discount
    return d


class Model:
    """What every task needs: totals, types and the discounts of each order."""

    def __init__(self, stats: list[list[int]]):
        self.order = len(stats)
        self.tokens, self.types = stats[0][:2]
        self.d = [good_turing(of[2:]) for of in stats]
        # discounted unigram mass, in tokens
        kept = self.tokens - sum(n * r * (1 - self.d[0][r]) for r, n in enumerate(stats[0][2 : 2 + GT_MAX], 1))
        self.scale = 1.0 if kept < self.tokens else self.tokens / (self.tokens + 1)
        self.unknown = 1 - self.scale * kept / self.tokens if self.tokens else 1.0

    def single(self, c: np.ndarray) -> np.ndarray:
        """Probabilities of single tokens."""
        return np.where(c > 0, self.scale * self.mass(1, c) / max(self.tokens, 1), self.unknown)

    def mass(self, n: int, c: np.ndarray) -> np.ndarray:
        """Discounted counts of n-grams."""
        return self.d[n - 1][np.minimum(c, GT_MAX + 1)] * c

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.1) / (self.tokens + 0.1 * (self.types + 1)))


#: replies that hold the weights of the histories of n tokens have this more than n as their level
WEIGHTS = 100


def read_block(row: dict, replies: list[dict], model: Model) -> Block:
    """A block with the totals of its n-grams, and the weights of its histories as far as they are answered."""
    b = open_block(row, model.order)
    of: dict[int, list[dict]] = {}
    for r in sorted(replies, key=lambda r: (r["level"], r["bucket"])):
        of.setdefault(r["level"], []).append(r)
    for n, level in enumerate(b.levels, 1):
        counts, flags = (np.concatenate([expand(r[c], t) for r in of[n]]) for c, t in (("totals", np.uint64), ("owned", np.uint8)))
        level.counts, level.owned = counts.astype(np.int64), flags & OWNED > 0
        # a text's beginning is a history as often as its end is a token
        ends = b.levels[0].counts[b.end]
        level.total = np.append(level.counts, ends)
        level.shared = np.append(flags & SHARED > 0, b.levels[0].shared[b.end] if n > 1 else flags[b.end] & SHARED > 0)
    for n in range(1, model.order):
        level = b.levels[n - 1]
        if n > 1 and b.levels[n - 2].alpha is None:
            break
        known, given = True, of.get(WEIGHTS + n, [])
        place = b.asked(n)[1]
        if len(place) and not given:
            known = False
        if known:
            alpha = backoff(*history_sums(b, n, model), level.total, n + 1, model)
            if given:
                alpha[place] = np.concatenate([expand(r["totals"], np.float64) for r in given])
            level.free, level.alpha = np.where(alpha < 0, level.total / (level.total + 1.0), 1.0), np.abs(alpha)
    return b


def seen(b: Block, n: int, some: np.ndarray, model: Model) -> np.ndarray:
    """Probabilities of the last token of some tokens' n-grams, all of them seen in training."""
    level = b.levels[n - 1]
    c = level.counts[level.at[some]]
    if n == 1:
        return model.single(c)
    h, shorter = level.history[some], b.levels[n - 2]
    return shorter.free[h] * model.mass(n, c) / np.maximum(shorter.total[h], 1)


def history_sums(b: Block, n: int, model: Model):
    """Per history of n tokens, of the n-grams one longer that this block owns: how many occur 1 .. GT_MAX times and the
    occurrences of the others; and the mass of their last tokens one order lower.  What is seen is seen there too."""
    longer, size = b.levels[n], len(b.levels[n - 1].keys) + 1
    use = longer.owned & (longer.counts > 0)
    some, c = longer.shown[use], longer.counts[use]
    h = longer.history[some]
    times = np.stack([*(np.bincount(h[c == r], minlength=size) for r in range(1, GT_MAX + 1)), np.bincount(h, weights=np.where(c > GT_MAX, c, 0), minlength=size)])
    return times.astype(np.int64), np.bincount(h, weights=seen(b, n, some, model), minlength=size)


def backoff(times: np.ndarray, lower: np.ndarray, total: np.ndarray, n: int, model: Model) -> np.ndarray:
    """alpha of each history of n-grams, negative where g isn't one; 1 for histories without training."""
    mass = model.d[n - 1][1 : GT_MAX + 1] * np.arange(1, GT_MAX + 1) @ times[:GT_MAX] + times[GT_MAX]
    with np.errstate(divide="ignore", invalid="ignore"):
        share = mass / total
        full = share >= 1 - 1e-12
        alpha = (1 - np.where(full, total / (total + 1.0), 1.0) * share) / (1 - lower)
    return np.where(total > 0, np.where(full, -alpha, alpha), 1.0)


def probabilities(b: Block, model: Model) -> np.ndarray:
    """The probability of each token: from single tokens up, the longer n-gram where it was seen, else the shorter one's with the weight of its history."""
    p = model.single(b.levels[0].counts[b.levels[0].at])
    every = np.arange(len(p))
    for n in range(2, model.order + 1):
        level, shorter = b.levels[n - 1], b.levels[n - 2]
        p = np.where(level.counts[level.at] > 0, seen(b, n, every, model), shorter.alpha[level.history] * p)
    return p


def answer_histories(parts: DataFrame, n: int, model: Model) -> DataFrame:
    """alpha of every history of n tokens for each block that asks, in the order it asked; histories are added up per bucket."""
    schema = "block long, level int, bucket int, totals binary, owned binary"
    target = arrow_schema(parts.sparkSession, schema)

    def add_up(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["block"])
        keys = [expand_sorted(r["keys"]) for r in rows]
        _, first, at = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        times = np.concatenate([expand(r["times"], np.uint32).reshape(GT_MAX + 1, -1) for r in rows], axis=1)
        times = np.stack([np.bincount(at, weights=t) for t in times])
        lower = np.bincount(at, weights=np.concatenate([expand(r["lower"], np.float64) for r in rows]))
        total = np.concatenate([expand(r["total"], np.uint32) for r in rows])[first].astype(np.int64)
        alpha, out, p = backoff(times, lower, total, n + 1, model)[at], [], 0
        for r, k in zip(rows, keys):
            out.append({"block": r["block"], "level": WEIGHTS + n, "bucket": r["bucket"], "totals": squeeze(alpha[p : p + len(k)]), "owned": None})
            p += len(k)
        return pa.Table.from_pylist(out, schema=target)

    return parts.groupBy("bucket").applyInArrow(add_up, schema)


def katz(docs: DataFrame, order: int = ORDER, buckets: int | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    if order < 1:
        raise ValueError("the order is at least 1")
    spark = prepare(docs.sparkSession)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    if buckets is None:
        size = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
        buckets = max(8, int(size / 6 / BUCKET_GRAMS) + 1)
    blocks = stored(make_blocks(rows, block_tokens), "katz-blocks")
    answers = stored(answer_buckets(grams_of(blocks, buckets, order)), "katz-counts")
    stats = {r["level"]: r["s"] for r in answers.where("block < 0").groupBy("level").agg(F.array(*[F.sum(F.col("stats")[k]) for k in range(GT_MAX + 3)]).alias("s")).collect()}
    model = Model([stats.get(n, [0] * (GT_MAX + 3)) for n in range(1, order + 1)])
    replies = answers.where("block >= 0").drop("stats")
    for n in range(1, order):
        parts = shared_histories(blocks, replies, n, buckets, model)
        replies = replies.unionByName(stored(answer_histories(parts, n, model), f"katz-histories-{n}"))

    schema = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    target = arrow_schema(spark, schema)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return target.empty_table()
        row = left.to_pylist()[0]
        b = read_block(row, right.to_pylist(), model)
        c, cut = b.levels[0].counts[b.levels[0].at], b.starts
        base = np.add.reduceat(model.base(c), cut) if model.tokens else np.zeros(len(cut))
        known, own = np.add.reduceat((c > 0).astype(np.int64), cut), np.add.reduceat(np.log10(probabilities(b, model)), cut)
        return pa.table([row["rows"], row["doc_ids"], row["held_out"], np.array(row["lengths"], np.int64), known, base, own], schema=target)

    scored = blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(score, schema)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def shared_histories(blocks: DataFrame, replies: DataFrame, n: int, buckets: int, model: Model) -> DataFrame:
    """What each block adds to the histories of n tokens that other blocks hold too."""
    schema = "block long, bucket int, keys binary, times binary, lower binary, total binary"
    target = arrow_schema(blocks.sparkSession, schema)

    def parts(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return target.empty_table()
        row = left.to_pylist()[0]
        b = read_block(row, right.to_pylist(), model)
        times, lower = history_sums(b, n, model)
        total = b.levels[n - 1].total
        keys, order = b.asked(n)
        cuts = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1))
        out = []
        for k in np.flatnonzero(np.diff(cuts)):
            o = order[cuts[k] : cuts[k + 1]]
            sums = squeeze(np.ascontiguousarray(times[:, o]).astype(np.uint32).reshape(-1))
            out.append({"block": row["block"], "bucket": int(k), "keys": squeeze_sorted(keys[cuts[k] : cuts[k + 1]]), "times": sums, "lower": squeeze(lower[o]), "total": squeeze(total[o].astype(np.uint32))})
        return pa.Table.from_pylist(out, schema=target)

    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(parts, schema)
