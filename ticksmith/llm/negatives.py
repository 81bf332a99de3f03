"""Hard negatives by rotated one-bit codes with stored code-vector alignment.

Every vector is rotated by one fixed random rotation and stored as the signs of
its coordinates, with its length and its alignment: the inner product with the
unit vector of its own signs.  For a query, popcounts of the code against the
bit planes of the rotated, quantised query estimate the query's inner product
with that unit vector, up to a known rounding error.  The rest of the score is
the product of two residuals, each orthogonal to the unit vector, and so at
most the product of their lengths (Cauchy-Schwarz).  Together they give an
interval that holds the score without exception.  Vectors whose interval ends
below what is needed are passed over; the others are scored in integers, so the
result is exact, not probable.

Vectors are dealt by a hash of their content into blocks of about
``BLOCK_ROWS``, each one row of the stored index; anchors are packed
``ANCHOR_ROWS`` at a time and each pack meets every block, one at a time, so a
task holds one block and one pack.  A block returns at most what the result can
use (``n_positives``, or ``n_negatives`` per positive), and windows over these
find the answer.  A label may hold any share of the rows.

Rows take no part if vec_id, label or vector is null, if a component is null or
not finite, or if an integer component is so large (over sqrt(2^62 / length))
that a score might not fit a long.  Equal rows count once; rows that share a
vec_id are not each other's positives or negatives.  Vectors meet vectors of
their own length; empty ones all score 0.  An empty table gives an empty
result.  Extra columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticksmith.llm.common import arrow_schema, map_batches, prepare, record_batch, stored

#: vectors of a block of the index, about
BLOCK_ROWS = 16_384
#: anchors of a pack, about
ANCHOR_ROWS = 1_024
#: bits to which a rotated query is quantised
QUERY_BITS = 6
SEED = 20_11

ROW_SCHEMA = "vec_id long, label long, row long, width int, ints array<bigint>"
INDEX_SCHEMA = "width int, block long, ids binary, labels binary, row_keys binary, ints binary, codes binary, alignment binary, norm binary"
PACK_SCHEMA = "width int, pack long, ids binary, labels binary, row_keys binary, ints binary, positives binary, n_positives binary"
FOUND = "array<struct<positive_id:bigint,positive_row:bigint,positive_score:bigint>>"
POSITIVE_SCHEMA = "anchor_id long, anchor_row long, anchor_label long, width int, positive_id long, positive_row long, positive_score long"
NEGATIVE_SCHEMA = "anchor_id long, anchor_row long, positive_id long, positive_row long, positive_score long, negative_id long, negative_row long, negative_score long"


def integer_rows(embeddings: DataFrame) -> DataFrame:
    """The distinct rows that take part, with labels and components as the scores use them."""
    fits = "forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where("vec_id is not null and label is not null and embedding is not null").where(fits)
    rows = rows.where("forall(embedding, x -> abs(256 * x) <= sqrt(4611686018427387904d / greatest(size(embedding), 1)) - 1)")
    rows = rows.select(
        "vec_id", F.expr("case when vec_id % 7 = 0 then (label + 1) % 10 else label end").alias("label"),
        F.expr("transform(embedding, x -> floor(256 * x))").alias("ints"), F.size("embedding").alias("width"),
    )
    return rows.select("vec_id", "label", F.xxhash64("label", "ints").alias("row"), "width", "ints").distinct()


@lru_cache(8)
def rotation(width: int) -> np.ndarray:
    """One fixed random rotation per vector length."""
    gauss = np.random.default_rng([SEED, width]).standard_normal((width, width))
    q, r = np.linalg.qr(gauss)
    return q * np.sign(np.diag(r))


def sign_codes(bits: np.ndarray) -> np.ndarray:
    """Rows of truth values as 64-bit words, filled up with zeros."""
    n, width = bits.shape
    padded = np.zeros((n, -(-width // 64) * 64), np.uint8)
    padded[:, :width] = bits
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


class Index:
    """One block: codes, lengths and alignments for the intervals; integers for the scores."""

    def __init__(self, ids, labels, rows, ints, codes, alignment, norm):
        self.ids, self.labels, self.rows, self.ints = ids, labels, rows, ints
        self.codes, self.alignment, self.norm = codes, alignment, norm
        self.residual = np.sqrt(np.maximum(norm**2 - alignment**2, 0))
        width = ints.shape[1]
        self.ones = np.bitwise_count(codes).sum(1, dtype=np.int64)
        self.rotation = rotation(width) if width else np.zeros((0, 0))
        #: integer products that doubles hold exactly
        self.largest = int(np.abs(ints).max(initial=0))
        self.doubles = ints.astype(np.float64)

    @classmethod
    def build(cls, ids, labels, rows, ints):
        """By label, so that the rows of one label lie together."""
        order = np.lexsort((rows, ids, labels))
        ids, labels, rows, ints = ids[order], labels[order], rows[order], ints[order]
        width = ints.shape[1]
        turned = ints @ (rotation(width).T if width else np.zeros((0, 0)))
        alignment = np.abs(turned).sum(1) / np.sqrt(max(width, 1))
        return cls(ids, labels, rows, ints, sign_codes(turned >= 0), alignment, np.sqrt((turned**2).sum(1)))

    def intervals(self, query: np.ndarray, some: slice) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the scores of some rows: estimate by popcounts, rounding error, residuals."""
        width = len(query)
        if not width:
            zero = np.zeros(len(self.ids[some]))
            return zero, zero
        turned = self.rotation @ query
        low, high = turned.min(), turned.max()
        step = (high - low) / ((1 << QUERY_BITS) - 1) or 1.0
        levels = np.rint((turned - low) / step).astype(np.int64)
        off = np.abs(turned - (low + step * levels)).sum()
        codes, chosen = self.codes[some], np.zeros(len(self.ids[some]), np.int64)
        for bit in range(QUERY_BITS):
            plane = sign_codes((levels >> bit & 1).astype(np.uint8)[None, :])[0]
            chosen += np.bitwise_count(codes & plane).sum(1, dtype=np.int64) << bit
        # the sum of the quantised query over the code's signs
        along = low * (2 * self.ones[some] - width) + step * (2 * chosen - levels.sum())
        root = np.sqrt(width)
        near, far = (along - off) / root, (along + off) / root
        length = float(np.sqrt((turned**2).sum()))
        least = np.where((near < 0) & (far > 0), 0.0, np.minimum(np.abs(near), np.abs(far)))
        rest = np.sqrt(np.maximum(length**2 - least**2, 0)) * self.residual[some]
        slack = 1e-9 * (length * self.norm[some] + 1) + 1e-6
        return self.alignment[some] * near - rest - slack, self.alignment[some] * far + rest + slack

    def scores(self, query: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Exact integer products with the rows at some places."""
        if self.largest * int(np.abs(query).max(initial=0)) * max(len(query), 1) < 1 << 53:
            return (self.doubles[at] @ query.astype(np.float64)).astype(np.int64)
        return self.ints[at] @ query

    def best(self, at: np.ndarray, scores: np.ndarray, n: int) -> np.ndarray:
        """The first n of some rows: higher scores first, ties by vec_id."""
        if len(at) > 4 * n:
            # only scores from the n-th highest on can be among them
            keep = np.flatnonzero(scores >= np.partition(scores, len(scores) - n)[len(scores) - n])
        else:
            keep = np.arange(len(at))
        return keep[np.lexsort((self.rows[at[keep]], self.ids[at[keep]], -scores[keep]))[:n]]

    def positives(self, anchor_id: int, label: int, query: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the first n rows of the label."""
        first, last = np.searchsorted(self.labels, [label, label + 1])
        low, high = self.intervals(query, slice(first, last))
        other = self.ids[first:last] != anchor_id
        sure = low[other]
        need = np.partition(sure, len(sure) - n)[len(sure) - n] if len(sure) > n else -np.inf
        at = first + np.flatnonzero(other & (high >= need))
        scores = self.scores(query, at)
        keep = self.best(at, scores, n)
        return at[keep], scores[keep]

    def negatives(self, anchor_id: int, label: int, query: np.ndarray, ranges: list[tuple[int, int]], n: int):
        """For each range of scores, places and scores of the first n rows of other labels within it."""
        low, high = self.intervals(query, slice(0, len(self.ids)))
        other = (self.labels != label) & (self.ids != anchor_id)
        wanted = np.zeros(len(self.ids), bool)
        for a, b in ranges:
            sure = low[other & (low >= a) & (high <= b)]
            need = max(a, np.partition(sure, len(sure) - n)[len(sure) - n]) if len(sure) >= n else a
            wanted |= other & (high >= need) & (low <= b)
        at = np.flatnonzero(wanted)
        scores = self.scores(query, at)
        for a, b in ranges:
            within = np.flatnonzero((scores >= a) & (scores <= b))
            keep = within[self.best(at[within], scores[within], n)]
            yield at[keep], scores[keep]


def matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(n, -1)


def numbers(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else column.to_numpy()


def blocks_of(rows: DataFrame, size: int) -> int:
    return max(1, -(-rows.count() // size))


def build_index(rows: DataFrame, blocks: int) -> DataFrame:
    """The stored index: one row per vector length and block."""
    target = arrow_schema(rows.sparkSession, INDEX_SCHEMA)

    def block(group: pa.Table) -> pa.Table:
        x = Index.build(numbers(group["vec_id"]), numbers(group["label"]), numbers(group["row"]), matrix(group["ints"]))
        row = {"width": [group["width"][0].as_py()], "block": [group["block"][0].as_py()], "ids": x.ids, "labels": x.labels, "row_keys": x.rows, "ints": x.ints, "codes": x.codes, "alignment": x.alignment, "norm": x.norm}
        return pa.Table.from_batches([record_batch({c: [v.tobytes()] if isinstance(v, np.ndarray) else v for c, v in row.items()}, target)])

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("vec_id", "row"), F.lit(blocks)))
    return stored(dealt.groupBy("width", "block").applyInArrow(block, INDEX_SCHEMA), "negatives-index")


def pack_anchors(anchors: DataFrame, packs: int, blocks: int) -> DataFrame:
    """Packs of anchors with their positives, one row each, for every block of the index."""
    target = arrow_schema(anchors.sparkSession, PACK_SCHEMA)

    def pack(group: pa.Table) -> pa.Table:
        found = group["positives"].to_pylist()
        row = {
            "ids": numbers(group["vec_id"]), "labels": numbers(group["label"]), "row_keys": numbers(group["row"]), "ints": matrix(group["ints"]),
            "positives": np.array([[*p.values()] for ps in found for p in ps], np.int64), "n_positives": np.array([len(ps) for ps in found], np.int64),
        }
        return pa.Table.from_batches([record_batch({"width": [group["width"][0].as_py()], "pack": [group["pack"][0].as_py()], **{c: [v.tobytes()] for c, v in row.items()}}, target)])

    dealt = anchors.withColumn("pack", F.pmod(F.xxhash64("vec_id", "row"), F.lit(packs)))
    return dealt.groupBy("width", "pack").applyInArrow(pack, PACK_SCHEMA).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))


def each_pair(index: DataFrame, packs: DataFrame, search, schema: str) -> DataFrame:
    """``search(index block, pack row)`` for every pack at every block."""
    own = [c for c in packs.columns if c not in ("width", "block")]
    pairs = index.join(packs.select("width", "block", F.struct(*own).alias("pack")), ["width", "block"]).select(*index.columns, "pack")

    def make():
        at, held = None, None

        def step(batch: pa.RecordBatch):
            nonlocal at, held
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                if at != (row["width"], row["block"]):
                    at, n = (row["width"], row["block"]), len(row["ids"]) // 8
                    ids, labels, rows = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "row_keys"))
                    ints, codes = np.frombuffer(row["ints"], np.int64).reshape(n, -1), np.frombuffer(row["codes"], np.uint64).reshape(n, -1)
                    held = Index(ids, labels, rows, ints, codes, np.frombuffer(row["alignment"]), np.frombuffer(row["norm"]))
                out = search(held, row["width"], row["pack"])
                if len(next(iter(out.values()))):
                    yield out

        return step

    return map_batches(pairs, make, schema)


def repeated(values, times) -> np.ndarray:
    return np.repeat(np.asarray(values, np.int64), times)


def mine(embeddings: DataFrame, every: int = 100, n_positives: int = 5, n_negatives: int = 10, low: int = 30, high: int = 90, block_rows: int = BLOCK_ROWS, anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose vec_id ``every`` divides.  A negative scores
    from ``low`` to ``high`` percent of its positive.
    """
    prepare(embeddings.sparkSession)
    rows = stored(integer_rows(embeddings), "negatives-rows")
    blocks = blocks_of(rows, block_rows)
    index = build_index(rows, blocks)
    anchors = rows.where(F.col("vec_id") % every == 0).withColumn("positives", F.expr(f"cast(array() as {FOUND})"))
    n_packs = blocks_of(anchors, anchor_rows)
    packs = pack_anchors(anchors, n_packs, blocks)

    def positives(block: Index, width: int, pack: dict) -> dict:
        ids, labels, keys = (np.frombuffer(pack[c], np.int64) for c in ("ids", "labels", "row_keys"))
        ints = np.frombuffer(pack["ints"], np.int64).reshape(len(ids), width)
        found = [block.positives(i, lab, q, n_positives) for i, lab, q in zip(ids, labels, ints)]
        n, at = [len(a) for a, _ in found], np.concatenate([a for a, _ in found])
        return {
            "anchor_id": repeated(ids, n), "anchor_row": repeated(keys, n), "anchor_label": repeated(labels, n), "width": np.full(len(at), width, np.int32),
            "positive_id": block.ids[at], "positive_row": block.rows[at], "positive_score": np.concatenate([s for _, s in found]),
        }

    def first(df: DataFrame, n: int, keys: list[str], score: str, id_: str, row: str) -> DataFrame:
        order = W.partitionBy(*keys).orderBy(F.col(score).desc(), F.col(id_), F.col(row))
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)

    anchor = ["anchor_id", "anchor_row"]
    best = first(each_pair(index, packs, positives, POSITIVE_SCHEMA), n_positives, anchor, "positive_score", "positive_id", "positive_row")
    asked = stored(best.groupBy(*anchor).agg(F.collect_list(F.struct("positive_id", "positive_row", "positive_score")).alias("positives")), "negatives-positives")
    def negatives(block: Index, width: int, pack: dict) -> dict:
        ids, labels, keys, counts = (np.frombuffer(pack[c], np.int64) for c in ("ids", "labels", "row_keys", "n_positives"))
        ints = np.frombuffer(pack["ints"], np.int64).reshape(len(ids), width)
        positives = np.frombuffer(pack["positives"], np.int64).reshape(-1, 3)
        owner = np.repeat(np.arange(len(ids)), counts)
        n, at, scores, begin = [], [], [], 0
        for k, count in enumerate(counts):
            own = positives[begin : begin + count, 2].tolist()
            begin += count
            # low * positive <= 100 * negative <= high * positive, in integers
            ranges = [(-(-low * p // 100), high * p // 100) for p in own]
            for a, s in block.negatives(ids[k], labels[k], ints[k], ranges, n_negatives):
                n.append(len(a))
                at.append(a)
                scores.append(s)
        at, who = np.concatenate(at), np.repeat(np.arange(len(positives)), n)
        return {
            "anchor_id": ids[owner[who]], "anchor_row": keys[owner[who]], "positive_id": positives[who, 0], "positive_row": positives[who, 1], "positive_score": positives[who, 2],
            "negative_id": block.ids[at], "negative_row": block.rows[at], "negative_score": np.concatenate(scores),
        }

    asked = asked.withColumnsRenamed({"anchor_id": "vec_id", "anchor_row": "row"})
    full = pack_anchors(anchors.drop("positives").join(asked, ["vec_id", "row"]), n_packs, blocks)
    found = first(each_pair(index, full, negatives, NEGATIVE_SCHEMA), n_negatives, [*anchor, "positive_id", "positive_row"], "negative_score", "negative_id", "negative_row")
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
