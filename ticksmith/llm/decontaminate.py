"""Benchmark decontamination by greedy string tiling.

Benchmark items are the stated query set: they are taken in blocks of at most
about ``BLOCK_WORDS`` words, each block is sent to all tasks, and one pass over
the documents finds its matches; nothing of the documents is shuffled.

Within a task, a rolling hash of ``SEED`` words (Karp-Rabin) finds the places
where document and item share a run.  Runs along one diagonal are maximal
matches.  The longest match whose words are still free on both sides becomes a
tile and marks its words; matches that overlap a tile are cut to their free
parts and tried again, down to ``SEED`` words.  Tiles may come in any order, so
reordered passages still cover the item.  A document is contaminated by an item
if tiles cover at least ``COVERAGE`` of its words.

Words are lower-cased (A-Z) and split at white space.  An item of fewer than
``SEED`` words matches only a document of exactly those words; items and
documents without words match nothing.  Null ids are carried as they are;
repeated rows are reported row by row.  Empty tables give an empty result.
Extra columns are ignored by ``contaminated`` and kept by ``without_benchmark``.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.common import U64, hashed_words, keep_rows, map_batches, prepare, raw_texts, shingle_hashes, split_words, word_hashes

SEED = 5
COVERAGE = 0.75
BLOCK_WORDS = 200_000
#: words of a document whose shared seeds are laid out at a time
SEGMENT = 4_096

SCHEMA = "doc_id long, item_id long, covered_words long, item_words long, coverage double, tiles array<struct<doc_start:int,item_start:int,length:int>>"


def maximal_matches(doc: np.ndarray, item_seeds: np.ndarray, item_words: int, places: np.ndarray) -> list[tuple[int, int, int]]:
    """(length, doc start, item start) of all runs of shared seeds; ``doc`` holds the seed hash at each word."""
    order = np.argsort(item_seeds, kind="stable")
    ranked = item_seeds[order]
    found = set()
    at = 0
    while at < len(places):
        # segments overlap by the item's length, so every run lies whole in one of them
        first = int(places[at])
        end = int(np.searchsorted(places, first + SEGMENT + item_words))
        here = places[at:end]
        lo, hi = np.searchsorted(ranked, doc[here], "left"), np.searchsorted(ranked, doc[here], "right")
        times = hi - lo
        p = np.repeat(here, times)
        q = order[np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(lo, times)]
        by = np.lexsort((p, p - q))
        p, q = p[by], q[by]
        if len(p):
            new = np.flatnonzero(np.append(True, (np.diff(p) != 1) | (np.diff(q) != 1)))
            length = np.diff(np.append(new, len(p))) + SEED - 1
            found.update(zip(length.tolist(), p[new].tolist(), q[new].tolist()))
        at = max(at + 1, int(np.searchsorted(places, first + SEGMENT)))
    return list(found)


def free_parts(taken: np.ndarray) -> list[tuple[int, int]]:
    """(offset, length) of the runs of False."""
    edge = np.flatnonzero(np.diff(np.concatenate([[True], taken, [True]]).astype(np.int8)))
    return [(int(a), int(b - a)) for a, b in zip(edge[::2], edge[1::2])]


def tile(matches: list[tuple[int, int, int]], doc_words: int, item_words: int) -> list[tuple[int, int, int]]:
    """Greedy tiling: (doc start, item start, length), longest first; ties go to the earlier place."""
    heap = [(-n, p, q) for n, p, q in matches]
    heapq.heapify(heap)
    doc_taken, item_taken, tiles = np.zeros(doc_words, bool), np.zeros(item_words, bool), []
    while heap and not item_taken.all():
        n, p, q = heapq.heappop(heap)
        n = -n
        taken = doc_taken[p : p + n] | item_taken[q : q + n]
        if taken.any():
            for off, size in free_parts(taken):
                if size >= SEED:
                    heapq.heappush(heap, (-size, p + off, q + off))
        else:
            doc_taken[p : p + n] = item_taken[q : q + n] = True
            tiles.append((p, q, n))
    return sorted(tiles)


class Items:
    """One block of benchmark items, ready for lookup by seed."""

    def __init__(self, rows: list[tuple[int | None, bytes]]):
        memo = word_hashes()
        self.ids = [i for i, _ in rows]
        words = [hashed_words(t, memo) for _, t in rows]
        self.words = [len(w) for w in words]
        self.seeds = [shingle_hashes(w, SEED) if len(w) >= SEED else np.zeros(0, U64) for w in words]
        self.short: dict[bytes, list[int]] = {}
        for k, (_, t) in enumerate(rows):
            if 0 < self.words[k] < SEED:
                self.short.setdefault(b" ".join(split_words(t)), []).append(k)
        flat = np.concatenate([*self.seeds, np.zeros(0, U64)])
        owner = np.repeat(np.arange(len(rows)), [len(s) for s in self.seeds])
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner = flat[order], owner[order]

    def matches(self, text: bytes | None, memo):
        """(item index, tiles, covered words) of every item that shares a seed with the text."""
        words = hashed_words(text, memo)
        if len(words) < SEED:
            if len(words):
                for k in self.short.get(b" ".join(split_words(text)), []):
                    yield k, [(0, 0, len(words))], len(words)
            return
        seeds = shingle_hashes(words, SEED)
        lo = np.searchsorted(self.flat, seeds)
        hit = np.flatnonzero((lo < len(self.flat)) & (self.flat[np.minimum(lo, len(self.flat) - 1)] == seeds)) if len(self.flat) else lo[:0]
        if not len(hit):
            return
        wanted = np.unique(seeds[hit])
        left, right = np.searchsorted(self.flat, wanted, "left"), np.searchsorted(self.flat, wanted, "right")
        for k in sorted({int(o) for a, b in zip(left, right) for o in self.owner[a:b]}):
            places = hit[np.isin(seeds[hit], self.seeds[k])]
            tiles = tile(maximal_matches(seeds, self.seeds[k], self.words[k], places), len(words), self.words[k])
            yield k, tiles, sum(n for *_, n in tiles)


def item_blocks(benchmark: DataFrame, block_words: int) -> list:
    """The items in broadcast blocks of at most about ``block_words`` words."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text")).where("text is not null")
    size = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-int(size) // (block_words * 5)))
    out = []
    for k in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        rows = sorted(((r["item_id"], bytes(r["text"])) for r in part), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        out.append(spark.sparkContext.broadcast(Items(rows)))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document and item that it covers: doc_id, item_id, covered_words, item_words, coverage, tiles."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = None
    for held in item_blocks(benchmark, block_words):

        def make(held=held):
            memo, block = word_hashes(), held.value

            def step(batch: pa.RecordBatch):
                out = []
                for doc_id, text in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1))):
                    for item, tiles, covered in block.matches(text, memo):
                        n = block.words[item]
                        if covered >= coverage * n:
                            out.append((doc_id, block.ids[item], covered, n, covered / n, [{"doc_start": p, "item_start": q, "length": m} for p, q, m in tiles]))
                names = ("doc_id", "item_id", "covered_words", "item_words", "coverage", "tiles")
                yield {c: [r[j] for r in out] for j, c in enumerate(names)}

            return step

        part = map_batches(rows, make, SCHEMA)
        found = part if found is None else found.unionByName(part)
    return found


def without_benchmark(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents that cover no benchmark item; all columns stay."""
    prepare(docs.sparkSession)
    for held in item_blocks(benchmark, block_words):

        def make(held=held):
            memo, block = word_hashes(), held.value
            return lambda texts: [not any(covered >= coverage * block.words[item] for item, _, covered in block.matches(t, memo)) for t in texts]

        docs = keep_rows(docs, make)
    return docs
