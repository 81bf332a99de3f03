"""Repeated passages by content-defined chunking.

A gear hash of the last 32 bytes runs over the text; where its top ``BITS``
bits are zero a chunk ends, at least ``MIN_CHUNK`` and at most ``MAX_CHUNK``
bytes after the one before.  Cuts follow the content, so an insertion only
changes the chunks around it.  Chunks are known by a 64-bit digest; a digest in
two rows, or with ``within`` at two places of any rows, is repeated.  Neighbouring repeated chunks of at least ``MIN_PASSAGE``
bytes together form a passage (a chance agreement of digests would have to
happen for all chunks of a run).  The first occurrence, by smallest doc_id and
place, is kept; all others are duplicates.

Null and empty texts have no chunks.  A passage repeated only inside one text
is reported with ``within`` (as the registered query asks), else not.  Repeated rows of one doc_id are rows of their own, so they
repeat each other.  Rows with a null doc_id come last in the order.  Empty
tables give an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ticksmith.llm.common import map_batches, prepare, raw_texts, stored

BITS = 4
MIN_CHUNK = 12
MAX_CHUNK = 128
MIN_PASSAGE = 128


def gear_table() -> np.ndarray:
    return np.random.default_rng(77).integers(0, 1 << 32, 256, dtype=np.uint32)


def gear_hashes(data: np.ndarray, gear: np.ndarray) -> np.ndarray:
    """h[i] = sum of gear[data[i - j]] << j over the last 32 bytes, by doubling."""
    h = gear[data]
    width = 1
    while width < 32:
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
        width *= 2
    return h


def cuts(text: bytes, gear: np.ndarray) -> list[int]:
    """Ends of the chunks of a text."""
    n = len(text)
    stops = (np.flatnonzero(gear_hashes(np.frombuffer(text, np.uint8), gear) >> np.uint32(32 - BITS) == 0) + 1).tolist()
    out, last, k = [], 0, 0
    while last < n:
        k = bisect_left(stops, last + MIN_CHUNK, k)
        end = stops[k] if k < len(stops) else n
        last = min(end, last + MAX_CHUNK, n)
        out.append(last)
    return out


def chunked(docs: DataFrame) -> DataFrame:
    """row, doc_id and the chunks (digest, start, end) of every text."""

    def make():
        gear, task, count = gear_table(), TaskContext.get().partitionId(), 0

        def step(batch: pa.RecordBatch):
            nonlocal count
            digests, starts, ends, sizes = [], [], [], []
            for text in raw_texts(batch.column(1)):
                end = cuts(text, gear) if text else []
                start = [0, *end[:-1]] if end else []
                digests += [xxhash.xxh3_64_intdigest(text[a:b]) for a, b in zip(start, end)]
                starts += start
                ends += end
                sizes.append(len(end))
            rows = [task << 40 | count + k for k in range(len(sizes))]
            count += len(sizes)
            parts = [pa.array(np.array(digests, np.uint64).view(np.int64)), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())]
            chunks = pa.ListArray.from_arrays(np.cumsum([0, *sizes]).astype(np.int32), pa.StructArray.from_arrays(parts, ["digest", "start", "end"]))
            yield {"row": rows, "doc_id": batch.column(0), "chunks": chunks}

        return step

    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, "row long, doc_id long, chunks array<struct<digest:bigint,start:int,end:int>>")


def repeated_passages(docs: DataFrame, min_bytes: int = MIN_PASSAGE, within: bool = False) -> DataFrame:
    """One row per occurrence of a repeated passage: doc_id, start, end (bytes), kept, first_doc_id.

    ``kept`` marks the first occurrence; ``first_doc_id`` is where it stands.
    """
    prepare(docs.sparkSession)
    chunks = stored(chunked(docs), "substring-chunks")
    each = chunks.select("row", F.explode("chunks.digest").alias("digest"))
    # the count needs only the smallest and largest row of each digest, and the number of its places
    repeated = each.groupBy("digest").agg(F.min("row").alias("lo"), F.max("row").alias("hi"), F.count("*").alias("places")).where("places > 1" if within else "lo < hi").select("digest")
    repeated = stored(repeated, "substring-repeated")
    place = chunks.select("row", "doc_id", F.posexplode("chunks").alias("pos", "c")).select("row", "doc_id", "pos", "c.*")
    found = stored(place.join(repeated, "digest"), "substring-found")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row", "pos")
    first = found.groupBy("digest").agg(F.min(order).alias("first"))
    runs = found.join(first, "digest").withColumn("kept", (F.col("first.row") == F.col("row")) & (F.col("first.pos") == F.col("pos")))
    # runs of neighbouring repeated chunks, then their parts by whether they are kept
    runs = runs.withColumn("run", F.col("pos") - F.row_number().over(W.partitionBy("row").orderBy("pos")))
    runs = runs.withColumn("bytes", F.sum(F.col("end") - F.col("start")).over(W.partitionBy("row", "run"))).where(F.col("bytes") >= min_bytes)
    runs = runs.withColumn("part", F.col("pos") - F.row_number().over(W.partitionBy("row", "run", "kept").orderBy("pos")))
    spans = runs.groupBy("row", "run", "kept", "part").agg(F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("end").alias("end"), F.min("first.doc_id").alias("first_doc_id"))
    return spans.select("doc_id", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"), "kept", "first_doc_id")
