"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ticksmith.session import checkpoint_root, configure, shared_dir, ship_package

#: entries a worker keeps in a memo of word facts; a full memo is emptied, which never changes a result
MEMO_WORDS = 200_000

U64 = np.uint64


def prepare(spark: SparkSession) -> SparkSession:
    """Settings for operators that pass whole texts to Python workers in Arrow batches."""
    configure(spark)
    checkpoint_root(spark)
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that lost executors don't undo.

    The reread table has a known size, so joins with it are broadcast only
    when Spark finds it below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterator[dict]]], schema: str | StructType) -> DataFrame:
    """``mapInArrow`` whose per-task state is built by ``make`` on the executor.

    ``make()`` returns a function from a record batch to column dictionaries
    (column name -> Arrow array or list) in the order of ``schema``.
    """
    target = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            if batch.num_rows:
                for columns in step(batch):
                    yield record_batch(columns, target)

    return df.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, schema: str | StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def keep_rows(docs: DataFrame, make: Callable[[], Callable[[list[bytes | None]], list[bool]]]) -> DataFrame:
    """The rows whose text passes; a narrow filter over all columns as they are, without a join."""
    width = len(docs.columns)

    def rows():
        judge = make()

        def step(batch: pa.RecordBatch):
            good = pa.array(judge(raw_texts(batch.column(width))), pa.bool_())
            kept = batch.filter(good)
            yield {f.name: kept.column(k) for k, f in enumerate(docs_schema)}

        return step

    docs_schema = docs.schema.fields
    return map_batches(docs.select("*", docs["text"].alias("__text")), rows, docs.schema)


def record_batch(columns: dict, target: pa.Schema) -> pa.RecordBatch:
    arrays = [
        (a if a.type == f.type else a.cast(f.type)) if isinstance(a := columns[f.name], (pa.Array, pa.ChunkedArray)) else pa.array(a, f.type)
        for f in target
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=target)


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


class WordMemo(dict):
    """word -> value of ``fact(word)``, emptied when full."""

    def __init__(self, fact: Callable, limit: int = MEMO_WORDS):
        super().__init__()
        self.fact, self.limit = fact, limit

    def __missing__(self, word):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.fact(word)
        return value


def word_hashes() -> WordMemo:
    return WordMemo(xxhash.xxh64_intdigest)


def split_words(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lower-cased."""
    return text.lower().split() if text else []


def hashed_words(text: bytes | None, memo: WordMemo) -> np.ndarray:
    words = split_words(text)
    return np.fromiter(map(memo.__getitem__, words), U64, len(words))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: spreads every input bit over the word."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


ODD = U64(0x9E3779B97F4A7C15)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all runs of ``size`` words; a shorter text counts as one run."""
    n = len(words)
    if n == 0:
        return words
    if n < size:
        h = U64(n) * np.ones(1, U64)
        for w in words:
            h = mix64(h * ODD + w)
        return h
    h = words[: n - size + 1].copy()
    for k in range(1, size):
        h = h * ODD + words[k : n - size + 1 + k]
    return mix64(h)


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """Connected components by alternating large-star and small-star rounds.

    Returns (node, component): every node with an edge and the smallest node
    reachable from it.  Each round keeps at most one edge per edge of the
    round before; the table is checkpointed in the shared folder, and only a
    count reaches the driver.  A hub only feeds partial minima
    and joins that Spark can split.  Rounds go on until nothing is left to do;
    their number grows with the square of the logarithm of the nodes at most.
    """
    a, b = F.col(left), F.col(right)
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct().checkpoint()
    while True:
        # done when every node but the roots has one edge, to a root
        ends = e.select(F.col("u").alias("k"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(e.select(F.col("v").alias("k"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if not ends.groupBy("k").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1").count():
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        e = small.distinct().checkpoint()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
