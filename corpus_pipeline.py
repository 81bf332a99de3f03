"""Corpus pipeline: filter, deduplicate, decontaminate and pack ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run``
writes every stage's result as Parquet in the shared folder and rereads it
for the next one.  All stages but the last return the columns of
``documents``; the last returns the packed pieces.  Cases such as null or
empty texts, repeated rows and empty tables follow the operator that each
stage calls; a document with a null doc_id passes the filters that go by id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ticksmith.llm.common import prepare, stored, table
from ticksmith.llm.decontaminate import without_benchmark
from ticksmith.llm.minhash import keep_one_per_group
from ticksmith.llm.packing import pack
from ticksmith.llm.templates import without_templates
from ticksmith.llm.tokens import tokenizer_path
from ticksmith.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that recur across documents go."""
    return without_templates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return keep_one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that cover a benchmark item go."""
    return without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of training sequences."""
    return pack(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("packing", packing),
]

#: a fitted model, near-duplicate links and token ids aren't expressible in SQL; tests compare with brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
