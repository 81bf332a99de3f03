"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: inputs up to this size are spread over the cores; anything larger is left as it scans
SMALL_INPUT = 64 << 20
#: bytes of input to a task whose work per row is heavy
HEAVY_TASK = 2 << 20


def fence(df: DataFrame, *passing: str) -> DataFrame:
    """Compute the columns of ``df`` once, as a one-row generator output.

    Catalyst inlines a projected expression into each consumer and pushes
    filters below projections by substituting the expression; for deep
    expressions (nested CASE over parsed JSON) that repeats the work per
    reference.  Columns produced by a generator are neither inlined nor
    filtered below, so a later ``where`` or multi-use stays cheap.  Columns
    named in ``passing`` are plain input columns: they stay outside, so
    filters on them still reach the scan.  The generator is narrow: no
    shuffle, same partitioning.
    """
    computed = [F.col(c) for c in df.columns if c not in passing]
    return df.select(*passing, F.inline(F.array(F.struct(*computed)))).select(*df.columns)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give CPU-heavy per-row work over a small input at least one task per core.

    A file of a few row groups scans as a few tasks, however heavy the work
    per row.  Inputs of at most ``SMALL_INPUT`` bytes are repartitioned (by
    ``keys`` if given); larger ones never are, on a cluster of any width.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > SMALL_INPUT or df.rdd.getNumPartitions() >= want:
        return df
    n = max(want * 2, 1)
    return df.repartition(n, *keys) if keys else df.repartition(n)


def spread_heavy(df: DataFrame) -> DataFrame:
    """Spread an input of any size for heavy work per row, evenly by rows.

    A scan never splits a row group, so a file of few large ones gives few
    tasks that hold rows, and their number of partitions doesn't show it.  The
    tasks here grow with the input: one to ``HEAVY_TASK`` bytes, and two to a
    core at least.  One shuffle of the columns that are used.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-size // HEAVY_TASK)))
