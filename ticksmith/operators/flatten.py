"""Flatten response documents into fact and dimension rows (A2, A14-A23,
A26, A27) and reject malformed documents as a whole (A34, A35).

A document is an object keyed by symbol (dynamic keys, so not a fixed
struct); each value holds ``meta`` (object) and ``values`` (array of bar
objects).  Everything here is narrow: a document is one row, the symbol
entries and bars are generated from it in place, and the accept/reject flag
is computed inside the row.  No shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticksmith.constants import BAR_FIELDS, DIM_COLUMNS, META_FIELDS
from ticksmith.functions.columns import fence
from ticksmith.schemas import BAR_DDL, ENTRY_MAP_DDL, META_DDL

# reasons a document is refused (the handler would raise before writing)
REJECT_HTTP = "http_status"
REJECT_MALFORMED = "malformed_json"
REJECT_NOT_OBJECT = "not_an_object"
REJECT_ENTRY = "entry_not_object"
REJECT_META = "bad_meta"
REJECT_VALUES = "bad_values"
REJECT_MISSING_META = "missing_meta_with_values"

HANDLER = "handler"      # ingest handlers: missing meta -> null dim attributes
EXPLORE = "explore"      # exploration script: missing meta with bars fails


def _typed_entry(_key: Column, e: Column) -> Column:
    """One symbol's entry, with the pieces cast once and presence kept
    apart from type errors (absent -> default, wrong type -> reject)."""
    return F.struct(
        e.isNull().alias("not_object"),
        e["meta"].isNotNull().alias("has_meta"),
        e["meta"].try_cast(META_DDL).alias("meta"),
        e["values"].isNotNull().alias("has_values"),
        e["values"].try_cast(BAR_DDL).alias("bars"),
    )


def parse_documents(docs: DataFrame, body: str = "body", mode: str = HANDLER,
                    status: str | None = None) -> DataFrame:
    """Add ``typed`` (map symbol -> typed entry) and ``reject_reason``.

    ``status`` names an HTTP status column (A35): 4xx/5xx refuses the
    document before it is parsed.
    """
    parsed = docs.withColumn("_doc", F.try_parse_json(F.col(body)))
    entries = F.col("_doc").try_cast(ENTRY_MAP_DDL)
    parsed = parsed.withColumn("typed", F.transform_values(entries, _typed_entry))
    typed_values = F.map_values(F.col("typed"))

    def any_entry(pred) -> Column:
        return F.exists(typed_values, pred)

    reason = F.when(F.col("_doc").isNull(), F.lit(REJECT_MALFORMED))
    if status is not None:
        reason = F.when(F.col(status) >= 400, F.lit(REJECT_HTTP)).when(
            F.col("_doc").isNull(), F.lit(REJECT_MALFORMED))
    reason = (
        reason.when(F.col("typed").isNull(), F.lit(REJECT_NOT_OBJECT))
        .when(any_entry(lambda t: t["not_object"]), F.lit(REJECT_ENTRY))
        .when(any_entry(lambda t: t["has_meta"] & t["meta"].isNull()), F.lit(REJECT_META))
        .when(any_entry(lambda t: t["has_values"] & (
            t["bars"].isNull() | F.exists(t["bars"], lambda b: b.isNull()))), F.lit(REJECT_VALUES))
    )
    if mode == EXPLORE:
        # the script defaults meta to a list, whose .get fails once a bar exists
        reason = reason.when(
            any_entry(lambda t: ~t["has_meta"] & (F.coalesce(F.size(t["bars"]), F.lit(0)) > 0)),
            F.lit(REJECT_MISSING_META))
    # fence: ``typed`` and ``reject_reason`` are each read several times
    # downstream; computed once here instead of being inlined per use
    return fence(parsed.withColumn("reject_reason", reason).drop("_doc"), *docs.columns)


def rows_where(parsed: DataFrame, cond: Column, keep: tuple[str, ...], *cols: Column) -> DataFrame:
    """``select(keep, cols).where(cond)`` written as a generator.

    A ``where`` on a column computed from the parsed document is pushed
    below the projection by Catalyst and parses every document a second
    time; a conditional one-element ``inline`` keeps a single parse.
    """
    return parsed.select(*keep, F.inline(F.when(cond, F.array(F.struct(*cols)))))


def accepted(parsed: DataFrame, keep: tuple[str, ...], *cols: Column) -> DataFrame:
    return rows_where(parsed, F.col("reject_reason").isNull(), keep, *cols)


def rejected(parsed: DataFrame, keep: tuple[str, ...] = ("doc_id",), body: str = "body") -> DataFrame:
    """Refused documents with their reason and the text as received."""
    return rows_where(parsed, F.col("reject_reason").isNotNull(), keep,
                      F.col("reject_reason"), F.col(body))


def entry_rows(parsed: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per (document, symbol) of accepted documents.

    The key comes from the object itself, so dotted symbols stay whole.
    The accept test sits inside the generator rather than in a ``where``:
    a filter would be pushed below the projection and parse every
    document a second time.
    """
    ok_entries = F.when(F.col("reject_reason").isNull(), F.col("typed"))
    return parsed.select(*keep, F.explode(ok_entries).alias("symbol", "t"))


def _stamp(stamp: Column | str | None) -> Column:
    if stamp is None:
        return F.lit(None).cast("string")
    return stamp if isinstance(stamp, Column) else F.lit(stamp)


def fact_rows(entries: DataFrame, stamp: Column | str | None, keep: tuple[str, ...] = (),
              date_column: str = "price_date", with_index: bool = False) -> DataFrame:
    """A15 + A16/A17 + A20 + A21: one row per bar, fixed column order.

    ``date_column`` is ``price_date`` for the handlers and ``datetime`` for
    the exploration script.  Absent or empty ``values`` give no rows.
    """
    bars = entries.select(*keep, "symbol", F.posexplode("t.bars").alias("bar_idx", "bar"))
    cols = [F.col("bar.datetime").alias(date_column)]
    cols += [F.col(f"bar.{c}").alias(c) for c in BAR_FIELDS[1:]]
    out = [*keep, "symbol", *cols, _stamp(stamp).alias("extracted_at_utc")]
    if with_index:
        out.append("bar_idx")
    return bars.select(*out)


def dim_rows(entries: DataFrame, stamp: Column | str | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """A18 + A19 + A22: one row per symbol entry, also without bars."""
    return entries.select(
        *keep, "symbol",
        *[F.col(f"t.meta.{c}").alias(c) for c in META_FIELDS],
        _stamp(stamp).alias("extracted_at_utc"),
    ).select(*keep, *DIM_COLUMNS)


def dim_distinct(entries: DataFrame, stamp: Column | str | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """The exploration script's dimension.

    It appends one row per *bar* and then drops duplicates over the six
    columns.  Inside one document the six values are the same for every
    bar of a symbol and keys are unique, so the result is exactly one row
    per symbol that has at least one bar: we keep those entries directly
    instead of generating a row per bar and shuffling them to dedupe.
    """
    return dim_rows(entries.where(F.coalesce(F.size("t.bars"), F.lit(0)) > 0), stamp, keep)


def document_counts(parsed: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """A24/A25 per accepted document, computed inside the row: the number
    of bars (fact rows) and of symbol entries (dim rows)."""
    typed_values = F.map_values(F.col("typed"))
    return accepted(
        parsed, keep,
        F.aggregate(typed_values, F.lit(0).cast("bigint"),
                    lambda acc, t: acc + F.coalesce(F.size(t["bars"]), F.lit(0)).cast("bigint")
                    ).alias("fact_row_count"),
        F.size(typed_values).cast("bigint").alias("dim_row_count"),
    )


def preview(facts: DataFrame, n: int = 5, order: tuple[str, ...] = ("doc_id", "symbol", "bar_idx")) -> DataFrame:
    """The first ``n`` rows; Spark rows have no order, so it is explicit."""
    return facts.orderBy(*order).limit(n)


def union_runs(*frames: DataFrame) -> DataFrame:
    """Bag union of several responses or runs, matched by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out

