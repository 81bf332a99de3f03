"""A store of landed answers: the time-series API's documents by symbol and day.

The API's answers land once as bounded documents, each with one symbol's bars
of one day (a part of them, if there are many), and ``symbol``, ``day`` and
``interval`` beside the body.  Reading the store is the table form of the API
(A1): symbol lists (A11), date ranges (A12) and the interval (A13) are filters
on columns that reach the Parquet scan.  Requests are answered by joins, not by
assembling a text per request: a request falls into legs (symbol, window),
equal legs are answered once for all requests that have them, and a leg's
totals are sums over days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticksmith.constants import DEFAULT_INTERVAL
from ticksmith.operators import flatten as fl
from ticksmith.plans.ingest import Answers, document_totals
from ticksmith.sources.landing import read_documents, write_documents

STORE_DDL = "symbol string, day string, interval string, doc_id string, body string"
LEG = ["symbol", "start_date", "end_date"]


def write_answers(docs: DataFrame, path: str) -> str:
    """Land answers by symbol and day, sorted in ranges so that a filter skips files and row groups."""
    rows = docs.select(*(f.split()[0] for f in STORE_DDL.split(", ")))
    return write_documents(rows.repartitionByRange("symbol", "day").sortWithinPartitions("symbol", "day", "doc_id"), path)


def read_answers(spark: SparkSession, path: str, symbols: list[str] | None = None, start_date: str | None = None,
                 end_date: str | None = None, interval: str = DEFAULT_INTERVAL) -> DataFrame:
    """The documents for a symbol list and an inclusive date range (ISO dates or beginnings of them)."""
    docs = read_documents(spark, path, STORE_DDL).where(F.col("interval") == interval)
    if symbols is not None:
        docs = docs.where(F.col("symbol").isin(symbols))
    if start_date is not None:
        docs = docs.where(F.col("day") >= start_date)
    if end_date is not None:
        docs = docs.where(F.col("day") <= end_date)
    return docs


def bars(docs: DataFrame) -> DataFrame:
    """The bars of accepted documents: the one flatten, without the run's stamp."""
    return fl.fact_rows(fl.entry_rows(fl.parse_documents(docs)), None).drop("extracted_at_utc")


def request_legs(requests: DataFrame) -> DataFrame:
    """Distinct (request_id, symbol, start_date, end_date) of the valid requests."""
    valid = requests.where(F.col("status") == 200)
    return valid.select("request_id", F.explode(F.array_distinct("symbols")).alias("symbol"), "start_date", "end_date")


def answer_legs(legs: DataFrame, docs: DataFrame) -> DataFrame:
    """Distinct legs with their HTTP status and totals.

    (symbol, start_date, end_date, known, documents, refused, reason, facts).
    A symbol without any landed document is unknown.  Documents are parsed once
    and summed per symbol and day before they meet the legs.
    """
    days = document_totals(fl.parse_documents(docs), "symbol", "day").groupBy("symbol", "day").agg(
        F.count("*").alias("documents"), F.count("reason").alias("refused"), F.min("reason").alias("reason"), F.sum("facts").alias("facts"))
    distinct = legs.select(*LEG).distinct()
    known = days.select("symbol").distinct().withColumn("known", F.lit(True))
    within = (distinct["symbol"] == days["symbol"]) & F.col("day").between(F.col("start_date"), F.col("end_date"))
    found = distinct.join(days, within).groupBy(*(distinct[c] for c in LEG)).agg(
        *(F.sum(c).alias(c) for c in ("documents", "refused", "facts")), F.min("reason").alias("reason"))
    totals = distinct.join(known, "symbol", "left").join(found, LEG, "left")
    return totals.select(*LEG, F.coalesce("known", F.lit(False)).alias("known"), "reason",
                         *(F.coalesce(c, F.lit(0)).alias(c) for c in ("documents", "refused", "facts")))


def http_status(known: Column) -> Column:
    """What the API answers: an error status if it knows none of a call's symbols."""
    return F.when(known, 200).otherwise(404)


def request_verdicts(requests: DataFrame, docs: DataFrame) -> DataFrame:
    """One row per valid request: its verdict over all its legs, and its totals.

    An unknown symbol beside known ones is an entry without bars, as in the
    API's answers; a request that holds only unknown ones is refused, as is one
    with a refused document.
    """
    legs = request_legs(requests)
    per = legs.join(answer_legs(legs, docs), LEG).groupBy("request_id").agg(
        F.count("*").alias("n"), F.max("known").alias("known"), F.min("reason").alias("bad"),
        *(F.sum(c).alias(c) for c in ("documents", "refused", "facts")))
    asked = requests.where(F.col("status") == 200).select("request_id", "symbols", "start_date", "end_date")
    reason = F.when(~F.col("known"), F.lit(fl.REJECT_HTTP)).otherwise(F.col("bad"))
    return asked.join(per, "request_id", "left").select(
        "request_id", "symbols", "start_date", "end_date", reason.alias("reason"),
        # an unknown symbol's error object and a window without bars are documents of the answer too
        F.coalesce(F.greatest("documents", "n"), F.lit(0)).alias("documents"),
        F.when(~F.col("known"), 1).otherwise(F.coalesce("refused", F.lit(0))).alias("refused"),
        F.coalesce("facts", F.lit(0)).alias("facts"), F.coalesce("n", F.lit(0)).alias("dims"))


def landed_answers(store: str, interval: str = DEFAULT_INTERVAL) -> Answers:
    """Answers to a table of requests from the store, for ``ingest_requests``.

    What is stored is the documents that an accepted request's legs cover, once
    each however many requests ask for them, and one entry without bars for an
    accepted leg that has no document.
    """

    def answers(spark: SparkSession, requests: DataFrame, landing: str):
        docs = read_answers(spark, store, interval=interval)

        def documents(verdicts: DataFrame) -> DataFrame:
            accepted = verdicts.where("reason is null and request_id is not null")
            legs = accepted.select(F.explode("symbols").alias("symbol"), "start_date", "end_date").distinct()
            # windows meet the days of a symbol, not its documents
            within = (docs["symbol"] == legs["symbol"]) & F.col("day").between(F.col("start_date"), F.col("end_date"))
            days = docs.select("symbol", "day").distinct().join(legs, within, "left_semi")
            needed = docs.join(days, ["symbol", "day"], "left_semi").select("doc_id", "body")
            covered = (legs["symbol"] == docs["symbol"]) & F.col("day").between(F.col("start_date"), F.col("end_date"))
            bare = legs.join(docs.select("symbol", "day").distinct(), covered, "left_anti").select(F.col("symbol").alias("s")).distinct()
            entry = F.to_json(F.create_map(F.col("s"), F.from_json(F.lit('{"values":[]}'), "struct<values:array<string>>")))
            empty = bare.select(F.concat(F.lit("none|"), "s").alias("doc_id"), entry.alias("body"))
            return fl.parse_documents(needed.unionByName(empty))

        return request_verdicts(requests, docs), documents

    return answers
