"""Registered queries: one per operator of the inventory, each reading the
driver's tables (or data Spark derives from them) over their full size.

Each function takes ``(spark, sf_dir)`` and returns a DataFrame; the oracle
SQL for each lives in ``ticksmith.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticksmith.functions.stamps import FIXED_STAMP, RunStamp, extract_date_text, isoformat_text, run_id_text
from ticksmith.operators import flatten as fl
from ticksmith.operators import requests as rq
from ticksmith.plans.fixtures import nest_events, request_events
from ticksmith.session import configure, shared_dir

STAMP = FIXED_STAMP.extracted_at_utc
SECOND_STAMP = RunStamp(FIXED_STAMP.at.replace(hour=23)).extracted_at_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; spread over the cores when it scans as fewer
    partitions than the cluster has (small files only; a no-op at scale)."""
    from ticksmith.functions.columns import spread

    configure(spark)
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _documents(spark, sf_dir, **kw) -> DataFrame:
    return nest_events(table(spark, sf_dir, "events"), **kw)


def _parsed(spark, sf_dir, mode=fl.HANDLER, **kw) -> DataFrame:
    return fl.parse_documents(_documents(spark, sf_dir, **kw), mode=mode)


# --- flatten (A14-A23, A26, A27) ---------------------------------------------

@query
def fact_rows(spark, sf_dir):
    """A2 + A14 + A15 + A16 + A20 + A21: the handler's price fact."""
    return fl.fact_rows(fl.entry_rows(_parsed(spark, sf_dir)), STAMP)


@query
def fact_rows_explore(spark, sf_dir):
    """The exploration script's fact (date column keeps its name)."""
    parsed = _parsed(spark, sf_dir, mode=fl.EXPLORE, drop_error_meta=False, empty_entry=False)
    return fl.fact_rows(fl.entry_rows(parsed), STAMP, date_column="datetime")


@query
def explode_symbols(spark, sf_dir):
    """One row per (document, symbol), also for symbols without bars."""
    return fl.entry_rows(_parsed(spark, sf_dir)).select("doc_id", "symbol")


@query
def explode_values(spark, sf_dir):
    """One row per bar with its position in the symbol's array."""
    facts = fl.fact_rows(fl.entry_rows(_parsed(spark, sf_dir)), None, keep=("doc_id",), with_index=True)
    return facts.select("doc_id", "symbol", F.col("bar_idx").cast("bigint").alias("bar_idx"), "price_date")


@query
def dim_rows(spark, sf_dir):
    """A18 + A19 + A22: the handler's stock dimension, one row per entry."""
    return fl.dim_rows(fl.entry_rows(_parsed(spark, sf_dir)), STAMP)


@query
def dim_distinct(spark, sf_dir):
    """The exploration script's deduplicated dimension."""
    parsed = _parsed(spark, sf_dir, mode=fl.EXPLORE, drop_error_meta=False, empty_entry=False)
    return fl.dim_distinct(fl.entry_rows(parsed), STAMP)


@query
def missing_keys(spark, sf_dir):
    """Absent keys become NULL: bars without volume, entries without meta."""
    entries = fl.entry_rows(_parsed(spark, sf_dir))
    facts = fl.fact_rows(entries, None)
    per_symbol_bars = facts.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("bars"),
        F.count_if(F.col("volume").isNull()).alias("bars_without_volume"))
    per_symbol_dims = fl.dim_rows(entries, None).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("entries"),
        F.count_if(F.col("interval").isNull()).alias("entries_without_meta"))
    return per_symbol_dims.join(per_symbol_bars, "symbol", "left").select(
        "symbol", "entries", "entries_without_meta",
        F.coalesce("bars", F.lit(0)).alias("bars"),
        F.coalesce("bars_without_volume", F.lit(0)).alias("bars_without_volume"))


@query
def stamp(spark, sf_dir):
    """Every fact and dim row carries the run's one stamp."""
    entries = fl.entry_rows(_parsed(spark, sf_dir))
    facts = fl.fact_rows(entries, STAMP).select("extracted_at_utc", F.lit("fact").alias("table_name"))
    dims = fl.dim_rows(entries, STAMP).select("extracted_at_utc", F.lit("dim").alias("table_name"))
    return facts.unionByName(dims).groupBy("table_name", "extracted_at_utc").agg(
        F.count(F.lit(1)).alias("row_count"))


@query
def run_counts(spark, sf_dir):
    """A24 + A25: fact and dim row counts per response, inside the row."""
    return fl.document_counts(_parsed(spark, sf_dir))


@query
def preview(spark, sf_dir):
    """The first five exploration fact rows in document order."""
    parsed = _parsed(spark, sf_dir, mode=fl.EXPLORE, drop_error_meta=False, empty_entry=False)
    facts = fl.fact_rows(fl.entry_rows(parsed), STAMP, keep=("doc_id",),
                         date_column="datetime", with_index=True)
    return fl.preview(facts).drop("doc_id", "bar_idx")


@query
def union_runs(spark, sf_dir):
    """Two runs over the same responses, unioned by column name."""
    entries = fl.entry_rows(_parsed(spark, sf_dir))
    return fl.union_runs(fl.fact_rows(entries, STAMP), fl.fact_rows(entries, SECOND_STAMP))


@query
def run_stamp(spark, sf_dir):
    """The three stamp texts of one instant, here the last event of
    each day taken as that day's run time."""
    ev = table(spark, sf_dir, "events")
    runs = ev.groupBy(F.to_date("ts").alias("day")).agg(F.max("ts").alias("run_ts"))
    ts = F.col("run_ts").cast("timestamp")
    return runs.select(
        F.date_format("day", "yyyy-MM-dd").alias("day"),
        run_id_text(ts).alias("run_id"),
        extract_date_text(ts).alias("extract_date"),
        isoformat_text(ts).alias("extracted_at_utc"))


# --- document checks (A34) -----------------------------------------------------

@query
def reject_documents(spark, sf_dir):
    """Documents carrying a scalar entry are refused whole."""
    return fl.rejected(_parsed(spark, sf_dir, scalar_every=5)).select("doc_id", "reject_reason")


@query
def reject_keep_rest(spark, sf_dir):
    """The batch goes on; facts of the accepted documents only."""
    return fl.fact_rows(fl.entry_rows(_parsed(spark, sf_dir, scalar_every=5)), STAMP)


# --- requests (A3-A10) -----------------------------------------------------------

def _request_events(spark, sf_dir) -> DataFrame:
    """Request events; routing one parses it, so they are spread evenly at any size."""
    from ticksmith.functions.columns import spread_heavy

    configure(spark)
    return request_events(spread_heavy(spark.read.parquet(f"{sf_dir}/events.parquet")))


def _requests(spark, sf_dir) -> DataFrame:
    return rq.normalise_requests(_request_events(spark, sf_dir))


@query
def request_scan(spark, sf_dir):
    """A3: request events landed as JSON lines, read back as a table."""
    from ticksmith.sources.landing import read_requests, write_requests

    landing = write_requests(_request_events(spark, sf_dir), shared_dir(spark, "requests"))
    return rq.normalise_requests(read_requests(spark, landing)).select("request_id", "route", "status")


@query
def request_route(spark, sf_dir):
    """A4: which branch of the routing each event takes."""
    return _requests(spark, sf_dir).select("request_id", "route", "status", "error")


@query
def request_defaults(spark, sf_dir):
    """A5: absent keys take the defaults; explicit values are kept."""
    return _requests(spark, sf_dir).select(
        "request_id", F.array_join("symbols", ",").alias("symbols"), "start_date", "end_date")


@query
def request_base64(spark, sf_dir):
    """The body text after the optional base64 decoding."""
    return _requests(spark, sf_dir).select("request_id", "body_text")


@query
def request_bad_json(spark, sf_dir):
    """Failing requests become status-500 rows with an error text."""
    return _requests(spark, sf_dir).where(F.col("status") == 500).groupBy("error").agg(
        F.count(F.lit(1)).alias("requests"))


@query
def request_null_event(spark, sf_dir):
    """Null or empty events route to the defaults."""
    return _requests(spark, sf_dir).groupBy("route").agg(F.count(F.lit(1)).alias("requests"))


@query
def symbols_join(spark, sf_dir):
    """The API's comma-joined ``symbol`` parameter."""
    from ticksmith.functions.encoding import symbols_param
    return _requests(spark, sf_dir).select("request_id", symbols_param(F.col("symbols")).alias("symbol_param"))


@query
def request_url(spark, sf_dir):
    """A10: the form-encoded GET URL (credential never part of it)."""
    reqs = _requests(spark, sf_dir)
    return reqs.select("request_id", rq.request_url(reqs).alias("url"))


def _handler_rows(reqs):
    from ticksmith.functions.encoding import symbols_param
    return reqs.select("request_id", "route", "status", symbols_param(F.col("symbols")).alias("symbols"),
                       "start_date", "end_date")


@query
def request_direct(spark, sf_dir):
    """A4 + A5 + A8, direct handler: top-level keys only, a body is never read."""
    return _handler_rows(rq.normalise_direct_requests(_request_events(spark, sf_dir)))


@query
def request_packaged(spark, sf_dir):
    """A4 + A5, packaged handler: a later default start date, a null event fails."""
    return _handler_rows(rq.normalise_packaged_requests(_request_events(spark, sf_dir)))


# --- sinks and runs (A29-A33, A36) ------------------------------------------------

def _ingest(spark, sf_dir, stamps=(FIXED_STAMP,)):
    from ticksmith.plans.ingest import ingest_documents

    root = shared_dir(spark, "ingest")
    docs = _documents(spark, sf_dir)
    results = [ingest_documents(spark, docs, root, s) for s in stamps]
    return root, results


@query
def sink_raw(spark, sf_dir):
    """Raw documents written as compact JSON and read back."""
    from ticksmith.sinks import files

    root, (res,) = _ingest(spark, sf_dir)
    raw = spark.read.text(files.run_path(root, "raw", res.extract_date, res.run_id, res.attempt))
    return raw.select(F.col("value").alias("body"))


@query
def sink_fact_csv(spark, sf_dir):
    """The fact CSV of one run, read back."""
    from ticksmith.sinks import files

    root, (res,) = _ingest(spark, sf_dir)
    return files.read_csv_run(spark, files.run_path(root, "fact", res.extract_date, res.run_id, res.attempt), "fact")


@query
def sink_dim_csv(spark, sf_dir):
    """The dim CSV of one run, read back."""
    from ticksmith.sinks import files

    root, (res,) = _ingest(spark, sf_dir)
    return files.read_csv_run(spark, files.run_path(root, "dim", res.extract_date, res.run_id, res.attempt), "dim")


def _two_runs():
    return (FIXED_STAMP, RunStamp(FIXED_STAMP.at.replace(day=30, hour=23)))


@query
def read_partitioned(spark, sf_dir):
    """Two runs into one root; partition discovery finds both."""
    from ticksmith.sinks import files

    root, _ = _ingest(spark, sf_dir, _two_runs())
    from ticksmith.constants import FACT_COLUMNS

    df = files.read_table(spark, root, "fact")
    return df.select(*FACT_COLUMNS, F.col("extract_date").cast("string").alias("extract_date"), "run_id")


@query
def run_manifest(spark, sf_dir):
    """One manifest row per run with keys and row counts."""
    from ticksmith.sinks import files

    root, _ = _ingest(spark, sf_dir, _two_runs())
    return files.read_manifest(spark, root).select(
        "status", "message", "raw_key", "fact_key", "dim_key",
        "fact_row_count", "dim_row_count", "rejected_count", "extract_date", "run_id")


@query
def error_manifest(spark, sf_dir):
    """Requests that fail become status-500 manifest rows."""
    from ticksmith.plans.ingest import error_manifest as errors

    return errors(_requests(spark, sf_dir), FIXED_STAMP).select(
        "request_id", "status", "message", "error", "run_id")


# --- landed answers (A1, A2, A11-A13, A35) and requests over them --------------------

def _store(spark, sf_dir) -> str:
    """The API's answers by symbol and day, landed by Spark from ``events``."""
    from ticksmith.plans.fixtures import symbol_day_documents
    from ticksmith.sources.answers import write_answers

    return write_answers(symbol_day_documents(table(spark, sf_dir, "events")), shared_dir(spark, "answers"))


@query
def api_source_scan(spark, sf_dir):
    """A1 + A13: all landed answers of the default interval as a table of bars."""
    from ticksmith.sources.answers import bars, read_answers

    return bars(read_answers(spark, _store(spark, sf_dir)))


@query
def filter_symbols(spark, sf_dir):
    """A symbol list pushed into the scan of the answers."""
    from ticksmith.sources.answers import bars, read_answers

    return bars(read_answers(spark, _store(spark, sf_dir), symbols=["click", "view"]))


@query
def filter_dates(spark, sf_dir):
    """A date range pushed into the scan of the answers (inclusive ends)."""
    from ticksmith.sources.answers import bars, read_answers

    return bars(read_answers(spark, _store(spark, sf_dir), start_date="2024-01-10", end_date="2024-01-20"))


@query
def http_status_reject(spark, sf_dir):
    """One call per symbol and week, answered from the store; a symbol
    the API doesn't know answers 404 and is refused, the others go on."""
    from ticksmith.sources.answers import answer_legs, http_status, read_answers

    events = table(spark, sf_dir, "events")
    symbols = events.select(F.col("event_type").alias("symbol")).distinct().unionByName(
        spark.createDataFrame([("UNKNOWN",)], "symbol string"))
    span = events.agg(F.min(F.to_date("ts")).alias("d0"), F.max(F.to_date("ts")).alias("d1"))
    weeks = span.select(F.explode(F.expr("sequence(d0, d1, interval 7 days)")).alias("w0"), "d1").select(
        F.lit(1).alias("one"), F.date_format("w0", "yyyy-MM-dd").alias("start_date"),
        F.date_format(F.least(F.date_add("w0", 6), "d1"), "yyyy-MM-dd").alias("end_date"))
    calls = symbols.withColumn("one", F.lit(1)).join(weeks, "one").drop("one")
    answered = answer_legs(calls, read_answers(spark, _store(spark, sf_dir)))
    status = http_status(F.col("known"))
    return answered.select(F.col("symbol").alias("symbols"), "start_date", "end_date", status.alias("http_status"),
                           F.when(status >= 400, fl.REJECT_HTTP).otherwise(F.col("reason")).alias("reject_reason"),
                           F.when(status < 400, F.col("facts")).alias("bars"))


@query
def response_scan(spark, sf_dir):
    """A2: response documents landed packed and read back by a splittable scan."""
    from ticksmith.sources.landing import read_documents, write_documents

    path = write_documents(_documents(spark, sf_dir), shared_dir(spark, "landing"))
    return fl.document_counts(fl.parse_documents(read_documents(spark, path)))


@query
def fetch_plan(spark, sf_dir):
    """A1 driven by a request table: requests -> distinct legs (symbol and
    window) joined with the landed answers -> one verdict per request."""
    from ticksmith.sources.answers import read_answers, request_verdicts

    verdicts = request_verdicts(_requests(spark, sf_dir), read_answers(spark, _store(spark, sf_dir)))
    return verdicts.select("request_id", F.lit(1).cast("bigint").alias("calls"),
                           F.col("reason").isNotNull().cast("bigint").alias("rejected_calls"),
                           F.when(F.col("reason").isNull(), F.col("facts")).otherwise(0).cast("bigint").alias("bars"))


# --- streaming (A37) -------------------------------------------------------------------

@query
def stream_ingest(spark, sf_dir):
    """Landed answers streamed into the tables, one run per batch;
    restarted once on its checkpoint, which must add nothing."""
    from ticksmith.sinks import files
    from ticksmith.sources.landing import write_documents
    from ticksmith.streaming.ingest_stream import start_ingest_stream

    base = shared_dir(spark, "stream")
    landing = write_documents(_documents(spark, sf_dir), f"{base}/landing")
    for _ in range(2):   # the second start is a restart on the same checkpoint: no new runs
        q = start_ingest_stream(spark, landing, f"{base}/out", checkpoint=f"{base}/checkpoint",
                                stamp=lambda: FIXED_STAMP, max_files_per_trigger=100)
        q.awaitTermination()
    return files.read_table(spark, f"{base}/out", "fact").drop("extract_date", "run_id")


@query
def stream_requests(spark, sf_dir):
    """Request events streamed through the gateway handler.  Every event
    lands twice, half of them again after a restart; each request is answered
    and listed once."""
    from ticksmith.sinks import files
    from ticksmith.sources.answers import landed_answers
    from ticksmith.sources.landing import write_requests
    from ticksmith.streaming.ingest_stream import start_request_stream

    base, answers = shared_dir(spark, "stream-requests"), landed_answers(_store(spark, sf_dir))
    events = _request_events(spark, sf_dir)
    again = events.where(F.crc32("request_id") % 2 == 0)
    for arrived in (events.unionByName(again), again):
        write_requests(arrived, f"{base}/landing", mode="append")
        q = start_request_stream(spark, f"{base}/landing", f"{base}/out", answers, checkpoint=f"{base}/checkpoint",
                                 stamp=lambda: FIXED_STAMP)
        q.awaitTermination()
    return files.read_manifest(spark, f"{base}/out").select(
        "request_id", "status", "fact_row_count", "dim_row_count", "rejected_count")


# --- URLs (R1, R2) -----------------------------------------------------------------------

@query
def url_parts(spark, sf_dir):
    """Every page URL and every link in the pages' HTML, split."""
    from ticksmith.operators.urls import page_urls, parse_url

    parsed = parse_url(page_urls(table(spark, sf_dir, "pages")))
    return parsed.select("page_id", "link_idx", "scheme", "auth", "host", "port", "path", "query",
                         "fragment", "parse_error")


@query
def url_normalise(spark, sf_dir):
    """R2: the same URLs normalised and joined back into text."""
    from ticksmith.operators.urls import normalise_urls, page_urls

    return normalise_urls(page_urls(table(spark, sf_dir, "pages"))).select(
        "page_id", "link_idx", "normalised_url")


# --- text profiles (R3-R10) ----------------------------------------------------------------

def _text_docs(spark, sf_dir):
    from ticksmith.functions.columns import spread
    from ticksmith.operators import textprofile as tp

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    configure(spark)
    return tp, spread(docs, "doc_id")


def _text_inputs(spark, sf_dir):
    tp, docs = _text_docs(spark, sf_dir)
    facts = tp.materialise_table(tp.char_table(spark, docs))
    return tp, docs, facts


def _profile(spark, sf_dir):
    tp, docs = _text_docs(spark, sf_dir)
    return tp, tp.CorpusProfile(spark, docs)


@query
def char_blocks(spark, sf_dir):
    """Characters per Unicode block per document."""
    tp, docs = _text_docs(spark, sf_dir)
    return tp.char_blocks(spark, docs)


@query
def char_rank(spark, sf_dir):
    """Letters per document and layer, ranked by count then first appearance."""
    tp, docs = _text_docs(spark, sf_dir)
    return tp.letter_ranks(spark, docs)


@query
def lang_candidates(spark, sf_dir):
    """Languages whose learned alphabet the chunk covers (share >= 0.2)."""
    _, prof = _profile(spark, sf_dir)
    return prof.candidates().select("doc_id", F.col("chunk").cast("bigint").alias("chunk"), "layer",
                                    "language", "share")


@query
def lang_coherence(spark, sf_dir):
    """Ranking coherence of each candidate language per chunk."""
    _, prof = _profile(spark, sf_dir)
    return prof.coherence().select("doc_id", F.col("chunk").cast("bigint").alias("chunk"), "layer",
                                   "language", "ratio")


@query
def lang_merge(spark, sf_dir):
    """Mean coherence per document and language over its chunks, each folded first."""
    tp, prof = _profile(spark, sf_dir)
    return tp.lang_merge(tp.lang_best(prof.coherence()))


@query
def lang_best(spark, sf_dir):
    """Alternative profiles folded into their language (best ratio), per chunk over its layers."""
    tp, prof = _profile(spark, sf_dir)
    best = tp.lang_best(prof.coherence())
    return best.select("doc_id", F.col("chunk").cast("bigint").alias("chunk"), "language", "ratio")


@query
def noise_counts(spark, sf_dir):
    """Order-free noise ratios per document."""
    tp, docs, facts = _text_inputs(spark, sf_dir)
    return tp.noise_counts(spark, docs, facts)


@query
def noise_neighbours(spark, sf_dir):
    """Neighbour-based noise ratios per document."""
    tp, docs, facts = _text_inputs(spark, sf_dir)
    return tp.noise_neighbours(spark, docs, facts)


@query
def request_ingest(spark, sf_dir):
    """A1 + A14-A36 over a request table: one verdict and one manifest row per
    request, each needed answer stored once (SURVEY 3.2)."""
    from ticksmith.plans.ingest import ingest_requests
    from ticksmith.sources.answers import landed_answers

    out = shared_dir(spark, "request-ingest")
    manifest = ingest_requests(spark, _requests(spark, sf_dir), out, FIXED_STAMP,
                               answers=landed_answers(_store(spark, sf_dir)))
    return manifest.select("request_id", "status", "fact_row_count", "dim_row_count", "rejected_count")


@query
def handler_run(spark, sf_dir):
    """SURVEY 3.1 end to end: the direct handler over all answers to one
    request, and a later one whose answers hold a malformed document: it stores
    nothing (A34).  The fact table is read back through the manifest."""
    from ticksmith.plans.ingest import ingest_answers
    from ticksmith.sinks import files
    from ticksmith.sources.answers import read_answers

    out, (first, later) = shared_dir(spark, "handler"), _two_runs()
    docs = read_answers(spark, _store(spark, sf_dir)).select("doc_id", "body", F.lit(200).alias("http_status"))
    ingest_answers(spark, docs, out, first)
    broken = spark.createDataFrame([("broken", '{"click":{"values":[7]}}', 200)], docs.schema)
    ingest_answers(spark, docs.unionByName(broken), out, later, on_error="row")
    return files.read_table(spark, out, "fact").drop("extract_date", "run_id")
