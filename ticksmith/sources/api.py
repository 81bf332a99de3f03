"""A1 time-series API as a Spark Python Data Source (A11-A13 as its options).

    spark.read.format("timeseries_api")
         .option("symbols", "AAPL,GOOG,NVDA")
         .option("start_date", "2026-01-01").option("end_date", "2026-03-31")
         .load()

Each input partition is one API call (a batch of ``symbols_per_call``
symbols x a window of ``days_per_call`` days), so calls run in parallel
on the executors and a failed task simply re-fetches its call.  A row is
one answer as received ``(call_id, symbols, start_date, end_date,
http_status, body)``; ``ticksmith.operators.flatten`` parses and judges
it, here as everywhere (``api_bars`` does both).

Other options: ``interval`` (default ``1day``), ``fetcher``
(``module:function``, default the HTTP fetcher), and fetcher options
(``base_url``, ``api_key_env``, ``timeout``).
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ticksmith.constants import DEFAULT_END_DATE, DEFAULT_INTERVAL, DEFAULT_START_DATE, DEFAULT_SYMBOLS
from ticksmith.operators import flatten as fl

DOCUMENTS_DDL = ("call_id string, symbols string, start_date string, end_date string, "
                 "http_status int, body string")


class ApiCall(InputPartition):
    def __init__(self, call_id: str, symbols: list[str], start_date: str, end_date: str):
        super().__init__(call_id)
        self.call_id = call_id
        self.symbols = symbols
        self.start_date = start_date
        self.end_date = end_date


def windows(start_date: str, end_date: str, days: int) -> Iterator[tuple[str, str]]:
    """The range cut into windows of ``days`` days; whole if 0, none if it is empty."""
    if start_date > end_date:
        return
    if days <= 0:
        yield start_date, end_date
        return
    at, end = date.fromisoformat(start_date), date.fromisoformat(end_date)
    while at <= end:
        stop = min(at + timedelta(days=days - 1), end)
        yield at.isoformat(), stop.isoformat()
        at = stop + timedelta(days=1)


def plan_calls(symbols: list[str], start_date: str, end_date: str, symbols_per_call: int,
               days_per_call: int) -> list[ApiCall]:
    """Symbol batches x date windows; an empty range gives no call."""
    step = max(1, symbols_per_call)
    return [ApiCall(f"{','.join(batch)}|{a}|{b}", batch, a, b)
            for batch in (symbols[i:i + step] for i in range(0, len(symbols), step))
            for a, b in windows(start_date, end_date, days_per_call)]


class TimeSeriesApiReader(DataSourceReader):
    def __init__(self, options):
        syms = options.get("symbols")
        self.symbols = [s for s in syms.split(",") if s] if syms is not None else list(DEFAULT_SYMBOLS)
        self.start_date = options.get("start_date", DEFAULT_START_DATE)
        self.end_date = options.get("end_date", DEFAULT_END_DATE)
        self.interval = options.get("interval", DEFAULT_INTERVAL)
        self.symbols_per_call = int(options.get("symbols_per_call", "8"))
        self.days_per_call = int(options.get("days_per_call", "0"))
        self.fetcher = options.get("fetcher", "ticksmith.sources.fetchers:http_fetch")
        self.fetch_options = dict(options)

    def partitions(self):
        calls = plan_calls(self.symbols, self.start_date, self.end_date,
                           self.symbols_per_call, self.days_per_call)
        return calls or [ApiCall("", [], self.start_date, self.end_date)]

    def read(self, partition: ApiCall):
        if not partition.symbols:
            return
        from ticksmith.sources.fetchers import resolve

        status, body = resolve(self.fetcher)(partition.symbols, partition.start_date, partition.end_date,
                                             self.interval, self.fetch_options)
        yield (partition.call_id, ",".join(partition.symbols), partition.start_date,
               partition.end_date, int(status), body)


class TimeSeriesApiSource(DataSource):
    @classmethod
    def name(cls):
        return "timeseries_api"

    def schema(self):
        return DOCUMENTS_DDL

    def reader(self, schema):
        return TimeSeriesApiReader(self.options)


def register(spark) -> None:
    from ticksmith.session import configure, ship_package

    configure(spark)
    ship_package(spark)
    spark.dataSource.register(TimeSeriesApiSource)


def _iso_day(bound: str | None) -> bool:
    try:
        return bound is not None and date.fromisoformat(bound).isoformat() == bound
    except ValueError:
        return False


def api_bars(spark: SparkSession, symbols: list[str] | None = None, start_date: str | None = None,
             end_date: str | None = None, on_error: str = "raise", **options: str) -> DataFrame:
    """The API as a table of bars: only the calls that the list and the range need are made.

    A bound that is no full date (``2026-02``) narrows no call and filters the
    rows.  A refused answer ends the read (``raise``, as the handler does) or
    gives no rows (``skip``).
    """
    register(spark)
    reader = spark.read.format("timeseries_api")
    if symbols is not None:
        reader = reader.option("symbols", ",".join(symbols))
    for name, bound in (("start_date", start_date), ("end_date", end_date)):
        if _iso_day(bound):
            reader = reader.option(name, bound)
    for k, v in options.items():
        reader = reader.option(k, str(v))
    parsed = fl.parse_documents(reader.load(), status="http_status")
    if on_error == "raise":
        refused = F.concat(F.lit("API call refused: "), "call_id", F.lit(" "), "reject_reason")
        parsed = parsed.withColumn("typed", F.when(F.col("reject_reason").isNull(), F.col("typed")).otherwise(F.raise_error(refused)))
        parsed = parsed.withColumn("reject_reason", F.lit(None).cast("string"))
    rows = fl.fact_rows(fl.entry_rows(parsed, keep=("call_id",)), None).drop("extracted_at_utc")
    if start_date is not None:
        rows = rows.where(F.col("price_date") >= start_date)
    if end_date is not None:
        rows = rows.where(F.col("price_date") <= end_date)
    return rows
