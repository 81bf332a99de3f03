"""Response documents and request events derived from the driver's tables.

The driver tables hold no stock data, so ``events`` is nested into the
answer shape of the time-series API: a document per (event day, chunk of
``DOC_CHUNK`` event ids), keyed by ``event_type`` as the symbol, with one bar
per event.  Documents are bounded by construction (at most ``DOC_CHUNK``
events), so even a day or a type holding a third of all rows never becomes
one huge group.  One shuffle (group by document), map-side nothing to
combine since collect_list keeps every row.

The same rules are written in SQL by the oracle queries in
``__spark_entry__.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticksmith.constants import DEFAULT_INTERVAL

DOC_CHUNK = 500

# invented instrument attributes per event type (the fixture's "meta");
# ``error`` carries no meta object unless asked to.
SYMBOL_META = {
    "click": ("USD", "NASDAQ", "XNGS", "Common Stock"),
    "view": ("USD", "NYSE", "XNYS", "Common Stock"),
    "purchase": ("EUR", "XETRA", "XETR", "ETF"),
    "signup": ("USD", "NASDAQ", "XNAS", "ETF"),
    "error": ("GBP", "LSE", "XLON", "Common Stock"),
}


def doc_id_col(ts: Column, event_id: Column) -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd"), F.lit("_"),
                    F.lpad(F.floor(event_id / DOC_CHUNK).cast("string"), 8, "0"))


def _money(value: Column, delta: int = 0) -> Column:
    dec = value.cast("decimal(18,2)")
    if delta:
        dec = dec + F.lit(delta)
    return dec.cast("string")


def bar_struct(events_cols) -> Column:
    ts, value, user_id = events_cols
    return F.struct(
        F.date_format(ts, "yyyy-MM-dd").alias("datetime"),
        _money(value).alias("open"),
        _money(value, 1).alias("high"),
        _money(value, -1).alias("low"),
        _money(value).alias("close"),
        F.when(user_id % 7 != 0, user_id.cast("string")).alias("volume"),
    )


def _meta_for(symbol: Column, drop_error_meta: bool) -> Column:
    fields = ["currency", "exchange", "mic_code", "type"]
    meta = F.struct(
        F.lit(DEFAULT_INTERVAL).alias("interval"),
        *[_case(symbol, i).alias(f) for i, f in enumerate(fields)],
    )
    if drop_error_meta:
        return F.when(symbol != F.lit("error"), meta)
    return meta


def _case(symbol: Column, i: int) -> Column:
    expr = None
    for sym, vals in SYMBOL_META.items():
        expr = (F.when(symbol == sym, F.lit(vals[i])) if expr is None
                else expr.when(symbol == sym, F.lit(vals[i])))
    return expr


def nest_events(events: DataFrame, drop_error_meta: bool = True, empty_entry: bool = True,
                scalar_every: int = 0) -> DataFrame:
    """events -> documents ``(doc_id STRING, body STRING)``.

    * ``drop_error_meta``: the ``error`` symbol has no ``meta`` (tests defaults).
    * ``empty_entry``: every document also carries a symbol ``empty`` with a
      meta object and no bars (in the handler's dim, not in the script's).
    * ``scalar_every``: documents of days whose day-of-month divides by it
      get a scalar entry ``"status": "error"`` and must be refused whole.
    """
    items = events.select(
        doc_id_col(F.col("ts"), F.col("event_id")).alias("doc_id"),
        F.dayofmonth("ts").alias("dom"),
        F.struct(
            F.col("event_type").alias("symbol"),
            F.col("event_id"),
            bar_struct((F.col("ts"), F.col("value"), F.col("user_id"))).alias("bar"),
        ).alias("item"),
    )
    grouped = items.groupBy("doc_id").agg(
        F.array_sort(F.collect_list("item")).alias("items"), F.first("dom").alias("dom"))
    symbols = F.array_sort(F.array_distinct(F.transform("items", lambda x: x["symbol"])))
    entries = F.transform(symbols, lambda s: F.struct(
        s.alias("key"),
        F.struct(
            _meta_for(s, drop_error_meta).alias("meta"),
            F.transform(F.filter("items", lambda x: x["symbol"] == s), lambda x: x["bar"]).alias("values"),
        ).alias("value"),
    ))
    base = grouped.select("doc_id", "dom", F.to_json(F.map_from_entries(entries)).alias("_b"))
    extra = []
    if empty_entry:
        extra.append(F.lit(',"empty":{"meta":{"interval":"1day"},"values":[]}'))
    if scalar_every:
        extra.append(F.when(F.col("dom") % scalar_every == 0, F.lit(',"status":"error"'))
                     .otherwise(F.lit("")))
    if not extra:
        return base.select("doc_id", F.col("_b").alias("body"))
    # splice the extra entries in before the closing brace of the object
    head = F.expr("substr(_b, 1, length(_b) - 1)")
    return base.select("doc_id", F.concat(head, *extra, F.lit("}")).alias("body"))


# --- request events ------------------------------------------------------------

REQUEST_CASES = 13


def request_events(events: DataFrame) -> DataFrame:
    """events -> request events ``(request_id STRING, event STRING)``.

    ``event_id % 13`` picks one of the handler's input shapes (every event
    becomes one request; nothing is dropped):
    0 direct full, 1 direct partial, 2 direct wins over body, 3 JSON body,
    4 base64 body, 5 broken body, 6 body not an object, 7 empty body,
    8 null event, 9 empty event, 10 symbols null, 11 symbols as a string,
    12 base64 body of bad length.
    """
    day = F.date_format("ts", "yyyy-MM-dd")
    sym = F.col("event_type")
    uid = F.col("user_id").cast("string")
    case = F.col("event_id") % REQUEST_CASES

    def obj(*cols):
        return F.to_json(F.struct(*cols))

    shapes = [
        obj(F.array(sym, F.concat(F.lit("S"), uid)).alias("symbols"), day.alias("start_date"),
            day.alias("end_date")),
        obj(day.alias("start_date")),
        obj(day.alias("end_date"), F.lit('{"symbols":["Z"]}').alias("body")),
        obj(obj(F.array(sym).alias("symbols"), day.alias("end_date")).alias("body")),
        obj(F.lit(True).alias("isBase64Encoded"),
            F.base64(F.encode(obj(F.array(sym).alias("symbols")), "UTF-8")).alias("body")),
        obj(F.concat(F.lit("{oops "), uid).alias("body")),
        obj(F.concat(F.lit("["), uid, F.lit("]")).alias("body")),
        F.lit('{"body":""}'),
        F.lit("null"),
        F.lit("{}"),
        F.lit('{"symbols":null}'),
        obj(sym.alias("symbols")),
        F.lit('{"isBase64Encoded":true,"body":"abc"}'),
    ]
    event = None
    for i, shape in enumerate(shapes):
        event = F.when(case == i, shape) if event is None else event.when(case == i, shape)
    return events.select(F.col("event_id").cast("string").alias("request_id"), event.alias("event"))


# --- landed answers by symbol and day ------------------------------------------------

def symbol_day_documents(events: DataFrame, drop_error_meta: bool = True) -> DataFrame:
    """events -> answers ``(symbol, day, interval, doc_id, body)``, one symbol's bars of one day.

    A day's bars are cut by ``DOC_CHUNK`` event ids, so a hot symbol or day
    still lands as many bounded documents.
    """
    chunk = F.lpad(F.floor(F.col("event_id") / DOC_CHUNK).cast("string"), 8, "0")
    items = events.select(
        F.col("event_type").alias("symbol"), F.date_format("ts", "yyyy-MM-dd").alias("day"), chunk.alias("chunk"),
        F.struct("event_id", bar_struct((F.col("ts"), F.col("value"), F.col("user_id"))).alias("bar")).alias("item"),
    )
    days = items.groupBy("symbol", "day", "chunk").agg(F.array_sort(F.collect_list("item")).alias("items"))
    entry = F.struct(_meta_for(F.col("symbol"), drop_error_meta).alias("meta"), F.transform("items", lambda x: x["bar"]).alias("values"))
    return days.select(
        "symbol", "day", F.lit(DEFAULT_INTERVAL).alias("interval"), F.concat_ws("|", "symbol", "day", "chunk").alias("doc_id"),
        F.to_json(F.create_map(F.col("symbol"), entry)).alias("body"),
    )
