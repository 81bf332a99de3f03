"""Ingest-request normalisation over a table of request events (A3-A10).

The gateway handler routes one event at a time; here a whole table of
events is routed with column expressions, row by row, with no shuffle and
no Python.  A row that the handler would answer with status 500 gets
``status = 500`` and an ``error`` text instead of stopping the batch.

Routing rules (per event):
1. null / empty event -> defaults
2. any of ``symbols``, ``start_date``, ``end_date`` at the top level (even
   an explicit null) -> take the top level; ``body`` is ignored
3. else a non-empty ``body`` -> optional base64, then JSON object
4. else defaults
An absent key is defaulted; an explicit null is not (it fails later, as
in the handler).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticksmith.constants import (API_BASE_URL, BAD_BODY_ERROR, DEFAULT_END_DATE, DEFAULT_INTERVAL,
                                 DEFAULT_START_DATE, DEFAULT_SYMBOLS, PACKAGED_DEFAULT_START_DATE)
from ticksmith.functions.columns import fence
from ticksmith.functions.encoding import base64_text, form_encode, symbols_param

REQUEST_KEYS = ("symbols", "start_date", "end_date")

# error texts of our own for the rows the handler would fail on
ERR_EVENT_JSON = "Request event must be valid JSON"
ERR_EVENT_OBJECT = "Request event must be a JSON object"
ERR_BODY_TYPE = "Request body must be a string"
ERR_BODY_BASE64 = "Request body is not valid base64-encoded UTF-8"
ERR_BODY_OBJECT = "Request body must be a JSON object"
ERR_SYMBOLS = "symbols must be a list of strings"
ERR_DATES = "start_date and end_date must be strings"

ROUTE_DIRECT = "direct"
ROUTE_BODY = "body"
ROUTE_DEFAULT = "default"


def _kind(v: Column) -> Column:
    """First word of the variant's schema: OBJECT, ARRAY, STRING, BIGINT, ..."""
    return F.split(F.schema_of_variant(v), "<", 2)[0]


def _truthy(v: Column, kind: Column) -> Column:
    """Python truthiness of a JSON value of a kind (None/false/0/""/[]/{} are false)."""
    return (
        F.when(v.isNull(), F.lit(False))
        .when(kind == "VOID", F.lit(False))
        .when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(kind == "STRING", F.length(F.try_variant_get(v, "$", "string")) > 0)
        .when(kind == "ARRAY", F.size(F.try_variant_get(v, "$", "array<variant>")) > 0)
        .when(kind == "OBJECT", F.size(v.try_cast("map<string,variant>")) > 0)
        .otherwise(F.coalesce(F.try_variant_get(v, "$", "double") != 0, F.lit(False)))
    )


def normalise_requests(raw: DataFrame, event: str = "event", request_id: str = "request_id",
                       default_symbols: list[str] = DEFAULT_SYMBOLS,
                       default_start: str = DEFAULT_START_DATE,
                       default_end: str = DEFAULT_END_DATE) -> DataFrame:
    """``(request_id, event STRING)`` -> ``(request_id, route, symbols,
    start_date, end_date, status, error, body_text)``."""
    ev = F.try_parse_json(F.col(event))
    step1 = raw.select(
        F.col(request_id).alias("request_id"),
        F.col(event).isNull().alias("_event_missing"),
        ev.alias("_ev"),
    )
    step1 = fence(step1, "request_id")
    obj = F.col("_ev").try_cast("map<string,variant>")
    step1 = fence(step1.select("request_id", "_event_missing", "_ev", _kind(F.col("_ev")).alias("_ev_kind"), obj.alias("_obj")), "request_id")

    # each of these is read several times below: a value and its kind are taken out once
    obj = F.col("_obj")
    empty_event = F.col("_event_missing") | (F.col("_ev").isNotNull() & ~_truthy(F.col("_ev"), F.col("_ev_kind")))
    has_top = F.lit(False)
    for k in REQUEST_KEYS:
        has_top = has_top | F.coalesce(F.map_contains_key(obj, k), F.lit(False))
    body_v, base64_v = obj["body"], obj["isBase64Encoded"]
    step1 = fence(step1.select(
        "request_id", "_ev", "_obj", empty_event.alias("_empty"), has_top.alias("_top"), body_v.alias("_body_v"),
        _kind(body_v).alias("_body_kind"), base64_v.alias("_b64_v"), _kind(base64_v).alias("_b64_kind")), "request_id")
    body_v, kind = F.col("_body_v"), F.col("_body_kind")
    body_text = F.when(kind == "STRING", F.try_variant_get(body_v, "$", "string"))
    step1 = fence(step1.select(
        "request_id", "_ev", "_obj", "_empty", "_top", _truthy(body_v, kind).alias("_has_body"),
        _truthy(F.col("_b64_v"), F.col("_b64_kind")).alias("_is_b64"), body_text.alias("_body_text")), "request_id")

    empty_event, has_top, has_body, body_text = (F.col(c) for c in ("_empty", "_top", "_has_body", "_body_text"))
    decoded = F.when(F.col("_is_b64"), base64_text(body_text)).otherwise(body_text)

    step2 = step1.select(
        "request_id",
        F.when(empty_event, F.lit(ROUTE_DEFAULT))
        .when(F.col("_ev").isNull(), F.lit(None))
        .when(obj.isNull(), F.lit(None))
        .when(has_top, F.lit(ROUTE_DIRECT))
        .when(has_body, F.lit(ROUTE_BODY))
        .otherwise(F.lit(ROUTE_DEFAULT)).alias("route"),
        F.when(empty_event, F.lit(None))
        .when(F.col("_ev").isNull(), F.lit(ERR_EVENT_JSON))
        .when(obj.isNull(), F.lit(ERR_EVENT_OBJECT)).alias("_event_error"),
        obj.alias("_obj"),
        (~empty_event & ~has_top & has_body).alias("_use"),
        F.when(~empty_event & ~has_top & has_body, decoded).alias("_text"),
        body_text.isNull().alias("_not_string"),
    )
    step2 = fence(step2, "request_id")
    step2 = fence(step2.select("request_id", "route", "_event_error", "_obj", F.when(F.col("_use"), F.struct(
        F.col("_not_string").alias("not_string"),
        F.col("_text").alias("text"),
        F.try_parse_json("_text").alias("json"),
    )).alias("_body")), "request_id")

    body = F.col("_body")
    body_obj = body["json"].try_cast("map<string,variant>")
    body_error = (
        F.when(body["not_string"], F.lit(ERR_BODY_TYPE))
        .when(body["text"].isNull(), F.lit(ERR_BODY_BASE64))
        .when(body["json"].isNull(), F.lit(BAD_BODY_ERROR))
        .when(body_obj.isNull(), F.lit(ERR_BODY_OBJECT))
    )
    src = F.when(F.col("route") == ROUTE_DIRECT, F.col("_obj")).when(F.col("route") == ROUTE_BODY, body_obj)
    step3 = step2.select(
        "request_id", "route",
        F.coalesce(F.col("_event_error"),
                   F.when(F.col("route") == ROUTE_BODY, body_error)).alias("_error"),
        F.col("_body.text").alias("body_text"),
        src.alias("_src"),
    )
    step3 = fence(step3, "request_id")

    src = F.col("_src")
    sym_v = src["symbols"]
    sym_arr = F.try_variant_get(sym_v, "$", "array<variant>")
    sym_ok = sym_arr.isNotNull() & F.forall(sym_arr, lambda x: _kind(x) == "STRING")
    symbols = F.when(~F.coalesce(F.map_contains_key(src, "symbols"), F.lit(False)),
                     F.array(*[F.lit(s) for s in default_symbols])) \
        .when(sym_ok, F.transform(sym_arr, lambda x: F.try_variant_get(x, "$", "string")))

    def date_field(key: str, default: str) -> tuple[Column, Column]:
        v = src[key]
        present = F.coalesce(F.map_contains_key(src, key), F.lit(False))
        value = F.when(~present, F.lit(default)).when(_kind(v) == "STRING", F.try_variant_get(v, "$", "string"))
        return value, present & (_kind(v) != "STRING")

    start, bad_start = date_field("start_date", default_start)
    end, bad_end = date_field("end_date", default_end)
    step4 = fence(step3.select(
        "request_id", "route", "body_text", "_error",
        symbols.alias("_symbols"), start.alias("_start"), end.alias("_end"),
        (bad_start | bad_end).alias("_bad_dates"),
    ), "request_id")
    error = F.coalesce(
        F.col("_error"),
        F.when(F.col("_symbols").isNull(), F.lit(ERR_SYMBOLS)),
        F.when(F.col("_bad_dates"), F.lit(ERR_DATES)),
    )
    step5 = fence(step4.withColumn("error", error), "request_id")
    ok = F.col("error").isNull()
    return fence(step5.select(
        "request_id", "route",
        F.when(ok, F.col("_symbols")).alias("symbols"),
        F.when(ok, F.col("_start")).alias("start_date"),
        F.when(ok, F.col("_end")).alias("end_date"),
        F.when(ok, F.lit(200)).otherwise(F.lit(500)).alias("status"),
        "error",
        "body_text",
    ), "request_id")


def normalise_direct_requests(raw: DataFrame, event: str = "event", request_id: str = "request_id",
                              default_start: str = DEFAULT_START_DATE, null_event_ok: bool = True) -> DataFrame:
    """The direct handler: only the event's top level is read, a ``body`` never is.

    Everything but the request keys is taken out of the event before
    routing, so an event with nothing but a body gets the defaults.  A null
    event counts as empty, unless ``null_event_ok`` is false: then it is
    refused like any event that isn't an object."""
    parsed = F.try_parse_json(F.col(event))
    top = parsed.try_cast("map<string,variant>")
    own = F.when(top.isNotNull(), F.to_json(F.map_filter(top, lambda k, _: k.isin(*REQUEST_KEYS)))).otherwise(F.col(event))
    if not null_event_ok:
        own = F.when(F.col(event).isNull() | (_kind(parsed) == "VOID"), F.lit('"null"')).otherwise(own)
    return normalise_requests(raw.withColumn(event, own), event, request_id, default_start=default_start)


def normalise_packaged_requests(raw: DataFrame, event: str = "event", request_id: str = "request_id") -> DataFrame:
    """The first packaged handler: like the direct one, with a later default
    start date; it reads its keys from the event itself, so a null event fails."""
    return normalise_direct_requests(raw, event, request_id, default_start=PACKAGED_DEFAULT_START_DATE, null_event_ok=False)


def request_url(requests: DataFrame, interval: str = DEFAULT_INTERVAL,
                base_url: str = API_BASE_URL) -> Column:
    """A10: the handler's GET URL, without the credential (sent as a
    header by our fetchers, never stored)."""
    query = form_encode([
        ("interval", F.lit(interval)),
        ("start_date", F.col("start_date")),
        ("end_date", F.col("end_date")),
        ("symbol", symbols_param(F.col("symbols"))),
    ])
    return F.when(F.col("status") == 200, F.concat(F.lit(base_url + "?"), query))
