"""Text encodings as column expressions.

All JVM-side built-ins; each helper returns NULL instead of failing so one
bad row never stops a batch.
"""

from __future__ import annotations

from urllib.parse import quote_plus

from pyspark.sql import Column
from pyspark.sql import functions as F


def form_value(value: Column) -> Column:
    """``urllib.parse.quote_plus`` of one value.

    Java's encoder differs from Python's in two characters: it keeps ``*``
    and escapes ``~``; everything else (space as ``+``, UTF-8 escapes in
    upper case) already agrees.
    """
    encoded = F.url_encode(value)
    return F.replace(F.replace(encoded, F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def form_encode(pairs: list[tuple[str, Column]]) -> Column:
    """``urlencode(dict)``: ``k=v`` pairs joined by ``&`` in the given order."""
    parts = [F.concat(F.lit(quote_plus(k) + "="), form_value(v)) for k, v in pairs]
    return F.concat_ws("&", *parts)


def symbols_param(symbols: Column) -> Column:
    """``",".join(symbols)``."""
    return F.array_join(symbols, ",")


def base64_text(body: Column) -> Column:
    """``base64.b64decode(body).decode("utf-8")``; NULL where Python raises.

    Characters outside the alphabet are skipped (Python's default mode);
    the remaining length must be a multiple of four, and the bytes must be
    valid UTF-8.
    """
    cleaned = F.regexp_replace(body, r"[^A-Za-z0-9+/=]", "")
    decoded = F.try_to_binary(cleaned, F.lit("base64"))
    text = F.try_validate_utf8(decoded.cast("string"))
    return F.when((F.length(cleaned) % 4) == 0, text)
