"""A stand-in API for tests: answers from a local folder that Spark wrote from ``events``."""

import glob
import json
import os

from pyspark.sql import functions as F

from ticksmith.plans.fixtures import DOC_CHUNK, _meta_for, bar_struct

_LISTINGS: dict[str, list[str]] = {}
_LINES: dict[str, list[str]] = {}


def _glob(pattern: str) -> list[str]:
    """Folder listings are immutable once the stand-in is written, so each
    Python worker lists a folder once."""
    if pattern not in _LISTINGS:
        if len(_LISTINGS) > 100_000:
            _LISTINGS.clear()
        _LISTINGS[pattern] = sorted(glob.glob(pattern))
    return _LISTINGS[pattern]


def _lines(path: str) -> list[str]:
    if path not in _LINES:
        if len(_LINES) > 20_000:
            _LINES.clear()
        with open(path, encoding="utf-8") as fh:
            _LINES[path] = fh.read().splitlines()
    return _LINES[path]


def folder_fetch(symbols: list[str], start_date: str, end_date: str, interval: str,
                 options: dict) -> tuple[int, str]:
    """Answer like the API from ``options["mock_root"]``.

    Layout (written by Spark): ``bars/symbol=S/day=D/*.txt`` with lines
    ``<chunk>\\t<JSON array of bars>`` and ``meta/symbol=S/*.txt`` with the
    meta object.  Unknown symbols get the API's per-symbol error object;
    a call where every symbol is unknown answers 404.
    """
    root = options["mock_root"]
    parts, known = [], 0
    for sym in symbols:
        sym_dir = os.path.join(root, "bars", f"symbol={sym}")
        meta_files = _glob(os.path.join(root, "meta", f"symbol={sym}", "*.txt"))
        day_dirs = _glob(os.path.join(sym_dir, "day=*"))
        if not day_dirs and not meta_files:
            parts.append(json.dumps(sym) + ':{"code":404,"message":"symbol not found","status":"error"}')
            continue
        known += 1
        meta = "{}"
        for f in meta_files:
            lines = [x for x in _lines(f) if x.strip()]
            if lines:
                meta = lines[0].strip()
                break
        frags = []
        for day_dir in day_dirs:
            day = day_dir.rsplit("=", 1)[1]
            if day < start_date or day > end_date:
                continue
            for f in _glob(os.path.join(day_dir, "*.txt")):
                for line in _lines(f):
                    chunk, _, arr = line.partition("\t")
                    if len(arr) > 2:
                        frags.append((day, chunk, arr[1:-1]))
        frags.sort()
        values = ",".join(f[2] for f in frags)
        parts.append(json.dumps(sym) + ':{"meta":' + meta + ',"values":[' + values + "]}")
    if symbols and known == 0:
        return 404, '{"code":404,"message":"no such symbols","status":"error"}'
    return 200, "{" + ",".join(parts) + "}"


def write_mock_api(events, root: str, drop_error_meta: bool = True) -> str:
    """Write what the stand-in API serves (``fetchers.folder_fetch``).

    ``bars/symbol=S/day=D``: one line per chunk of ``DOC_CHUNK`` event ids,
    ``<chunk>\\t<JSON array of bars in event order>``; ``meta/symbol=S``:
    the symbol's meta object.  Groups are bounded by the chunk, so a hot
    symbol or day is still split into many small groups.
    """
    items = events.select(
        F.col("event_type").alias("symbol"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.lpad(F.floor(F.col("event_id") / DOC_CHUNK).cast("string"), 8, "0").alias("chunk"),
        F.struct(F.col("event_id"),
                 bar_struct((F.col("ts"), F.col("value"), F.col("user_id"))).alias("bar")).alias("item"),
    )
    frags = items.groupBy("symbol", "day", "chunk").agg(F.array_sort(F.collect_list("item")).alias("items"))
    frags.select(
        "symbol", "day",
        F.concat("chunk", F.lit("\t"), F.to_json(F.transform("items", lambda x: x["bar"]))).alias("value"),
    ).write.mode("overwrite").partitionBy("symbol", "day").text(f"{root}/bars")
    symbols = events.select(F.col("event_type").alias("symbol")).distinct()
    meta = _meta_for(F.col("symbol"), drop_error_meta)
    symbols.select("symbol", F.coalesce(F.to_json(meta), F.lit("{}")).alias("value")) \
        .write.mode("overwrite").partitionBy("symbol").text(f"{root}/meta")
    return root
