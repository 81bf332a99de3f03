"""Fetchers: one API call -> ``(http_status, body_text)``.

A fetcher is named by ``"module:function"`` so it can be imported on the
executors; it is called as ``fetch(symbols, start_date, end_date,
interval, options)``.

``http_fetch`` is the real GET (form-encoded query, 30 s timeout, no retry:
Spark's task retry re-runs the idempotent read).  The credential is sent
as a header, read from an environment variable on the executor, and is
never part of the URL or any table.
"""

from __future__ import annotations

import os
import urllib.error
import urllib.parse
import urllib.request
from importlib import import_module

from ticksmith.constants import API_BASE_URL, API_TIMEOUT_SECONDS

DEFAULT_KEY_ENV = "TICKSMITH_API_KEY"


def resolve(name: str):
    module, _, func = name.partition(":")
    return getattr(import_module(module), func)


def http_fetch(symbols: list[str], start_date: str, end_date: str, interval: str,
               options: dict) -> tuple[int, str]:
    params = {"interval": interval, "start_date": start_date, "end_date": end_date,
              "symbol": ",".join(symbols)}
    url = options.get("base_url", API_BASE_URL) + "?" + urllib.parse.urlencode(params)
    headers = {"User-Agent": "ticksmith/0.1"}
    key = os.environ.get(options.get("api_key_env", DEFAULT_KEY_ENV))
    if key:
        headers["Authorization"] = f"apikey {key}"
    req = urllib.request.Request(url, headers=headers)
    timeout = float(options.get("timeout", API_TIMEOUT_SECONDS))
    try:
        with urllib.request.urlopen(req, timeout=timeout) as resp:
            return resp.status, resp.read().decode("utf-8")
    except urllib.error.HTTPError as e:  # 4xx / 5xx: keep the status, refuse later
        return e.code, e.read().decode("utf-8", errors="replace")
