"""Request matrix (FIXTURES.md section 1)."""

import base64

import pytest

from ticksmith.operators import requests as rq

B64 = base64.b64encode(b'{"symbols":["Z"]}').decode()
D = ["AAPL", "GOOG", "NVDA"]

# event text, expected (route, symbols, start, end, status)
MATRIX = [
    ('{"symbols":["A","B"],"start_date":"2026-02-01","end_date":"2026-02-28"}',
     ("direct", ["A", "B"], "2026-02-01", "2026-02-28", 200)),
    ('{"start_date":"2026-02-01"}', ("direct", D, "2026-02-01", "2026-03-31", 200)),
    ('{"end_date":"2026-02-28","body":"{\\"symbols\\":[\\"Z\\"]}"}', ("direct", D, "2026-01-01", "2026-02-28", 200)),
    ('{"body":"{\\"symbols\\":[\\"Z\\"]}"}', ("body", ["Z"], "2026-01-01", "2026-03-31", 200)),
    ('{"isBase64Encoded":true,"body":"' + B64 + '"}', ("body", ["Z"], "2026-01-01", "2026-03-31", 200)),
    ('{"body":"{oops"}', ("body", None, None, None, 500)),
    ('{"body":"[1]"}', ("body", None, None, None, 500)),
    ('{"body":""}', ("default", D, "2026-01-01", "2026-03-31", 200)),
    ("{}", ("default", D, "2026-01-01", "2026-03-31", 200)),
    ("null", ("default", D, "2026-01-01", "2026-03-31", 200)),
    (None, ("default", D, "2026-01-01", "2026-03-31", 200)),
    ('{"symbols":null}', ("direct", None, None, None, 500)),
    ('{"symbols":"AAPL"}', ("direct", None, None, None, 500)),
    ('{"start_date":null}', ("direct", None, None, None, 500)),
    ('{"isBase64Encoded":true,"body":"abc"}', ("body", None, None, None, 500)),
    ('[1,2]', (None, None, None, None, 500)),
    ('{not json', (None, None, None, None, 500)),
]


@pytest.fixture(scope="module")
def normalised(spark):
    rows = [(str(i), ev) for i, (ev, _) in enumerate(MATRIX)]
    df = rq.normalise_requests(spark.createDataFrame(rows, "request_id string, event string"))
    return {r["request_id"]: r for r in df.collect()}


@pytest.mark.parametrize("i", range(len(MATRIX)))
def test_request_matrix(normalised, i):
    r = normalised[str(i)]
    route, symbols, start, end, status = MATRIX[i][1]
    assert (r["route"], r["symbols"], r["start_date"], r["end_date"], r["status"]) == (
        route, symbols, start, end, status), MATRIX[i][0]
    assert (r["error"] is None) == (status == 200)


def test_bad_json_message(normalised):
    assert normalised["5"]["error"] == "Request body must be valid JSON"


def test_url_form_encoding(spark):
    df = spark.createDataFrame([("1", '{"symbols":["A B","C~D*"],"start_date":"2026-01-01"}')],
                               "request_id string, event string")
    reqs = rq.normalise_requests(df)
    url = reqs.select(rq.request_url(reqs)).first()[0]
    from urllib.parse import urlencode
    want = urlencode({"interval": "1day", "start_date": "2026-01-01", "end_date": "2026-03-31",
                      "symbol": "A B,C~D*"})
    assert url == "https://api.twelvedata.com/time_series?" + want
    assert "apikey" not in url


def test_packaged_defaults(spark):
    df = spark.createDataFrame([("1", "{}"), ("2", '{"end_date":"2026-03-15"}')], "request_id string, event string")
    got = {r["request_id"]: (r["start_date"], r["end_date"]) for r in rq.normalise_packaged_requests(df).collect()}
    assert got == {"1": ("2026-03-01", "2026-03-31"), "2": ("2026-03-01", "2026-03-15")}


def test_one_row_group_of_events_is_spread_evenly(spark, tmp_path, monkeypatch):
    from pyspark.sql import functions as F

    from ticksmith.functions import columns
    from ticksmith.plans.registry import QUERIES

    events = spark.range(4000).selectExpr(
        "id as event_id", "timestamp_ntz'2024-01-02 00:00:00' as ts", "id % 9 as user_id", "'click' as event_type", "1.5D as value", "'{}' as props")
    events.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(columns, "SMALL_INPUT", 0)  # as for a larger file
    for per_task in (10**9, 1000):
        monkeypatch.setattr(columns, "HEAVY_TASK", per_task)
        out = QUERIES["request_defaults"](spark, str(tmp_path))
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        tasks = max(2 * spark.sparkContext.defaultParallelism, 1)
        assert sum(sizes) == 4000 and len(sizes) >= tasks and max(sizes) <= 2 * 4000 // tasks
    assert len(sizes) > tasks  # more tasks for more bytes
