"""Requests as a table: one verdict per request, distinct calls, keys only to what exists; the three handlers' routing."""

import json

import pytest
from pyspark.sql import functions as F

from ticksmith.functions.stamps import FIXED_STAMP
from ticksmith.operators import requests as rq
from ticksmith.plans.ingest import call_plan, ingest_requests
from ticksmith.sinks import files

ENTRY = {"meta": {"interval": "1day"}, "values": [{"datetime": "2026-01-02", "open": "1"}]}


def answer(symbols, start, end, interval, options):
    """A stand-in for the API: B is malformed, E has no bars, X is unknown."""
    body = {s: 7 if s == "B" else {**ENTRY, "values": []} if s == "E" else ENTRY for s in symbols}
    return (404, "{}") if symbols == ["X"] else (200, json.dumps(body))


@pytest.fixture()
def fetcher(monkeypatch):
    from ticksmith.plans import ingest

    def fetch(spark, calls, name, options=None, interval="1day", partitions=None):
        rows = [(c["call_id"], ",".join(c["symbols"]), c["start_date"], c["end_date"],
                 *answer(c["symbols"], None, None, interval, {})) for c in calls.collect()]
        return spark.createDataFrame(rows, ingest.FETCHED_DDL)

    monkeypatch.setattr(ingest, "fetch_calls", fetch)


def test_request_runs(spark, tmp_path, fetcher):
    nine = [f"S{k}" for k in range(9)]
    events = {
        "nine": {"symbols": nine}, "mixed": {"symbols": [*nine, "B"]}, "same": {"symbols": nine},
        "empty": {"symbols": ["E"]}, "none": {"symbols": []}, "unknown": {"symbols": ["X"]}, "bad": {"symbols": 3},
    }
    raw = spark.createDataFrame([(k, json.dumps(v)) for k, v in events.items()], "request_id string, event string")
    reqs = rq.normalise_requests(raw)
    assert call_plan(reqs).count() == 4  # equal requests share a call, an empty one makes none
    root = str(tmp_path)
    for _ in range(2):  # a re-run replaces itself
        rows = {r["request_id"]: r for r in ingest_requests(spark, reqs, root, FIXED_STAMP, "unused").collect()}
        assert len(rows) == len(events)
    assert (rows["nine"]["status"], rows["nine"]["fact_row_count"], rows["nine"]["dim_row_count"]) == (200, 9, 9)
    assert rows["same"]["fact_key"] == rows["nine"]["fact_key"] is not None
    # one malformed entry among ten symbols refuses the whole request
    assert (rows["mixed"]["status"], rows["mixed"]["fact_row_count"], rows["mixed"]["rejected_count"]) == (500, 0, 1)
    assert rows["mixed"]["raw_key"] is None
    assert (rows["empty"]["status"], rows["empty"]["fact_key"], rows["empty"]["dim_row_count"]) == (200, None, 1)
    assert [rows["none"][f"{t}_key"] for t in ("raw", "fact", "dim")] == [None] * 3
    assert rows["unknown"]["status"] == rows["bad"]["status"] == 500
    day, run = FIXED_STAMP.extract_date, FIXED_STAMP.run_id
    assert files.read_table(spark, root, "fact").count() == 9
    attempt = files.published_attempts(spark, root)[day, run]
    rejects = spark.read.json(f"{root}/rejects/extract_date={day}/run_id={run}/attempt={attempt}")
    assert sorted(r["reject_reason"] for r in rejects.collect()) == ["entry_not_object", "http_status"]


def test_raise_ends_a_batch_of_requests_before_its_first_write(spark, tmp_path, fetcher):
    raw = spark.createDataFrame([("ok", '{"symbols":["A"]}'), ("mixed", '{"symbols":["A","B"]}')], "request_id string, event string")
    with pytest.raises(ValueError, match="entry_not_object"):
        ingest_requests(spark, rq.normalise_requests(raw), str(tmp_path), FIXED_STAMP, "unused", on_error="raise")
    assert not (tmp_path / "raw").exists() and not (tmp_path / "manifest").exists()
    rows = ingest_requests(spark, rq.normalise_requests(raw.where("request_id = 'ok'")), str(tmp_path), FIXED_STAMP, "unused", on_error="raise")
    assert [r["status"] for r in rows.collect()] == [200]


DAY = {"meta": {"interval": "1day"}, "values": [{"datetime": "2026-01-02", "open": "1"}]}


@pytest.fixture()
def store(spark, tmp_path):
    from ticksmith.sources.answers import write_answers

    rows = [(s, d, "1day", f"{s}|{d}", json.dumps({s: DAY})) for s in "ABC" for d in ("2026-01-02", "2026-02-03")]
    rows += [("D", "2026-01-02", "1day", "D|bad", '{"D":{"values":[7]}}'), ("A", "2026-01-02", "1h", "A|h", json.dumps({"A": DAY}))]
    return write_answers(spark.createDataFrame(rows, "symbol string, day string, interval string, doc_id string, body string"), str(tmp_path / "store"))


def test_requests_over_landed_answers(spark, tmp_path, store):
    from ticksmith.sources.answers import landed_answers

    events = {
        "two": {"symbols": ["A", "B", "A"]}, "january": {"symbols": ["A"], "end_date": "2026-01-31"}, "part": {"symbols": ["A", "X"]},
        "none": {"symbols": ["X", "Y"]}, "bad": {"symbols": ["C", "D"]}, "late": {"symbols": ["C"], "start_date": "2026-03-01"}, "empty": {"symbols": []},
    }
    reqs = rq.normalise_requests(spark.createDataFrame([(k, json.dumps(v)) for k, v in events.items()], "request_id string, event string"))
    root = str(tmp_path / "out")
    rows = {r["request_id"]: r for r in ingest_requests(spark, reqs, root, FIXED_STAMP, answers=landed_answers(store)).collect()}
    got = {k: (r["status"], r["fact_row_count"], r["dim_row_count"], r["rejected_count"]) for k, r in rows.items()}
    assert got == {
        "two": (200, 4, 2, 0), "january": (200, 1, 1, 0), "part": (200, 2, 2, 0), "none": (500, 0, 0, 1), "bad": (500, 0, 0, 1),
        "late": (200, 0, 1, 0), "empty": (200, 0, 0, 0),
    }
    assert rows["empty"]["raw_key"] is None and rows["late"]["fact_key"] is None and rows["late"]["dim_key"]
    # each needed answer once; nothing of C, whose only request with bars is refused
    facts = files.read_table(spark, root, "fact")
    assert sorted(r["symbol"] for r in facts.collect()) == ["A", "A", "B", "B"]
    assert {r["symbol"] for r in files.read_table(spark, root, "dim").collect()} == {"A", "B", "C", "X"}


def test_filters_reach_the_scan_of_the_store(spark, store):
    from ticksmith.sources.answers import bars, read_answers

    df = bars(read_answers(spark, store, symbols=["A", "B"], start_date="2026-02"))
    assert sorted((r["symbol"], r["price_date"]) for r in df.collect()) == [("A", "2026-01-02"), ("B", "2026-01-02")]
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :]
    assert "IsNotNull(day)" in pushed and "In(symbol, [A,B])" in pushed and "GreaterThanOrEqu" in pushed


def test_direct_handler_gives_one_verdict(spark, tmp_path):
    from ticksmith.plans.ingest import ingest_answers

    nine = [(f"call{k}", json.dumps({f"S{k}": DAY}), 200) for k in range(8)] + [("call8", '{"S8":7}', 200)]
    schema, root = "doc_id string, body string, http_status int", str(tmp_path)
    with pytest.raises(ValueError, match="entry_not_object"):
        ingest_answers(spark, spark.createDataFrame(nine, schema), root, FIXED_STAMP)
    assert not any((tmp_path / d).exists() for d in ("raw", "manifest", "rejects"))
    res = ingest_answers(spark, spark.createDataFrame(nine, schema), root, FIXED_STAMP, on_error="row")
    assert (res.status, res.fact_row_count, res.rejected_count) == (500, 0, 1)
    assert not (tmp_path / "raw").exists() and files.read_manifest(spark, root).first()["status"] == 500
    assert ingest_answers(spark, spark.createDataFrame(nine[:8], schema), root, FIXED_STAMP).fact_row_count == 8


def test_direct_handler_makes_one_call(spark, tmp_path):
    from ticksmith.plans.ingest import ingest_api

    (tmp_path / "answer.py").write_text(
        "import json\ndef fetch(symbols, start, end, interval, options):\n"
        "    return 200, json.dumps({s: 7 if s == 'B' else {'meta': {'interval': interval}, 'values': [{'datetime': start, 'open': len(symbols)}]} for s in symbols})\n")
    spark.sparkContext.addPyFile(str(tmp_path / "answer.py"))
    symbols = [f"S{k}" for k in range(9)]
    args = ("2026-01-01", "2026-01-31", "answer:fetch")
    for per_call in (0, 2):
        with pytest.raises(ValueError, match="entry_not_object"):
            ingest_api(spark, str(tmp_path / "out"), FIXED_STAMP, [*symbols, "B"], *args, symbols_per_call=per_call)
        assert not (tmp_path / "out" / "raw").exists()
    assert ingest_api(spark, str(tmp_path / "out"), FIXED_STAMP, symbols, *args).fact_row_count == 9
    opened = files.read_table(spark, str(tmp_path / "out"), "fact").select("open").distinct().collect()
    assert [r[0] for r in opened] == ["9"]


EVENTS = {
    "body": '{"body":"{\\"symbols\\":[\\"Z\\"]}"}', "top": '{"symbols":["A"],"body":"x"}', "null": None,
    "json_null": "null", "list": "[1]", "text": '{"symbols":"A"}',
}


@pytest.mark.parametrize("handler,expected", [
    (rq.normalise_requests, {"body": ["Z"], "top": ["A"], "null": 3, "json_null": 3, "list": None, "text": None}),
    (rq.normalise_direct_requests, {"body": 3, "top": ["A"], "null": 3, "json_null": 3, "list": None, "text": None}),
    (rq.normalise_packaged_requests, {"body": 3, "top": ["A"], "null": None, "json_null": None, "list": None, "text": None}),
])
def test_routing_of_the_handlers(spark, handler, expected):
    raw = spark.createDataFrame(list(EVENTS.items()), "request_id string, event string")
    got = {r["request_id"]: r["symbols"] for r in handler(raw).collect()}
    assert {k: len(v) if expected[k] == 3 else v for k, v in got.items()} == expected


def test_filters_on_input_columns_reach_the_scan(spark, tmp_path):
    from ticksmith.operators.flatten import parse_documents

    path = str(tmp_path / "t")
    spark.createDataFrame([("1", "{}")], "request_id string, event string").write.parquet(path)
    events = spark.read.parquet(path)
    docs = events.select(F.col("request_id").alias("doc_id"), F.col("event").alias("body"))
    for df in (rq.normalise_requests(events).where("request_id = '1'"), parse_documents(docs).where("doc_id = '1'")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "EqualTo(request_id,1)" in plan


def test_events_are_read_once_for_verdicts_and_manifest(spark, tmp_path, store):
    from ticksmith.sources.answers import landed_answers

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    raw = spark.createDataFrame([("a", '{"symbols":["A"]}'), ("b", "{oops"), (None, '{"symbols":["B"]}')], "request_id string, event string")
    reqs = rq.normalise_requests(raw.mapInArrow(counted, "request_id string, event string"))
    root = str(tmp_path / "out")
    rows = {r["request_id"]: r["status"] for r in ingest_requests(spark, reqs, root, FIXED_STAMP, answers=landed_answers(store)).collect()}
    assert rows == {"a": 200, "b": 500, None: 200} and seen.value == 3
    assert not reqs.storageLevel.useMemory
    assert {r["symbol"] for r in files.read_table(spark, root, "fact").collect()} == {"A"}


def test_requests_kept_by_the_caller_stay_kept(spark, tmp_path, fetcher):
    reqs = rq.normalise_requests(spark.createDataFrame([("a", '{"symbols":["A"]}')], "request_id string, event string")).persist()
    ingest_requests(spark, reqs, str(tmp_path), FIXED_STAMP, "unused")
    assert reqs.storageLevel.useMemory
    reqs.unpersist()
