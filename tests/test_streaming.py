"""Streaming ingest: two arrivals, then a restart on the same checkpoint."""

import os

from ticksmith.functions.stamps import FIXED_STAMP
from ticksmith.sinks import files
from ticksmith.streaming.ingest_stream import start_ingest_stream

DOC1 = '{"A":{"meta":{},"values":[{"datetime":"2026-01-02","open":"1"}]}}'
DOC2 = '{"B":{"meta":{},"values":[{"datetime":"2026-01-03","open":"2"},{"datetime":"2026-01-04"}]}}'


def _land(path, name, text):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as fh:
        fh.write(text)


def test_two_arrivals_and_restart(spark, tmp_path):
    landing, out, ckpt = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ckpt")
    _land(landing, "r1.json", DOC1)
    start_ingest_stream(spark, landing, out, ckpt, stamp=lambda: FIXED_STAMP, packed=False).awaitTermination()
    _land(landing, "r2.json", DOC2)
    start_ingest_stream(spark, landing, out, ckpt, stamp=lambda: FIXED_STAMP, packed=False).awaitTermination()
    start_ingest_stream(spark, landing, out, ckpt, stamp=lambda: FIXED_STAMP, packed=False).awaitTermination()
    facts = files.read_table(spark, out, "fact")
    assert sorted(r["symbol"] for r in facts.collect()) == ["A", "B", "B"]
    runs = files.read_manifest(spark, out).select("run_id").collect()
    assert sorted(r[0] for r in runs) == ["stream-0000000000", "stream-0000000001"]


def test_landed_files_follow_the_volume(spark, tmp_path):
    from ticksmith.sources.landing import read_document_files, read_documents, write_documents

    docs = spark.range(3000).selectExpr("concat('d', id) as doc_id", "'{}' as body").repartition(7)
    path = write_documents(docs, str(tmp_path / "packed"))
    parts = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(parts) == 1 and read_documents(spark, path).count() == 3000
    assert len([f for f in os.listdir(write_documents(docs, str(tmp_path / "bounded"), max_documents=1000)) if f.startswith("part-")]) == 3
    _land(str(tmp_path / "single"), "a.json", DOC1)
    assert [r["body"] for r in read_document_files(spark, str(tmp_path / "single")).collect()] == [DOC1]


def test_request_stream_answers_each_request_once(spark, tmp_path):
    import json

    from ticksmith.sources.answers import landed_answers, write_answers
    from ticksmith.sources.landing import write_requests
    from ticksmith.streaming.ingest_stream import start_request_stream

    store = write_answers(spark.createDataFrame([("A", "2026-01-02", "1day", "d", DOC1)], "symbol string, day string, interval string, doc_id string, body string"), str(tmp_path / "store"))
    landing, out, ckpt = (str(tmp_path / d) for d in ("in", "out", "ckpt"))
    event = json.dumps({"symbols": ["A"]})
    for rows in ([("1", event), ("1", event), ("2", "{oops")], [("2", "{oops"), ("3", event)], [("1", event)]):
        write_requests(spark.createDataFrame(rows, "request_id string, event string"), landing, mode="append")
        for _ in range(2):  # the second start is a restart with nothing new
            start_request_stream(spark, landing, out, landed_answers(store), ckpt, stamp=lambda: FIXED_STAMP).awaitTermination()
    got = sorted((r["request_id"], r["status"], r["fact_row_count"]) for r in files.read_manifest(spark, out).collect())
    assert got == [("1", 200, 1), ("2", 500, None), ("3", 200, 1)]


def test_a_batch_of_requests_is_parsed_once(spark, tmp_path, monkeypatch):
    from ticksmith.operators import requests as rq
    from ticksmith.sources.answers import landed_answers, write_answers
    from ticksmith.sources.landing import write_requests
    from ticksmith.streaming.ingest_stream import start_request_stream

    seen, normalise = spark.sparkContext.accumulator(0), rq.normalise_requests

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    monkeypatch.setattr(rq, "normalise_requests", lambda raw: normalise(raw).mapInArrow(counted, normalise(raw).schema))
    store = write_answers(spark.createDataFrame([("A", "2026-01-02", "1day", "d", DOC1)], "symbol string, day string, interval string, doc_id string, body string"), str(tmp_path / "store"))
    landing, out, ckpt = (str(tmp_path / d) for d in ("in", "out", "ckpt"))
    write_requests(spark.createDataFrame([(str(k % 5), '{"symbols":["A"]}') for k in range(10)], "request_id string, event string"), landing)
    start_request_stream(spark, landing, out, landed_answers(store), ckpt, stamp=lambda: FIXED_STAMP).awaitTermination()
    assert files.read_manifest(spark, out).count() == seen.value == 5


def test_a_batch_killed_before_its_pointer_is_done_again(spark, tmp_path, monkeypatch):
    import pytest

    landing, out, ckpt = (str(tmp_path / d) for d in ("in", "out", "ckpt"))
    _land(landing, "r1.json", DOC1)

    def killed(*a, **kw):
        raise RuntimeError("killed")

    with monkeypatch.context() as m, pytest.raises(Exception, match="killed"):
        m.setattr(files, "publish_manifest", killed)
        start_ingest_stream(spark, landing, out, ckpt, stamp=lambda: FIXED_STAMP, packed=False).awaitTermination()
    assert files.read_manifest(spark, out).count() == 0
    start_ingest_stream(spark, landing, out, ckpt, stamp=lambda: FIXED_STAMP, packed=False).awaitTermination()
    assert files.read_table(spark, out, "fact").count() == 1
