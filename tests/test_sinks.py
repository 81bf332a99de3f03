"""Sink read-back: exact CSV bytes, header-only runs, partition discovery, manifest."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from ticksmith.functions.stamps import FIXED_STAMP, RunStamp
from ticksmith.plans.ingest import ingest_documents
from ticksmith.sinks import files

GOOD = '{"A":{"meta":{"interval":"1day"},"values":[{"datetime":"2026-01-02","open":"a,b","high":"q\\"x","close":""}]}}'


def _read_csv_text(path):
    parts = sorted(glob.glob(os.path.join(path, "part-*.csv")))
    return "".join(open(p, encoding="utf-8", newline="").read() for p in parts)


def test_csv_dialect_and_readback(spark, tmp_path):
    root = str(tmp_path)
    docs = spark.createDataFrame([("d", GOOD)], "doc_id string, body string")
    res = ingest_documents(spark, docs, root, FIXED_STAMP, single_file=True)
    assert res.status == 200 and res.fact_row_count == 1 and res.dim_row_count == 1
    text = _read_csv_text(files.run_path(root, "fact", res.extract_date, res.run_id, res.attempt))
    assert text == ("symbol,price_date,open,high,low,close,volume,extracted_at_utc\r\n"
                    'A,2026-01-02,"a,b","q""x",,,,2026-03-31T22:15:30+00:00\r\n')
    back = files.read_csv_run(spark, files.run_path(root, "fact", res.extract_date, res.run_id, res.attempt), "fact").first()
    assert back["open"] == "a,b" and back["high"] == 'q"x' and back["low"] is None
    raw = spark.read.text(files.run_path(root, "raw", res.extract_date, res.run_id, res.attempt)).first()[0]
    assert raw == GOOD  # as received
    assert res.raw_key == "raw/twelvedata/stocks_api/extract_date=2026-03-31/run_id=20260331T221530Z/"


def test_field_text_is_not_trimmed(spark, tmp_path):
    root = str(tmp_path)
    body = '{" A ":{"meta":{"interval":" 1day"},\n "values":[{"datetime":"2026-01-02","open":"  1.50"}]}}'
    res = ingest_documents(spark, spark.createDataFrame([("d", body)], "doc_id string, body string"), root, FIXED_STAMP,
                           single_file=True)
    assert _read_csv_text(files.run_path(root, "fact", res.extract_date, res.run_id, res.attempt)).split("\r\n")[1].startswith(
        " A ,2026-01-02,  1.50,")
    assert files.read_csv_run(spark, files.run_path(root, "dim", res.extract_date, res.run_id, res.attempt), "dim").first()[
        "interval"] == " 1day"
    raw = spark.read.text(files.run_path(root, "raw", res.extract_date, res.run_id, res.attempt)).collect()
    assert [r[0] for r in raw] == [body.replace("\n", " ")]


def test_rerun_keeps_one_manifest_row_and_no_stale_one(spark, tmp_path):
    root = str(tmp_path)
    docs = spark.createDataFrame([("d", GOOD)], "doc_id string, body string")
    res = ingest_documents(spark, docs, root, FIXED_STAMP)
    ingest_documents(spark, docs, root, FIXED_STAMP)
    assert files.read_manifest(spark, root).count() == 1
    assert files.run_listed(spark, root, res.run_id) and not files.run_listed(spark, root, "other")
    bad = spark.createDataFrame([("d", '{"A":1}')], "doc_id string, body string")
    with pytest.raises(ValueError, match="entry_not_object"):
        ingest_documents(spark, bad, root, FIXED_STAMP, on_error="raise")
    # the refused re-run has taken nothing away
    assert files.read_table(spark, root, "fact").count() == 1


@pytest.mark.parametrize("broken", ["write_raw", "write_csv", "publish_manifest"])
def test_a_killed_rerun_leaves_the_earlier_run_readable(spark, tmp_path, monkeypatch, broken):
    root = str(tmp_path)
    docs = spark.createDataFrame([("d", GOOD)], "doc_id string, body string")
    more = spark.createDataFrame([("d", GOOD), ("e", GOOD.replace("A", "B"))], "doc_id string, body string")
    first = ingest_documents(spark, docs, root, FIXED_STAMP)

    def killed(*a, **kw):
        raise KeyboardInterrupt

    with monkeypatch.context() as m, pytest.raises(KeyboardInterrupt):
        m.setattr(files, broken, killed)
        ingest_documents(spark, more, root, FIXED_STAMP)
    symbols = lambda: sorted(r["symbol"] for r in files.read_table(spark, root, "fact").collect())
    assert symbols() == ["A"] and files.read_manifest(spark, root).first()["fact_row_count"] == 1
    # a whole re-run replaces the first; then what neither pointer needs can go
    last = ingest_documents(spark, more, root, FIXED_STAMP)
    assert symbols() == ["A", "B"] and files.read_manifest(spark, root).count() == 1
    assert files.published_attempts(spark, root) == {(last.extract_date, last.run_id): last.attempt}
    assert files.clean_attempts(spark, root) >= 5 and symbols() == ["A", "B"]
    assert files.read_table(spark, root, "fact", manifest_only=False).count() == 2
    assert not os.path.exists(files.run_path(root, "raw", first.extract_date, first.run_id, first.attempt))


def test_empty_run_writes_header(spark, tmp_path):
    root = str(tmp_path)
    res = ingest_documents(spark, spark.createDataFrame([("d", "{}")], "doc_id string, body string"),
                           root, FIXED_STAMP, single_file=True)
    assert res.status == 200 and res.fact_row_count == 0
    text = _read_csv_text(files.run_path(root, "fact", res.extract_date, res.run_id, res.attempt))
    assert text == "symbol,price_date,open,high,low,close,volume,extracted_at_utc\r\n"


def test_all_rejected_run_is_error(spark, tmp_path):
    root = str(tmp_path)
    res = ingest_documents(spark, spark.createDataFrame([("d", '{"code":400}')], "doc_id string, body string"),
                           root, FIXED_STAMP)
    assert res.status == 500 and res.rejected_count == 1
    m = files.read_manifest(spark, root).first()
    assert m["status"] == 500 and m["message"] == "Error during stock ingestion"
    assert "entry_not_object" in m["error"]


def test_partitioned_runs_and_manifest(spark, tmp_path):
    root = str(tmp_path)
    docs = spark.createDataFrame([("d", GOOD)], "doc_id string, body string")
    later = RunStamp(FIXED_STAMP.at.replace(day=30))
    ingest_documents(spark, docs, root, FIXED_STAMP)
    ingest_documents(spark, docs, root, later)
    ingest_documents(spark, docs, root, later)  # same run again: overwrites itself
    df = files.read_table(spark, root, "fact")
    got = sorted((str(r["extract_date"]), r["run_id"]) for r in df.select("extract_date", "run_id").collect())
    assert got == [("2026-03-30", "20260330T221530Z"), ("2026-03-31", "20260331T221530Z")]
    assert dict(df.dtypes)["extract_date"] == "date"
    # a partial run not in the manifest is ignored by readers
    os.makedirs(files.run_path(root, "fact", "2026-04-01", "X", "a"), exist_ok=True)
    with open(os.path.join(files.run_path(root, "fact", "2026-04-01", "X", "a"), "part-0.csv"), "w") as fh:
        fh.write("symbol,price_date,open,high,low,close,volume,extracted_at_utc\r\nZ,,,,,,,\r\n")
    assert files.read_table(spark, root, "fact").where(F.col("symbol") == "Z").count() == 0
    assert files.read_table(spark, root, "fact", manifest_only=False).where(F.col("symbol") == "Z").count() == 1


def test_raw_only_run(spark, tmp_path):
    root = str(tmp_path)
    docs = spark.createDataFrame([("d", GOOD)], "doc_id string, body string")
    res = ingest_documents(spark, docs, root, FIXED_STAMP, raw_only=True)
    assert res.status == 200 and res.fact_key is None and res.raw_key
    m = files.read_manifest(spark, root).first()
    assert m["message"] == "Stock API Data ingested successfully"
    assert not os.path.exists(files.run_path(root, "fact", res.extract_date, res.run_id, res.attempt))
