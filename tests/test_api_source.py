"""API data source: call plan, options, one flatten for its answers."""

import pytest
from pyspark.sql import functions as F

from standin import write_mock_api
from ticksmith.sources.api import api_bars, plan_calls, register

SF = "/root/testdata/sf0.001"
SYMBOLS = ["click", "error", "purchase", "signup", "view"]


@pytest.fixture(scope="module")
def api(spark):
    import os
    import tempfile

    spark.sparkContext.addPyFile(os.path.join(os.path.dirname(__file__), "standin.py"))
    return {"fetcher": "standin:folder_fetch", "mock_root": write_mock_api(spark.read.parquet(f"{SF}/events.parquet"), tempfile.mkdtemp() + "/api")}


def test_plan_calls():
    calls = plan_calls(["A", "B", "C"], "2026-01-01", "2026-01-10", 2, 7)
    assert [(c.symbols, c.start_date, c.end_date) for c in calls] == [
        (["A", "B"], "2026-01-01", "2026-01-07"), (["A", "B"], "2026-01-08", "2026-01-10"),
        (["C"], "2026-01-01", "2026-01-07"), (["C"], "2026-01-08", "2026-01-10")]
    assert plan_calls(["A"], "2026-02-01", "2026-01-01", 8, 0) == []


def test_bars_equal_the_events(spark, api):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    assert api_bars(spark, SYMBOLS, "2024-01-01", "2024-01-31", symbols_per_call=2, days_per_call=7, **api).count() == ev.count()
    f = api_bars(spark, ["click", "view"], "2024-01-10", "2024-01-20", days_per_call=7, **api)
    day = F.date_format("ts", "yyyy-MM-dd")
    assert f.count() == ev.where(F.col("event_type").isin("click", "view") & day.between("2024-01-10", "2024-01-20")).count()
    # the calls are those the list and the range need: one batch x two weeks
    assert f.rdd.getNumPartitions() == 2


def test_a_bound_that_is_no_date_filters_rows(spark, tmp_path):
    (tmp_path / "dated.py").write_text(
        "import json\ndef fetch(symbols, start, end, interval, options):\n"
        "    return 200, json.dumps({'A': {'values': [{'datetime': d, 'open': start} for d in ('2026-01-31', '2026-02-01', '2026-03-01')]}})\n")
    spark.sparkContext.addPyFile(str(tmp_path / "dated.py"))
    for bound, rows, start in (("2026-02", 2, "2026-01-01"), ("2026-02-01", 2, "2026-02-01"), ("2026-2-1", 0, "2026-01-01"), ("", 3, "2026-01-01"), ("x", 0, "2026-01-01")):
        got = api_bars(spark, ["A"], start_date=bound, fetcher="dated:fetch").collect()
        assert len(got) == rows and {r["open"] for r in got} <= {start}


def test_refused_answers(spark, api):
    with pytest.raises(Exception, match="refused"):
        api_bars(spark, ["click", "NOPE"], "2024-01-01", "2024-01-31", symbols_per_call=1, **api).collect()
    kept = api_bars(spark, ["click", "NOPE"], "2024-01-01", "2024-01-31", on_error="skip", symbols_per_call=1, **api)
    assert {r["symbol"] for r in kept.select("symbol").distinct().collect()} == {"click"}


def test_numbers_keep_their_text(spark, tmp_path):
    (tmp_path / "plain_numbers.py").write_text("def fetch(*a):\n    return 200, '{\"A\":{\"values\":[{\"open\":5,\"high\":1.50}]}}'\n")
    spark.sparkContext.addPyFile(str(tmp_path / "plain_numbers.py"))
    row = api_bars(spark, ["A"], fetcher="plain_numbers:fetch").first()
    assert (row["open"], row["high"]) == ("5", "1.5")


def test_documents_404(spark, api):
    register(spark)
    bad = spark.read.format("timeseries_api").option("fetcher", api["fetcher"]).option("mock_root", api["mock_root"]).option("symbols", "NOPE").load()
    assert bad.select("http_status").first()[0] == 404
