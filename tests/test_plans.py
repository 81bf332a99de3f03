"""Plan shape: the scale properties the README claims, checked on real plans."""

from pyspark.sql import functions as F

from ticksmith.operators import requests as rq
from ticksmith.operators import textprofile as tp
from ticksmith.operators.urls import normalise_urls, page_urls
from ticksmith.plans.fixtures import request_events

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_request_filter_does_not_blow_up_plan(spark):
    reqs = rq.normalise_requests(request_events(spark.read.parquet(f"{SF}/events.parquet")))
    plan = _plan(reqs.where(F.col("status") == 500).groupBy("error").count())
    assert len(plan) < 200_000
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_url_jobs_are_narrow(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    plan = _plan(normalise_urls(page_urls(pages)))
    assert "Exchange" not in plan and "Python" not in plan


def test_noise_ratios_are_narrow_regexes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    facts = tp.materialise_table(tp.char_table(spark, docs))
    for df in (tp.noise_neighbours(spark, docs, facts), tp.noise_counts(spark, docs, facts)):
        plan = _plan(df)
        assert "Exchange" not in plan and "Window" not in plan and "Generate" not in plan


def test_coherence_has_no_pair_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    prof = tp.CorpusProfile(spark, docs)
    plan = _plan(prof.coherence())
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # narrow from the text to the ratio but for the profiles, the only join, on their block
    assert plan.count("Join ") == 1 and plan.count("Exchange") == plan.count("BroadcastExchange") <= 1
    ranks = _plan(tp.letter_ranks(spark, docs))
    assert ranks.count("Exchange") == 1 and "Join" not in ranks and "Window" not in ranks


def test_ranks_are_compared_by_a_worker(spark):
    """Letters are counted and ranks compared by two workers' functions, none by expressions on each pair of letters."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    plan = _plan(tp.CorpusProfile(spark, docs).coherence())
    assert plan.count("MapInArrow") == 2 and "array_position" not in plan and "array_intersect" not in plan
