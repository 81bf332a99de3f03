"""Golden documents (FIXTURES.md section 2): handler and exploration semantics."""

import pytest

from ticksmith.operators import flatten as fl

GOOD = ('{"A":{"meta":{"interval":"1day","currency":"USD","exchange":"X","mic_code":"M","type":"T"},'
        '"values":[{"datetime":"2026-01-02","open":"1","high":"2","low":"0.5","close":"1.5","volume":"10"},'
        '{"datetime":"2026-01-03","open":"1","high":"2","low":"0.5","close":"1.5","volume":"11"}]},'
        '"B":{"meta":{"interval":"1day"},"values":[{"datetime":"2026-01-02"},{"datetime":"2026-01-03"}]}}')

# body, fact rows, dim rows (handler), dim rows (exploration: None = fails)
CASES = [
    ("good", GOOD, 4, 2, 2),
    ("empty_values", '{"A":{"meta":{"type":"x"},"values":[]}}', 0, 1, 0),
    ("missing_meta_no_values", '{"A":{}}', 0, 1, 0),
    ("missing_meta_one_bar", '{"A":{"values":[{"open":"1"}]}}', 1, 1, None),
    ("missing_bar_fields", '{"A":{"meta":{},"values":[{"datetime":"2026-01-02"}]}}', 1, 1, 1),
    ("per_symbol_error", '{"A":{"code":404,"status":"error"}}', 0, 1, 0),
    ("number_not_text", '{"A":{"values":[{"open":1.50}]}}', 1, 1, None),
    ("explicit_null_meta", '{"A":{"meta":null,"values":[]}}', None, None, None),
    ("scalar_entry", '{"code":400,"message":"x","status":"error"}', None, None, None),
    ("mixed_good_scalar", '{"A":{"values":[{"open":"1"}]},"status":"ok"}', None, None, None),
    ("not_keyed", '{"meta":{},"values":[{"open":"1"}]}', None, None, None),
    ("non_object_bar", '{"A":{"values":[1]}}', None, None, None),
    ("duplicate_key", '{"A":{"values":[{"open":"1"}]},"A":{"values":[{"open":"2"}]}}', 1, 1, None),
    ("dotted_symbol", '{"BRK.B":{"meta":{},"values":[{"open":"1"}]}}', 1, 1, 1),
    ("malformed", "{oops", None, None, None),
    ("empty_object", "{}", 0, 0, 0),
]


@pytest.mark.parametrize("name,body,n_fact,n_dim,n_dim_explore", CASES, ids=[c[0] for c in CASES])
def test_golden_documents(spark, docs_df, name, body, n_fact, n_dim, n_dim_explore):
    docs = docs_df([(name, body)])
    parsed = fl.parse_documents(docs)
    reason = parsed.select("reject_reason").first()[0]
    if n_fact is None:
        assert reason is not None, name
        assert fl.entry_rows(parsed).count() == 0
        return
    assert reason is None, (name, reason)
    entries = fl.entry_rows(parsed)
    assert fl.fact_rows(entries, "s").count() == n_fact
    assert fl.dim_rows(entries, "s").count() == n_dim
    explore = fl.parse_documents(docs, mode=fl.EXPLORE)
    ex_reason = explore.select("reject_reason").first()[0]
    if n_dim_explore is None:
        assert ex_reason is not None
    else:
        assert ex_reason is None
        assert fl.dim_distinct(fl.entry_rows(explore), "s").count() == n_dim_explore


def test_values_and_names(spark, docs_df):
    docs = docs_df([("d", '{"BRK.B":{"meta":{"currency":"USD"},"values":[{"datetime":"2026-01-02",'
                          '"open":1.50,"volume":12}]},"A":{"values":[{"open":"1"}]},"A":{"values":[{"open":"2"}]}}')])
    entries = fl.entry_rows(fl.parse_documents(docs))
    facts = {r["symbol"]: r for r in fl.fact_rows(entries, "stamp").collect()}
    assert facts["BRK.B"]["open"] == "1.5" and facts["BRK.B"]["volume"] == "12"
    assert facts["BRK.B"]["price_date"] == "2026-01-02" and facts["BRK.B"]["high"] is None
    assert facts["A"]["open"] == "2"  # duplicate key: last one wins
    assert fl.fact_rows(entries, "stamp").columns == [
        "symbol", "price_date", "open", "high", "low", "close", "volume", "extracted_at_utc"]
    dims = {r["symbol"]: r for r in fl.dim_rows(entries, "stamp").collect()}
    assert dims["BRK.B"]["currency"] == "USD" and dims["A"]["interval"] is None
    explore = fl.fact_rows(entries, None, date_column="datetime")
    assert explore.columns[1] == "datetime"


def test_reject_keeps_batch_going(spark, docs_df):
    docs = docs_df([("ok", GOOD), ("bad", '{"A":{"values":[1]}}'), ("junk", "nope")])
    parsed = fl.parse_documents(docs)
    rej = {r["doc_id"]: r["reject_reason"] for r in fl.rejected(parsed).collect()}
    assert rej == {"bad": fl.REJECT_VALUES, "junk": fl.REJECT_MALFORMED}
    assert fl.fact_rows(fl.entry_rows(parsed), "s").count() == 4
    counts = fl.document_counts(parsed).collect()
    assert [(r["doc_id"], r["fact_row_count"], r["dim_row_count"]) for r in counts] == [("ok", 4, 2)]


def test_http_status_rejects(spark):
    docs = spark.createDataFrame([("a", GOOD, 200), ("b", GOOD, 429)], "doc_id string, body string, code int")
    parsed = fl.parse_documents(docs, status="code")
    assert {r["doc_id"]: r["reject_reason"] for r in parsed.select("doc_id", "reject_reason").collect()} == {
        "a": None, "b": fl.REJECT_HTTP}


def test_preview_order(spark, docs_df):
    docs = docs_df([("d1", GOOD), ("d0", GOOD)])
    facts = fl.fact_rows(fl.entry_rows(fl.parse_documents(docs)), "s", keep=("doc_id",), with_index=True)
    rows = fl.preview(facts, 3).collect()
    assert [(r["doc_id"], r["symbol"], r["bar_idx"]) for r in rows] == [("d0", "A", 0), ("d0", "A", 1), ("d0", "B", 0)]


def test_fact_path_is_narrow(spark, tmp_path):
    """The flatten adds no shuffle and no Python: one parse, generators only."""
    path = str(tmp_path / "docs")
    spark.createDataFrame([("d", GOOD)], "doc_id string, body string").write.parquet(path)
    facts = fl.fact_rows(fl.entry_rows(fl.parse_documents(spark.read.parquet(path))), "s")
    plan = facts._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
    assert plan.count("parseJson") == 1


def test_exploration_flow(spark, docs_df):
    from ticksmith.functions.stamps import FIXED_STAMP
    from ticksmith.plans.explore import explore_documents

    docs = docs_df([("d", GOOD), ("m", '{"A":{"values":[{"open":"1"}]}}')])
    ex = explore_documents(docs, FIXED_STAMP)
    assert ex.fact.count() == 4 and ex.dim.count() == 2
    assert [r["doc_id"] for r in ex.rejected.collect()] == ["m"]
    head = ex.fact_head(3)
    assert head.columns[1] == "datetime" and head.count() == 3
    assert ex.dim_head().columns == ["symbol", "interval", "currency", "exchange", "mic_code", "type",
                                     "extracted_at_utc"]
