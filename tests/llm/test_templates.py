"""Line templates: variable fields, families of copies, blank lines, plan without Python; odd rows."""

import re

from tests.llm.conftest import prose
from ticksmith.llm import templates as tp


def test_masking_matches_a_plain_one(spark):
    lines = ["a1 b  c22d", "  x\ty ", "no digits here", "1", "", "é9 é", "v1.2.3 (c) 2024", "z" * 5000 + " 7"]
    df = spark.createDataFrame([(s,) for s in lines], "line string")
    got = [r[0] for r in df.select(tp.masked(df["line"])).collect()]
    assert got == [" ".join("<*>" if re.search("[0-9]", w) else w for w in re.split(r"[\x09-\x0D\x20]+", s) if w) for s in lines]


def test_recurring_lines_go_and_content_stays(spark, make_docs):
    rows = []
    for k in range(12):
        own = prose(100 + k, 60).split("\n")
        rows.append((k, "\n".join([own[0], f"Page {k} of 90", own[1], f"Posted by user {'abcdefghijkl'[k]}x in group news today", "", "All rights reserved."]), "s"))
    copied = prose(7, 60)
    rows += [(100 + k, copied, "s") for k in range(30)]
    twice = prose(8, 40)
    rows += [(200 + k, prose(300 + k, 50) + "\nOnly in two", "s") for k in range(2)] + [(300, twice, "s")]
    got = {r["doc_id"]: r for r in tp.document_lines(make_docs(rows)).collect()}
    for k in range(12):
        lines = got[k]["text"].split("\n")
        own = prose(100 + k, 60).split("\n")
        assert lines == [own[0], own[1], ""] and (got[k]["n_lines"], got[k]["n_dropped"]) == (6, 3)
    assert all(got[100 + k]["text"] == copied for k in range(30)) and got[300]["text"] == twice
    assert "Only in two" in got[200]["text"]


def test_native_plan_and_odd_rows(spark, make_docs, odd_docs, odd_rows):
    out = tp.without_templates(odd_docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
    assert out.columns == odd_docs.columns
    assert sorted((str(r["doc_id"]), r["text"]) for r in out.collect() if r["text"]) == sorted((str(i), t) for i, t, _ in odd_rows if t)
    assert out.where("doc_id = 1").first()["text"] is None
    lines = {r["doc_id"]: r for r in tp.document_lines(odd_docs).collect()}
    assert (lines[1]["n_lines"], lines[2]["n_lines"], lines[3]["n_lines"]) == (0, 1, 2)
    assert tp.without_templates(make_docs([])).count() == 0
    junk = make_docs([(k, "only this line", "s") for k in range(5)])
    assert {r["text"] for r in tp.without_templates(junk).collect()} == {"only this line"}
    changed = make_docs([(k, prose(k, 50) + "\nCopyright 2024 by us", "s") for k in range(5)])
    after = tp.without_templates(changed).collect()
    assert all(r["n_chars"] == len(r["text"]) and "Copyright" not in r["text"] for r in after)
