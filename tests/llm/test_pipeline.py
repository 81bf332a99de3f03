"""The pipeline on a small table: each stage's decision takes effect, clean documents stay."""

import corpus_pipeline
from tests.llm.conftest import edited, prose


def test_stages_take_effect(spark, make_docs, tmp_path):
    item = " ".join(f"w{k}x" for k in range(30))
    rows = [(k, prose(k, 80) + "\nAll rights reserved by us.", "s") for k in range(60)]
    rows += [(k, prose(k, 40).replace("\n", " ") + " you utter blockhead of words", "t") for k in range(100, 140)]
    rows += [(200, prose(3, 80), "s"), (201, edited(prose(4, 80), 30), "s"), (202, "see " + item, "s"), (203, None, "s"), (204, "", "s")]
    sf = str(tmp_path)
    make_docs(rows).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i >= 100)) for i, *_ in rows if i < 140], "doc_id bigint, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        out.write.parquet(f"{sf}/{name}")
        docs = spark.read.parquet(f"{sf}/{name}")
        seen.append({r["doc_id"]: r["text"] for r in docs.collect()})
    toxic, lines, near, clean = seen
    assert set(toxic) == set(range(60)) | {200, 201, 202, 203, 204}
    assert lines[5] == prose(5, 80) and lines[203] is None
    assert set(near) == set(lines) - {200, 201} and set(clean) == set(near) - {202}
    pieces = corpus_pipeline.run(spark, sf)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == set(clean)


def test_registered():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert len(corpus_pipeline.STAGES) == 5
