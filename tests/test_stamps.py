from datetime import datetime, timezone

from pyspark.sql import functions as F

from ticksmith.functions.encoding import base64_text
from ticksmith.functions.stamps import RunStamp, extract_date_text, isoformat_text, run_id_text


def test_stamp_texts_match_python(spark):
    for at in [datetime(2026, 3, 31, 22, 15, 30, tzinfo=timezone.utc),
               datetime(2026, 1, 2, 3, 4, 5, 67, tzinfo=timezone.utc)]:
        s = RunStamp(at)
        df = spark.createDataFrame([(at,)], "ts timestamp")
        row = df.select(run_id_text(F.col("ts")), extract_date_text(F.col("ts")), isoformat_text(F.col("ts"))).first()
        assert tuple(row) == (s.run_id, s.extract_date, s.extracted_at_utc)


def test_base64_guarded(spark):
    df = spark.createDataFrame([("eyJhIjoxfQ==",), ("eyJhIjo\nxfQ==",), ("abc",), ("/w==",)], "b string")
    got = [r[0] for r in df.select(base64_text(F.col("b"))).collect()]
    assert got == ['{"a":1}', '{"a":1}', None, None]
