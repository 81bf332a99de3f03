"""Landing-folder scans: response documents (A2) and request events (A3).

Documents land packed: Parquet files hold many bounded documents, each a row
with its id inside, so the number of files follows the volume and not the
number of documents, and the scan splits inside of a file.  Further columns
(``symbol``, ``day``, ``interval``, ``http_status``) land beside them, and
filters on them reach the scan.  Single files from elsewhere, one JSON value
each, are read whole by ``read_document_files``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT_DDL = "doc_id string, body string"
#: bytes of bodies to a landed file, about
PACK_BYTES = 128 << 20


def write_documents(docs: DataFrame, path: str, mode: str = "overwrite", max_documents: int = 0) -> str:
    """Land documents as they are partitioned; small partitions are put together first.

    ``max_documents`` bounds the documents of a file (0: no bound)."""
    writer = docs.hint("rebalance").write.mode(mode)
    if max_documents:
        writer = writer.option("maxRecordsPerFile", max_documents)
    writer.option("parquet.block.size", PACK_BYTES).parquet(path)
    return path


def read_documents(spark: SparkSession, path: str, schema: str | None = DOCUMENT_DDL) -> DataFrame:
    """A2: ``(doc_id, body)`` of packed documents; ``schema`` names further columns, None takes all."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_document_files(spark: SparkSession, path: str) -> DataFrame:
    """A2: ``(doc_id, body)`` of single files, the path as the id and the whole file as the body."""
    raw = spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(path)
    return raw.select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("body"))


def write_requests(requests: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Land ``(request_id, event)`` as JSON lines; the event stays text."""
    requests.select("request_id", "event").write.mode(mode).json(path)
    return path


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """A3: request events, one JSON line each, with a fixed schema; the
    event is kept as text so each row is parsed (and judged) on its own."""
    return spark.read.schema("request_id string, event string").json(path)
