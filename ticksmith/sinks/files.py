"""Raw, fact, dim and manifest sinks (A29-A33) and their read-back.

Layout, relative to a root folder (object store or shared file system)::

    raw/<vendor>/stocks_api/extract_date=D/run_id=R/attempt=A/   JSON as received, one document per line
    raw/<vendor>/stocks_fact/extract_date=D/run_id=R/attempt=A/  CSV, header, CRLF
    raw/<vendor>/stocks_dim/extract_date=D/run_id=R/attempt=A/   CSV, header, CRLF
    rejects/extract_date=D/run_id=R/attempt=A/                   refused documents (JSON lines)
    manifest/extract_date=D/run_id=R/attempt=A/                  the run's manifest rows
    manifest/extract_date=D/run_id=R/_current-A                  the pointer, written last

A run is published in two phases.  Every attempt writes into directories of
its own, data first and manifest rows last; then one empty pointer file names
the attempt.  Until that file exists nothing of the attempt is visible, and
what an earlier attempt of the run has published stays as it is: a re-run that
is killed half-way takes nothing away.  Of several pointers the latest counts;
``clean_attempts`` deletes what no pointer names any more.  Readers discover
``extract_date`` / ``run_id`` as partition columns.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ticksmith.constants import DIM_TABLE, FACT_TABLE, RAW_PREFIX, RAW_TABLE
from ticksmith.schemas import DIM_SCHEMA, FACT_SCHEMA, MANIFEST_SCHEMA

# Python's csv default dialect: comma, CRLF, minimal quoting, doubled
# quotes, None written as an empty field.
CSV_WRITE_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "lineSep": "\r\n",
    # field text is kept as it is, blanks at its ends included
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
CSV_READ_OPTIONS = {"header": "true", "sep": ",", "quote": '"', "escape": '"', "nullValue": "",
                    "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

TABLES = {"raw": RAW_TABLE, "fact": FACT_TABLE, "dim": DIM_TABLE}
SCHEMAS = {"fact": FACT_SCHEMA, "dim": DIM_SCHEMA}


def table_base(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{RAW_PREFIX}/{TABLES[table]}"


def run_key(table: str, extract_date: str, run_id: str) -> str:
    """Storage key of one run's directory, relative to the root."""
    return f"{RAW_PREFIX}/{TABLES[table]}/extract_date={extract_date}/run_id={run_id}/"


def new_attempt() -> str:
    """A name for one attempt at a run; later ones sort after earlier ones."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%fZ}-{uuid.uuid4().hex[:8]}"


def run_path(root: str, table: str, extract_date: str, run_id: str, attempt: str = "*") -> str:
    """Directory of one attempt at a run; by default a pattern for all of them."""
    return f"{root.rstrip('/')}/{run_key(table, extract_date, run_id)}attempt={attempt}"


def raw_text(body: Column) -> Column:
    """The text as received, on one line: JSON holds line feeds only between
    tokens, where a space means the same.  Numbers and key order stay."""
    return F.regexp_replace(body, "[\\r\\n]+", " ")


def write_raw(docs: DataFrame, path: str, body: str = "body", single_file: bool = False) -> None:
    out = docs.select(raw_text(F.col(body)).alias("value"))
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    if single_file:
        df = df.coalesce(1)
    df.write.mode("overwrite").options(**CSV_WRITE_OPTIONS).csv(path)


def read_csv_run(spark: SparkSession, path: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).options(**CSV_READ_OPTIONS).csv(path)


def read_table(spark: SparkSession, root: str, table: str, manifest_only: bool = True) -> DataFrame:
    """All runs of a table with ``extract_date`` (DATE) and ``run_id``
    discovered from the path; by default only published attempts of runs the
    manifest lists with status 200."""
    base = table_base(root, table)
    if table == "raw":
        df = spark.read.text(base)
    else:
        df = spark.read.schema(SCHEMAS[table]).options(**CSV_READ_OPTIONS).csv(base)
    if not manifest_only:
        return df.drop("attempt")
    runs = read_manifest(spark, root, "attempt").where(F.col("status") == 200).select(
        F.to_date("extract_date").alias("extract_date"), "run_id", "attempt").distinct()
    return df.join(runs, ["extract_date", "run_id", "attempt"], "left_semi").drop("attempt")


def manifest_path(root: str) -> str:
    return f"{root.rstrip('/')}/manifest"


def _files(spark: SparkSession, root: str):
    """The root's file system, and a function from text to its paths."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _parts(status) -> tuple[str, str, str]:
    """Day, run and attempt from the path of an attempt's folder or pointer."""
    day, run, last = str(status.getPath()).split("/")[-3:]
    return day.partition("=")[2], run.partition("=")[2], last.partition("=")[2] or last.partition("-")[2]


def published_attempts(spark: SparkSession, root: str, extract_date: str = "*", run_id: str = "*") -> dict[tuple[str, str], str]:
    """The attempt that counts for each published run; only the names of pointer files are looked at."""
    fs, path = _files(spark, root)
    found: dict[tuple[str, str], str] = {}
    for f in fs.globStatus(path(f"{manifest_path(root)}/extract_date={extract_date}/run_id={run_id}/_current-*")) or []:
        day, run, attempt = _parts(f)
        found[day, run] = max(attempt, found.get((day, run), ""))
    return found


def run_listed(spark: SparkSession, root: str, run_id: str) -> bool:
    """Whether a run is published, on any date."""
    return bool(published_attempts(spark, root, run_id=run_id))


def publish_manifest(rows: DataFrame, root: str, extract_date: str, run_id: str, attempt: str) -> None:
    """The rows of one run, written after every data file of the attempt; then the pointer to it."""
    base = f"{manifest_path(root)}/extract_date={extract_date}/run_id={run_id}"
    rows.drop("extract_date", "run_id").write.parquet(f"{base}/attempt={attempt}")
    fs, path = _files(rows.sparkSession, root)
    fs.create(path(f"{base}/_current-{attempt}"), False).close()


def read_manifest(spark: SparkSession, root: str, *extra: str) -> DataFrame:
    """The manifest rows of all published attempts; ``extra`` may ask for the attempt."""
    schema = StructType([*MANIFEST_SCHEMA.fields, StructField("attempt", StringType())])
    base = manifest_path(root)
    folders = [f"{base}/extract_date={day}/run_id={run}/attempt={a}" for (day, run), a in sorted(published_attempts(spark, root).items())]
    df = spark.read.schema(schema).option("basePath", base).parquet(*folders) if folders else spark.createDataFrame([], schema)
    return df.select(*MANIFEST_COLUMNS, *extra)


def clean_attempts(spark: SparkSession, root: str) -> int:
    """Delete attempts older than the published one of their run; returns their number of folders.

    Attempts after it may still be running and stay, and so does a run that
    was never published."""
    fs, path = _files(spark, root)
    current, gone = published_attempts(spark, root), 0
    for base in (*(table_base(root, t) for t in TABLES), f"{root.rstrip('/')}/rejects", manifest_path(root)):
        for f in fs.globStatus(path(f"{base}/extract_date=*/run_id=*/{{attempt=,_current-}}*")) or []:
            day, run, attempt = _parts(f)
            if attempt < current.get((day, run), ""):
                fs.delete(f.getPath(), True)
                gone += 1
    return gone


def write_rejects(rejects: DataFrame, root: str, extract_date: str, run_id: str, attempt: str) -> str:
    path = f"{root.rstrip('/')}/rejects/extract_date={extract_date}/run_id={run_id}/attempt={attempt}"
    rejects.write.mode("overwrite").json(path)
    return path


MANIFEST_COLUMNS = list(MANIFEST_SCHEMA.names)
