"""Event-driven ingest with Structured Streaming.

The handler runs once per event.  ``start_request_stream`` takes a stream of
request events: repeated request ids are dropped by the stream's own state,
across batches and restarts, and each micro-batch goes through
``ingest_requests`` as one run, so every request is answered and listed once.
``start_ingest_stream`` takes a stream of landed answers.

The run id is derived from the batch id, so a replayed batch (after a failure
between publishing a run and the commit of the streaming checkpoint) is skipped
once its run is published, on whatever date; until then its attempts count for
nothing.  ``trigger(availableNow=True)`` processes what is there and stops,
which suits scheduled runs; a processing-time trigger keeps it running.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ticksmith.functions.stamps import RunStamp
from ticksmith.session import configure, shared_dir
from ticksmith.sinks import files
from ticksmith.sources.landing import DOCUMENT_DDL


def batch_run_id(prefix: str, batch_id: int) -> str:
    return f"{prefix}{batch_id:010d}"


def _start(stream: DataFrame, run: Callable[[DataFrame, str], None], root: str, checkpoint: str, prefix: str,
           available_now: bool, processing_time: str | None) -> StreamingQuery:
    """Each micro-batch as one run, unless its run is published already."""

    def batch_run(batch: DataFrame, batch_id: int) -> None:
        run_id = batch_run_id(prefix, batch_id)
        if not files.run_listed(batch.sparkSession, root, run_id):
            run(batch, run_id)

    writer = stream.writeStream.foreachBatch(batch_run).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def start_ingest_stream(spark: SparkSession, landing: str, root: str, checkpoint: str | None = None,
                        available_now: bool = True, processing_time: str | None = None,
                        stamp: Callable[[], RunStamp] = RunStamp.now, run_prefix: str = "stream-",
                        max_files_per_trigger: int | None = None, packed: bool = True) -> StreamingQuery:
    """Stream landed answers from ``landing`` into ``root``'s tables.

    Answers land packed (``write_documents``); with ``packed=False`` they are
    single files, one JSON value each."""
    configure(spark)
    if packed:
        reader = spark.readStream.schema(DOCUMENT_DDL).format("parquet")
    else:
        reader = spark.readStream.format("text").option("wholetext", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    docs = reader.load(landing)
    if not packed:
        docs = docs.select(F.col("_metadata.file_path").alias("doc_id"), F.col("value").alias("body"))

    def run(batch: DataFrame, run_id: str) -> None:
        from ticksmith.plans.ingest import ingest_documents

        ingest_documents(batch.sparkSession, batch, root, stamp(), run_id=run_id)

    return _start(docs, run, root, checkpoint or shared_dir(spark, "stream-checkpoint"), run_prefix, available_now, processing_time)


def start_request_stream(spark: SparkSession, landing: str, root: str, answers, checkpoint: str | None = None,
                         available_now: bool = True, processing_time: str | None = None,
                         stamp: Callable[[], RunStamp] = RunStamp.now, run_prefix: str = "requests-",
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Stream request events (JSON lines ``request_id``, ``event``) through the gateway handler.

    ``answers`` is what ``ingest_requests`` takes: API calls or landed answers.
    Of events with one id the first seen counts; ids are remembered in the
    stream's state, with as many partitions as shuffles have."""
    configure(spark)
    reader = spark.readStream.schema("request_id string, event string").format("json")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    events = reader.load(landing).dropDuplicates(["request_id"])

    def run(batch: DataFrame, run_id: str) -> None:
        from ticksmith.operators.requests import normalise_requests
        from ticksmith.plans.ingest import ingest_requests

        # ingest_requests keeps what it reads several times: events are deduplicated and parsed once
        ingest_requests(batch.sparkSession, normalise_requests(batch), root, stamp(), answers=answers, run_id=run_id)

    return _start(events, run, root, checkpoint or shared_dir(spark, "stream-checkpoint"), run_prefix, available_now, processing_time)
