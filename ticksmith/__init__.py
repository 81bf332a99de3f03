"""ticksmith: Spark-native ingest of nested market time-series documents.

Layout:
  constants / schemas  fixed values and table schemas
  session              session settings and the shared working folder
  functions/           column-expression helpers (stamps, encodings)
  sources/             response landing scan, request scan, API data source
  operators/           request normalisation, flatten, validation, run counts,
                       URL and text-profile jobs
  sinks/               raw / fact / dim / manifest writers
  plans/               end-to-end jobs (ingest run, exploration, fixtures)
  streaming/           event-driven ingest with Structured Streaming
"""

from ticksmith.session import configure, shared_dir  # noqa: F401

__version__ = "0.1.0"
