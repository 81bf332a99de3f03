"""Table schemas: fixed by hand, like the reference's CSV field lists."""

from pyspark.sql import types as T

from ticksmith.constants import BAR_FIELDS, DIM_COLUMNS, FACT_COLUMNS, META_FIELDS

_S = T.StringType()

FACT_SCHEMA = T.StructType([T.StructField(c, _S, True) for c in FACT_COLUMNS])
DIM_SCHEMA = T.StructType([T.StructField(c, _S, True) for c in DIM_COLUMNS])

# cast targets for the variant payload; numbers/booleans become text, a
# nested object becomes its JSON text, a non-object becomes NULL
BAR_DDL = "array<struct<" + ", ".join(f"`{c}`: string" for c in BAR_FIELDS) + ">>"
META_DDL = "struct<" + ", ".join(f"`{c}`: string" for c in META_FIELDS) + ">"
# a response document: object keyed by symbol, each value an object
ENTRY_MAP_DDL = "map<string, map<string, variant>>"

# one row per run (our request_id, rejected_count, extract_date, run_id and
# extracted_at_utc come in addition to the handler's summary fields)
MANIFEST_SCHEMA = T.StructType([
    T.StructField("request_id", _S),
    T.StructField("status", T.IntegerType()),
    T.StructField("message", _S),
    T.StructField("error", _S),
    T.StructField("raw_key", _S),
    T.StructField("fact_key", _S),
    T.StructField("dim_key", _S),
    T.StructField("symbols", T.ArrayType(_S)),
    T.StructField("start_date", _S),
    T.StructField("end_date", _S),
    T.StructField("fact_row_count", T.LongType()),
    T.StructField("dim_row_count", T.LongType()),
    T.StructField("rejected_count", T.LongType()),
    T.StructField("extract_date", _S),
    T.StructField("run_id", _S),
    T.StructField("extracted_at_utc", _S),
])
