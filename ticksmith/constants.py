"""Values that must match the reference behaviour exactly.

Fixed values (kept together, in natural order, as plain text):
"""

# --- fixed values: request defaults -------------------------------------
DEFAULT_SYMBOLS = ["AAPL", "GOOG", "NVDA"]
DEFAULT_START_DATE = "2026-01-01"
DEFAULT_END_DATE = "2026-03-31"
# the first packaged handler used a later default start
PACKAGED_DEFAULT_START_DATE = "2026-03-01"
DEFAULT_INTERVAL = "1day"

# --- fixed values: API endpoint and call settings ------------------------
API_BASE_URL = "https://api.twelvedata.com/time_series"
API_TIMEOUT_SECONDS = 30

# --- fixed values: storage layout -----------------------------------------
RAW_PREFIX = "raw/twelvedata"
RAW_TABLE = "stocks_api"
FACT_TABLE = "stocks_fact"
DIM_TABLE = "stocks_dim"

# --- fixed values: output columns, in order --------------------------------
FACT_COLUMNS = ["symbol", "price_date", "open", "high", "low", "close", "volume",
                "extracted_at_utc"]
DIM_COLUMNS = ["symbol", "interval", "currency", "exchange", "mic_code", "type",
               "extracted_at_utc"]
# fields read from each bar and from each symbol's meta object
BAR_FIELDS = ["datetime", "open", "high", "low", "close", "volume"]
META_FIELDS = ["interval", "currency", "exchange", "mic_code", "type"]

# --- fixed values: run summary texts ----------------------------------------
SUCCESS_MESSAGE = "Stock API raw, fact, and dim files ingested successfully"
RAW_ONLY_MESSAGE = "Stock API Data ingested successfully"
ERROR_MESSAGE = "Error during stock ingestion"
BAD_BODY_ERROR = "Request body must be valid JSON"

# --- fixed values: stamp formats (Spark datetime patterns) -------------------
RUN_ID_PATTERN = "yyyyMMdd'T'HHmmss'Z'"
EXTRACT_DATE_PATTERN = "yyyy-MM-dd"
