"""Types and small fixed dimension tables.

Everything under "Fixed values" must equal the behaviour being reproduced
(interval codes, retention windows, suffix lists, markers); it is stated
plainly, in natural order, and turned into tiny broadcastable dimensions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
ALL_INTERVALS = ("1m", "2m", "5m", "15m", "30m", "60m", "90m", "1h",
                 "1d", "5d", "1wk", "1mo", "3mo")
INTRADAY_INTERVALS = ("1m", "2m", "5m", "15m", "30m", "60m", "90m", "1h")
CUMULATIVE_INTERVALS = ("1d", "5d", "1wk", "1mo", "3mo")
# retention window per intraday interval, in days
RETENTION_DAYS = {"1m": 7, "2m": 60, "5m": 60, "15m": 60, "30m": 60,
                  "60m": 60, "90m": 60, "1h": 60}
# bar width in minutes for the intraday intervals
INTRADAY_MINUTES = {"1m": 1, "2m": 2, "5m": 5, "15m": 15, "30m": 30,
                    "60m": 60, "90m": 90, "1h": 60}
# stored series shorter than this are not trusted for incremental refresh
MIN_TRUSTED_ROWS = 20
# cumulative history windows tried in this order until one returns bars
PERIOD_FALLBACKS = ("max", "5d", "1mo", "3mo", "6mo", "1y", "2y", "5y", "10y")
# the daily workflow's cumulative pair
DAILY_RUN_INTERVALS = ("1d", "1wk")
# published slices: included intervals and the subset that must be present
SLICES = {
    "daily": {"intervals": ("1d", "5d", "1wk", "1mo", "3mo"),
              "required": ("1d", "1wk")},
    "intraday": {"intervals": ("1m", "2m", "5m", "15m", "30m", "60m", "90m", "1h"),
                 "required": ("1m", "2m", "5m", "15m", "30m", "60m", "90m", "1h")},
}
# file names in a snapshot tree that are not data files
CONTROL_FILES = (".gitkeep", "dataset-metadata.json", ".kaggle-pull-state.json", ".DS_Store")
READY_STATUSES = ("READY",)
FAILED_STATUSES = ("FAILED", "DELETED")
# exchange suffixes that a listing symbol keeps as-is
EXCHANGE_SUFFIXES = (".KS", ".KQ", ".L", ".HK", ".TW", ".TWO", ".T", ".SS", ".SZ",
                     ".DE", ".PA", ".AS", ".BR", ".MI", ".MC", ".SW",
                     ".ST", ".HE", ".CO", ".OL", ".LS", ".VI", ".IR", ".F")
# preferred suffixes for European primary listings, best first
EUROPE_SUFFIXES = (".DE", ".PA", ".AS", ".BR", ".MI", ".MC", ".SW", ".ST",
                   ".HE", ".CO", ".OL", ".LS", ".VI", ".IR", ".L", ".F")
# security names with these words are dropped from listings (any case, whole word)
SKIP_SECURITY_NAME_PATTERN = r"(?i)\b(?:Warrant|Warrants|Right|Rights|Unit|Units)\b"
# plain ticker lists: cash / collateral rows and the accepted symbol shape
PLAIN_TICKER_SKIP = ("CASH", "USD", "XTSLA", "P5N994")
PLAIN_TICKER_PATTERN = r"^[A-Z][A-Z0-9.\-]{0,9}$"
# exchange directory markets and their suffix
EXCHANGE_MARKETS = (("KOSPI", ".KS"), ("KOSDAQ", ".KQ"))
# failure message markers
MISSING_MARKERS = ("404", "not found", "does not exist", "couldn't find",
                   "could not find", "no dataset")
TRANSIENT_MARKERS = ("403", "permission", "forbidden")
PERMANENT_MARKERS = ("invalid credentials", "unauthorized", "401", "api token",
                     "authentication failed")
# at most this many failures are listed in a summary
FAILURE_LIST_LIMIT = 100

# ---------------------------------------------------------------------------
# Types
# ---------------------------------------------------------------------------
PRICE_COLUMNS = ("open", "high", "low", "close", "adj_close")
OPTIONAL_COLUMNS = ("dividends", "stock_splits")
SERIES_KEY = ("asset_class", "interval", "ticker")

BAR_SCHEMA = T.StructType([
    T.StructField("asset_class", T.StringType()),
    T.StructField("interval", T.StringType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("adj_close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("dividends", T.DoubleType()),
    T.StructField("stock_splits", T.DoubleType()),
])

JOB_RESULT_SCHEMA = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("ticker", T.StringType()),
    T.StructField("asset_class", T.StringType()),
    T.StructField("interval", T.StringType()),
    T.StructField("message", T.StringType()),
])


def interval_dim(spark: SparkSession) -> DataFrame:
    """13-row dimension: interval, kind, retention_days, minutes, daily_slice."""
    rows = []
    for iv in ALL_INTERVALS:
        kind = "intraday" if iv in RETENTION_DAYS else "cumulative"
        rows.append((iv, kind, RETENTION_DAYS.get(iv), INTRADAY_MINUTES.get(iv),
                     "daily" if iv in SLICES["daily"]["intervals"] else "intraday"))
    return spark.createDataFrame(
        rows, "interval string, kind string, retention_days int, minutes int, slice string")


def slice_dim(spark: SparkSession) -> DataFrame:
    """slice, interval, required — one row per included interval."""
    rows = [(name, iv, iv in spec["required"])
            for name, spec in SLICES.items() for iv in spec["intervals"]]
    return spark.createDataFrame(rows, "slice string, interval string, required boolean")
