"""Bar-domain inputs derived from the driver's TPC-H-style tables.

The driver data has no market bars, listings or job logs, so each input is a
deterministic projection of a driver table (same definition on the DuckDB
oracle side, see ``barforge.plans.oracle``). All of them are plain
DataFrame plans over the full tables: their size grows with the scale factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.session import prepare


_TABLES: dict = {}
_PLANS: dict = {}


def _memo(fn):
    """Reuse the DataFrame (a lazy plan, not data) a derivation returns for
    the same session and arguments; execution still does all the work."""
    import functools

    @functools.wraps(fn)
    def wrapper(spark, sf_dir, *args):
        key = (fn.__name__, id(spark._jsparkSession), sf_dir,
               tuple(tuple(a) if isinstance(a, (list, tuple)) else a for a in args))
        df = _PLANS.get(key)
        if df is None:
            df = _PLANS[key] = fn(spark, sf_dir, *args)
        prepare(spark)
        return df
    return wrapper


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. The DataFrame (a plan, not data) is reused per session
    so repeated references skip file listing and footer reads."""
    key = (id(spark._jsparkSession), sf_dir, name)
    df = _TABLES.get(key)
    if df is None:
        df = _TABLES[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df


# ---------------------------------------------------------------------------
# Daily bars from orders: one ticker per o_custkey % 10, one bar per order day.
# ---------------------------------------------------------------------------
@_memo
def bars_1d(spark: SparkSession, sf_dir: str, statuses: tuple[str, ...] | None = None) -> DataFrame:
    prepare(spark)
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    if statuses is not None:
        o = o.where(F.col("o_orderstatus").isin(*statuses))
    k = F.col("o_custkey") % 10
    o = o.select(
        F.when(k < 4, "stocks_us").when(k < 7, "crypto").otherwise("indices").alias("asset_class"),
        F.concat(F.lit("T"), k.cast("string")).alias("ticker"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        "o_orderkey", "o_totalprice", k.alias("k"))
    # partial (map-side) aggregation: output is bounded by tickers x days
    bars = o.groupBy("asset_class", "ticker", "ts", "k").agg(
        F.min_by("o_totalprice", "o_orderkey").alias("open"),
        F.max("o_totalprice").alias("high"),
        F.min("o_totalprice").alias("low"),
        F.max_by("o_totalprice", "o_orderkey").alias("close"),
        F.count(F.lit(1)).alias("volume"))
    return bars.select(
        "asset_class", F.lit("1d").alias("interval"), "ticker", "ts",
        "open", "high", "low", "close",
        F.when(F.col("k") % 2 == 0, F.col("close") * 0.98).alias("adj_close"),
        F.col("volume").cast("bigint").alias("volume"))


@_memo
def bars_many(spark: SparkSession, sf_dir: str, n: int = 40) -> DataFrame:
    """Quarterly bars of ``n`` series from orders (ticker per o_custkey % n)."""
    prepare(spark)
    o = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("Q"), (F.col("o_custkey") % n).cast("string")).alias("ticker"),
        F.date_trunc("quarter", F.col("o_orderdate").cast("timestamp")).alias("ts"), "o_orderkey", "o_totalprice")
    bars = o.groupBy("ticker", "ts").agg(F.max_by("o_totalprice", "o_orderkey").alias("close"))
    return bars.select(F.lit("indices").alias("asset_class"), F.lit("3mo").alias("interval"), "ticker", "ts", "close")


@_memo
def bars_1d_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored (finished orders) and fresh (open / pending orders) daily bars
    in one DataFrame with a ``src`` column - one pass over orders."""
    prepare(spark)
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    k = F.col("o_custkey") % 10
    o = o.select(
        F.when(F.col("o_orderstatus") == "F", "stored").otherwise("fresh").alias("src"),
        F.when(k < 4, "stocks_us").when(k < 7, "crypto").otherwise("indices").alias("asset_class"),
        F.concat(F.lit("T"), k.cast("string")).alias("ticker"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
        "o_orderkey", "o_totalprice", k.alias("k"))
    bars = o.groupBy("src", "asset_class", "ticker", "ts", "k").agg(
        F.min_by("o_totalprice", "o_orderkey").alias("open"),
        F.max("o_totalprice").alias("high"),
        F.min("o_totalprice").alias("low"),
        F.max_by("o_totalprice", "o_orderkey").alias("close"),
        F.count(F.lit(1)).alias("volume"))
    return bars.select(
        "src", "asset_class", F.lit("1d").alias("interval"), "ticker", "ts",
        "open", "high", "low", "close",
        F.when(F.col("k") % 2 == 0, F.col("close") * 0.98).alias("adj_close"),
        F.col("volume").cast("bigint").alias("volume"))


# ---------------------------------------------------------------------------
# Ticks from events: ticker per user, price = value, size from props.k.
# ---------------------------------------------------------------------------
@_memo
def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    e = table(spark, sf_dir, "events")
    u = F.col("user_id")
    return e.select(
        F.when(u % 3 == 0, "crypto").when(u % 3 == 1, "stocks_us").otherwise("currencies")
        .alias("asset_class"),
        F.concat(F.lit("U"), u.cast("string"),
                 F.when(u % 3 == 0, "-USD").when(u % 3 == 2, "=X").otherwise("")).alias("ticker"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("size"),
        F.col("event_id").alias("seq"),
        "event_type")


@_memo
def bars_intraday(spark: SparkSession, sf_dir: str, intervals=None) -> DataFrame:
    from barforge.operators.bars import bars_from_ticks
    from barforge.schema import INTRADAY_INTERVALS
    return bars_from_ticks(ticks(spark, sf_dir), intervals or INTRADAY_INTERVALS)


def bar_tasks(spark: SparkSession, sf_dir: str, intervals=None, share: int | None = None) -> int | None:
    """Partitions for a step over all bars of the ticks; see the operator."""
    from barforge.operators import bars as B
    from barforge.schema import INTRADAY_INTERVALS
    return B.bar_tasks(ticks(spark, sf_dir), len(intervals or INTRADAY_INTERVALS), share)


def bars_by_series(spark: SparkSession, sf_dir: str, intervals=None) -> DataFrame:
    """:func:`bars_intraday` by series, for windows over whole series."""
    from barforge.operators import bars as B
    from barforge.schema import SERIES_KEY
    return B.spread(bars_intraday(spark, sf_dir, intervals), bar_tasks(spark, sf_dir, intervals), *SERIES_KEY)


# ---------------------------------------------------------------------------
# Listing rows from part: raw symbol, security name, test-issue flag, position.
# ---------------------------------------------------------------------------
LISTING_SYMBOL_SQL = """
CASE
  WHEN p_size = 50 THEN NULL
  WHEN p_size = 49 THEN 'nan'
  WHEN p_size = 48 THEN '   '
  WHEN p_size % 12 = 9 THEN '.' || substr(base, 1, 1)
  ELSE CASE WHEN p_size % 12 = 5 THEN '  ' ELSE '' END || base ||
       CASE p_size % 12 WHEN 0 THEN '.B' WHEN 1 THEN '.ks' WHEN 2 THEN '=X' WHEN 3 THEN '-USD'
         WHEN 4 THEN '.BC' WHEN 5 THEN '  ' WHEN 6 THEN '.t' WHEN 7 THEN '.b' WHEN 8 THEN '.1'
         WHEN 10 THEN '=F' ELSE '' END
END"""

SECURITY_NAME_SQL = """
p_name || CASE p_size % 10
  WHEN 3 THEN ' Warrants'
  WHEN 4 THEN ' Unity Inc'
  WHEN 6 THEN ' RIGHT'
  WHEN 7 THEN ' Units-A'
  ELSE ' Common Stock' END"""

TEST_ISSUE_SQL = """
CASE p_brand WHEN 'Brand#7' THEN 'Y' WHEN 'Brand#14' THEN 'Y'
  WHEN 'Brand#5' THEN 'y' WHEN 'Brand#3' THEN NULL ELSE 'N' END"""

# listing file a part row belongs to (several listing files per class)
LISTING_CLASS_SQL = """
CASE p_type WHEN 'ECONOMY' THEN 'stocks_us' WHEN 'SMALL' THEN 'stocks_us'
  WHEN 'STANDARD' THEN 'stocks_eu' WHEN 'MEDIUM' THEN 'stocks_eu'
  ELSE 'indices' END"""


@_memo
def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """asset_class, file_pos, pos, symbol, security_name, test_issue."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    p = p.withColumn("base", F.upper(F.concat(
        F.substring(F.substring_index("p_name", " ", 1), 1, 2),
        F.substring(F.substring_index("p_name", " ", -1), 1, 3))))
    return p.select(
        F.expr(LISTING_CLASS_SQL).alias("asset_class"),
        F.when(F.col("p_type").isin("SMALL", "MEDIUM", "PROMO"), 1).otherwise(0).alias("file_pos"),
        F.col("p_partkey").alias("pos"),
        F.expr(LISTING_SYMBOL_SQL).alias("symbol"),
        F.expr(SECURITY_NAME_SQL).alias("security_name"),
        F.expr(TEST_ISSUE_SQL).alias("test_issue"))


@_memo
def inline_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inline (config) lists per class from supplier: asset_class, pos, ticker.
    Inline entries are used verbatim (no symbol mapping, duplicates kept)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    cls = (F.when(F.col("s_nationkey") < 8, "stocks_us")
           .when(F.col("s_nationkey") < 16, "stocks_eu").otherwise("crypto"))
    return s.select(cls.alias("asset_class"), F.col("s_suppkey").alias("pos"),
                    F.concat(F.lit("S"), F.substring("s_name", -2, 2)).alias("ticker"))


# ---------------------------------------------------------------------------
# Job results from lineitem: one fetch outcome per line.
# ---------------------------------------------------------------------------
JOB_CLASS_SQL = """
CASE WHEN l_linenumber = 7 THEN ''
     WHEN l_returnflag = 'A' THEN 'stocks_us'
     WHEN l_returnflag = 'R' THEN 'crypto' ELSE 'indices' END"""
JOB_INTERVAL_SQL = """
CASE l_linenumber WHEN 1 THEN '1d' WHEN 2 THEN '1wk' WHEN 3 THEN '1m'
  WHEN 4 THEN '5m' WHEN 5 THEN '1h' WHEN 6 THEN '1mo' ELSE NULL END"""
JOB_STATUS_SQL = """
CASE WHEN l_discount >= 0.09 THEN 'failed'
     WHEN l_tax = 0 THEN 'skipped'
     WHEN l_discount = 0 THEN 'unknown'
     ELSE 'success' END"""
JOB_MESSAGE_SQL = """
CASE WHEN l_discount >= 0.09 THEN
  CASE CAST(l_quantity AS BIGINT) % 5
    WHEN 0 THEN 'No dataset under this name (code 404)'
    WHEN 1 THEN 'source answered 403, no permission for this series'
    WHEN 2 THEN 'login rejected, Unauthorized'
    WHEN 3 THEN 'forbidden: the key has invalid credentials'
    ELSE 'no answer within the time limit' END
  ELSE 'ok' END"""


@_memo
def job_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """status, ticker, asset_class, interval, message, seq, shard."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount",
        "l_tax", "l_returnflag", "l_shipdate")
    return li.select(
        F.expr(JOB_STATUS_SQL).alias("status"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("ticker"),
        F.expr(JOB_CLASS_SQL).alias("asset_class"),
        F.expr(JOB_INTERVAL_SQL).alias("interval"),
        F.expr(JOB_MESSAGE_SQL).alias("message"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
        F.year("l_shipdate").alias("shard"))


# ---------------------------------------------------------------------------
# Intraday bar sources for merges: ticks split by event type into a fresh
# download, the stored series and legacy dated day files.
# ---------------------------------------------------------------------------
TICK_SOURCE_SQL = """
CASE event_type WHEN 'error' THEN 'legacy' WHEN 'click' THEN 'fresh'
  WHEN 'purchase' THEN 'fresh' ELSE 'stored' END"""


@_memo
def intraday_source_bars(spark: SparkSession, sf_dir: str, intervals=None) -> DataFrame:
    """All three sources in one DataFrame (``src`` column; ``day`` = the
    dated file's day for legacy rows) - one pass over the ticks."""
    from barforge.operators.bars import bars_from_ticks
    from barforge.schema import INTRADAY_INTERVALS
    t = ticks(spark, sf_dir).withColumn("src", F.expr(TICK_SOURCE_SQL))
    b = bars_from_ticks(t, intervals or INTRADAY_INTERVALS, key=("src", "asset_class", "ticker"))
    return b.drop("n_ticks").withColumn("day", F.when(F.col("src") == "legacy", F.to_date("ts")))


def source_bars_by_time(spark: SparkSession, sf_dir: str, sources: tuple[str, ...] | None = None) -> DataFrame:
    """:func:`intraday_source_bars` (of some sources) by (series, ts), for merges:
    bars of one time from different sources meet in one task, which holds them
    in aggregates' maps as a roll-up's does."""
    from barforge.operators import bars as B
    from barforge.schema import SERIES_KEY
    b = intraday_source_bars(spark, sf_dir)
    if sources is not None:
        b = b.where(F.col("src").isin(*sources))
    return B.spread(b, bar_tasks(spark, sf_dir, share=B.ROLLUP_BYTES), *SERIES_KEY, "ts")


def intraday_sources(spark: SparkSession, sf_dir: str, intervals=None) -> dict:
    b = intraday_source_bars(spark, sf_dir, intervals)
    out = {s: b.where(F.col("src") == s).drop("src", "day") for s in ("fresh", "stored", "legacy")}
    out["legacy"] = b.where(F.col("src") == "legacy").drop("src")
    return out
