"""Registered merge / retention / consolidation queries."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from barforge.functions.symbols import safe_filename
from barforge.operators import bars as B
from barforge.operators import merge as M
from barforge.plans import sqlparts as Q
from barforge.plans.registry import register
from barforge.schema import CUMULATIVE_INTERVALS, DAILY_RUN_INTERVALS, RETENTION_DAYS, SERIES_KEY
from barforge.session import checkpoint_dir
from barforge.sources import derived as D
from barforge.sources import store as ST

KEY = list(SERIES_KEY)
AS_OF = dt.datetime(2024, 1, 31, 0, 0, tzinfo=dt.timezone.utc)
AS_OF_SQL = "2024-01-31 00:00:00"
BAR_COLS = ["open", "high", "low", "close", "adj_close", "volume"]


def r6(c):
    return F.round(F.col(c), 6)


# --------------------------------------------------------------------------- A1
_A1 = [Q.bars_1d("stored_1d", ["F"]), Q.bars_1d("fresh_1d", ["O", "P"]),
       Q.merged({"stored": ("stored_1d", 0, 0), "fresh": ("fresh_1d", 1, 0)})]


def _a1(spark, sf):
    return M.merge_cumulative_sources(D.bars_1d_sources(spark, sf))


@register("a1_incremental_merge", Q.with_(*_A1) + f"""
SELECT {Q.SERIES}, ts, open, high, low, close, round(adj_close, 6) AS adj_close, volume FROM merged""")
def a1_incremental_merge(spark, sf):
    m = _a1(spark, sf)
    return m.select(*KEY, "ts", "open", "high", "low", "close", r6("adj_close").alias("adj_close"), "volume")


@register("a1_merge_counts", Q.with_(*_A1) + f"""
SELECT {Q.SERIES}, count(*) AS rows, count(*) FILTER (WHERE NOT in_stored) AS new_rows,
       count(*) FILTER (WHERE changed) AS updated_rows
FROM merged GROUP BY {Q.SERIES}""")
def a1_merge_counts(spark, sf):
    return M.merge_report(_a1(spark, sf))


# --------------------------------------------------------------------------- A2
_SRC = [Q.TICKS, Q.TICK_SOURCES, Q.source_bars(),
        "fresh_b AS (SELECT * FROM src_bars WHERE src = 'fresh')",
        "stored_b AS (SELECT * FROM src_bars WHERE src = 'stored')",
        "legacy_b AS (SELECT *, CAST(ts AS DATE) AS day FROM src_bars WHERE src = 'legacy')"]
_A2 = _SRC + [Q.merged({"fresh": ("fresh_b", 0, 0), "stored": ("stored_b", 1, 0),
                        "legacy": ("legacy_b", 2, "date_diff('day', DATE '1970-01-01', day)")},
                       "m_all"),
              f"merged AS (SELECT * FROM m_all WHERE {Q.retention_sql(AS_OF_SQL)})"]


def _winners(sources: tuple[str, ...], name: str) -> str:
    """The rows that win by (source rank, day of a dated file) within retention,
    without the change flags of the full merge."""
    listed = ", ".join(f"'{x}'" for x in sources)
    return f"""{name} AS (
  SELECT * FROM src_bars WHERE src IN ({listed}) AND {Q.retention_sql(AS_OF_SQL)}
  QUALIFY row_number() OVER (PARTITION BY {Q.SERIES}, ts ORDER BY
    CASE src WHEN 'legacy' THEN 2 WHEN 'stored' THEN 1 ELSE 0 END DESC) = 1)"""


#: A legacy row's day is its own, so rows of one time differ in their source alone.
_A2_ROWS = [Q.TICKS, Q.TICK_SOURCES, Q.source_bars(), _winners(("fresh", "stored", "legacy"), "merged")]
_A11_ROWS = [Q.TICKS, Q.TICK_SOURCES, Q.source_bars(), _winners(("stored", "legacy"), "consolidated")]


def _a2(spark, sf):
    return M.merge_intraday_sources(D.source_bars_by_time(spark, sf), AS_OF)


@register("a2_intraday_merge", Q.with_(*_A2_ROWS) + f"""
SELECT {Q.SERIES}, ts, open, high, low, close, volume FROM merged""")
def a2_intraday_merge(spark, sf):
    return _a2(spark, sf).select(*KEY, "ts", "open", "high", "low", "close", "volume")


@register("a2_rows_kept", Q.with_(*_A2) + f"""
SELECT {Q.SERIES}, count(*) AS rows_kept FROM merged GROUP BY {Q.SERIES}""")
def a2_rows_kept(spark, sf):
    return _a2(spark, sf).groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows_kept"))


# --------------------------------------------------------------------------- P6
@register("p6_retention_prune", Q.with_(Q.TICKS, Q.bars_from_ticks()) + f"""
SELECT {Q.SERIES}, ts, close FROM bars_intraday WHERE {Q.retention_sql(AS_OF_SQL)}""")
def p6_retention_prune(spark, sf):
    """Retention on a stored table: written once, then one pruned read per cutoff."""
    root = f"{checkpoint_dir(spark).rstrip('/')}/p6-{uuid.uuid4().hex}"
    ST.write_store(D.bars_intraday(spark, sf), root, partitions=D.bar_tasks(spark, sf))
    return ST.read_retained(spark, root, AS_OF).select(*KEY, "ts", "close")


# --------------------------------------------------------------------------- P13
@register("p13_trusted_history", Q.with_(*_SRC) + f"""
SELECT {Q.SERIES}, count(*) AS stored_rows, CASE WHEN count(*) >= 20 THEN max(ts) END AS last_ts
FROM stored_b GROUP BY {Q.SERIES}""")
def p13_trusted_history(spark, sf):
    return M.trusted_last_ts(D.intraday_sources(spark, sf)["stored"])


# --------------------------------------------------------------------------- A11
_A11 = _SRC + [Q.merged({"stored": ("stored_b", 1, 0),
                         "legacy": ("legacy_b", 2, "date_diff('day', DATE '1970-01-01', day)")},
                        "c_all"),
               f"consolidated AS (SELECT * FROM c_all WHERE {Q.retention_sql(AS_OF_SQL)})",
               f"""c_per AS (
  SELECT {Q.SERIES}, coalesce(n_before, 0) AS n_before, coalesce(n_after, 0) AS n_after,
         coalesce(files, 0) AS files
  FROM (SELECT {Q.SERIES}, count(*) AS n_before FROM stored_b GROUP BY ALL) b
  FULL JOIN (SELECT {Q.SERIES}, count(*) AS n_after FROM consolidated GROUP BY ALL) a USING ({Q.SERIES})
  FULL JOIN (SELECT {Q.SERIES}, count(DISTINCT day) AS files FROM legacy_b GROUP BY ALL) d USING ({Q.SERIES}))"""]


def _a11(spark, sf):
    return M.consolidate_sources(D.source_bars_by_time(spark, sf, ("stored", "legacy")), AS_OF)


@register("a11_consolidated_bars", Q.with_(*_A11_ROWS) + f"""
SELECT {Q.SERIES}, ts, open, close, volume FROM consolidated""")
def a11_consolidated_bars(spark, sf):
    return _a11(spark, sf)[0].select(*KEY, "ts", "open", "close", "volume")


@register("a11_consolidation_report", Q.with_(*_A11) + """
SELECT asset_class, interval, CAST(sum(files) AS BIGINT) AS removed, count(*) FILTER (WHERE files > 0) AS consolidated,
       count(*) FILTER (WHERE files = 0 AND n_after < n_before) AS pruned
FROM c_per GROUP BY asset_class, interval""")
def a11_consolidation_report(spark, sf):
    r = _a11(spark, sf)[1]
    return r.select("asset_class", "interval", F.col("removed").cast("bigint").alias("removed"),
                    "consolidated", "pruned")


# --------------------------------------------------------------------------- P8 / J6
_SAFE_SQL = "replace(replace(replace(ticker, '^', ''), '=', '_'), '/', '_')"
_FILES = _SRC + [f"""files AS (
  SELECT DISTINCT asset_class, interval, {_SAFE_SQL} || '_' || CAST(day AS VARCHAR) || '.csv' AS file_name
  FROM legacy_b
  UNION ALL
  SELECT DISTINCT asset_class, interval, {_SAFE_SQL} || '.csv' AS file_name FROM stored_b)"""]
_DATED_RE = r"^(.+)_(\d{4}-\d{2}-\d{2})\.csv$"


def _files(spark, sf):
    """File names of the stored series and of the legacy dated files, from
    one pass over the source bars."""
    b = D.intraday_source_bars(spark, sf).where(F.col("src").isin("stored", "legacy"))
    stem = safe_filename(F.col("ticker"))
    name = F.when(F.col("src") == "legacy", F.concat(stem, F.lit("_"), F.date_format("day", "yyyy-MM-dd"),
                                                     F.lit(".csv"))).otherwise(F.concat(stem, F.lit(".csv")))
    return b.select("asset_class", "interval", name.alias("file_name")).distinct()


@register("p8_dated_name_parse", Q.with_(*_FILES) + f"""
SELECT asset_class, interval, file_name,
       CASE WHEN regexp_matches(file_name, '{_DATED_RE}') THEN regexp_extract(file_name, '{_DATED_RE}', 1) END AS stem,
       CASE WHEN regexp_matches(file_name, '{_DATED_RE}') THEN CAST(regexp_extract(file_name, '{_DATED_RE}', 2) AS DATE) END AS day
FROM files""")
def p8_dated_name_parse(spark, sf):
    f = _files(spark, sf)
    return f.select("asset_class", "interval", "file_name", *M.parse_dated_name("file_name"))


@register("j6_legacy_match", Q.with_(*_FILES, """universe AS (SELECT DISTINCT asset_class, ticker FROM ticks)""") + f"""
SELECT f.asset_class, f.interval, u.ticker, f.file_name, CAST(regexp_extract(f.file_name, '{_DATED_RE}', 2) AS DATE) AS day
FROM files f JOIN universe u ON f.asset_class = u.asset_class
 AND regexp_extract(f.file_name, '{_DATED_RE}', 1) = replace(replace(replace(u.ticker, '^', ''), '=', '_'), '/', '_')
WHERE regexp_matches(f.file_name, '{_DATED_RE}')""")
def j6_legacy_match(spark, sf):
    universe = D.ticks(spark, sf).select("asset_class", "ticker").distinct()
    j = M.match_legacy(_files(spark, sf), universe)
    return j.select("asset_class", "interval", "ticker", "file_name", "day")


# --------------------------------------------------------------------------- S14
@register("s14_snapshot_overlay", Q.with_(*_SRC) + f"""
SELECT {Q.SERIES}, origin, count(*) AS rows FROM (
  SELECT *, 'kept' AS origin FROM stored_b s WHERE NOT EXISTS (
    SELECT 1 FROM fresh_b f WHERE f.asset_class = s.asset_class AND f.interval = s.interval AND f.ticker = s.ticker)
  UNION ALL SELECT *, 'incoming' AS origin FROM fresh_b)
GROUP BY {Q.SERIES}, origin""")
def s14_snapshot_overlay(spark, sf):
    s = D.intraday_sources(spark, sf)
    o = M.overlay(s["stored"], s["fresh"])
    return o.groupBy(*KEY, "origin").agg(F.count(F.lit(1)).alias("rows"))


# --------------------------------------------------------------------------- U1
@register("u1_union_optional_columns", Q.with_(Q.bars_1d(), Q.rollup("bars_1d", "1mo", "bars_1mo")) + f"""
SELECT {Q.SERIES}, ts, close, NULL::DOUBLE AS dividends, NULL::DOUBLE AS stock_splits FROM bars_1d
UNION ALL
SELECT {Q.SERIES}, ts, close, volume / 100.0 AS dividends,
       CASE WHEN volume > 150 THEN 2.0 ELSE 0.0 END AS stock_splits FROM bars_1mo""")
def u1_union_optional_columns(spark, sf):
    d = D.bars_1d(spark, sf)
    mo = B.rollup_bars(d, "1mo")
    mo = mo.withColumn("dividends", F.col("volume") / 100.0).withColumn(
        "stock_splits", F.when(F.col("volume") > 150, 2.0).otherwise(0.0))
    u = d.unionByName(mo, allowMissingColumns=True)
    return u.select(*KEY, "ts", "close", "dividends", "stock_splits")


# --------------------------------------------------------------------------- W1 / P5
_CORR = [Q.TICKS, """deliveries AS (
  SELECT asset_class, ticker, ts, price, seq, 0 AS src_rank FROM ticks
  UNION ALL
  SELECT asset_class, ticker, ts, price + 1 AS price, seq, 1 AS src_rank FROM ticks WHERE event_type = 'error')"""]


def _deliveries(spark, sf):
    t = D.ticks(spark, sf)
    corr = t.where(F.col("event_type") == "error").withColumn("price", F.col("price") + 1)
    return (t.withColumn("src_rank", F.lit(0)).unionByName(corr.withColumn("src_rank", F.lit(1)))
            .select("asset_class", "ticker", "ts", "price", "seq", "src_rank"))


@register("w1_last_write_wins", Q.with_(*_CORR) + """
SELECT asset_class, ticker, ts, round(price, 6) AS price, seq FROM deliveries
QUALIFY row_number() OVER (PARTITION BY asset_class, ticker, ts ORDER BY src_rank DESC, seq DESC) = 1""")
def w1_last_write_wins(spark, sf):
    w = B.last_write_wins(_deliveries(spark, sf), ["asset_class", "ticker", "ts"], ("src_rank", "seq"))
    return w.select("asset_class", "ticker", "ts", r6("price").alias("price"), "seq")


@register("p5_normalise_bars", Q.with_(*_CORR) + """
SELECT asset_class, ticker, ts, round(price, 6) AS open, round(price, 6) AS close FROM deliveries
QUALIFY row_number() OVER (PARTITION BY asset_class, ticker, ts ORDER BY src_rank DESC, seq DESC) = 1""")
def p5_normalise_bars(spark, sf):
    """Raw download frames: string time with offset, two-level (struct)
    price columns, an unknown extra column, re-delivered rows."""
    d = _deliveries(spark, sf)
    raw = d.select(
        "asset_class", "ticker",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias("Datetime"),
        F.struct(F.col("price").alias("px")).alias("Open"),
        F.struct(F.col("price").alias("px")).alias("Close"),
        F.lit(True).alias("Repaired?"),
        (F.col("src_rank") * F.lit(10 ** 12) + F.col("seq")).alias("row_seq"))
    n = B.normalise_bars(raw, ("asset_class", "ticker"), "Datetime", "row_seq")
    return n.select("asset_class", "ticker", "ts", r6("open").alias("open"), r6("close").alias("close"))


# --------------------------------------------------------------------------- I1
_INTRA_LIST = ", ".join(f"'{i}'" for i in RETENTION_DAYS)
_CUM_LIST = ", ".join(f"'{i}'" for i in CUMULATIVE_INTERVALS)
_IV_LIST = _INTRA_LIST + ", " + _CUM_LIST
_I1 = [Q.bars_1d("stored_1d", ["F"]), Q.rollup("stored_1d", "1wk", "stored_1wk"),
       Q.bars_1d("fresh_1d", ["O", "P"]), Q.rollup("fresh_1d", "1wk", "fresh_1wk"),
       "stored AS (SELECT * FROM stored_1d UNION ALL SELECT * FROM stored_1wk)",
       "staged AS (SELECT * FROM fresh_1d UNION ALL SELECT * FROM fresh_1wk)",
       """plan AS (SELECT DISTINCT asset_class, ticker, unnest(['1d', '1wk']) AS interval FROM fresh_1d)""",
       f"""trusted AS (SELECT {Q.SERIES}, CASE WHEN count(*) >= 20 THEN max(ts) END AS last_ts
                       FROM stored GROUP BY {Q.SERIES})""",
       f"""refresh AS (
  SELECT p.asset_class, p.interval, p.ticker,
         CASE WHEN p.interval NOT IN ({_IV_LIST}) THEN 'unsupported'
              WHEN p.interval IN ({_INTRA_LIST}) THEN 'window'
              WHEN t.last_ts IS NULL THEN 'full' ELSE 'incremental' END AS mode,
         CASE WHEN p.interval IN ({_CUM_LIST}) AND t.last_ts IS NOT NULL
              THEN CAST(t.last_ts AS DATE) - 1 END AS start
  FROM plan p LEFT JOIN trusted t USING ({Q.SERIES}))"""]


@register("i1_refresh_plan", Q.with_(*_I1) + f"""
SELECT r.asset_class, r.interval, r.ticker, r.mode, r.start, count(s.ts) AS loaded_rows
FROM refresh r LEFT JOIN staged s ON r.asset_class = s.asset_class AND r.interval = s.interval
  AND r.ticker = s.ticker AND (r.start IS NULL OR s.ts >= r.start)
GROUP BY ALL""")
def i1_refresh_plan(spark, sf):
    from barforge.plans.refresh import refresh_plan, staged_load, work_plan
    stored_d = D.bars_1d(spark, sf, ("F",))
    fresh_d = D.bars_1d(spark, sf, ("O", "P"))
    stored = stored_d.unionByName(B.rollup_bars(stored_d, "1wk"))
    staged = fresh_d.unionByName(B.rollup_bars(fresh_d, "1wk"))
    plan = work_plan(fresh_d.select("asset_class", "ticker").distinct(), DAILY_RUN_INTERVALS)
    rp = refresh_plan(plan, stored)
    return staged_load(rp, staged)
