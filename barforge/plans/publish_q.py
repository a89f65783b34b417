"""Registered publish / storage queries (A6, P11, J9, A13, I4, I5, S1, S10,
S11, S15)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from barforge.functions.symbols import safe_filename
from barforge.operators import bars as B
from barforge.operators import merge as M
from barforge.plans import publish as P
from barforge.plans import sqlparts as Q
from barforge.plans.merge_q import AS_OF, AS_OF_SQL
from barforge.plans.registry import register
from barforge.schema import CONTROL_FILES, SLICES, slice_dim
from barforge.session import checkpoint_dir
from barforge.sources import derived as D
from barforge.sources import store as ST

_SAFE = "replace(replace(replace(ticker, '^', ''), '=', '_'), '/', '_')"
_CONTROL_SQL = ", ".join(f"'{c}'" for c in CONTROL_FILES)


def _scratch(spark, tag: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


# ---- snapshot trees derived from the bar sources -------------------------
def _pulled_paths(spark, sf):
    """The pulled snapshot as file paths: one series file per stored series,
    one dated file per legacy (series, day), control files per directory.
    Every path comes from one distinct-keys aggregation (one pass)."""
    b = D.intraday_source_bars(spark, sf).where(F.col("src").isin("stored", "legacy"))
    d = D.bars_1d(spark, sf, ("F",)).select("asset_class", "interval", "ticker",
                                            F.lit("stored").alias("src"), F.lit(None).cast("date").alias("day"))
    keys = b.select("asset_class", "interval", "ticker", "src", "day").unionByName(d).distinct()
    stem = safe_filename(F.col("ticker"))
    data = F.when(F.col("src") == "legacy", F.concat(stem, F.lit("_"), F.date_format("day", "yyyy-MM-dd"),
                                                      F.lit(".csv"))).otherwise(F.concat(stem, F.lit(".csv")))
    paths = F.array(F.concat_ws("/", "asset_class", "interval", data),
                    F.concat_ws("/", "asset_class", F.lit(".gitkeep")),
                    F.concat_ws("/", "asset_class", "interval", F.lit(".DS_Store")),
                    F.concat_ws("/", "asset_class", F.lit("README.md")))
    return keys.select(F.explode(paths).alias("path")).distinct()


_SERIES_CTES = [Q.TICKS, Q.TICK_SOURCES, Q.source_bars(),
                "stored_b AS (SELECT * FROM src_bars WHERE src = 'stored')",
                "legacy_b AS (SELECT *, CAST(ts AS DATE) AS day FROM src_bars WHERE src = 'legacy')",
                Q.bars_1d("stored_1d", ["F"]), Q.bars_1d()]
_PULLED = _SERIES_CTES + [f"""pseries AS (
  SELECT DISTINCT {Q.SERIES} FROM stored_b UNION SELECT DISTINCT {Q.SERIES} FROM stored_1d)""",
                          f"""pdirs AS (
  SELECT DISTINCT asset_class, interval FROM pseries UNION SELECT DISTINCT asset_class, interval FROM legacy_b)""",
                          f"""pulled AS (
  SELECT asset_class || '/' || interval || '/' || {_SAFE} || '.csv' AS path FROM pseries
  UNION ALL
  SELECT DISTINCT asset_class || '/' || interval || '/' || {_SAFE} || '_' || strftime(day, '%Y-%m-%d') || '.csv' FROM legacy_b
  UNION ALL SELECT DISTINCT asset_class || '/.gitkeep' FROM pdirs
  UNION ALL SELECT DISTINCT asset_class || '/' || interval || '/.DS_Store' FROM pdirs
  UNION ALL SELECT DISTINCT asset_class || '/README.md' FROM pdirs)""",
                          f"""ptree AS (
  SELECT path, len(string_split(path, '/')) AS depth,
         CASE WHEN len(string_split(path, '/')) >= 3 THEN string_split(path, '/')[2] END AS interval,
         string_split(path, '/')[-1] IN ({_CONTROL_SQL}) AS control
  FROM pulled)"""]
_CURRENT = _PULLED + [Q.merged({"stored": ("stored_b", 1, 0),
                                "legacy": ("legacy_b", 2, "date_diff('day', DATE '1970-01-01', day)")}, "c_all"),
                      f"consolidated AS (SELECT * FROM c_all WHERE {Q.retention_sql(AS_OF_SQL)})",
                      f"""ctree AS (
  SELECT path, 3 AS depth, string_split(path, '/')[2] AS interval, false AS control FROM (
    SELECT DISTINCT asset_class || '/' || interval || '/' || {_SAFE} || '.csv' AS path FROM (
      SELECT {Q.SERIES} FROM consolidated UNION SELECT {Q.SERIES} FROM bars_1d)))"""]


def _tree(paths):
    return ST.file_tree(paths)


@register("a6_tree_counts", Q.with_(*_PULLED) + """
SELECT interval, count(*) AS n_files FROM ptree WHERE NOT control AND depth >= 3 GROUP BY interval
UNION ALL SELECT '*total*', count(*) FROM ptree WHERE NOT control""")
def a6_tree_counts(spark, sf):
    per, total = P.tree_counts(_tree(_pulled_paths(spark, sf)))
    return per.unionByName(total.select(F.lit("*total*").alias("interval"), "n_files"))


@register("p11_slice_filter", Q.with_(*_PULLED) + f"""
SELECT s.slice, t.interval, count(*) AS n_files
FROM ptree t JOIN (VALUES {", ".join(f"('{n}', '{iv}')" for n, sp in SLICES.items() for iv in sp["intervals"])}) s(slice, interval)
  ON t.interval = s.interval
WHERE t.depth >= 3 GROUP BY s.slice, t.interval""")
def p11_slice_filter(spark, sf):
    tree = _tree(_pulled_paths(spark, sf))
    dim = slice_dim(spark)
    parts = [P.slice_files(tree, dim, n).withColumn("slice", F.lit(n)) for n in SLICES]
    u = parts[0].unionByName(parts[1])
    return u.groupBy("slice", "interval").agg(F.count(F.lit(1)).alias("n_files"))


_REQ = SLICES["intraday"]["required"]
_INC = SLICES["intraday"]["intervals"]
_GUARD = _CURRENT + [f"""prev AS (SELECT interval, count(*) AS n FROM ptree WHERE NOT control AND depth >= 3
                               AND interval IN ({", ".join(f"'{i}'" for i in _INC)}) GROUP BY interval)""",
                     f"""cur AS (SELECT interval, count(*) AS n FROM ctree
                              WHERE interval IN ({", ".join(f"'{i}'" for i in _INC)}) GROUP BY interval)""",
                     f"""guard AS (
  SELECT k.interval, coalesce(p.n, 0) AS pulled, coalesce(c.n, 0) AS current,
         k.interval IN ({", ".join(f"'{i}'" for i in _REQ)}) AS required,
         k.interval IN ({", ".join(f"'{i}'" for i in _REQ)}) AND coalesce(c.n, 0) = 0 AS missing,
         coalesce(c.n, 0) < coalesce(p.n, 0) AS reduced
  FROM (SELECT interval FROM prev UNION SELECT interval FROM cur
        UNION SELECT * FROM (VALUES {", ".join(f"('{i}')" for i in _REQ)}) r(interval)) k
  LEFT JOIN prev p USING (interval) LEFT JOIN cur c USING (interval))"""]


def _snapshot_counts(spark, sf):
    """(interval, pulled, current) files without building a single path: per
    series whether it is stored, its dated files and its latest bar. Pulled are
    the series file and one file per dated day; after consolidation a series
    has one file if its latest bar survives the retention."""
    cols = ["asset_class", "interval", "ticker", "src", "day", "ts"]
    b = D.intraday_source_bars(spark, sf).where(F.col("src").isin("stored", "legacy"))
    d = D.bars_1d_sources(spark, sf).withColumn("day", F.lit(None).cast("date"))
    series = b.select(*cols).unionByName(d.select(*cols)).groupBy(
        "asset_class", "interval", safe_filename(F.col("ticker")).alias("stem")).agg(
        F.max((F.col("src") == "stored").cast("int")).alias("stored"),
        F.size(F.collect_set("day")).alias("days"),  # one file a day: bounded by the series' time span
        F.max("ts").alias("ts"))
    kept = B.retention_predicate(AS_OF).cast("int")
    return series.groupBy("interval").agg(F.sum(F.col("stored") + F.col("days")).alias("pulled"), F.sum(kept).alias("current"))


def _guard(spark, sf):
    return P.guard_counts(_snapshot_counts(spark, sf), _REQ, _INC)


@register("j9_publish_guard", Q.with_(*_GUARD) + "SELECT * FROM guard")
def j9_publish_guard(spark, sf):
    return _guard(spark, sf).select("interval", "pulled", "current", "required", "missing", "reduced")


@register("j9_publish_verdict", Q.with_(*_GUARD) + """
SELECT CAST(sum(pulled) AS BIGINT) AS pulled, CAST(sum(current) AS BIGINT) AS current, bool_or(missing) AS any_missing,
       bool_or(reduced) AS any_reduced,
       bool_or(missing) OR bool_or(reduced) OR (sum(pulled) > 0 AND sum(current) < sum(pulled)) AS refused
FROM guard""")
def j9_publish_verdict(spark, sf):
    v = P.guard_verdict(_guard(spark, sf))
    return v.select(F.col("pulled").cast("bigint").alias("pulled"), F.col("current").cast("bigint").alias("current"),
                    "any_missing", "any_reduced", "refused")


@register("i4_slice_split", Q.with_(*_PULLED) + f"""
SELECT s.slice, t.interval, count(*) AS n_files
FROM ptree t JOIN (VALUES {", ".join(f"('{n}', '{iv}')" for n, sp in SLICES.items() for iv in sp["intervals"])}) s(slice, interval)
  ON t.interval = s.interval
WHERE NOT t.control AND t.depth >= 3 GROUP BY s.slice, t.interval""")
def i4_slice_split(spark, sf):
    parts = P.split_slices(_tree(_pulled_paths(spark, sf)), slice_dim(spark))
    return parts.groupBy("slice", "interval").agg(F.count(F.lit(1)).alias("n_files"))


_I5_BARS = ["asset_class", "interval", "ticker", "ts", "open", "high", "low", "close", "adj_close", "volume"]


@register("i5_daily_publish", Q.with_(Q.bars_1d("stored_1d", ["F"]), Q.bars_1d()) + """
SELECT 'daily' AS dataset, 1 AS version, interval, count(*) AS n_files, 'READY' AS status
FROM (SELECT DISTINCT asset_class, interval, ticker FROM stored_1d) GROUP BY interval
UNION ALL SELECT 'daily', 2, interval, count(*), 'READY'
FROM (SELECT DISTINCT asset_class, interval, ticker FROM bars_1d) GROUP BY interval
UNION ALL SELECT 'daily', v, '*', CAST(NULL AS BIGINT), 'READY' FROM (VALUES (1), (2)) t(v)
UNION ALL SELECT 'daily', 3, '*', CAST(NULL AS BIGINT), 'REFUSED'""")
def i5_daily_publish(spark, sf):
    """A store that holds daily bars only, published with its required
    interval; the third publish lacks that interval and is refused although
    shrinking is allowed."""
    root = _scratch(spark, "i5d")
    stored, bars = D.bars_1d(spark, sf, ("F",)).select(*_I5_BARS), D.bars_1d(spark, sf).select(*_I5_BARS)
    P.publish_snapshot(spark, stored, root, "daily", required=["1d"])
    P.publish_snapshot(spark, bars, root, "daily", required=["1d"])
    other = bars.withColumn("interval", F.lit("5d"))
    P.publish_snapshot(spark, other, root, "daily", required=["1d"], allow_shrink=True)
    man = spark.read.schema(P.MANIFEST_ROW).parquet(f"{root}/manifest").withColumn("status", F.lit("READY"))
    log = spark.read.schema(P.VERSION_ROW).parquet(f"{root}/versions").select(
        "dataset", "version", F.lit("*").alias("interval"), F.lit(None).cast("bigint").alias("n_files"), "status")
    return man.unionByName(log)


@register("i5_publish_plan", Q.with_(*_CURRENT, """v1 AS (
  SELECT interval, count(*) AS n FROM (SELECT DISTINCT asset_class, interval, ticker FROM pseries) GROUP BY interval)""",
                                     """v2 AS (
  SELECT interval, count(*) AS n FROM (
    SELECT asset_class, interval, ticker FROM consolidated UNION SELECT asset_class, interval, ticker FROM bars_1d)
  GROUP BY interval)""", """g AS (
  SELECT coalesce(p.n, 0) AS pulled, coalesce(c.n, 0) AS current, coalesce(c.n, 0) < coalesce(p.n, 0) AS reduced
  FROM v1 p FULL JOIN v2 c USING (interval))""", """ref AS (
  SELECT bool_or(reduced) OR (sum(pulled) > 0 AND sum(current) < sum(pulled)) AS refused FROM g)""") + """
SELECT 'combined' AS dataset, 1 AS version, interval, n AS n_files, 'READY' AS status FROM v1
UNION ALL SELECT 'combined', 2, interval, n, 'READY' FROM v2 WHERE NOT (SELECT refused FROM ref)
UNION ALL SELECT 'combined', 1, '*', CAST(NULL AS BIGINT), 'READY'
UNION ALL SELECT 'combined', 2, '*', CAST(NULL AS BIGINT),
                 CASE WHEN (SELECT refused FROM ref) THEN 'REFUSED' ELSE 'READY' END""")
def i5_publish_plan(spark, sf):
    """Publish the pulled snapshot (version 1), then consolidate and publish
    again (version 2) through the no-shrink guard; returns the manifest of
    the READY versions and the version log ('*' rows)."""
    root = _scratch(spark, "i5")
    tasks = D.bar_tasks(spark, sf)
    b = D.intraday_source_bars(spark, sf).where(F.col("src").isin("stored", "legacy"))
    pulled = (b.where(F.col("src") == "stored").select(*_I5_BARS)
              .unionByName(D.bars_1d(spark, sf, ("F",)).select(*_I5_BARS)))
    P.publish_snapshot(spark, pulled, root, "combined", required=["1d"], partitions=tasks)
    merged, _ = M.consolidate_sources(D.source_bars_by_time(spark, sf, ("stored", "legacy")), AS_OF)
    current = merged.select(*_I5_BARS).unionByName(D.bars_1d(spark, sf).select(*_I5_BARS))
    P.publish_snapshot(spark, current, root, "combined", required=["1d"], partitions=tasks)
    man = spark.read.parquet(f"{root}/manifest").select(
        "dataset", "version", "interval", "n_files", F.lit("READY").alias("status"))
    log = spark.read.parquet(f"{root}/versions").select(
        "dataset", "version", F.lit("*").alias("interval"), F.lit(None).cast("bigint").alias("n_files"), "status")
    return man.unionByName(log)


# --------------------------------------------------------------------------- A13
_VERSIONS_SQL = """
SELECT c_mktsegment AS dataset, c_nationkey + 1 AS version,
       CASE WHEN bal < 0 THEN 'FAILED' WHEN bal > 9800 THEN 'DatasetStatus.PENDING'
            WHEN bal > 9000 THEN 'deleted' ELSE 'DatasetStatus.READY' END AS status
FROM (SELECT c_mktsegment, c_nationkey, arg_max(c_acctbal, c_custkey) AS bal FROM customer GROUP BY ALL)"""


def _versions(spark, sf):
    c = D.table(spark, sf, "customer")
    v = c.groupBy("c_mktsegment", "c_nationkey").agg(F.max_by("c_acctbal", "c_custkey").alias("bal"))
    return v.select(F.col("c_mktsegment").alias("dataset"), (F.col("c_nationkey") + 1).alias("version"),
                    F.expr("CASE WHEN bal < 0 THEN 'FAILED' WHEN bal > 9800 THEN 'DatasetStatus.PENDING' "
                           "WHEN bal > 9000 THEN 'deleted' ELSE 'DatasetStatus.READY' END").alias("status"))


@register("a13_version_readiness", f"""
WITH v AS ({_VERSIONS_SQL}),
s AS (SELECT *, upper(split_part(status, '.', -1)) AS st FROM v),
d AS (SELECT dataset, max(version) FILTER (WHERE st = 'READY') AS current_version,
             CASE WHEN dataset = 'MACHINERY' THEN 'PENDING' ELSE 'READY' END AS ds_status FROM s GROUP BY dataset),
per AS (SELECT dataset, max(version) AS max_v,
               count(*) FILTER (WHERE st <> '' AND st NOT IN ('READY', 'FAILED', 'DELETED')) AS n_pending,
               count(*) FILTER (WHERE st IN ('FAILED', 'DELETED')) AS n_failed FROM s GROUP BY dataset)
SELECT d.dataset, CAST(d.current_version AS BIGINT) AS current_version,
       CAST(greatest(d.current_version, coalesce(p.max_v, 0)) AS BIGINT) AS max_version,
       coalesce(p.n_pending, 0) AS n_pending, coalesce(p.n_failed, 0) AS n_failed,
       d.ds_status = 'READY' AND coalesce(p.n_pending, 0) = 0 AND d.current_version > 0 AND NOT EXISTS (
         SELECT 1 FROM range(d.current_version + 1, greatest(d.current_version, coalesce(p.max_v, 0)) + 1) r(v)
         WHERE r.v NOT IN (SELECT version FROM s WHERE s.dataset = d.dataset AND st IN ('FAILED', 'DELETED'))) AS ready,
       CAST(greatest(d.current_version, coalesce(p.max_v, 0)) + 1 AS BIGINT) AS next_version
FROM d LEFT JOIN per p USING (dataset)""")
def a13_version_readiness(spark, sf):
    v = _versions(spark, sf)
    st = P.status_name(F.col("status"))
    ds = v.groupBy("dataset").agg(F.max(F.when(st == "READY", F.col("version"))).alias("current_version"))
    ds = ds.withColumn("status", F.when(F.col("dataset") == "MACHINERY", "PENDING").otherwise("READY"))
    r = P.version_readiness(v, ds)
    return r.select("dataset", F.col("current_version").cast("bigint").alias("current_version"),
                    F.col("max_version").cast("bigint").alias("max_version"), "n_pending", "n_failed", "ready",
                    F.col("next_version").cast("bigint").alias("next_version"))


# --------------------------------------------------------------------------- S10 / S1 / S11 / S15
@register("s10_bar_csv_format", Q.with_(Q.bars_1d()) + """
SELECT asset_class, interval, ticker AS "Ticker", strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+0000' AS "Datetime",
       printf('%.10f', open) AS "Open", printf('%.10f', high) AS "High", printf('%.10f', low) AS "Low",
       printf('%.10f', close) AS "Close",
       CASE WHEN adj_close IS NOT NULL THEN printf('%.10f', round(adj_close, 6)) END AS "Adj Close",
       CAST(volume AS VARCHAR) AS "Volume"
FROM bars_1d""")
def s10_bar_csv_format(spark, sf):
    b = D.bars_1d(spark, sf).withColumn("adj_close", F.round("adj_close", 6))
    return ST.csv_frame(b)


@register("s1_bar_csv_scan", Q.with_(Q.bars_1d()) + """
SELECT asset_class, interval, ticker AS stem, ts, open, high, low, close, round(adj_close, 6) AS adj_close, volume
FROM bars_1d""")
def s1_bar_csv_scan(spark, sf):
    """Round trip through a per-ticker CSV tree whose files do not all share
    one column order (crypto files are written Close-first)."""
    root = _scratch(spark, "s1")
    b = D.bars_1d(spark, sf).repartition("asset_class", "ticker")  # a file per ticker, not per task
    frame = ST.csv_frame(b).withColumnRenamed("Ticker", "ticker")
    std = ["Datetime", "Open", "High", "Low", "Close", "Adj Close", "Volume"]
    alt = ["Datetime", "Close", "Volume", "Open", "Low", "High", "Adj Close"]
    for cls_filter, order in ((F.col("asset_class") != "crypto", std), (F.col("asset_class") == "crypto", alt)):
        (frame.where(cls_filter).select("asset_class", "interval", "ticker", *order)
         .write.mode("append").partitionBy("asset_class", "interval", "ticker")
         .option("header", True).csv(root))
    bars, _ = ST.read_bar_csv(spark, root, "*/*/*/*.csv")
    return bars.select("asset_class", "interval", "stem", "ts", "open", "high", "low", "close",
                       F.round("adj_close", 6).alias("adj_close"), "volume")


@register("s11_partitioned_store", Q.with_(Q.TICKS, Q.bars_from_ticks()) + f"""
SELECT {Q.SERIES}, ts, open, high, low, close, volume FROM bars_intraday WHERE interval = '5m'""")
def s11_partitioned_store(spark, sf):
    root = _scratch(spark, "s11")
    ST.write_store(D.bars_intraday(spark, sf), root, partitions=D.bar_tasks(spark, sf))
    back = ST.read_store(spark, root).where(F.col("interval") == "5m")  # partition pruning
    return back.select("asset_class", "interval", "ticker", "ts", "open", "high", "low", "close", "volume")


@register("s15_manifest", Q.with_(*_PULLED) + """
SELECT 'intraday' AS dataset, 1 AS version, interval, count(*) AS n_files
FROM ptree WHERE NOT control AND depth >= 3 GROUP BY interval""")
def s15_manifest(spark, sf):
    root = _scratch(spark, "s15")
    ST.manifest(_tree(_pulled_paths(spark, sf)), "intraday", 1).write.mode("overwrite").parquet(root)
    return spark.read.parquet(root)
