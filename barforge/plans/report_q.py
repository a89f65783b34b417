"""Registered run-report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from barforge.operators import report as RP
from barforge.operators.bars import rollup_bars
from barforge.plans import refresh as R
from barforge.plans import sqlparts as Q
from barforge.plans.merge_q import _I1
from barforge.plans.registry import register
from barforge.schema import MISSING_MARKERS, PERMANENT_MARKERS, TRANSIENT_MARKERS
from barforge.sources import derived as D

_NORM = """j AS (
  SELECT CASE WHEN status IN ('success', 'failed', 'skipped') THEN status ELSE 'failed' END AS status,
         CASE WHEN coalesce(interval, '') = '' THEN '(unknown)' ELSE interval END AS interval_key,
         CASE WHEN coalesce(asset_class, '') = '' THEN '(unknown)' ELSE asset_class END AS class_key,
         ticker, asset_class, interval, message, seq, shard
  FROM jobs)"""
_COUNTS = ("count(*) FILTER (WHERE status = 'success') AS success, "
           "count(*) FILTER (WHERE status = 'failed') AS failed, "
           "count(*) FILTER (WHERE status = 'skipped') AS skipped")
_SUMMARY = [Q.JOBS, _NORM, f"""g AS (
  SELECT CASE GROUPING(interval_key, class_key) WHEN 3 THEN 'total' WHEN 1 THEN 'interval'
              ELSE 'asset_class' END AS scope,
         coalesce(interval_key, class_key, '') AS key, {_COUNTS}
  FROM j GROUP BY GROUPING SETS ((), (interval_key), (class_key)))""", """summary AS (
  SELECT scope, key, success, failed, skipped, success + failed + skipped AS total,
         success + failed AS attempted,
         coalesce(round_even(failed / nullif(success + failed, 0), 6), 0.0) AS failure_rate
  FROM g)"""]


def _summary(spark, sf):
    return RP.run_summary(D.job_results(spark, sf))


@register("a3_run_summary", Q.with_(*_SUMMARY) + "SELECT * FROM summary")
def a3_run_summary(spark, sf):
    return _summary(spark, sf).select("scope", "key", "success", "failed", "skipped", "total",
                                      "attempted", "failure_rate")


@register("a4_merge_partial_summaries", Q.with_(Q.JOBS, _NORM, f"""parts AS (
  SELECT shard, CASE GROUPING(interval_key, class_key) WHEN 3 THEN 'total' WHEN 1 THEN 'interval'
              ELSE 'asset_class' END AS scope,
         coalesce(interval_key, class_key, '') AS key, {_COUNTS}
  FROM j GROUP BY GROUPING SETS ((shard), (shard, interval_key), (shard, class_key)))""") + """
SELECT scope, key, CAST(sum(success) AS BIGINT) AS success, CAST(sum(failed) AS BIGINT) AS failed,
       CAST(sum(skipped) AS BIGINT) AS skipped,
       CAST(sum(success) + sum(failed) + sum(skipped) AS BIGINT) AS total,
       CAST(sum(success) + sum(failed) AS BIGINT) AS attempted,
       round(coalesce(sum(failed) / nullif(sum(success) + sum(failed), 0), 0.0), 9) AS failure_rate
FROM parts GROUP BY scope, key""")
def a4_merge_partial_summaries(spark, sf):
    parts = RP.run_summary(D.job_results(spark, sf), extra_keys=["shard"])
    m = RP.merge_summaries(parts, "shard")
    return m.select("scope", "key", *[F.col(c).cast("bigint").alias(c) for c in
                                      ("success", "failed", "skipped", "total", "attempted")],
                    F.round("failure_rate", 9).alias("failure_rate"))


@register("a5_failure_rate_pct", Q.with_(*_SUMMARY) + """
SELECT scope, key, round(coalesce(100.0 * failure_rate,
                                  100.0 * failed / nullif(CASE WHEN attempted > 0 THEN attempted ELSE success + failed END, 0),
                                  0.0), 4) AS failure_rate_pct
FROM summary""")
def a5_failure_rate_pct(spark, sf):
    p = RP.failure_rate_pct(_summary(spark, sf))
    return p.select("scope", "key", F.round("failure_rate_pct", 4).alias("failure_rate_pct"))


def _contains_any(markers) -> str:
    return "(" + " OR ".join(f"contains(t, '{m.replace(chr(39), chr(39) * 2)}')" for m in markers) + ")"


@register("p12_failure_triage", Q.with_(*_SUMMARY[:2]) + f"""
SELECT label, message, count(*) AS n FROM (
  SELECT message, CASE WHEN {_contains_any(MISSING_MARKERS)} THEN 'missing'
                       WHEN {_contains_any(TRANSIENT_MARKERS)} AND NOT {_contains_any(PERMANENT_MARKERS)} THEN 'transient'
                       WHEN {_contains_any(PERMANENT_MARKERS)} THEN 'permanent' ELSE 'other' END AS label
  FROM (SELECT message, lower(coalesce(message, '')) AS t FROM j WHERE status = 'failed'))
GROUP BY label, message""")
def p12_failure_triage(spark, sf):
    j = RP.normalise_outcomes(D.job_results(spark, sf)).where(F.col("status") == "failed")
    return j.groupBy(RP.triage(F.col("message")).alias("label"), "message").agg(
        F.count(F.lit(1)).alias("n"))


@register("o3_first_failures", Q.with_(*_SUMMARY[:2]) + """
SELECT ticker, asset_class, interval, message, seq FROM j WHERE status = 'failed' ORDER BY seq LIMIT 100""")
def o3_first_failures(spark, sf):
    return RP.first_failures(D.job_results(spark, sf), "seq", 100)


@register("o2_sample_catalogue", Q.with_(Q.bars_1d(), Q.TICKS, Q.TICK_SOURCES, Q.source_bars(), f"""keys AS (
  SELECT DISTINCT {Q.SERIES} FROM bars_1d UNION SELECT DISTINCT {Q.SERIES} FROM src_bars)""") + """
SELECT asset_class, interval, list_sort(list(ticker) FILTER (WHERE rn <= 3)) AS sample, count(*) AS series
FROM (SELECT *, row_number() OVER (PARTITION BY asset_class, interval ORDER BY ticker) AS rn FROM keys)
GROUP BY asset_class, interval""")
def o2_sample_catalogue(spark, sf):
    keys = (D.bars_1d(spark, sf).select("asset_class", "interval", "ticker")
            .unionByName(D.intraday_source_bars(spark, sf).select("asset_class", "interval", "ticker")))
    return RP.catalogue(keys, 3)


@register("s16_summary_json")
def s16_summary_json(spark, sf):
    """Rows-only: the JSON summary document (counters, buckets, failures)."""
    jobs = D.job_results(spark, sf)
    return RP.summary_document(RP.run_summary(jobs), RP.first_failures(jobs))


_DOCUMENT = ("success long, failed long, skipped long, total long, attempted long, failure_rate_pct double, "
             "by_interval map<string, struct<success: long, failed: long, skipped: long>>, "
             "by_asset_class map<string, struct<success: long, failed: long, skipped: long>>, "
             "failures array<struct<ticker: string, asset_class: string, interval: string, message: string>>")


@register("s16_summary_fields", Q.with_(*_SUMMARY) + """
SELECT scope, key, success, failed, skipped, CASE WHEN scope = 'total' THEN total END AS total,
       CASE WHEN scope = 'total' THEN attempted END AS attempted,
       CASE WHEN scope = 'total' THEN round(failure_rate * 100, 4) END AS failure_rate_pct, CAST(NULL AS VARCHAR) AS failure FROM summary
UNION ALL
SELECT 'failure', CAST(row_number() OVER (ORDER BY seq) AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL,
       concat_ws('|', ticker, asset_class, interval, message)
FROM (SELECT * FROM j WHERE status = 'failed' ORDER BY seq LIMIT 100)""")
def s16_summary_fields(spark, sf):
    """The JSON summary document, parsed back into its fields."""
    doc = s16_summary_json(spark, sf).select(F.from_json("summary_json", _DOCUMENT).alias("d")).select("d.*")
    none = lambda kind: F.lit(None).cast(kind)
    total = doc.select(F.lit("total").alias("scope"), F.lit("").alias("key"), "success", "failed", "skipped", "total", "attempted",
                       "failure_rate_pct", none("string").alias("failure"))
    buckets = [doc.select(F.lit(scope).alias("scope"), F.explode(f"by_{scope}").alias("key", "b")).select(
        "scope", "key", "b.success", "b.failed", "b.skipped", none("long").alias("total"), none("long").alias("attempted"),
        none("double").alias("failure_rate_pct"), none("string").alias("failure")) for scope in ("interval", "asset_class")]
    failures = doc.select(F.posexplode("failures").alias("pos", "f")).select(
        F.lit("failure").alias("scope"), (F.col("pos") + 1).cast("string").alias("key"), *(none("long").alias(c) for c in (
            "success", "failed", "skipped", "total", "attempted")), none("double").alias("failure_rate_pct"),
        F.concat_ws("|", "f.ticker", "f.asset_class", "f.interval", "f.message").alias("failure"))
    return total.unionByName(buckets[0]).unionByName(buckets[1]).unionByName(failures)


# --------------------------------------------------------------------------- I3
_PLAN_IVS = ("1d", "1wk", "3mo", "5m", "2h")


def _i3(spark, sf):
    stored_d = D.bars_1d(spark, sf, ("F",))
    fresh_d = D.bars_1d(spark, sf, ("O", "P"))
    stored = stored_d.unionByName(rollup_bars(stored_d, "1wk"))
    staged = fresh_d.unionByName(rollup_bars(fresh_d, "1wk"))
    plan = R.work_plan(fresh_d.select("asset_class", "ticker").distinct(), _PLAN_IVS)
    loaded = R.staged_load(R.refresh_plan(plan, stored), staged)
    errors = (staged.groupBy("asset_class", "interval", "ticker")
              .agg(F.max("volume").alias("v")).where(F.col("v") > 20)
              .select("asset_class", "interval", "ticker",
                      F.concat(F.lit("rejected bar volume "), F.col("v").cast("string")).alias("error")))
    return R.job_outcomes(loaded, errors)


@register("i3_job_outcomes", Q.with_(*_I1[:4], "stored AS (SELECT * FROM stored_1d UNION ALL SELECT * FROM stored_1wk)",
                                     "staged AS (SELECT * FROM fresh_1d UNION ALL SELECT * FROM fresh_1wk)",
                                     f"""plan AS (SELECT DISTINCT asset_class, ticker, unnest([{", ".join(f"'{i}'" for i in _PLAN_IVS)}]) AS interval FROM fresh_1d)""",
                                     *_I1[7:], f"""loaded AS (
  SELECT r.asset_class, r.interval, r.ticker, r.mode, count(s.ts) AS loaded_rows
  FROM refresh r LEFT JOIN staged s ON r.asset_class = s.asset_class AND r.interval = s.interval
    AND r.ticker = s.ticker AND (r.start IS NULL OR s.ts >= r.start)
  GROUP BY ALL)""", f"""errs AS (
  SELECT {Q.SERIES}, 'rejected bar volume ' || CAST(max(volume) AS VARCHAR) AS error
  FROM staged GROUP BY ALL HAVING max(volume) > 20)""") + f"""
SELECT CASE WHEN l.mode = 'unsupported' THEN 'skipped'
            WHEN e.error IS NOT NULL THEN 'failed'
            WHEN l.loaded_rows = 0 AND l.mode IN ('full', 'window') THEN 'failed' ELSE 'success' END AS status,
       l.ticker, l.asset_class, l.interval,
       CASE WHEN l.mode = 'unsupported' THEN 'unsupported interval ' || chr(39) || l.interval || chr(39)
            WHEN e.error IS NOT NULL THEN e.error
            WHEN l.loaded_rows = 0 AND l.mode = 'window' THEN 'No ' || l.interval || ' data (illiquid, halted, or unsupported)'
            WHEN l.loaded_rows = 0 AND l.mode = 'full' THEN 'No ' || l.interval || ' data returned'
            ELSE CAST(l.loaded_rows AS VARCHAR) || ' row(s) loaded' END AS message
FROM loaded l LEFT JOIN errs e USING ({Q.SERIES})""")
def i3_job_outcomes(spark, sf):
    return _i3(spark, sf)
