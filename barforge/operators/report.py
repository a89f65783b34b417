"""Run outcome reporting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.schema import (FAILURE_LIST_LIMIT, MISSING_MARKERS, PERMANENT_MARKERS,
                             TRANSIENT_MARKERS)

STATUSES = ("success", "failed", "skipped")


def normalise_outcomes(jobs: DataFrame) -> DataFrame:
    """Unknown status -> failed; blank or missing keys -> '(unknown)'."""
    def key(c):
        return F.when(F.coalesce(F.col(c), F.lit("")) == "", F.lit("(unknown)")).otherwise(F.col(c))
    return (jobs.withColumn("status", F.when(F.col("status").isin(*STATUSES), F.col("status"))
                            .otherwise("failed"))
            .withColumn("interval_key", key("interval"))
            .withColumn("class_key", key("asset_class")))


def _counts(status: Column | None = None):
    status = F.col("status") if status is None else status
    return [F.count_if(status == s).alias(s) for s in STATUSES]


def _finish(df: DataFrame, rounded: bool = True) -> DataFrame:
    attempted = F.col("success") + F.col("failed")
    rate = F.try_divide(F.col("failed"), attempted)
    rate = F.bround(rate, 6) if rounded else rate
    return (df.withColumn("total", F.col("success") + F.col("failed") + F.col("skipped"))
            .withColumn("attempted", attempted)
            .withColumn("failure_rate", F.coalesce(rate, F.lit(0.0))))


def _scope(gid: Column) -> Column:
    # grouping_id bits (extra keys are always grouped): interval_key 2, class_key 1
    return F.when(gid == 3, "total").when(gid == 1, "interval").otherwise("asset_class")


def run_summary(jobs: DataFrame, extra_keys=()) -> DataFrame:
    """A3: counters for the whole run, per interval and per asset class in
    one GROUPING SETS aggregation (map-side combined, one shuffle).
    ``extra_keys`` (e.g. a shard id) are added to every grouping set."""
    j = normalise_outcomes(jobs)
    extra = list(extra_keys)
    sets = [[*extra], [*extra, "interval_key"], [*extra, "class_key"]]
    agg = j.groupingSets(sets, *extra, "interval_key", "class_key").agg(
        *_counts(), F.grouping_id().alias("_gid"))
    out = agg.select(*extra, _scope(F.col("_gid")).alias("scope"),
                     F.coalesce("interval_key", "class_key", F.lit("")).alias("key"),
                     *STATUSES)
    return _finish(out)


def merge_summaries(parts: DataFrame, part_key: str = "shard") -> DataFrame:
    """A4: combine per-part summaries (rows of :func:`run_summary` with a
    ``part_key``) - a second-level sum; the merged rate is not rounded."""
    merged = parts.groupBy("scope", "key").agg(*[F.sum(s).alias(s) for s in STATUSES])
    return _finish(merged, rounded=False)


def failure_rate_pct(summary: DataFrame) -> DataFrame:
    """A5: percent of attempted jobs that failed, with the same fallbacks:
    stored rate, else failed / attempted, else 0."""
    attempted = F.when(F.col("attempted") > 0, F.col("attempted")).otherwise(
        F.col("success") + F.col("failed"))
    pct = F.coalesce(100.0 * F.col("failure_rate"),
                     F.try_divide(100.0 * F.col("failed"), F.nullif(attempted, F.lit(0))),
                     F.lit(0.0))
    return summary.withColumn("failure_rate_pct", pct)


def _any_marker(text: Column, markers) -> Column:
    cond = None
    for m in markers:
        c = text.contains(m)
        cond = c if cond is None else cond | c
    return cond


def triage(msg: Column) -> Column:
    """Missing / transient / permanent / other from an error message."""
    t = F.lower(F.coalesce(msg, F.lit("")))
    transient = _any_marker(t, TRANSIENT_MARKERS) & ~_any_marker(t, PERMANENT_MARKERS)
    return (F.when(_any_marker(t, MISSING_MARKERS), "missing")
            .when(transient, "transient")
            .when(_any_marker(t, PERMANENT_MARKERS), "permanent")
            .otherwise("other"))


def first_failures(jobs: DataFrame, order: str = "seq", limit: int = FAILURE_LIST_LIMIT) -> DataFrame:
    """O3: the first ``limit`` failures in a deterministic order
    (TakeOrderedAndProject: each task keeps its own top ``limit``)."""
    f = normalise_outcomes(jobs).where(F.col("status") == "failed")
    return f.orderBy(order).limit(limit).select("ticker", "asset_class", "interval", "message", order)


def catalogue(series: DataFrame, per_group: int = 3, key=("asset_class", "interval"),
              name: str = "ticker") -> DataFrame:
    """O2: up to ``per_group`` series names per (class, interval), by name,
    plus the number of series in the group. The sample is a per-group limit
    (Catalyst inserts a partial WindowGroupLimit before the shuffle, so no
    task holds more than ``per_group`` rows of a group); the count is a
    separate partial aggregate."""
    key = list(key)
    d = series.select(*key, name).distinct()
    w = Window.partitionBy(*key).orderBy(name)
    top = (d.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= per_group)
           .groupBy(*key).agg(F.array_sort(F.collect_list(name)).alias("sample")))
    counts = d.groupBy(*key).agg(F.count(F.lit(1)).alias("series"))
    return top.join(counts, key, "inner")


def summary_document(summary: DataFrame, failures: DataFrame) -> DataFrame:
    """One JSON document per run: counters, per-interval and per-class
    buckets, percent rounded to 4 places, and the (already capped) failure
    list. One global aggregation over the summary rows plus the failure rows;
    both inputs are bounded (buckets per interval/class, <= 100 failures).
    Buckets are sorted by key and failures by sequence, so the document is
    byte-for-byte reproducible."""
    s = failure_rate_pct(summary)
    order = "seq" if "seq" in failures.columns else F.lit(0)
    fail = F.struct(F.col(order) if isinstance(order, str) else order.alias("seq"),
                    "ticker", "asset_class", "interval", "message")
    rows = s.select("scope", "key", *STATUSES, "total", "attempted", "failure_rate",
                    "failure_rate_pct", F.lit(None).cast(failures.select(fail.alias("f")).schema["f"].dataType).alias("f"))
    rows = rows.unionByName(failures.select(F.lit("failure").alias("scope"), fail.alias("f")),
                            allowMissingColumns=True)
    tot = F.col("scope") == "total"
    bucket = F.struct(*STATUSES)

    def total(c):
        return F.max(F.when(tot, F.col(c)))
    doc = rows.agg(
        *[total(c).alias(c) for c in (*STATUSES, "total", "attempted", "failure_rate")],
        F.round(total("failure_rate_pct"), 4).alias("failure_rate_pct"),
        F.map_from_entries(F.array_sort(F.collect_list(
            F.when(F.col("scope") == "interval", F.struct("key", bucket))))).alias("by_interval"),
        F.map_from_entries(F.array_sort(F.collect_list(
            F.when(F.col("scope") == "asset_class", F.struct("key", bucket))))).alias("by_asset_class"),
        F.transform(F.array_sort(F.collect_list("f")), lambda x: x.dropFields("seq")).alias("failures"))
    return doc.select(F.to_json(F.struct(*doc.columns)).alias("summary_json"))
