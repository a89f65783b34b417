"""Publishing snapshots: counts, slices, the no-shrink guard, version
readiness, slice split and the publish plan (A6, P11, J9, A13, I4, I5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.schema import ALL_INTERVALS, FAILED_STATUSES, READY_STATUSES, SLICES
from barforge.session import path_exists
from barforge.sources.store import read_partitioned, write_store


def tree_counts(tree: DataFrame, intervals=None):
    """(per-interval counts at depth >= 3, total). Control files are
    skipped; any extension counts. Without an interval filter the total
    counts files at any depth."""
    data = tree.where(~F.col("control"))
    by_iv = data.where(F.col("depth") >= 3)
    if intervals is not None:
        by_iv = by_iv.where(F.col("interval").isin(*intervals))
    per = by_iv.groupBy("interval").agg(F.count(F.lit(1)).alias("n_files"))
    total_src = data if intervals is None else by_iv
    total = total_src.agg(F.count(F.lit(1)).alias("n_files"))
    return per, total


def slice_files(tree: DataFrame, slice_dim: DataFrame, name: str) -> DataFrame:
    """Files of one slice (semi join on the slice's intervals)."""
    ivs = F.broadcast(slice_dim.where(F.col("slice") == name).select("interval"))
    return tree.where(F.col("depth") >= 3).join(ivs, "interval", "left_semi")


def ignore_patterns(spark: SparkSession, name: str) -> DataFrame:
    """P11 complement: one ``**/<interval>/**`` pattern per known interval
    outside the slice."""
    include = set(SLICES[name]["intervals"])
    known = [iv for iv in (*SLICES["daily"]["intervals"], *SLICES["intraday"]["intervals"])]
    rows = [(iv, f"**/{iv}/**") for iv in known if iv not in include]
    return spark.createDataFrame(rows, "interval string, pattern string")


def publish_guard(previous: DataFrame, current: DataFrame, required, include=None) -> DataFrame:
    """Per interval the pulled (previous) and current file counts, whether
    the interval is required, missing (required with no files) or reduced
    (fewer files than pulled). ``previous`` / ``current``: (interval, n_files)."""
    prev = previous if include is None else previous.where(F.col("interval").isin(*include))
    cur = current if include is None else current.where(F.col("interval").isin(*include))
    req = list(required)
    # each input is referenced once: chained full outer joins on interval
    j = (prev.withColumnRenamed("n_files", "pulled")
         .join(cur.withColumnRenamed("n_files", "current"), "interval", "full"))
    if req:
        req_df = prev.sparkSession.createDataFrame([(r, True) for r in req], "interval string, required boolean")
        j = j.join(req_df, "interval", "full")
    else:
        j = j.withColumn("required", F.lit(False))
    return guard_rows(j)


def guard_counts(counts: DataFrame, required, include=None) -> DataFrame:
    """:func:`publish_guard` over one table (interval, pulled, current)."""
    own = counts if include is None else counts.where(F.col("interval").isin(*include))
    req = counts.sparkSession.createDataFrame([(r, True) for r in required], "interval string, required boolean")
    return guard_rows(own.join(req, "interval", "full"))


def guard_rows(j: DataFrame) -> DataFrame:
    j = j.na.fill(0, ["pulled", "current"]).na.fill(False, ["required"])
    return j.select("interval", "pulled", "current", "required",
                    (F.col("required") & (F.col("current") == 0)).alias("missing"),
                    (F.col("current") < F.col("pulled")).alias("reduced"))


def guard_verdict(per_interval: DataFrame, n_files: DataFrame | None = None) -> DataFrame:
    """J9 verdict (one row): refuse when a required interval is missing,
    any interval shrank, or the total shrank below the pulled total."""
    agg = per_interval.agg(F.sum("pulled").alias("pulled"), F.sum("current").alias("current"),
                           F.bool_or("missing").alias("any_missing"),
                           F.bool_or("reduced").alias("any_reduced"))
    refuse = (F.col("any_missing") | F.col("any_reduced")
              | ((F.col("pulled") > 0) & (F.col("current") < F.col("pulled"))))
    return agg.withColumn("refused", refuse)


def status_name(c) -> F.Column:
    """Enum-ish status text -> upper-case name (``DatasetStatus.READY`` -> READY)."""
    return F.upper(F.substring_index(F.coalesce(c.cast("string"), F.lit("")), ".", -1))


def version_readiness(versions: DataFrame, datasets: DataFrame) -> DataFrame:
    """``versions(dataset, version, status)``, ``datasets(dataset,
    current_version, status)``. Ready iff the dataset status is READY, no
    version is pending, current > 0, and every version in (current, max] has
    failed (FAILED or DELETED); ``next_version`` = max + 1."""
    v = versions.withColumn("st", status_name(F.col("status")))
    failed = F.col("st").isin(*FAILED_STATUSES)
    pending = (F.col("st") != "") & ~F.col("st").isin(*READY_STATUSES) & ~failed
    per = v.groupBy("dataset").agg(
        F.max("version").alias("max_v"),
        F.count_if(pending).alias("n_pending"),
        F.count_if(failed).alias("n_failed"),
        F.collect_set(F.when(failed, F.col("version"))).alias("failed_versions"))
    d = datasets.withColumn("ds_status", status_name(F.col("status"))).join(per, "dataset", "left")
    max_v = F.greatest(F.col("current_version"), F.coalesce("max_v", F.lit(0)))
    gap_free = F.when(F.col("current_version") >= max_v, F.lit(True)).otherwise(
        F.size(F.array_except(F.sequence(F.col("current_version") + 1, max_v),
                              F.coalesce("failed_versions", F.array().cast("array<int>")))) == 0)
    ready = (F.col("ds_status").isin(*READY_STATUSES) & (F.coalesce("n_pending", F.lit(0)) == 0)
             & (F.col("current_version") > 0) & gap_free)
    return d.select("dataset", "current_version", max_v.alias("max_version"),
                    F.coalesce("n_pending", F.lit(0)).alias("n_pending"),
                    F.coalesce("n_failed", F.lit(0)).alias("n_failed"),
                    ready.alias("ready"), (max_v + 1).alias("next_version"))


def split_slices(tree: DataFrame, slice_dim: DataFrame) -> DataFrame:
    """I4: one combined snapshot -> the daily and intraday slices (files of
    known intervals only), tagged by slice. Raises when the source is empty."""
    data = tree.where(~F.col("control") & (F.col("depth") >= 3)
                      & F.col("interval").isin(*ALL_INTERVALS))
    if data.isEmpty():
        raise RuntimeError("No files in the combined snapshot")
    return data.join(F.broadcast(slice_dim.select("slice", "interval")), "interval", "inner")


VERSION_ROW = "dataset string, version int, status string, at timestamp"
MANIFEST_ROW = "dataset string, version int, interval string, n_files bigint"


def remove_refused(spark: SparkSession, root: str) -> list[int]:
    """Delete the data of versions that the log refuses (and no dataset below
    ``root`` published); returns them. The log keeps their rows, so a number is
    never used again, and a crash before the deletion is made up for by the
    next publish."""
    log = spark.read.schema(VERSION_ROW).parquet(f"{root}/versions")
    counts = log.groupBy("version").agg(F.bool_or(F.col("status") == "READY").alias("ready"))
    refused = [r["version"] for r in counts.where("not ready").orderBy("version").collect()]
    removed = []
    for version in refused:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/data/version={version}")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(path) and fs.delete(path, True):
            removed.append(version)
    return removed


def publish_snapshot(spark: SparkSession, bars: DataFrame, root: str, dataset: str,
                     required=(), include=None, allow_shrink: bool = False, partitions: int | None = None) -> dict:
    """I5 write path, write-then-commit: the snapshot is written once to
    ``<root>/data/version=<N+1>`` (partitioned by asset_class / interval), its
    per-interval counts are read back from the written files (partition
    columns and ticker only), guarded against the last published manifest
    (re-based counts), and only then the version log is flipped - READY, or
    REFUSED, in which case readers never see the data and it is deleted. The
    snapshot lineage
    is evaluated exactly once. ``allow_shrink`` excuses fewer files, never a
    missing required interval. ``partitions``: see :func:`store.write_store`.

    Counts are series per interval (one file per series in the published
    layout), so the guard sees what a reader of the slice sees."""
    import datetime as dt
    log_path, man_path = f"{root}/versions", f"{root}/manifest"
    last = top = None
    if path_exists(spark, f"{log_path}/*.parquet"):  # else the first publish; a read error is raised
        log = spark.read.schema(VERSION_ROW).parquet(log_path).where(F.col("dataset") == dataset)
        last = log.where(F.col("status") == "READY").agg(F.max("version")).first()[0]
        top = log.agg(F.max("version")).first()[0]
    version = (top or 0) + 1
    path = f"{root}/data/version={version}"
    write_store(bars, path, partitions=partitions)
    cur = (read_partitioned(spark, path).select("asset_class", "interval", "ticker").distinct()
           .groupBy("interval").agg(F.count(F.lit(1)).alias("n_files")))
    if last is not None:
        prev = (spark.read.schema(MANIFEST_ROW).parquet(man_path).where((F.col("dataset") == dataset) & (F.col("version") == last))
                .select("interval", "n_files"))
    else:
        prev = cur.limit(0)
    verdict = guard_verdict(publish_guard(prev, cur, required, include)).first()
    refused = bool(verdict.any_missing) or (bool(verdict.refused) and not allow_shrink)
    if not refused:
        cur.select(F.lit(dataset).alias("dataset"), F.lit(version).alias("version"), "interval", "n_files") \
            .write.mode("append").parquet(man_path)
    spark.createDataFrame([(dataset, version, "REFUSED" if refused else "READY", dt.datetime.now(dt.timezone.utc))],
                          VERSION_ROW) \
        .write.mode("append").parquet(log_path)
    remove_refused(spark, root)
    return {"version": None if refused else version, "refused": bool(verdict.refused),
            "pulled": verdict.pulled, "current": verdict.current}
