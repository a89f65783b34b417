"""Continuous bar upsert with Structured Streaming.

Staged bar files (each row tagged with its ``src_rank`` and ``seq``) arrive
in a folder. Each micro-batch is merged into the store with the same
precedence rule as the batch merge (greatest (src_rank, seq) wins), pruned to
the retention window, and committed.

Store layout (plain Parquet, partition-level versions):

* ``<root>/data/stream=<s>/v=<N>/asset_class=<c>/interval=<i>/month=<yyyy-MM>/``
  data written by version N of stream s (the seed is stream ``seed``, version 0)
* ``<root>/log/stream=<s>/``  rows (version, asset_class, interval, month, status)
  appended by stream s only (concurrent writers never share an output
  directory); the current data of a partition is the one of its greatest
  logged version (status ``EMPTY`` when the merge left nothing). Concurrent
  streams must touch disjoint partitions (e.g. split by interval).

* ``<root>/series/stream=<s>/v=<N>/``  one row per series of each partition that
  version wrote (bars, first and last time): what counts and manifests need, so
  that they follow from the touched partitions and never from a recount of bars

A micro-batch reads and rewrites only the (asset_class, interval, month)
partitions its rows touch, plus, per intraday interval, the month that
straddles the retention cutoff; months wholly past retention are dropped by
a log entry alone. A daily update of decades of daily bars therefore
rewrites one month, not the series history.

Commits. Data is written first, then one log row per touched partition, under
a version one above the greatest logged one. A crash in between leaves an
unlogged directory that the next batch overwrites. Precedence travels in the
rows and the greatest (src_rank, seq) wins, so merging a batch again - a
replay after a crash, a duplicate delivery, or a new checkpoint over staged
files seen before - changes nothing: batches need no identity, none is ever
skipped, and no row is dropped for being late. The streaming checkpoint lives
in the shared ``spark.checkpoint.dir``. ``vacuum`` removes what no live
partition refers to and shortens the log.
"""

from __future__ import annotations

import datetime as dt
import operator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

from barforge.operators.bars import packed_rank, prune_retention
from barforge.schema import SERIES_KEY
from barforge.session import path_exists

PAYLOAD = ["open", "high", "low", "close", "adj_close", "volume"]
OPTIONAL = ["dividends", "stock_splits"]
DATA_SCHEMA = ("ticker string, ts timestamp, open double, high double, low double, close double, adj_close double, "
               "volume bigint, dividends double, stock_splits double, src_rank int, seq bigint, "
               "stream string, v int, asset_class string, interval string, month string")
PART = ["asset_class", "interval", "month"]
FILE_ORDER = [*PART, "ticker", "ts"]
LOG_ROW = "version int, asset_class string, interval string, month string, status string"
DIGEST_ROW = "asset_class string, interval string, month string, ticker string, bars long, first_ts timestamp, last_ts timestamp"
LOG_SCHEMA = LOG_ROW + ", stream string"  # stream = the log/stream=<name> directory


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _part_dir(spark: SparkSession, **values) -> str:
    """``name=value/...`` as Spark's writer names partition directories: values
    with characters such as ``:`` or ``%`` are escaped there."""
    named = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    return "/".join(named(k, None if v is None else str(v)) for k, v in values.items())


def _part_values(spark: SparkSession, path: str) -> dict[str, str | None]:
    """The partition values of a directory, unescaped."""
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    named = (p.split("=", 1) for p in path.split("/") if "=" in p)
    return {k: None if v == NO_VALUE else unescape(v) for k, v in named}


def _glob(path: str) -> str:
    """A path as a glob that matches it alone."""
    return "".join(f"\\{c}" if c in "\\*?[]{},^" else c for c in path)


def bar_columns(bars: DataFrame) -> DataFrame:
    """The store's columns in order and type; absent optional ones are null."""
    cols = {c: F.col(c) if c in bars.columns else F.lit(None) for c in (*PAYLOAD, *OPTIONAL)}
    return bars.select(*SERIES_KEY, F.col("ts").cast("timestamp").alias("ts"),
                       *[c.cast("bigint" if n == "volume" else "double").alias(n) for n, c in cols.items()],
                       F.col("src_rank").cast("int").alias("src_rank"), F.col("seq").cast("bigint").alias("seq"))


def month_of(ts) -> F.Column:
    """The store's time partition of a bar: its UTC calendar month."""
    return F.date_format(ts, "yyyy-MM")


def laid_out(bars: DataFrame) -> DataFrame:
    """Bars with their ``month``, in ranges of the store's file order."""
    return bars.withColumn("month", month_of(F.col("ts"))).repartitionByRange(*FILE_ORDER)


def merge_ranked(store: DataFrame | None, batch: DataFrame, key=SERIES_KEY) -> DataFrame:
    """Greatest (src_rank, seq) per (series, ts) over store + batch rows - the
    batch's row where they are equal - laid out for :func:`commit`. The rows
    travel once, as they are, into the ranges they are written in; one sort
    there serves the choice of the winner and the files' order."""
    u = bar_columns(batch).withColumn("_late", F.lit(True))
    if store is not None:
        u = bar_columns(store).withColumn("_late", F.lit(False)).unionByName(u)
    newest = (Window.partitionBy(*dict.fromkeys([*PART, *key, "ts"]))
              .orderBy(packed_rank(F.col("src_rank"), F.col("seq")).desc(), F.col("_late").desc()))
    return laid_out(u).withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") == 1).drop("_rn", "_late")


def _month_bounds(month: str) -> tuple[dt.datetime, dt.datetime]:
    y, m = (int(x) for x in month.split("-"))
    start = dt.datetime(y, m, 1, tzinfo=dt.timezone.utc)
    end = dt.datetime(y + (m == 12), m % 12 + 1, 1, tzinfo=dt.timezone.utc)
    return start, end


def retention_months(live, as_of: dt.datetime):
    """Split live intraday partitions into (expired, straddling) months for
    ``as_of``: expired months hold only bars older than the retention cutoff
    (dropped by a log entry), the straddling month is re-pruned."""
    from barforge.operators.bars import retention_cutoffs
    cut = retention_cutoffs(as_of)
    expired, straddling = set(), set()
    for c, i, m, *_ in live:
        if i not in cut:
            continue
        start, end = _month_bounds(m)
        if end <= cut[i]:
            expired.add((c, i, m))
        elif start < cut[i]:
            straddling.add((c, i, m))
    return expired, straddling


def _log(spark: SparkSession, root: str) -> DataFrame | None:
    """The commit log; None when nothing is committed yet. Any other failure to
    read it is raised: an unreadable store must not pass for an empty one."""
    if not path_exists(spark, f"{root}/log/stream=*/*.parquet"):
        return None
    return spark.read.schema(LOG_SCHEMA).parquet(f"{root}/log")


def latest_version(spark: SparkSession, root: str, stream: str | None = None) -> int | None:
    log = _log(spark, root)
    if log is None:
        return None
    if stream is not None:
        log = log.where(F.col("stream") == stream)
    return log.agg(F.max("version")).first()[0]


def current_partitions(spark: SparkSession, root: str, touched=None) -> list[tuple]:
    """(asset_class, interval, month, version, stream) of the live data of each
    partition (optionally only ``touched`` ones). One row per partition -
    metadata."""
    log = _log(spark, root)
    if log is None:
        return []
    if touched is not None:
        if not touched:
            return []
        keys = spark.createDataFrame(list(touched), "asset_class string, interval string, month string")
        log = log.join(keys, PART, "left_semi")
    w = Window.partitionBy(*PART).orderBy(F.col("version").desc())
    cur = log.withColumn("_rn", F.row_number().over(w)).where((F.col("_rn") == 1) & (F.col("status") == "READY"))
    return [tuple(r) for r in cur.select(*PART, "version", "stream").collect()]


def read_current(spark: SparkSession, root: str, touched=None) -> DataFrame | None:
    parts = current_partitions(spark, root, touched)
    if not parts:
        return None
    paths = [_glob(f"{root}/data/" + _part_dir(spark, stream=s, v=v, asset_class=c, interval=i, month=m)) for c, i, m, v, s in parts]
    # explicit schema: an interval such as 1d must not be inferred as a number
    return spark.read.schema(DATA_SCHEMA).option("basePath", f"{root}/data").parquet(*paths).drop("stream", "v", "month")


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame | None:
    """The live store (``version`` is accepted for symmetry; the log decides)."""
    return read_current(spark, root)


def live_series(spark: SparkSession, root: str) -> DataFrame:
    """One row per series of the live store: asset_class, interval, ticker, bars,
    first_ts, last_ts, from the digests of the live partitions."""
    live = spark.createDataFrame(current_partitions(spark, root), "asset_class string, interval string, month string, v int, stream string")
    if not path_exists(spark, f"{root}/series/stream=*/v=*/*.parquet"):
        return spark.createDataFrame([], DIGEST_ROW).drop("month")
    digests = spark.read.schema(DIGEST_ROW + ", stream string, v int").option("basePath", f"{root}/series").parquet(f"{root}/series")
    same = [digests[c].eqNullSafe(live[c]) for c in (*PART, "v", "stream")]
    kept = digests.join(live, reduce(operator.and_, same), "left_semi")
    return kept.groupBy(*SERIES_KEY).agg(F.sum("bars").alias("bars"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))


def series_counts(spark: SparkSession, root: str) -> DataFrame:
    """A6 / I5 on the live store: series and bars per interval, kept current by
    each micro-batch (no bar is read)."""
    return live_series(spark, root).groupBy("interval").agg(F.count(F.lit(1)).alias("series"), F.sum("bars").alias("bars"))


def live_manifest(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """S15 on the live store: series per interval under the latest version."""
    return series_counts(spark, root).select(F.lit(dataset).alias("dataset"), F.lit(latest_version(spark, root)).alias("version"),
                                             "interval", F.col("series").alias("n_files"))


def commit(spark: SparkSession, root: str, bars: DataFrame, version: int, touched,
           stream: str = "main") -> None:
    """Write the new data of the ``touched`` partitions as ``version`` of
    ``stream`` and log them; partitions left empty are logged as EMPTY. Bars
    that carry ``month`` are taken as :func:`laid_out`."""
    path = f"{root}/data/{_part_dir(spark, stream=stream, v=version)}"
    ((bars if "month" in bars.columns else laid_out(bars))
     .sortWithinPartitions(*FILE_ORDER)
     .write.mode("overwrite").partitionBy(*PART).parquet(path))
    written = spark.read.schema(DATA_SCHEMA).option("basePath", f"{root}/data").parquet(_glob(path))
    digest = written.groupBy(*PART, "ticker").agg(F.count(F.lit(1)).alias("bars"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    own = f"{root}/series/{_part_dir(spark, stream=stream, v=version)}"
    digest.write.mode("overwrite").parquet(own)
    present = {tuple(r) for r in spark.read.schema(DIGEST_ROW).parquet(_glob(own)).select(*PART).distinct().collect()}
    rows = [(version, c, i, m, "READY" if (c, i, m) in present else "EMPTY") for c, i, m in touched]
    if rows:
        spark.createDataFrame(rows, LOG_ROW).write.mode("append").parquet(f"{root}/log/{_part_dir(spark, stream=stream)}")


def seed_store(spark: SparkSession, root: str, bars: DataFrame) -> None:
    """Version 0 of the store (rows must carry src_rank and seq)."""
    data = bar_columns(bars)
    touched = [tuple(r) for r in data.select("asset_class", "interval", month_of(F.col("ts")).alias("month"))
               .distinct().collect()]
    commit(spark, root, data, 0, touched, "seed")


def upsert_batch_fn(root: str, as_of: dt.datetime, key=SERIES_KEY, stream: str = "main"):
    """The ``foreachBatch`` function. It always consumes its batch, once (the
    batch is kept while its partitions are looked up and merged)."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            touched = {tuple(r) for r in batch.select("asset_class", "interval", month_of(F.col("ts")).alias("month"))
                       .distinct().collect()}
            if not touched:
                return
            version = (latest_version(spark, root) or 0) + 1
            expired, straddling = retention_months(current_partitions(spark, root), as_of)
            groups = {(c, i) for c, i, _ in touched}
            straddling = {p for p in straddling if (p[0], p[1]) in groups}
            expired = {p for p in expired if (p[0], p[1]) in groups}
            store = read_current(spark, root, (touched | straddling) - expired)
            merged = prune_retention(merge_ranked(store, batch, key), as_of)
            commit(spark, root, merged, version, sorted(touched | straddling | expired), stream)
        finally:
            batch.unpersist()
    return fn


def start_upsert(spark: SparkSession, staged_dir: str, schema, root: str, checkpoint: str,
                 as_of: dt.datetime, files_per_batch: int = 1, intervals=None, stream: str = "main"):
    """Start the upsert stream; ``trigger(availableNow=True)`` drains what is
    staged and stops (a scheduled job); drop the trigger to run continuously.

    The stream keeps no state: duplicates and late rows are settled by the
    merge itself, however late they are. ``intervals`` splits the work into
    streams that touch disjoint partitions (each with its own checkpoint and
    ``stream`` name)."""
    rows = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
            .parquet(staged_dir))
    if intervals is not None:
        rows = rows.where(F.col("interval").isin(*intervals))
    return (rows.writeStream.foreachBatch(upsert_batch_fn(root, as_of, stream=stream))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def vacuum(spark: SparkSession, root: str) -> int:
    """Delete data directories of versions that no live partition refers to and
    replace the log by one row per partition. Run it while no stream writes and
    no reader holds an older version. Returns the number of partition
    directories removed."""
    log = _log(spark, root)
    if log is None:
        return 0
    w = Window.partitionBy(*PART).orderBy(F.col("version").desc())
    newest = log.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")
    rows = [tuple(r) for r in newest.select("version", *PART, "status", "stream").collect()]
    live = {(s, v, c, i, m) for v, c, i, m, status, s in rows if status == "READY"}
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    removed = 0
    found_root = fs.getFileStatus(hadoop.Path(root)).getPath().toString()
    for found in fs.globStatus(hadoop.Path(f"{root}/data/stream=*/v=*/asset_class=*/interval=*/month=*")) or []:
        path = found.getPath()
        parts = _part_values(spark, path.toString()[len(found_root):])
        if (parts["stream"], int(parts["v"]), parts["asset_class"], parts["interval"], parts["month"]) not in live:
            fs.delete(path, True)
            removed += 1
    versions = {(s, v) for s, v, *_ in live}
    for found in fs.globStatus(hadoop.Path(f"{root}/series/stream=*/v=*")) or []:
        parts = _part_values(spark, found.getPath().toString()[len(found_root):])
        if (parts["stream"], int(parts["v"])) not in versions:
            fs.delete(found.getPath(), True)
    # the short log is complete before the long one goes; versions keep their numbers
    old = [f.getPath() for f in fs.globStatus(hadoop.Path(f"{root}/log/stream=*/*")) or []]
    for s in sorted({r[5] for r in rows}):
        own = [r[:5] for r in rows if r[5] == s]
        spark.createDataFrame(own, LOG_ROW).coalesce(1).write.mode("append").parquet(f"{root}/log/{_part_dir(spark, stream=s)}")
    for path in old:
        fs.delete(path, False)
    return removed
