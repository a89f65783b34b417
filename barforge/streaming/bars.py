"""I6 on a stream: ticks -> bars with event-time windows and a watermark.

A bar is emitted once, in append mode, when the watermark (the greatest
event time seen minus the allowed lateness) passes the end of its window;
late ticks inside the lateness still update the open bar, later ones are
dropped by Spark. Windows are aligned like the batch bars: minute and 5-day
bars to the Unix epoch, weekly bars to Monday (the epoch is a Thursday).

In update mode (:func:`start_bar_updates`) bars are current after every batch,
late ticks go into their bars and a side table, and nothing is dropped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.operators.bars import bar_end, bar_start, tick_order
from barforge.schema import INTRADAY_MINUTES
from barforge.session import path_exists

_FIXED = {"1d": ("1 day", None), "5d": ("5 days", None), "1wk": ("7 days", "4 days")}


def window_spec(interval: str) -> tuple[str, str | None]:
    if interval in INTRADAY_MINUTES:
        return f"{INTRADAY_MINUTES[interval]} minutes", None
    if interval in _FIXED:
        return _FIXED[interval]
    raise ValueError(f"interval {interval!r} has no fixed width; stream bars support "
                     f"{sorted(INTRADAY_MINUTES)} and {sorted(_FIXED)}")


def stream_bars(ticks: DataFrame, interval: str, lateness: str = "5 minutes",
                key=("asset_class", "ticker")) -> DataFrame:
    """Streaming OHLCV bars of one ``interval`` from ``ticks(key..., ts,
    price, size, seq)``; open / close are the first / last tick by (ts, seq)."""
    key = list(key)
    width, start = window_spec(interval)
    w = F.window("ts", width, width, start) if start else F.window("ts", width)
    t = ticks.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    order = F.struct("ts", "seq")
    g = t.groupBy(*key, w.alias("w")).agg(
        F.min_by("price", order).alias("open"), F.max("price").alias("high"),
        F.min("price").alias("low"), F.max_by("price", order).alias("close"),
        F.sum("size").cast("bigint").alias("volume"), F.count(F.lit(1)).alias("n_ticks"))
    return g.select(*key[:1], F.lit(interval).alias("interval"), *key[1:], F.col("w.start").alias("ts"),
                    "open", "high", "low", "close", "volume", "n_ticks")


def start_bar_stream(spark, staged_dir: str, schema, out_dir: str, checkpoint: str,
                     interval: str, lateness: str = "5 minutes", files_per_batch: int = 1):
    """Run :func:`stream_bars` from a folder of tick files into Parquet (the
    file sink is exactly-once with its checkpoint); ``availableNow`` drains
    what is staged and stops."""
    ticks = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(staged_dir)
    return (stream_bars(ticks, interval, lateness).writeStream.format("parquet")
            .option("path", out_dir).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start())


# ---------------------------------------------------------------------------
# Update mode: bars from many micro-batches, with no tick lost.
# ---------------------------------------------------------------------------
_PARTIAL = ["open", "open_at", "high", "low", "close", "close_at", "volume", "n_ticks"]


def partial_bars(ticks: DataFrame, interval: str, key=("asset_class", "ticker")) -> DataFrame:
    """Bars of some of their ticks, in a form that merges: the first and last
    price carry the place of their tick."""
    key = list(key)
    start = bar_start("ts", interval)
    order = tick_order(F.col("ts"), F.col("bar"), F.col("seq"))
    return ticks.withColumn("bar", start).groupBy(*key, "bar").agg(
        F.min_by("price", order).alias("open"), F.min(order).alias("open_at"), F.max("price").alias("high"), F.min("price").alias("low"),
        F.max_by("price", order).alias("close"), F.max(order).alias("close_at"),
        F.sum("size").cast("bigint").alias("volume"), F.count(F.lit(1)).alias("n_ticks"))


def merged_partials(parts: DataFrame, key=("asset_class", "ticker")) -> DataFrame:
    """One row per bar from its partial rows, whatever the batches they came in."""
    return parts.groupBy(*key, "bar").agg(
        F.min_by("open", "open_at").alias("open"), F.min("open_at").alias("open_at"), F.max("high").alias("high"), F.min("low").alias("low"),
        F.max_by("close", "close_at").alias("close"), F.max("close_at").alias("close_at"),
        F.sum("volume").cast("bigint").alias("volume"), F.sum("n_ticks").cast("bigint").alias("n_ticks"))


def _marks(spark: SparkSession, root: str) -> DataFrame | None:
    if not path_exists(spark, f"{root}/marks/batch=*/*.parquet"):
        return None
    return spark.read.schema("latest timestamp, batch long").parquet(f"{root}/marks")


def update_batch_fn(root: str, interval: str, lateness_minutes: int = 5, key=("asset_class", "ticker")):
    """The ``foreachBatch`` function of :func:`start_bar_updates`. A batch writes
    its partial bars, its late ticks and its latest time, each under its number
    and over what an earlier attempt left there, so a replay changes nothing."""
    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = _marks(spark, root)
        # the watermark that earlier batches set; this one's ticks do not move it
        mark = None if marks is None else marks.where(F.col("batch") < batch_id).agg(F.max("latest")).first()[0]
        partial_bars(batch, interval, key).write.mode("overwrite").parquet(f"{root}/partials/batch={batch_id}")
        closed = F.lit(False) if mark is None else (
            F.col("bar_end") <= F.lit(mark) - F.make_dt_interval(mins=F.lit(lateness_minutes)))
        late = batch.withColumn("bar_end", bar_end("ts", interval)).where(closed).drop("bar_end")
        late.write.mode("overwrite").parquet(f"{root}/late/batch={batch_id}")
        # the mark goes last: a batch without one has not been counted anywhere
        batch.agg(F.max("ts").alias("latest")).write.mode("overwrite").parquet(f"{root}/marks/batch={batch_id}")
    return fn


def start_bar_updates(spark: SparkSession, staged_dir: str, schema, root: str, checkpoint: str, interval: str,
                      lateness_minutes: int = 5, files_per_batch: int = 1, key=("asset_class", "ticker")):
    """Bars of ``interval`` from a folder of tick files over many micro-batches.

    Each batch is reduced to partial bars that merge in any order, so nothing is
    dropped for being late and no state outlives a batch but the tables below
    ``root``: ``partials`` (bars by batch), ``late`` (ticks of bars that the
    watermark had closed before they came) and ``marks`` (each batch's latest
    time). :func:`read_bar_updates` gives the bars, :func:`compact` shortens the
    tables. ``availableNow`` drains what is staged and stops."""
    ticks = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(staged_dir)
    return (ticks.writeStream.foreachBatch(update_batch_fn(root, interval, lateness_minutes, key))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def _partials(spark: SparkSession, root: str, key) -> DataFrame | None:
    kinds = {"open_at": "decimal(38,0)", "close_at": "decimal(38,0)", "volume": "long", "n_ticks": "long"}
    schema = ", ".join([*(f"{k} string" for k in key), "bar timestamp", *(f"{c} {kinds.get(c, 'double')}" for c in _PARTIAL), "batch long"])
    parts = []
    upto = -1
    if path_exists(spark, f"{root}/compacted/batch=*/*.parquet"):
        merged = spark.read.schema(schema).parquet(f"{root}/compacted")
        upto = merged.agg(F.max("batch")).first()[0]
        upto = -1 if upto is None else upto
        parts.append(merged.where(F.col("batch") == upto))
    if path_exists(spark, f"{root}/partials/batch=*/*.parquet"):
        parts.append(spark.read.schema(schema).parquet(f"{root}/partials").where(F.col("batch") > upto))
    return reduce(DataFrame.unionByName, parts) if parts else None


def read_bar_updates(spark: SparkSession, root: str, interval: str, lateness_minutes: int = 5,
                     drained: bool = False, key=("asset_class", "ticker")) -> DataFrame | None:
    """The bars of all batches so far, each with ``final``: whether the watermark
    has passed its end. With ``drained`` (no more ticks will come) open bars are
    flushed as final too. None before the first batch."""
    parts, marks = _partials(spark, root, key), _marks(spark, root)
    if parts is None or marks is None:
        return None
    mark = marks.agg(F.max("latest")).first()[0]
    closed = F.lit(drained) if mark is None else F.lit(drained) | (
        bar_end("bar", interval) <= F.lit(mark) - F.make_dt_interval(mins=F.lit(lateness_minutes)))
    bars = merged_partials(parts, key)
    return bars.select(*list(key)[:1], F.lit(interval).alias("interval"), *list(key)[1:], F.col("bar").alias("ts"),
                       "open", "high", "low", "close", "volume", "n_ticks", closed.alias("final"))


def read_late_ticks(spark: SparkSession, root: str, schema) -> DataFrame | None:
    """The late ticks of all batches (they are part of their bars as well)."""
    if not path_exists(spark, f"{root}/late/batch=*/*.parquet"):
        return None
    return spark.read.schema(schema).parquet(f"{root}/late")


def compact(spark: SparkSession, root: str, key=("asset_class", "ticker")) -> int | None:
    """Merge the partial rows of all marked batches into one table; readers then
    skip those batches. Returns the last batch merged. Run it between batches."""
    marks, parts = _marks(spark, root), _partials(spark, root, key)
    upto = None if marks is None else marks.agg(F.max("batch")).first()[0]
    if upto is None or parts is None:
        return None
    merged_partials(parts.where(F.col("batch") <= upto), key).write.mode("overwrite").parquet(f"{root}/compacted/batch={upto}")
    return upto
