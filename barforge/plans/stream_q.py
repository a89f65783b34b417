"""Registered streaming queries (I2, I6 as a stream) and the sort operator (O1)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from barforge.plans import sqlparts as Q
from barforge.plans.listing_q import _LISTED, _listed
from barforge.plans.merge_q import _A2_ROWS, AS_OF
from barforge.plans.registry import register
from barforge.schema import SERIES_KEY
from barforge.session import checkpoint_dir
from barforge.sources import derived as D
from barforge.streaming import upsert as U


@register("i2_stream_upsert", Q.with_(*_A2_ROWS) + f"""
SELECT {Q.SERIES}, ts, open, high, low, close, volume FROM merged""")
def i2_stream_upsert(spark, sf):
    """The streamed store equals the batch merge (A2)."""
    out = U.read_version(spark, _streamed_store(spark, sf))
    return out.select(*SERIES_KEY, "ts", "open", "high", "low", "close", "volume")


@register("a6_live_series_counts", Q.with_(*_A2_ROWS) + """
SELECT interval, count(DISTINCT asset_class || '|' || ticker) AS series, count(*) AS bars FROM merged GROUP BY interval""")
def a6_live_series_counts(spark, sf):
    """Series and bars per interval of the streamed store, from its digests."""
    return U.series_counts(spark, _streamed_store(spark, sf))


def _streamed_store(spark, sf) -> str:
    """Stored bars seed the store; fresh and legacy files are staged and
    streamed in over several micro-batches, a duplicate delivery included."""
    base = f"{checkpoint_dir(spark).rstrip('/')}/i2-{uuid.uuid4().hex}"
    s = D.intraday_sources(spark, sf)
    stored = s["stored"].withColumn("src_rank", F.lit(1)).withColumn("seq", F.lit(0).cast("bigint"))
    fresh = s["fresh"].withColumn("src_rank", F.lit(0)).withColumn("seq", F.lit(0).cast("bigint"))
    legacy = s["legacy"].withColumn("src_rank", F.lit(2)).withColumn(
        "seq", F.unix_date("day").cast("bigint"))
    U.seed_store(spark, f"{base}/store", U.bar_columns(stored))
    staged = f"{base}/staged"
    deliveries = (fresh, legacy, fresh)
    for part in deliveries:  # the second fresh delivery is a duplicate
        U.bar_columns(part).write.mode("append").parquet(staged)
    schema = U.bar_columns(fresh).schema
    # several micro-batches, each a merge of the partitions it touches: as many at any size
    files = -(-len(spark.read.parquet(staged).inputFiles()) // len(deliveries))
    q = U.start_upsert(spark, staged, schema, f"{base}/store", f"{base}/checkpoint", AS_OF, files_per_batch=files)
    q.awaitTermination()
    return f"{base}/store"


@register("o1_sorted_symbols", Q.with_(*_LISTED) + """
SELECT asset_class, symbol FROM listed ORDER BY asset_class, symbol""")
def o1_sorted_symbols(spark, sf):
    """Sort at the sink only: binary (code-point) order of the symbols."""
    return _listed(spark, sf).select("asset_class", "symbol").orderBy("asset_class", "symbol")


@register("i6_stream_bars", Q.with_(Q.TICKS, Q.bars_from_ticks(["15m"], "b15")) + f"""
SELECT {Q.SERIES}, ts, open, high, low, close, volume, n_ticks, true AS final FROM b15""")
def i6_stream_bars(spark, sf):
    """Ticks streamed into 15-minute bars over several micro-batches of files in
    time order; the bars still open when the staged files are drained are
    flushed. Every tick is in its bar."""
    from barforge.streaming import bars as SB
    base = f"{checkpoint_dir(spark).rstrip('/')}/i6s-{uuid.uuid4().hex}"
    t = D.ticks(spark, sf).select("asset_class", "ticker", "ts", "price", "size", "seq")
    files = 2 * spark.sparkContext.defaultParallelism
    t.repartitionByRange(files, "ts").sortWithinPartitions("ts", "seq").write.parquet(f"{base}/staged")
    SB.start_bar_updates(spark, f"{base}/staged", t.schema, f"{base}/bars", f"{base}/ckpt", "15m",
                         files_per_batch=-(-files // 4)).awaitTermination()
    out = SB.read_bar_updates(spark, f"{base}/bars", "15m", drained=True)
    return out.select(*SERIES_KEY, "ts", "open", "high", "low", "close", "volume", "n_ticks", "final")
