"""Refresh planning as set operations.

The reference walks a ticker list in a thread pool; here the whole run is a
handful of joins over the universe, the stored series and the staged loads.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.operators.merge import trusted_last_ts
from barforge.schema import CUMULATIVE_INTERVALS, RETENTION_DAYS, SERIES_KEY
from barforge.session import stored_table

# Job outcome messages
MSG_UNSUPPORTED = "unsupported interval '%s'"
MSG_EXISTS = "skipped (exists)"
MSG_EMPTY_WINDOW = "No %s data (illiquid, halted, or unsupported)"
MSG_EMPTY_FULL = "No %s data returned"
MSG_LOADED = "%d row(s) loaded"


def work_plan(universe: DataFrame, intervals) -> DataFrame:
    """Every (asset_class, ticker) x requested interval. The interval list
    is a literal array exploded per row - a generator, not a cross join."""
    return universe.withColumn("interval", F.explode(F.array(*[F.lit(i) for i in intervals])))


def refresh_plan(plan: DataFrame, stored: DataFrame, key=SERIES_KEY,
                 skip_existing: bool = False) -> DataFrame:
    """How each planned series is loaded (``mode``) and from when:

    * intraday intervals - ``window``: the whole retention window, always;
    * cumulative intervals - ``incremental`` from the day before the last
      stored bar when the stored history is trusted (P13), else ``full``;
    * anything else - ``unsupported``;
    * with ``skip_existing``: ``exists`` for a cumulative series with trusted
      history or an intraday series with any stored bar (nothing is loaded).
    """
    t = trusted_last_ts(stored, key)
    j = plan.join(t, list(key), "left")
    iv = F.col("interval")
    intraday = iv.isin(*RETENTION_DAYS)
    cumulative = iv.isin(*CUMULATIVE_INTERVALS)
    exists = (cumulative & F.col("last_ts").isNotNull()) | (intraday & (F.coalesce("stored_rows", F.lit(0)) > 0))
    mode = F.when(~(intraday | cumulative), "unsupported")
    if skip_existing:
        mode = mode.when(exists, "exists")
    mode = mode.when(intraday, "window").when(F.col("last_ts").isNull(), "full").otherwise("incremental")
    return (j.withColumn("mode", mode)
            .withColumn("start", F.when(F.col("mode") == "incremental", F.date_sub(F.to_date("last_ts"), 1)))
            .drop("last_ts", "stored_rows"))


def staged_load(rp: DataFrame, staged: DataFrame, key=SERIES_KEY) -> DataFrame:
    """Rows of the staged download each planned series would load: all of
    them for a full load, those at or after ``start`` (a day) otherwise.

    Staged rows are first reduced to counts per (series, day) - a partial
    aggregation, so a hot series is combined map-side - and only those
    counts meet the plan in the join; the raw rows are never shuffled to the
    task of their series."""
    key = list(key)
    daily = (staged.groupBy(*key, F.to_date("ts").alias("d"))
             .agg(F.count(F.lit(1)).alias("n")))
    r, s = rp.alias("r"), daily.alias("s")
    cond = [F.col(f"r.{k}") == F.col(f"s.{k}") for k in key]
    cond.append(F.col("r.start").isNull() | (F.col("s.d") >= F.col("r.start")))
    j = r.join(s, cond, "left")
    return (j.groupBy(*[F.col(f"r.{k}").alias(k) for k in key], F.col("r.mode").alias("mode"),
                      F.col("r.start").alias("start"))
            .agg(F.coalesce(F.sum(F.col("s.n")), F.lit(0)).cast("bigint").alias("loaded_rows")))


def resume(plan: DataFrame, done: DataFrame, key=SERIES_KEY):
    """(remaining, skipped) - planned work minus work already stored."""
    key = list(key)
    return plan.join(done, key, "left_anti"), plan.join(done, key, "left_semi")


def first_available(candidates: DataFrame, available: DataFrame,
                    key=("asset_class", "ticker", "interval"), group=(), priority="priority"):
    """The highest-priority candidate that exists in ``available``."""
    ok = candidates.join(available.select(*key).distinct(), list(key), "left_semi")
    return ok.groupBy(*group).agg(F.min_by(F.struct(*key), F.col(priority)).alias("pick")) \
        .select(*group, *[F.col(f"pick.{k}").alias(k) for k in key if k not in group])


def period_fallback(responses: DataFrame, key=("asset_class", "ticker", "interval"),
                    rank: str = "period_rank") -> DataFrame:
    """Keep the rows of the first non-empty response window in fallback
    order per series. The per-series minimum is a partial aggregate (a hot
    series is combined map-side) and the rows are kept by a semi join on
    (series, rank) - AQE can split a skewed left side, and turns the small
    side into a broadcast only after measuring it."""
    key = list(key)
    best = responses.groupBy(*key).agg(F.min(rank).alias(rank))
    return responses.join(best, [*key, rank], "left_semi")


#: Partitions whose counts are summed together in :func:`positions`.
PREFIX_BLOCK = 128


def positions(df: DataFrame, group, order, out: str = "pos", partitions: int | None = None) -> DataFrame:
    """0-based row number of each row within ``group`` by ``order``, without
    putting a whole group into one task: rows are range-partitioned on
    (group, order), numbered inside each (partition, group) cell, and shifted
    by the sizes of the same group's cells in earlier partitions. That shift is
    a two-level prefix sum over a table of one row per partition and group:
    partitions are summed in blocks, and only the blocks' sums of a group meet
    in one row. A group larger than a partition is thus spread over several
    tasks, and no window spans a whole group.

    The partitioned rows are written once with their partition id and their
    place in the cell; counts and rows are both read from that table. Computing
    the exchange twice would sample its bounds twice and give two different
    partitionings."""
    group, order = list(group), list(order)
    local = Window.partitionBy("_pid", *group).orderBy(*order)
    placed = (df.repartitionByRange(*([partitions] if partitions else []), *group, *order)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_local", F.row_number().over(local) - 1))
    placed = stored_table(placed, "positions")
    cells = (placed.groupBy("_pid", *group).agg(F.count(F.lit(1)).alias("_n"))
             .withColumn("_block", F.expr(f"_pid div {PREFIX_BLOCK}")))
    within = Window.partitionBy("_block", *group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_before", F.coalesce(F.sum("_n").over(within), F.lit(0)))
    sums = cells.groupBy(*group, "_block").agg(F.sum("_n").alias("_n"))
    sums = sums.groupBy(*group).agg(F.sort_array(F.collect_list(F.struct("_block", "_n"))).alias("_sums"))
    shifts = sums.select(*(F.col(g).alias(f"_sum_{g}") for g in group), F.explode(F.transform("_sums", lambda x, i: F.struct(
        x["_block"].alias("block"), F.aggregate(F.slice("_sums", F.lit(1), i), F.lit(0).cast("bigint"),
                                                lambda t, y: t + y["_n"]).alias("shift")))).alias("_s"))
    same = F.col("_block") == F.col("_s.block")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_sum_{g}"))
    offsets = cells.join(shifts, same).select("_pid", *group, (F.col("_before") + F.col("_s.shift")).alias("_off"))
    offsets = offsets.withColumnsRenamed({"_pid": "_cell", **{g: f"_of_{g}" for g in group}})
    cond = F.col("_pid") == F.col("_cell")
    for g in group:  # a null group is a group as well
        cond = cond & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    return placed.join(offsets, cond).select(
        *df.columns, (F.col("_off") + F.col("_local")).cast("bigint").alias(out))


def stable_shards(universe: DataFrame, shard_count: int, shard_index: int | None = None,
                  cls: str = "asset_class", sym: str = "ticker") -> DataFrame:
    """shard = rank of the symbol among the class's sorted distinct
    symbols modulo ``shard_count``; with one shard, list order and duplicates
    are kept. Validates 1 <= count and 0 <= index < count."""
    if shard_count < 1:
        raise ValueError(f"shard_count must be >= 1, got {shard_count}")
    if shard_index is not None and not 0 <= shard_index < shard_count:
        raise ValueError(f"shard_index must be in [0, {shard_count}), got {shard_index}")
    if shard_count == 1:
        out = universe.withColumn("shard", F.lit(0))
    else:
        d = positions(universe.select(cls, sym).distinct(), [cls], [sym], "_rank")
        out = d.withColumn("shard", (F.col("_rank") % shard_count).cast("int")).drop("_rank")
    return out if shard_index is None else out.where(F.col("shard") == shard_index)


def distinct_requests(plan: DataFrame, req=("ticker", "interval", "start", "period")):
    """Identical requests across classes are served once: (unique
    requests, plan rows with their request id). The id is the rank of the
    request among all distinct ones; plan rows get it by a null-safe join on
    the request's own columns, so two requests never share an id."""
    req = list(req)
    uniq = positions(plan.select(*req).distinct(), [], req, "request_id")
    named = uniq.withColumnsRenamed({c: f"_req_{c}" for c in req})
    cond = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_req_{c}")) for c in req])
    return uniq, plan.join(named, cond, "left").select(*plan.columns, "request_id")


def job_outcomes(loaded: DataFrame, errors: DataFrame, supported=None, key=SERIES_KEY) -> DataFrame:
    """One result per planned (series, interval) from the load counts
    (``mode``, ``loaded_rows``; see :func:`refresh_plan`, :func:`staged_load`)
    and load errors. A failing series never affects the others:

    * unsupported interval -> skipped;
    * ``exists`` (skip_existing hit) -> success, not skipped;
    * a load error -> failed with its message;
    * an empty full cumulative load or an empty intraday window -> failed;
    * otherwise success (an empty incremental load is a success with 0 rows).
    """
    key = list(key)
    j = loaded.join(errors, key, "left")
    mode, n, iv = F.col("mode"), F.col("loaded_rows"), F.col("interval")
    unsupported = mode == "unsupported"
    if supported is not None:
        unsupported = unsupported | ~iv.isin(*supported)
    empty_window = (n == 0) & (mode == "window")
    empty_full = (n == 0) & (mode == "full")
    status = (F.when(unsupported, "skipped").when(mode == "exists", "success")
              .when(F.col("error").isNotNull(), "failed")
              .when(empty_window | empty_full, "failed").otherwise("success"))
    message = (F.when(unsupported, F.format_string(MSG_UNSUPPORTED, iv))
               .when(mode == "exists", F.lit(MSG_EXISTS))
               .when(F.col("error").isNotNull(), F.col("error"))
               .when(empty_window, F.format_string(MSG_EMPTY_WINDOW, iv))
               .when(empty_full, F.format_string(MSG_EMPTY_FULL, iv))
               .otherwise(F.format_string(MSG_LOADED, n)))
    return j.select(status.alias("status"), "ticker", "asset_class", "interval", message.alias("message"))


def unknown_names(requested: DataFrame, known: DataFrame, col: str = "asset_class") -> DataFrame:
    """Requested EXCEPT known (distinct)."""
    return requested.select(col).subtract(known.select(col))


def select_classes(universe: DataFrame, requested: DataFrame, col: str = "asset_class") -> DataFrame:
    """Rows of the requested classes; unknown names raise, listing the
    known ones. The check collects only the (tiny) set of unknown names."""
    unknown = sorted(r[0] for r in unknown_names(requested, universe, col).collect())
    if unknown:
        known = sorted(r[0] for r in universe.select(col).distinct().collect())
        raise ValueError("Unknown asset class(es): " + ", ".join(unknown)
                         + ". Known: " + ", ".join(known))
    return universe.join(requested.select(col).distinct(), col, "left_semi")


def allowed_intervals(requested: DataFrame, supported: DataFrame, col: str = "interval") -> DataFrame:
    """U4: requested INTERSECT supported."""
    return requested.select(col).intersect(supported.select(col))


def classify_intervals(df: DataFrame, interval_dim: DataFrame, col: str = "interval") -> DataFrame:
    """P10: cumulative / intraday / unsupported via the 13-row interval
    dimension (a fixed-size broadcast)."""
    dim = F.broadcast(interval_dim.select(F.col("interval").alias(col), "kind"))
    return df.join(dim, col, "left").withColumn("kind", F.coalesce("kind", F.lit("unsupported")))


def shard_audit(plan: DataFrame, universe: DataFrame):
    """``plan(entry_id, asset_class, shard_index, shard_count)`` against
    the universe. Returns (per-entry ticker counts with a duplicate flag,
    universe classes no entry covers). Entries of unknown classes count 0."""
    bad = plan.where(F.col("entry_id").isNull() | F.col("asset_class").isNull()).limit(1).collect()
    if bad:
        raise ValueError(f"Invalid shard entry (needs entry_id and asset_class): {bad[0].asDict()}")
    counts = []
    sizes = [r[0] for r in plan.select("shard_count").distinct().collect()]  # a handful
    for n in sizes:
        s = stable_shards(universe, n).withColumn("shard_count", F.lit(n))
        counts.append(s.groupBy("asset_class", "shard_count", "shard").agg(
            F.count(F.lit(1)).alias("tickers")))
    per_shard = reduce(DataFrame.unionByName, counts)
    w = Window.partitionBy("asset_class", "shard_count", "shard_index")
    entries = (plan.join(per_shard.withColumnRenamed("shard", "shard_index"),
                         ["asset_class", "shard_count", "shard_index"], "left")
               .na.fill(0, ["tickers"])
               .withColumn("duplicated", F.count(F.lit(1)).over(w) > 1))
    uncovered = universe.select("asset_class").distinct().join(plan, "asset_class", "left_anti")
    return entries, uncovered
