"""Bar construction and hygiene: ticks -> bars, last-write-wins, normalisation,
retention pruning, adjusted-close preference."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.schema import (INTRADAY_MINUTES, OPTIONAL_COLUMNS, PRICE_COLUMNS,
                             RETENTION_DAYS, SERIES_KEY)
from barforge.session import input_bytes

_CALENDAR_UNIT = {"1d": "day", "1wk": "week", "1mo": "month", "3mo": "quarter"}
_FIXED_DAYS = {"5d": 5}


def bar_start(ts: Column | str, interval: str) -> Column:
    """Start of the bar that contains ``ts``. Minute and ``5d`` bars are
    aligned to the Unix epoch (UTC); 1d/1wk/1mo/3mo to calendar units
    (ISO weeks start on Monday)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    if interval in _CALENDAR_UNIT:
        return F.date_trunc(_CALENDAR_UNIT[interval], ts)
    if interval in INTRADAY_MINUTES or interval in _FIXED_DAYS:
        width_us = (INTRADAY_MINUTES.get(interval) or _FIXED_DAYS[interval] * 1440) * 60_000_000
        us = F.unix_micros(ts)
        return F.timestamp_micros(us - F.pmod(us, F.lit(width_us)))
    raise ValueError(f"unsupported interval {interval!r}")


def bar_end(ts: Column | str, interval: str) -> Column:
    """End of the bar that contains ``ts`` (the start of the next one)."""
    start = bar_start(ts, interval)
    months = {"1mo": 1, "3mo": 3}.get(interval)
    if months:
        return (F.add_months(F.to_date(start), months)).cast("timestamp")
    days = {"1d": 1, "1wk": 7, **_FIXED_DAYS}.get(interval)
    minutes = days * 1440 if days else INTRADAY_MINUTES[interval]
    return F.timestamp_micros(F.unix_micros(start) + F.lit(minutes * 60_000_000))


def _bar_start_by_interval(ts: Column, intervals) -> Column:
    expr = None
    for iv in intervals:
        branch = bar_start(ts, iv)
        expr = F.when(F.col("interval") == iv, branch) if expr is None else expr.when(F.col("interval") == iv, branch)
    return expr


def ordered_pair(high: Column, low: Column) -> Column:
    """Two integers as one DECIMAL(38) ordered like the pair: high * 2^64 + low.
    Exact for every BIGINT ``low`` (null counts as 0) and every INT ``high``,
    negative ones included. Being a fixed-width value it lets ``min_by`` /
    ``max_by`` run as a hash aggregate (a struct ordering forces a sort-based
    one)."""
    wide = F.lit(Decimal(1 << 64))
    return (high.cast("decimal(17,0)") * wide + F.coalesce(low.cast("bigint"), F.lit(0)).cast("decimal(20,0)")).cast("decimal(38,0)")


def split_pair(pair: Column) -> tuple[Column, Column]:
    """(high, low) of :func:`ordered_pair` for non-negative ``low``."""
    wide = F.lit(Decimal(1 << 64)).cast("decimal(20,0)")
    low = F.pmod(pair, wide)
    return ((pair - low) / wide).cast("bigint"), low.cast("bigint")


def tick_order(ts: Column, bar_ts: Column, seq: Column) -> Column:
    """Orders ticks inside one 1-minute bar by (ts, seq): the microsecond offset
    from the bar start, then the sequence."""
    return ordered_pair(F.unix_micros(ts) - F.unix_micros(bar_ts), seq)


#: Tick file bytes, times the intervals rolled up from them, that one task takes:
#: a minute bar grows to one bar per interval there, some 50 bytes each on file
#: to 500 in the aggregates' maps.
ROLLUP_BYTES = 4 << 20
#: The same for a task that sorts the rolled-up bars (one row each).
BAR_BYTES = 8 << 20


def bar_tasks(ticks: DataFrame, intervals: int, share: int | None = None) -> int | None:
    """Partitions for a step over the bars of ``intervals`` intervals rolled up
    from ``ticks``, by the ticks' files: a task's part stays the same however
    many ticks there are. None (adaptive execution decides) where that is no
    more than it spreads over all cores anyway."""
    n = -(-input_bytes(ticks) * intervals // (share or BAR_BYTES))
    return n if n > ticks.sparkSession.sparkContext.defaultParallelism else None


def spread(df: DataFrame, tasks: int | None, *keys) -> DataFrame:
    """``df`` by ``keys`` in ``tasks`` partitions, as it is where that is None.
    A window or aggregate by these keys (and more) needs no other shuffle."""
    return df.repartition(tasks, *keys) if tasks else df


def by_series_day(base: DataFrame, ticks: DataFrame, keys: list, intervals: int) -> DataFrame:
    """Minute bars by (series, day), in as many partitions as their roll-up to
    ``intervals`` intervals needs. The shuffle's bytes, by which adaptive
    execution would join partitions, do not show that growth, so beyond what it
    spreads over all cores anyway the number follows from the ticks' files."""
    n = bar_tasks(ticks, intervals, ROLLUP_BYTES)
    return base.repartition(*([n] if n else []), *keys)


def bars_from_ticks(ticks: DataFrame, intervals, key=("asset_class", "ticker")) -> DataFrame:
    """OHLCV bars per series and interval from trade ticks
    ``(key..., ts, price, size, seq)``.

    A lattice of intervals, one scan: ticks are first combined into 1-minute
    bars (hash aggregation with map-side partial aggregation, so a hot ticker is
    reduced before the shuffle). Those meet once by (series, day), where every
    interval within a day follows without another shuffle: a series has at most
    1,440 such bars a day. Longer intervals are rolled up from the daily bars.
    Each interval's boundaries are multiples of its parent's, so every roll-up
    is exact; 1-minute bars travel once, not once per interval. What a task
    holds is bounded by :func:`by_series_day`, however many ticks there are."""
    key = list(key)
    ticks = ticks.withColumn("bar_ts", bar_start("ts", "1m"))
    order = tick_order(F.col("ts"), F.col("bar_ts"), F.col("seq"))
    base = (ticks.groupBy(*key, "bar_ts")
            .agg(F.min_by("price", order).alias("open"),
                 F.max("price").alias("high"),
                 F.min("price").alias("low"),
                 F.max_by("price", order).alias("close"),
                 F.sum("size").alias("volume"),
                 F.count(F.lit(1)).alias("n_ticks")))
    ivs = list(dict.fromkeys(intervals))
    within = [i for i in ivs if i in INTRADAY_MINUTES or i == "1d"]
    beyond = [i for i in ivs if i not in within]

    def rolled_up(parent: DataFrame, wanted: list[str], start: str, *at: str) -> DataFrame:
        return (parent.withColumn("interval", F.explode(F.array(*[F.lit(i) for i in wanted])))
                .withColumn("ts", _bar_start_by_interval(F.col(start), wanted))
                .groupBy(*key, *at, "interval", "ts")
                .agg(F.min_by("open", start).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
                     F.max_by("close", start).alias("close"), F.sum("volume").alias("volume"), F.sum("n_ticks").alias("n_ticks"))
                .drop(*at))
    by_day = by_series_day(base.withColumn("_day", F.date_trunc("day", "bar_ts")), ticks, [*key, "_day"], max(len(within), 1))
    parts = [rolled_up(by_day, within, "bar_ts", "_day")] if within else []
    if beyond:
        days = rolled_up(by_day, ["1d"], "bar_ts", "_day").withColumnRenamed("ts", "day_ts").drop("interval")
        parts.append(rolled_up(days, beyond, "day_ts"))
    rolled = reduce(DataFrame.unionByName, parts)
    return rolled.select(*key[:1], "interval", *key[1:], "ts", "open", "high", "low", "close",
                         F.lit(None).cast("double").alias("adj_close"),
                         F.col("volume").cast("bigint").alias("volume"),
                         F.col("n_ticks").cast("bigint").alias("n_ticks"))


def rollup_bars(bars: DataFrame, interval: str, key=("asset_class", "ticker")) -> DataFrame:
    """Resample finer bars of one series into ``interval`` bars (open of the
    first bar, close/adj_close of the last, high/low extremes, summed volume and
    dividends, splits multiplied; the last two where the bars carry them)."""
    key = list(key)
    # a ratio of 0 or null means no split on that bar
    split = lambda c: F.exp(F.sum(F.when(F.col(c) > 0, F.ln(c))))
    extra = {c: how for c, how in (("dividends", F.sum), ("stock_splits", split)) if c in bars.columns}
    return (bars.withColumn("_b", bar_start("ts", interval))
            .groupBy(*key, "_b")
            .agg(F.min_by("open", "ts").alias("open"), F.max("high").alias("high"),
                 F.min("low").alias("low"), F.max_by("close", "ts").alias("close"),
                 F.max_by("adj_close", "ts").alias("adj_close"),
                 F.sum("volume").cast("bigint").alias("volume"),
                 *[how(c).alias(c) for c, how in extra.items()])
            .select(*key[:1], F.lit(interval).alias("interval"), *key[1:],
                    F.col("_b").alias("ts"), "open", "high", "low", "close", "adj_close", "volume", *extra))


def packed_rank(rank: Column, seq: Column) -> Column:
    """(src_rank, seq) as one value ordered like the pair, any BIGINT seq."""
    return ordered_pair(rank, seq)


def last_write_wins(df: DataFrame, key, rank_cols=("src_rank", "seq")) -> DataFrame:
    """One row per ``key``; the row with the greatest ``rank_cols`` wins.

    Expressed as an aggregate rather than a row_number window so duplicates
    combine map-side before the shuffle. With (src_rank, seq) - or a single
    primitive rank column - the rank is one number and every column is taken
    with its own ``max_by`` on it: a hash aggregate. Ranks must be unique per
    key (a unique ``seq`` guarantees it), so all columns come from one row."""
    key = list(key)
    rank_cols = [c for c in rank_cols if c in df.columns]
    payload = [c for c in df.columns if c not in key]
    if rank_cols == ["src_rank", "seq"]:
        rank = packed_rank(F.col("src_rank"), F.col("seq"))
    elif len(rank_cols) == 1:
        rank = F.col(rank_cols[0])
    else:
        winner = F.max_by(F.struct(*payload), F.struct(*rank_cols)).alias("_w")
        return df.groupBy(*key).agg(winner).select(*key, *[F.col(f"_w.{c}").alias(c) for c in payload])
    d = df.withColumn("_rk", rank)
    return d.groupBy(*key).agg(*[F.max_by(c, "_rk").alias(c) for c in payload])


def normalise_bars(raw: DataFrame, key=SERIES_KEY, ts_col: str = "Datetime",
                   seq_col: str = "seq") -> DataFrame:
    """P5: flatten two-level (``price.ticker``) columns, keep the whitelisted
    OHLCV columns, parse the time as UTC, last row per timestamp wins.

    ``raw`` may carry struct columns such as ``Open: struct<AAPL: double>``
    (the two-level header); the first field of each is taken. A cell that does
    not parse becomes null. ``seq_col`` (required) orders rows of one
    timestamp: an order made up from partitions would depend on file splits."""
    cols = {}
    for field in raw.schema.fields:
        name = field.name
        col = F.col(f"`{name}`")
        if field.dataType.typeName() == "struct":
            col = col.getField(field.dataType.fields[0].name)
        cols[name.lower().replace(" ", "_")] = col
    keep = [c for c in (*PRICE_COLUMNS, "volume", *OPTIONAL_COLUMNS) if c in cols]
    key = [k for k in key if k in cols]
    ts_raw = cols[ts_col.lower()]
    ts = ts_raw if raw.schema[ts_col].dataType.typeName().startswith("timestamp") \
        else F.try_to_timestamp(ts_raw.cast("string"))
    if seq_col.lower() not in cols:
        raise ValueError(f"no sequence column {seq_col!r} in {raw.columns}")
    seq = cols[seq_col.lower()]
    df = raw.select(*[cols[k].alias(k) for k in key], ts.cast("timestamp").alias("ts"),
                    *[(cols[c].try_cast("double").try_cast("bigint") if c == "volume" else cols[c].try_cast("double")).alias(c)
                      for c in keep],
                    seq.alias("seq"))
    df = df.where(F.col("ts").isNotNull())
    return last_write_wins(df, [*key, "ts"], ("seq",)).drop("seq")


def retention_cutoffs(as_of: dt.datetime) -> dict[str, dt.datetime]:
    return {iv: as_of - dt.timedelta(days=d) for iv, d in RETENTION_DAYS.items()}


def retention_predicate(as_of: dt.datetime, interval_col: str = "interval") -> Column:
    """P6 as a literal predicate per interval (inclusive cutoff), so the
    filter is pushed into the Parquet scan; non-intraday intervals pass."""
    cond = ~F.col(interval_col).isin(*RETENTION_DAYS) | F.col(interval_col).isNull()
    for iv, cutoff in retention_cutoffs(as_of).items():
        cond = cond | ((F.col(interval_col) == iv) & (F.col("ts") >= F.lit(cutoff)))
    return cond


def prune_retention(bars: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Drop intraday bars older than ``as_of`` minus the interval's
    retention window. ``as_of`` is explicit; the wall clock is never read."""
    return bars.where(retention_predicate(as_of))


def adjusted_close(bars: DataFrame, key=SERIES_KEY, out: str = "price") -> DataFrame:
    """Use ``adj_close`` for a series when it has any value, else ``close``
    (a column-level choice per series, not a per-row coalesce)."""
    from pyspark.sql import Window
    w = Window.partitionBy(*key)
    has_adj = F.count("adj_close").over(w) > 0
    return bars.withColumn(out, F.when(has_adj, F.col("adj_close")).otherwise(F.col("close")))


def drop_incomplete(df: DataFrame, subset=None) -> DataFrame:
    """Drop rows with any null (or NaN) in ``subset``."""
    subset = list(subset or df.columns)
    cond = None
    for c in subset:
        dtype = df.schema[c].dataType.typeName()
        ok = F.col(c).isNotNull()
        if dtype in ("double", "float"):
            ok = ok & ~F.isnan(c)
        cond = ok if cond is None else cond & ok
    return df.where(cond)
