"""Windows over series too long for one task.

A series is cut into time buckets of a fixed number of bar steps, so a bucket
holds a bounded number of rows whatever the series' length. Each bucket gets a
halo: copies of the last rows before it and, where a window looks ahead, of the
first rows behind it, from as many neighbouring buckets as it takes. A window
partitioned by (series, bucket) then sees every row its frame asks for, and the
copies are dropped from the result. Only the buckets' edges travel twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.schema import INTRADAY_MINUTES, SERIES_KEY
from barforge.session import stored_table

#: Bar steps in a bucket.
STEPS = 4096
BUCKET, COPY = "_bucket", "_copy"
_DAYS = {"1d": 1, "5d": 5, "1wk": 7, "1mo": 30, "3mo": 90}


def bucket_of(steps: int = STEPS, interval: str = "interval", ts: str = "ts") -> Column:
    """The bucket of a bar: its time over the length of ``steps`` bars of its
    interval, so no bucket has more than about ``steps`` bars. Bars of other
    intervals are taken as one a minute."""
    seconds = F.lit(60)
    for iv, s in [(i, m * 60) for i, m in INTRADAY_MINUTES.items()] + [(i, d * 86400) for i, d in _DAYS.items()]:
        seconds = F.when(F.col(interval) == iv, s).otherwise(seconds)
    return F.floor(F.unix_seconds(ts) / (seconds * F.lit(steps))).cast("bigint")


def _edges(rows: DataFrame, key: list[str], n: int, after: bool) -> DataFrame:
    """Copies of each bucket's last ``n`` rows (first ones with ``after``), under
    the following (preceding) buckets that still need them."""
    order = F.asc("ts") if after else F.desc("ts")
    w = Window.partitionBy(*key, BUCKET).orderBy(order)
    edge = rows.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n)
    sizes = rows.groupBy(*key, BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    # the buckets of a series in order: rows up to each, and the buckets behind
    along = Window.partitionBy(*key).orderBy(F.col(BUCKET).desc() if after else F.col(BUCKET))
    sizes = sizes.withColumn("_upto", F.sum("_n").over(along))
    # bucket m still needs row k (from the edge) of bucket j if the buckets
    # between them hold fewer than n - k + 1 rows; each holds one at least
    near = along.rowsBetween(1, n)
    nexts = sizes.withColumn("_next", F.collect_list(F.struct(F.col(BUCKET).alias("b"), (F.col("_upto") - F.col("_n")).alias("before"))).over(near))
    nexts = nexts.select(*key, BUCKET, F.explode(F.filter("_next", lambda x: x["before"] - F.col("_upto") < n)).alias("_to"), "_upto")
    cond = [F.col(f"e.{c}").eqNullSafe(F.col(f"t.{c}")) for c in key] + [F.col(f"e.{BUCKET}") == F.col(f"t.{BUCKET}")]
    met = cond[0]
    for c in cond[1:]:
        met = met & c
    copies = edge.alias("e").join(nexts.alias("t"), met).where(F.col("t._to.before") - F.col("t._upto") + F.col("e._k") <= n)
    return copies.select(*(F.col(f"e.{c}") for c in rows.columns if c not in (BUCKET, COPY)), F.col("t._to.b").alias(BUCKET), F.lit(True).alias(COPY))


def with_halo(df: DataFrame, before: int, after: int = 0, key=SERIES_KEY, steps: int = STEPS) -> DataFrame:
    """``df`` (unique ts per series) with ``_bucket`` and ``_copy``: every row in
    its bucket, and copies of the ``before`` rows that precede each bucket and
    the ``after`` rows that follow it. The rows are written once and read for
    the buckets, their sizes and their edges."""
    key = list(key)
    rows = stored_table(df.withColumn(BUCKET, bucket_of(steps)), "bucketed")
    out = rows.withColumn(COPY, F.lit(False))
    if before:
        out = out.unionByName(_edges(rows, key, before, False))
    if after:
        out = out.unionByName(_edges(rows, key, after, True))
    return out


def by_bucket(df: DataFrame, windows: Callable[[DataFrame, list[str]], DataFrame], before: int, after: int = 0,
              key=SERIES_KEY, steps: int = STEPS) -> DataFrame:
    """``windows(rows, key)`` evaluated per (series, bucket): a function that adds
    windowed columns with frames of at most ``before`` rows back and ``after``
    ahead, and keeps all rows and the columns it is given."""
    halo = with_halo(df, before, after, key, steps)
    done = windows(halo, [*key, BUCKET])
    return done.where(~F.col(COPY)).drop(BUCKET, COPY)


def returns(bars: DataFrame, price: str = "close", key=SERIES_KEY, steps: int = STEPS) -> DataFrame:
    """W3 + W7 on series of any length; equal to ``series.returns``."""
    from barforge.operators import series as S

    def add(rows: DataFrame, k: list[str]) -> DataFrame:
        w, p = S.series_window(k), F.col(price)
        return rows.withColumns({"price": p, "ret": S.simple_return(p, w), "log_ret": S.log_return(p, w)})
    out = by_bucket(bars.select(*key, "ts", price), add, 1, 0, key, steps)
    return out.where(F.col("ret").isNotNull()).select(*key, "ts", "price", "ret", "log_ret")


def feature_frame(bars: DataFrame, price: str = "close", key=SERIES_KEY, widths=(5, 10, 20),
                  volume: str | None = "volume", steps: int = STEPS) -> DataFrame:
    """W7-W10 on series of any length; equal to ``series.feature_frame``. The
    widest frame is of log returns, which look one row further back."""
    from barforge.operators import series as S
    columns = list(dict.fromkeys([*key, "ts", price, *([volume] if volume else [])]))
    halo = with_halo(bars.select(*columns), max([*widths, 20]), 1, key, steps)
    names = {price: "price"} | ({volume: "volume"} if volume else {})
    out = S.feature_columns(halo.withColumnsRenamed(names), [*key, BUCKET], widths, "volume" if volume else None, [COPY])
    return out.where(~F.col(COPY)).drop(BUCKET, COPY)


def feature_windows(df: DataFrame, features, lookback: int, key=SERIES_KEY, steps: int = STEPS) -> DataFrame:
    """W11 on series of any length; equal to ``series.feature_windows``."""
    from barforge.operators import series as S
    halo = with_halo(df, lookback, 0, key, steps)
    return S.feature_windows(halo, features, lookback, [*key, BUCKET]).where(~F.col(COPY)).drop(BUCKET, COPY)


def smoothed_abs_error(df: DataFrame, err: str, width: int = 5, out: str = "smoothed", key=SERIES_KEY,
                       steps: int = STEPS) -> DataFrame:
    """W15 on series of any length: adds ``out``, the rolling mean of |err|."""
    from barforge.operators import series as S
    return by_bucket(df, lambda rows, k: rows.withColumn(out, S.smoothed_abs_error(F.col(err), width, k)), width - 1, 0, key, steps)
