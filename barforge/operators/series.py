"""Per-series window operators.

Every window is ``partitionBy(series key).orderBy(ts)`` - never a global
window - so one hash shuffle on the series key serves all of them when they
are computed in the same ``select``. A series is one bar per interval step,
so its length is bounded by its time span, not by the data volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.schema import SERIES_KEY


def series_window(key=SERIES_KEY, order="ts"):
    return Window.partitionBy(*key).orderBy(order)


def rolling_frame(width: int, key=SERIES_KEY, order="ts"):
    return series_window(key, order).rowsBetween(-(width - 1), 0)


def simple_return(price: Column, w) -> Column:
    """p_t / p_{t-1} - 1 (null on the first row; division guarded)."""
    return F.try_divide(price, F.lag(price).over(w)) - 1


def log_return(price: Column, w) -> Column:
    """Ln p_t - ln p_{t-1}."""
    return F.ln(price) - F.lag(F.ln(price)).over(w)


def rolling_mean(x: Column, width: int, key=SERIES_KEY, order="ts") -> Column:
    """Mean over the last ``width`` rows; null until the frame is full."""
    frame = rolling_frame(width, key, order)
    return F.when(F.count(x).over(frame) == width, F.avg(x).over(frame))


def rolling_std(x: Column, width: int, key=SERIES_KEY, order="ts") -> Column:
    """Sample std over the last ``width`` rows; null until full."""
    frame = rolling_frame(width, key, order)
    return F.when(F.count(x).over(frame) == width, F.stddev_samp(x).over(frame))


def returns(bars: DataFrame, price: str = "close", key=SERIES_KEY) -> DataFrame:
    """W3 + W7: simple and log returns; the first row of each series is dropped."""
    w = series_window(key)
    p = F.col(price)
    out = bars.select(*key, "ts", p.alias("price"),
                      simple_return(p, w).alias("ret"),
                      log_return(p, w).alias("log_ret"))
    return out.where(F.col("ret").isNotNull())


def normalized_price(df: DataFrame, price: str = "price", key=SERIES_KEY) -> DataFrame:
    """Growth of 1 - price divided by the series' first price."""
    w = series_window(key).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn("norm", F.col(price) / F.first(price).over(w))


def row_tail(df: DataFrame, n: int, key=SERIES_KEY, order="ts") -> DataFrame:
    """Last ``n`` rows per series (a per-group limit Catalyst plans as
    WindowGroupLimit, so each task keeps at most ``n`` rows per series)."""
    w = Window.partitionBy(*key).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def volume_zscore(vol: Column, width: int = 20, key=SERIES_KEY) -> Column:
    """Z-score of log1p(volume) against its rolling ``width`` mean/std;
    missing (warm-up or zero std) -> 0."""
    lv = F.log1p(vol.cast("double"))
    m = rolling_mean(lv, width, key)
    s = rolling_std(lv, width, key)
    return F.coalesce(F.try_divide(lv - m, s), F.lit(0.0))


def next_value(x: Column, w) -> Column:
    """The next row's value (target at t+1)."""
    return F.lead(x, 1).over(w)


def feature_frame(bars: DataFrame, price: str = "close", key=SERIES_KEY,
                  widths=(5, 10, 20), volume: str | None = "volume") -> DataFrame:
    """W7-W10 in one select: log return, rolling means/stds, volume z-score
    and next-step target; rows with an incomplete feature vector dropped (P14)."""
    columns = [*key, "ts", F.col(price).alias("price"), *([F.col(volume).alias("volume")] if volume else [])]
    return feature_columns(bars.select(*columns), key, widths, "volume" if volume else None)


def feature_columns(rows: DataFrame, key, widths=(5, 10, 20), volume: str | None = "volume", also=()) -> DataFrame:
    """The features of ``rows`` (key, ts, price and volume), windows by ``key``;
    columns ``also`` are kept as they are."""
    w = series_window(key)
    lp = F.ln(F.col("price"))
    base = rows.select(*key, "ts", "price", lp.alias("log_price"),
                       (lp - F.lag(lp).over(w)).alias("log_ret"),
                       F.lead(F.col("price")).over(w).alias("next_price"),
                       *([volume] if volume else []), *also)
    lr = F.col("log_ret")
    cols = [*key, "ts", "price", "log_price", "log_ret", "next_price"]
    feats = []
    for width in widths:
        feats += [rolling_mean(lr, width, key).alias(f"sma_{width}"),
                  rolling_std(lr, width, key).alias(f"vol_{width}")]
    if volume:
        feats.append(volume_zscore(F.col(volume), 20, key).alias("volume_z"))
    feats.append(next_value(lr, w).alias("target"))
    out = base.select(*cols, *feats, *also)
    names = [c for c in out.columns if c not in key and c != "ts" and c not in also]
    cond = None
    for c in names:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return out.where(cond)


def feature_windows(df: DataFrame, features, lookback: int, key=SERIES_KEY,
                    include_current: bool = False) -> DataFrame:
    """For each row the previous ``lookback`` feature vectors (rows
    i-L..i-1, or i-L+1..i with ``include_current``) as array<array<double>>;
    rows without a full window are dropped."""
    lo, hi = (-(lookback - 1), 0) if include_current else (-lookback, -1)
    frame = series_window(key).rowsBetween(lo, hi)
    vec = F.array(*[F.col(c).cast("double") for c in features])
    out = df.withColumn("window", F.collect_list(vec).over(frame))
    return out.where(F.size("window") == lookback)


def last_n_days(df: DataFrame, n: int, key=SERIES_KEY) -> DataFrame:
    """Rows from the calendar day N-1 days before the series' last day on."""
    w = Window.partitionBy(*key)
    start = F.date_trunc("day", F.max("ts").over(w)) - F.make_dt_interval(F.lit(n - 1))
    return df.withColumn("_start", start).where(F.col("ts") >= F.col("_start")).drop("_start")


def latest_session(df: DataFrame, key=SERIES_KEY) -> DataFrame:
    """Rows on the series' latest UTC calendar day."""
    w = Window.partitionBy(*key)
    return (df.withColumn("_last", F.max("ts").over(w))
            .where(F.to_date("ts") == F.to_date("_last")).drop("_last"))


def positional_split(df: DataFrame, test_rows: int = 90, val_fraction: float = 0.85,
                     key=SERIES_KEY) -> DataFrame:
    """Label rows train / val / test by position: the last ``test_rows``
    are test, validation starts at int(val_fraction * split)."""
    w = series_window(key)
    n = F.count(F.lit(1)).over(Window.partitionBy(*key))
    i = (F.row_number().over(w) - 1).cast("bigint")
    split = n - test_rows
    val_start = F.floor(split * F.lit(val_fraction))
    return (df.withColumn("row_idx", i).withColumn("n_rows", n)
            .withColumn("split_label",
                        F.when(F.col("row_idx") >= split, "test")
                        .when(F.col("row_idx") >= val_start, "val").otherwise("train")))


def smoothed_abs_error(err: Column, width: int = 5, key=SERIES_KEY) -> Column:
    """Rolling mean of |error| over ``width`` rows."""
    return rolling_mean(F.abs(err), width, key)
