"""Series statistics and multi-series alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.schema import SERIES_KEY

def align_long(df: DataFrame, series_col: str = "ticker", n_series: int | None = None,
               on: str = "ts") -> DataFrame:
    """J1 (long form): keep timestamps present in all ``n_series`` series,
    i.e. an N-way inner join on the exact instant without materialising it.

    Input rows are unique per (series, ts) - true of bars - so the number of
    series at a timestamp is a window count over ``ts``: one shuffle and one
    pass over the input (a group-by plus semi join would evaluate the input
    twice). A timestamp holds at most one row per series."""
    if n_series is None:
        n_series = df.select(series_col).distinct().count()
    w = Window.partitionBy(on)
    return (df.withColumn("_n", F.count(F.lit(1)).over(w))
            .where(F.col("_n") == n_series).drop("_n"))


def align_wide(df: DataFrame, series, value: str = "price", series_col: str = "ticker",
               on: str = "ts") -> DataFrame:
    """J1 (wide form): one column per series (explicit pivot values), rows
    with any missing series dropped - ``concat(axis=1).dropna()``. For lists of
    series too long for columns use :func:`align_long` or :func:`align_arrays`."""
    names = list(dict.fromkeys(series))
    if not names:
        raise ValueError("series list is empty")
    wide = df.groupBy(on).pivot(series_col, names).agg(F.first(value))
    return wide.na.drop("any", subset=names)


def align_arrays(df: DataFrame, value: str = "price", series_col: str = "ticker", on: str = "ts",
                 n_series: int | None = None) -> DataFrame:
    """J1 (wide form, any number of series): one row per timestamp that all
    series share, with the names in order and their values beside them."""
    pairs = F.sort_array(F.collect_list(F.struct(F.col(series_col).alias("name"), F.col(value).alias("value"))))
    rows = align_long(df, series_col, n_series, on).groupBy(on).agg(pairs.alias("_p"))
    return rows.select(on, F.col("_p.name").alias("series"), F.col("_p.value").alias("values"))


def left_reindex(axis: DataFrame, other: DataFrame, on=("ticker", "ts")) -> DataFrame:
    """Keep ``axis`` rows, attach matching ``other`` columns (nulls when absent)."""
    return axis.join(other, list(on), "left")


def describe_returns(r: DataFrame, col: str = "ret", key=SERIES_KEY) -> DataFrame:
    """Count, mean, sample std, min, max per series."""
    x = F.col(col)
    return r.groupBy(*key).agg(F.count(x).alias("n"), F.avg(x).alias("mean"),
                               F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
                               F.max(x).alias("max"))


def session_stats(bars: DataFrame, price: str = "close", key=SERIES_KEY) -> DataFrame:
    """Bars, sessions (distinct UTC days), return mean/std/min/max and
    first/last bar per series."""
    w = Window.partitionBy(*key).orderBy("ts")
    p = F.col(price)
    r = bars.select(*key, "ts", (F.try_divide(p, F.lag(p).over(w)) - 1).alias("ret"))
    return r.groupBy(*key).agg(
        F.count(F.lit(1)).alias("bars"),
        F.count_distinct(F.to_date("ts")).alias("sessions"),
        F.avg("ret").alias("mean_ret"), F.stddev_samp("ret").alias("std_ret"),
        F.min("ret").alias("min_ret"), F.max("ret").alias("max_ret"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def forecast_metrics(fc: DataFrame, models, actual: str = "actual",
                     key=("ticker",)) -> DataFrame:
    """A10: MAE, RMSE, MAPE% per series and model (models unpivoted with
    ``stack`` so one aggregation covers all of them)."""
    key = list(key)
    stack = ", ".join(f"'{m}', `{m}`" for m in models)
    long = fc.selectExpr(*key, actual, f"stack({len(models)}, {stack}) AS (model, pred)")
    e = F.col("pred") - F.col(actual)
    return long.groupBy(*key, "model").agg(
        F.count(e).alias("n"),
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.avg(F.try_divide(F.abs(e), F.col(actual))) * 100).alias("mape_pct"))


def model_gap(fc: DataFrame, a: str, b: str, key=("ticker",)) -> DataFrame:
    """Mean and max absolute difference between two forecasts."""
    gap = F.abs(F.col(a) - F.col(b))
    return fc.groupBy(*key).agg(F.avg(gap).alias("gap_mean"), F.max(gap).alias("gap_max"))


def coverage(df: DataFrame, key=SERIES_KEY) -> DataFrame:
    """first/last timestamp and bar count per series."""
    return df.groupBy(*key).agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
                                F.count(F.lit(1)).alias("bars"))


def standardisation_stats(df: DataFrame, features, train_col: str = "is_train",
                          key=SERIES_KEY) -> DataFrame:
    """Mean and population std of each feature over training rows;
    a scale below 1e-8 becomes 1."""
    aggs = []
    for c in features:
        aggs.append(F.avg(F.when(F.col(train_col), F.col(c))).alias(f"{c}_mean"))
        sd = F.stddev_pop(F.when(F.col(train_col), F.col(c)))
        aggs.append(F.when(sd < 1e-8, F.lit(1.0)).otherwise(sd).alias(f"{c}_std"))
    return df.groupBy(*key).agg(*aggs)
