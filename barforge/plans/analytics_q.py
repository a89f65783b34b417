"""Registered analytics queries over derived daily and intraday bars."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.operators import bars as B
from barforge.operators import blocks as BL
from barforge.operators import forecast as FC
from barforge.operators import longseries as LS
from barforge.operators import series as S
from barforge.operators import stats as ST
from barforge.plans import sqlparts as Q
from barforge.plans.registry import register
from barforge.schema import ALL_INTERVALS, SERIES_KEY
from barforge.session import stored_table
from barforge.sources import derived as D

KEY = list(SERIES_KEY)
_FEATURES = ["log_ret", "sma_5", "vol_5", "sma_10", "vol_10", "sma_20", "vol_20", "volume_z"]


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def priced(spark: SparkSession, sf: str) -> DataFrame:
    return B.adjusted_close(D.bars_1d(spark, sf))


def weekly_priced(spark: SparkSession, sf: str) -> DataFrame:
    return B.adjusted_close(B.rollup_bars(D.bars_1d(spark, sf), "1wk"))


def split_frame(spark: SparkSession, sf: str) -> DataFrame:
    feat = S.feature_frame(priced(spark, sf), "price")
    return (S.positional_split(feat, 90, 0.85)
            .withColumn("is_train", F.col("split_label") == "train")
            .withColumn("before_split", F.col("split_label") != "test"))


def log_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    """ARMA and window-model forecasts of every row with a full feature window.
    The split frame and the fits (a row per series) are written once."""
    fs = stored_table(split_frame(spark, sf), "split-frame")
    rows = FC.arma_forecast(fs, stored_table(FC.arma_fit(fs), "arma-fit"))
    rows = FC.window_return_forecast(rows, stored_table(FC.window_return_fit(fs, _FEATURES), "return-fit"), _FEATURES)
    return rows.where(F.col("lr_log").isNotNull()).withColumn("actual_log", F.ln("next_price"))


def forecast_table(spark: SparkSession, sf: str) -> DataFrame:
    fs = log_forecasts(spark, sf).withColumn("is_val", F.col("split_label") == "val")
    fs = FC.with_blend_weight(fs, "ar_log", "lr_log", "actual_log", "is_val")
    # series without validation rows have no weight (and no blended forecast)
    out = FC.blended_forecast(fs.where(F.col("best_w").isNotNull()), None, "ar_log", "lr_log")
    return out.select(*KEY, "ts", "split_label", "p", "q", "coef", "ret_hat", F.col("next_price").alias("actual"),
                      F.col("price").alias("prev_close"), F.exp("ar_log").alias("ar"),
                      F.exp("lr_log").alias("lr"), F.col("price").alias("naive"),
                      "hybrid", "best_w", "collapsed")


# --------------------------------------------------------------------------- A7
@register("a7_return_description", Q.with_(Q.bars_1d(), Q.adjusted("bars_1d"), f"""r AS (
  SELECT {Q.SERIES}, ts, price / lag(price) OVER (PARTITION BY {Q.SERIES} ORDER BY ts) - 1 AS ret
  FROM px)""") + f"""
SELECT {Q.SERIES}, count(ret) AS n, round(avg(ret), 6) AS mean, round(stddev_samp(ret), 6) AS std,
       round(min(ret), 6) AS min, round(max(ret), 6) AS max
FROM r WHERE ret IS NOT NULL GROUP BY {Q.SERIES}""")
def a7_return_description(spark, sf):
    d = ST.describe_returns(S.returns(priced(spark, sf), "price"))
    return d.select(*KEY, "n", *[r6(c).alias(c) for c in ("mean", "std", "min", "max")])


# --------------------------------------------------------------------------- W3 / W7
@register("w3_simple_return", Q.with_(Q.bars_1d()) + f"""
SELECT {Q.SERIES}, ts, round(close / lag(close) OVER (PARTITION BY {Q.SERIES} ORDER BY ts) - 1, 6) AS ret
FROM bars_1d QUALIFY lag(close) OVER (PARTITION BY {Q.SERIES} ORDER BY ts) IS NOT NULL""")
def w3_simple_return(spark, sf):
    r = S.returns(D.bars_1d(spark, sf), "close")
    return r.select(*KEY, "ts", r6("ret").alias("ret"))


@register("w7_log_return", Q.with_(Q.bars_1d()) + f"""
SELECT {Q.SERIES}, ts, round(ln(close) - lag(ln(close)) OVER (PARTITION BY {Q.SERIES} ORDER BY ts), 6) AS log_ret
FROM bars_1d QUALIFY lag(close) OVER (PARTITION BY {Q.SERIES} ORDER BY ts) IS NOT NULL""")
def w7_log_return(spark, sf):
    r = S.returns(D.bars_1d(spark, sf), "close")
    return r.select(*KEY, "ts", r6("log_ret").alias("log_ret"))


# --------------------------------------------------------------------------- S2 / P7
@register("p7_adjusted_close", Q.with_(Q.bars_1d(), Q.adjusted("bars_1d")) + f"""
SELECT {Q.SERIES}, ts, round(price, 6) AS price, adj_close IS NOT NULL AS adjusted FROM px""")
def p7_adjusted_close(spark, sf):
    p = priced(spark, sf)
    return p.select(*KEY, "ts", r6("price").alias("price"), F.col("adj_close").isNotNull().alias("adjusted"))


@register("s2_load_close", Q.with_(Q.bars_1d(), Q.adjusted("bars_1d")) + f"""
SELECT ticker, ts, round(price, 6) AS close FROM px
WHERE asset_class = 'stocks_us' AND interval = '1d' ORDER BY ticker, ts""")
def s2_load_close(spark, sf):
    """Load the (adjusted-preferred) close of one asset class's daily series."""
    p = priced(spark, sf).where((F.col("asset_class") == "stocks_us") & (F.col("interval") == "1d"))
    return p.select("ticker", "ts", r6("price").alias("close")).orderBy("ticker", "ts")


# --------------------------------------------------------------------------- J1 / W5 / A8 (weekly)
_WEEKLY = [Q.bars_1d(), Q.rollup("bars_1d", "1wk", "bars_1wk"), Q.adjusted("bars_1wk")]
_ALIGNED = _WEEKLY + ["""aligned AS (
  SELECT * FROM px WHERE ts IN (
    SELECT ts FROM px GROUP BY ts HAVING count(DISTINCT ticker) = (SELECT count(DISTINCT ticker) FROM px)))"""]


def aligned_weekly(spark, sf):
    return ST.align_long(weekly_priced(spark, sf), "ticker")


@register("j1_series_alignment", Q.with_(*_ALIGNED) + """
SELECT ticker, ts, round(price, 6) AS price FROM aligned""")
def j1_series_alignment(spark, sf):
    return aligned_weekly(spark, sf).select("ticker", "ts", r6("price").alias("price"))


@register("w5_normalized_price", Q.with_(*_ALIGNED) + f"""
SELECT ticker, ts, round(price / first_value(price) OVER (PARTITION BY {Q.SERIES} ORDER BY ts
       ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 6) AS norm FROM aligned""")
def w5_normalized_price(spark, sf):
    n = S.normalized_price(aligned_weekly(spark, sf), "price")
    return n.select("ticker", "ts", r6("norm").alias("norm"))


_RETURNS = """rets AS (
  SELECT ticker, ts, price / lag(price) OVER (PARTITION BY ticker ORDER BY ts) - 1 AS ret FROM aligned),
full_rets AS (SELECT * FROM rets WHERE ret IS NOT NULL)"""


@register("a8_correlation_matrix", Q.with_(*_ALIGNED, _RETURNS) + """
SELECT x.ticker AS a, y.ticker AS b, round(corr(x.ret, y.ret), 6) AS corr
FROM full_rets x JOIN full_rets y ON x.ts = y.ts AND x.ticker <= y.ticker GROUP BY ALL""")
def a8_correlation_matrix(spark, sf):
    c = BL.correlations(S.returns(aligned_weekly(spark, sf), "price"))
    return c.select("a", "b", r6("corr").alias("corr"))


_MANY = [Q.bars_many(), """aligned AS (
  SELECT ticker, ts, close AS price FROM bars_3mo WHERE ts IN (
    SELECT ts FROM bars_3mo GROUP BY ts HAVING count(*) = (SELECT count(DISTINCT ticker) FROM bars_3mo)))"""]


@register("a8_top_correlated", Q.with_(*_MANY, _RETURNS) + """
SELECT a, b, rank, round(corr, 6) AS corr FROM (
  SELECT x.ticker AS a, y.ticker AS b, corr(x.ret, y.ret) AS corr,
         row_number() OVER (PARTITION BY x.ticker ORDER BY corr(x.ret, y.ret) DESC, y.ticker)::INTEGER AS rank
  FROM full_rets x JOIN full_rets y ON x.ts = y.ts AND x.ticker <> y.ticker GROUP BY x.ticker, y.ticker)
WHERE rank <= 5""")
def a8_top_correlated(spark, sf):
    """The five most correlated others of each of many quarterly series."""
    r = S.returns(ST.align_long(D.bars_many(spark, sf), "ticker"), "close")
    return BL.correlations(r, top=5, block=16).select("a", "b", "rank", r6("corr").alias("corr"))


# --------------------------------------------------------------------------- W6
@register("w6_row_tail", Q.with_(Q.bars_1d()) + f"""
SELECT {Q.SERIES}, ts, close FROM bars_1d
QUALIFY row_number() OVER (PARTITION BY {Q.SERIES} ORDER BY ts DESC) <= 250""")
def w6_row_tail(spark, sf):
    return S.row_tail(D.bars_1d(spark, sf), 250).select(*KEY, "ts", "close")


# --------------------------------------------------------------------------- W8-W10 feature frame
_FEAT = [Q.bars_1d(), Q.adjusted("bars_1d"), Q.features("px")]


@register("w8_rolling_stats", Q.with_(*_FEAT) + f"""
SELECT {Q.SERIES}, ts, round(sma_5, 6) AS sma_5, round(vol_5, 6) AS vol_5, round(sma_10, 6) AS sma_10,
       round(vol_10, 6) AS vol_10, round(sma_20, 6) AS sma_20, round(vol_20, 6) AS vol_20 FROM feat""")
def w8_rolling_stats(spark, sf):
    f = S.feature_frame(priced(spark, sf), "price")
    return f.select(*KEY, "ts", *[r6(c).alias(c) for c in
                                  ("sma_5", "vol_5", "sma_10", "vol_10", "sma_20", "vol_20")])


@register("w9_volume_zscore", Q.with_(*_FEAT) + f"""
SELECT {Q.SERIES}, ts, round(volume_z, 6) AS volume_z FROM feat""")
def w9_volume_zscore(spark, sf):
    f = S.feature_frame(priced(spark, sf), "price")
    return f.select(*KEY, "ts", r6("volume_z").alias("volume_z"))


@register("w10_next_target", Q.with_(*_FEAT) + f"""
SELECT {Q.SERIES}, ts, round(target, 6) AS target, round(next_price, 6) AS next_price FROM feat""")
def w10_next_target(spark, sf):
    f = S.feature_frame(priced(spark, sf), "price")
    return f.select(*KEY, "ts", r6("target").alias("target"), r6("next_price").alias("next_price"))


@register("w11_feature_windows", Q.with_(*_FEAT) + f"""
SELECT {Q.SERIES}, ts, round(target, 6) AS target, win AS window FROM (
  SELECT *, list([{", ".join(f"round({c}, 6)" for c in _FEATURES)}]) OVER (
      PARTITION BY {Q.SERIES} ORDER BY ts ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) AS win
  FROM feat) WHERE len(win) = 30""")
def w11_feature_windows(spark, sf):
    f = S.feature_frame(priced(spark, sf), "price")
    f = f.select(*KEY, "ts", "target", *[r6(c).alias(c) for c in _FEATURES])
    w = S.feature_windows(f, _FEATURES, 30)
    return w.select(*KEY, "ts", r6("target").alias("target"), "window")


# --------------------------------------------------------------------------- W14 / A17
_SPLIT = _FEAT + [Q.split("feat")]


@register("w14_positional_split", Q.with_(*_SPLIT) + f"""
SELECT {Q.SERIES}, ts, row_idx, split_label FROM fs""")
def w14_positional_split(spark, sf):
    return split_frame(spark, sf).select(*KEY, "ts", "row_idx", "split_label")


@register("a17_standardisation_stats", Q.with_(*_SPLIT) + f"""
SELECT {Q.SERIES}, {", ".join(f"round(avg({c}) FILTER (WHERE row_idx < n_rows - 90), 6) AS {c}_mean, "
    f"round(CASE WHEN stddev_pop({c}) FILTER (WHERE row_idx < n_rows - 90) < 1e-8 THEN 1.0 "
    f"ELSE stddev_pop({c}) FILTER (WHERE row_idx < n_rows - 90) END, 6) AS {c}_std" for c in _FEATURES)}
FROM fs GROUP BY {Q.SERIES}""")
def a17_standardisation_stats(spark, sf):
    """Mean and scale over all rows before the test span, validation included."""
    st = ST.standardisation_stats(split_frame(spark, sf), _FEATURES, "before_split")
    return st.select(*KEY, *[r6(c).alias(c) for c in st.columns if c not in KEY])


# --------------------------------------------------------------------------- forecasts
_FC = _SPLIT + [Q.forecasts(_FEATURES, "fs")]


def r4(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 4)


@register("w17_ar_forecast", Q.with_(*_FC) + f"""
SELECT {Q.SERIES}, ts, p::INTEGER AS p, q::INTEGER AS q, round(coalesce(coef[1], 0), 6) AS phi_1, round(coalesce(coef[2], 0), 6) AS phi_2,
       round(coalesce(coef[3], 0), 6) AS theta_1, round(coalesce(coef[4], 0), 6) AS theta_2, round(ar, 4) AS ar
FROM fct WHERE split_label = 'test'""")
def w17_ar_forecast(spark, sf):
    t = forecast_table(spark, sf).where(F.col("split_label") == "test")
    names = ("phi_1", "phi_2", "theta_1", "theta_2")
    return t.select(*KEY, "ts", "p", "q", *(r6(F.coalesce(F.element_at("coef", i + 1), F.lit(0.0))).alias(c) for i, c in enumerate(names)),
                    r4("ar").alias("ar"))


@register("a14_blend_weight", Q.with_(*_FC) + f"""
SELECT {Q.SERIES}, round(best_w, 6) AS best_w, round(best_mse, 9) AS best_mse FROM bw""")
def a14_blend_weight(spark, sf):
    val = log_forecasts(spark, sf).where(F.col("split_label") == "val")
    w = FC.blend_weight(val, "ar_log", "lr_log", "actual_log")
    return w.select(*KEY, r6("best_w").alias("best_w"), F.round("best_mse", 9).alias("best_mse"))


@register("w19_blended_forecast", Q.with_(*_FC) + f"""
SELECT {Q.SERIES}, ts, round(hybrid, 4) AS hybrid, NOT (best_w > 0.05 AND best_w < 0.95) AS collapsed
FROM fct WHERE split_label = 'test'""")
def w19_blended_forecast(spark, sf):
    t = forecast_table(spark, sf).where(F.col("split_label") == "test")
    return t.select(*KEY, "ts", r4("hybrid").alias("hybrid"), "collapsed")


_MODELS = ["naive", "ar", "lr", "hybrid"]


@register("a10_forecast_metrics", Q.with_(*_FC) + f"""
SELECT {Q.SERIES}, model, count(pred) AS n, round(avg(abs(pred - actual)), 4) AS mae,
       round(sqrt(avg((pred - actual) * (pred - actual))), 4) AS rmse,
       round(avg(abs(pred - actual) / actual) * 100, 6) AS mape_pct
FROM (SELECT {Q.SERIES}, actual, unnest(['naive', 'ar', 'lr', 'hybrid']) AS model,
             unnest([naive, ar, lr, hybrid]) AS pred FROM fct WHERE split_label = 'test')
GROUP BY {Q.SERIES}, model""")
def a10_forecast_metrics(spark, sf):
    t = forecast_table(spark, sf).where(F.col("split_label") == "test")
    m = ST.forecast_metrics(t, _MODELS, "actual", KEY)
    return m.select(*KEY, "model", "n", r4("mae").alias("mae"), r4("rmse").alias("rmse"), r6("mape_pct").alias("mape_pct"))


@register("a15_model_gap", Q.with_(*_FC) + f"""
SELECT {Q.SERIES}, round(avg(abs(ar - lr)), 4) AS gap_mean, round(max(abs(ar - lr)), 4) AS gap_max
FROM fct WHERE split_label = 'test' GROUP BY {Q.SERIES}""")
def a15_model_gap(spark, sf):
    t = forecast_table(spark, sf).where(F.col("split_label") == "test")
    g = ST.model_gap(t, "ar", "lr", KEY)
    return g.select(*KEY, r4("gap_mean").alias("gap_mean"), r4("gap_max").alias("gap_max"))


@register("w15_smoothed_abs_error", Q.with_(*_FC) + f"""
SELECT {Q.SERIES}, ts, round(CASE WHEN count(e) OVER w = 5 THEN avg(e) OVER w END, 4) AS mae_5
FROM (SELECT *, abs(hybrid - actual) AS e FROM fct WHERE split_label = 'test')
WINDOW w AS (PARTITION BY {Q.SERIES} ORDER BY ts ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""")
def w15_smoothed_abs_error(spark, sf):
    t = forecast_table(spark, sf).where(F.col("split_label") == "test")
    return t.select(*KEY, "ts", r4(S.smoothed_abs_error(F.col("hybrid") - F.col("actual"), 5)).alias("mae_5"))


@register("w16_forecast_returns", Q.with_(*_FC) + f"""
SELECT {Q.SERIES}, ts, round(actual / prev_close - 1, 6) AS actual_ret, round(ar / prev_close - 1, 6) AS ar_ret,
       round(lr / prev_close - 1, 6) AS lr_ret, round(hybrid / prev_close - 1, 6) AS hybrid_ret,
       round(naive / prev_close - 1, 6) AS naive_ret
FROM fct WHERE split_label = 'test'""")
def w16_forecast_returns(spark, sf):
    t = forecast_table(spark, sf).where(F.col("split_label") == "test")
    r = FC.forecast_returns(t, _MODELS, "prev_close", "actual")
    return r.select(*KEY, "ts", *[r6(f"{m}_ret").alias(f"{m}_ret") for m in ["actual", *_MODELS]])


@register("j3_forecast_alignment", Q.with_(*_FC, f"""nxt AS (
  SELECT ticker, ts, lead(close) OVER (PARTITION BY {Q.SERIES} ORDER BY ts) AS next_close FROM bars_1d)""") + """
SELECT f.ticker, f.ts, round(n.next_close, 6) AS next_close, round(f.ar, 4) AS ar
FROM fct f JOIN nxt n ON f.ticker = n.ticker AND f.ts = n.ts AND n.next_close IS NOT NULL
WHERE f.split_label = 'test'""")
def j3_forecast_alignment(spark, sf):
    pred = forecast_table(spark, sf).where(F.col("split_label") == "test").select("ticker", "ts", "ar")
    actual = (D.bars_1d(spark, sf)
              .select("ticker", "ts", S.next_value(F.col("close"), S.series_window()).alias("next_close"))
              .where(F.col("next_close").isNotNull()))
    j = FC.align_forecast(pred, actual, ("ticker", "ts"))
    return j.select("ticker", "ts", r6("next_close").alias("next_close"), r4("ar").alias("ar"))


@register("w18_linear_return_model", Q.with_(*_SPLIT, Q.window_model(_FEATURES, "fs")) + f"""
SELECT {Q.SERIES}, ts, round(ret_hat, 6) AS ret_hat, round(exp(lr_log), 4) AS lr_pred
FROM lr_fc WHERE split_label = 'test' AND lr_log IS NOT NULL""")
def w18_linear_return_model(spark, sf):
    """One ridge regression per series on its standardised feature windows."""
    fs = stored_table(split_frame(spark, sf), "split-frame")
    pred = FC.window_return_forecast(fs, stored_table(FC.window_return_fit(fs, _FEATURES), "return-fit"), _FEATURES)
    pred = pred.where((F.col("split_label") == "test") & F.col("lr_log").isNotNull())
    return pred.select(*KEY, "ts", r6("ret_hat").alias("ret_hat"), r4(F.exp("lr_log")).alias("lr_pred"))


# --------------------------------------------------------------------------- J2 / P14
_REINDEX = [Q.bars_1d(), Q.rollup("bars_1d", "1wk", "bars_1wk"), """reidx AS (
  SELECT w.ticker, w.ts, w.close AS week_close, d.close AS day_close, d.volume AS day_volume
  FROM bars_1wk w LEFT JOIN bars_1d d ON w.ticker = d.ticker AND w.ts = d.ts)"""]


def _reindex(spark, sf):
    d = D.bars_1d(spark, sf)
    wk = B.rollup_bars(d, "1wk").select("ticker", "ts", F.col("close").alias("week_close"))
    day = d.select("ticker", "ts", F.col("close").alias("day_close"), F.col("volume").alias("day_volume"))
    return ST.left_reindex(wk, day, ("ticker", "ts"))


@register("j2_left_reindex", Q.with_(*_REINDEX) + "SELECT * FROM reidx")
def j2_left_reindex(spark, sf):
    return _reindex(spark, sf).select("ticker", "ts", "week_close", "day_close", "day_volume")


@register("p14_drop_incomplete", Q.with_(*_REINDEX) + """
SELECT * FROM reidx WHERE day_close IS NOT NULL AND NOT isnan(day_close) AND day_volume IS NOT NULL""")
def p14_drop_incomplete(spark, sf):
    r = _reindex(spark, sf).select("ticker", "ts", "week_close", "day_close", "day_volume")
    return B.drop_incomplete(r, ["day_close", "day_volume"])


# --------------------------------------------------------------------------- intraday: I6 / S3 / W12 / W13 / A9 / A16
_TICK_BARS = [Q.TICKS, Q.bars_from_ticks(ALL_INTERVALS, "bars_all")]


@register("i6_bars_from_ticks", Q.with_(*_TICK_BARS) + f"""
SELECT {Q.SERIES}, ts, open, high, low, close, volume, n_ticks FROM bars_all""")
def i6_bars_from_ticks(spark, sf):
    b = B.bars_from_ticks(D.ticks(spark, sf), ALL_INTERVALS)
    return b.select(*KEY, "ts", "open", "high", "low", "close", "volume", "n_ticks")


_INTRA = [Q.TICKS, Q.bars_from_ticks()]


@register("w12_last_n_days", Q.with_(*_INTRA) + f"""
SELECT {Q.SERIES}, ts, close FROM bars_intraday
QUALIFY ts >= date_trunc('day', max(ts) OVER (PARTITION BY {Q.SERIES})) - INTERVAL 6 DAY""")
def w12_last_n_days(spark, sf):
    return S.last_n_days(D.bars_by_series(spark, sf), 7).select(*KEY, "ts", "close")


_LOADED = [Q.TICKS, Q.TICK_SOURCES, Q.source_bars(["5m"])]
_FILE_ORDER = {"legacy": 0, "stored": 1, "fresh": 2}  # files of a series in load order


@register("s3_intraday_load", Q.with_(*_LOADED, f"""loaded AS (
  SELECT * FROM src_bars QUALIFY row_number() OVER (PARTITION BY {Q.SERIES}, ts
    ORDER BY CASE src WHEN 'legacy' THEN 0 WHEN 'stored' THEN 1 ELSE 2 END DESC) = 1)""") + f"""
SELECT {Q.SERIES}, ts, open, high, low, close, volume FROM loaded
QUALIFY ts >= date_trunc('day', max(ts) OVER (PARTITION BY {Q.SERIES})) - INTERVAL 2 DAY""")
def s3_intraday_load(spark, sf):
    """5-minute bars of every series from all its files: of rows with one time
    the last file's is kept; the last 3 calendar days."""
    files = D.intraday_sources(spark, sf, ["5m"])
    rows = [b.select(*KEY, "ts", "open", "high", "low", "close", "volume").withColumn("seq", F.lit(_FILE_ORDER[src]))
            for src, b in files.items()]
    b = B.last_write_wins(reduce(DataFrame.unionByName, rows), [*KEY, "ts"], ("seq",))
    return S.last_n_days(b, 3).select(*KEY, "ts", "open", "high", "low", "close", "volume")


@register("w13_latest_session", Q.with_(*_INTRA) + f"""
SELECT {Q.SERIES}, ts, close FROM bars_intraday
QUALIFY CAST(ts AS DATE) = CAST(max(ts) OVER (PARTITION BY {Q.SERIES}) AS DATE)""")
def w13_latest_session(spark, sf):
    return S.latest_session(D.bars_by_series(spark, sf)).select(*KEY, "ts", "close")


@register("a9_session_stats", Q.with_(*_INTRA) + f"""
SELECT {Q.SERIES}, count(*) AS bars, count(DISTINCT CAST(ts AS DATE)) AS sessions,
       round(avg(ret), 6) AS mean_ret, round(stddev_samp(ret), 6) AS std_ret,
       round(min(ret), 6) AS min_ret, round(max(ret), 6) AS max_ret, min(ts) AS first_ts, max(ts) AS last_ts
FROM (SELECT *, close / lag(close) OVER (PARTITION BY {Q.SERIES} ORDER BY ts) - 1 AS ret FROM bars_intraday)
GROUP BY {Q.SERIES}""")
def a9_session_stats(spark, sf):
    s = ST.session_stats(D.bars_by_series(spark, sf), "close")
    return s.select(*KEY, "bars", "sessions", *[r6(c).alias(c) for c in
                                              ("mean_ret", "std_ret", "min_ret", "max_ret")],
                    "first_ts", "last_ts")


@register("a16_series_coverage", Q.with_(Q.bars_1d(), *_INTRA) + f"""
SELECT {Q.SERIES}, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS bars
FROM (SELECT {Q.SERIES}, ts FROM bars_1d UNION ALL SELECT {Q.SERIES}, ts FROM bars_intraday)
GROUP BY {Q.SERIES}""")
def a16_series_coverage(spark, sf):
    allb = D.bars_1d(spark, sf).select(*KEY, "ts").unionByName(
        D.bars_intraday(spark, sf).select(*KEY, "ts"))
    return ST.coverage(allb)


# --------------------------------------------------------------------------- series too long for one task
_MINUTE = [Q.TICKS, Q.bars_from_ticks(["1m"], "bars_1m")]


@register("w3_long_series_returns", Q.with_(*_MINUTE) + f"""
SELECT {Q.SERIES}, ts, round(close / lag(close) OVER (PARTITION BY {Q.SERIES} ORDER BY ts) - 1, 6) AS ret
FROM bars_1m QUALIFY ret IS NOT NULL""")
def w3_long_series_returns(spark, sf):
    """Returns of minute bars, windows by (series, time bucket) with halo rows."""
    return LS.returns(D.bars_intraday(spark, sf, ["1m"])).select(*KEY, "ts", r6("ret").alias("ret"))


@register("w8_long_series_features", Q.with_(*_MINUTE, f"px AS (SELECT *, close AS price FROM bars_1m)", Q.features("px")) + f"""
SELECT {Q.SERIES}, ts, round(log_ret, 6) AS log_ret, round(sma_5, 6) AS sma_5, round(vol_20, 6) AS vol_20,
       round(volume_z, 6) AS volume_z, round(target, 6) AS target FROM feat""")
def w8_long_series_features(spark, sf):
    """The feature frame (W7-W10) of minute bars, by (series, time bucket)."""
    f = LS.feature_frame(D.bars_intraday(spark, sf, ["1m"]), "close")
    return f.select(*KEY, "ts", *(r6(c).alias(c) for c in ("log_ret", "sma_5", "vol_20", "volume_z", "target")))
