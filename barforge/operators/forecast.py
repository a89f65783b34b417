"""Forecasting operators (W16-W19, A14) for all series at once.

Log prices are modelled as ARIMA(p, 1, q), p and q up to 2, by the two-stage
regression of Hannan and Rissanen: a long autoregression of the log returns
gives residuals, and returns are regressed on their own lags and the residuals'
lags. Every order's fit follows from one table of sums per series, so the order
with the least AIC is chosen without a solver that iterates. The return model
(W18) is a ridge regression per series on the standardised feature windows.
Alignment is the one-step rule: information through t, target t+1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.operators.regression import (dot, product_sums, products, right_side, row_count, solved, system,
                                           target_squares)
from barforge.schema import SERIES_KEY

#: Lags of the long autoregression, and the largest p and q.
LONG_LAGS, MAX_ORDER = 5, 2
#: (p, q) in the order they are tried; the first of equal AICs is taken.
ORDERS = [(p, q) for p in range(MAX_ORDER + 1) for q in range(MAX_ORDER + 1) if p + q]
#: Rows of a feature window, and the ridge per training row.
LOOKBACK, RIDGE = 30, 1e-3


_FITS = ("val", "test")
_LAGS = [f"_r{i}" for i in range(1, LONG_LAGS + 1)]


def _array(names) -> str:
    return f"array({', '.join(names)})"


def _with_lags(feat: DataFrame, key) -> DataFrame:
    w = Window.partitionBy(*key).orderBy("ts")
    return feat.withColumns({c: F.lag("log_ret", i + 1).over(w) for i, c in enumerate(_LAGS)})


def _with_residuals(rows: DataFrame, key) -> DataFrame:
    """``_e_val``, ``_e_test`` (of the two long autoregressions) and their lags."""
    w = Window.partitionBy(*key).orderBy("ts")
    rows = rows.withColumns({f"_e_{f}": F.expr(f"IF({_LAGS[-1]} IS NOT NULL, log_ret - {dot(f'long_{f}', _array(_LAGS))}, NULL)")
                             for f in _FITS})
    return rows.withColumns({f"_e{i}_{f}": F.lag(f"_e_{f}", i).over(w) for f in _FITS for i in range(1, MAX_ORDER + 1)})


def arma_fit(feat: DataFrame, key=SERIES_KEY, train_col: str = "is_train",
             before_test_col: str = "before_split") -> DataFrame:
    """One row per series: order ``p``, ``q``, coefficients ``val`` and
    ``test`` (phi_1, phi_2, theta_1, theta_2) and those of the long
    autoregressions, ``long_val`` and ``long_test``.

    The order is chosen on the rows before the test span. The ``val`` fits use
    the training rows, the ``test`` fits all rows before the test span. Rows
    without all lags are not fitted; singular sums give null coefficients."""
    key = list(key)
    spans = {"val": train_col, "test": before_test_col}
    rows = _with_lags(feat.select(*key, "ts", "log_ret", train_col, before_test_col), key)
    full = rows.where(F.col(_LAGS[-1]).isNotNull()).withColumns({f"_x_{f}": products(_array(_LAGS), "log_ret", on) for f, on in spans.items()})
    sums = full.groupBy(*key).agg(*(product_sums(f"_x_{f}").alias(f"_{f}") for f in _FITS))
    long_fit = sums.select(*key, *(F.expr(solved(system(f"_{f}", LONG_LAGS), LONG_LAGS)).alias(f"long_{f}") for f in _FITS))
    k = 2 * MAX_ORDER
    rows = _with_residuals(rows.join(long_fit, key), key).where(F.col(f"_e{MAX_ORDER}_test").isNotNull())
    rows = rows.withColumns({f"_x_{f}": products(_array([*_LAGS[:MAX_ORDER], *(f"_e{i}_{f}" for i in range(1, MAX_ORDER + 1))]), "log_ret", on)
                             for f, on in spans.items()})
    sums = rows.groupBy(*key).agg(F.any_value("long_val").alias("long_val"), F.any_value("long_test").alias("long_test"),
                                  *(product_sums(f"_x_{f}").alias(f"_{f}") for f in _FITS))
    orders = _array(f"named_struct('at', {i}, 'p', {p}, 'q', {q}, 'used', {_array(str(r < p or MAX_ORDER <= r < MAX_ORDER + q) for r in range(k))})"
                    for i, (p, q) in enumerate(ORDERS))
    tried = ", ".join(f"'{f}', {solved(system(f'_{f}', k, 'o.used'), k)}" for f in _FITS)
    fits = sums.withColumn("_tried", F.expr(f"transform({orders}, o -> named_struct('at', o.at, 'p', o.p, 'q', o.q, {tried}))"))
    left, n = f"({target_squares('_test', k)} - {dot('o.test', right_side('_test', k))})", row_count("_test", k)
    scored = (f"transform(_tried, o -> named_struct('aic', IF({left} > 0 AND {n} > 0, {n} * ln({left} / {n}) + 2 * (o.p + o.q + 1), NULL), "
              "'at', o.at, 'p', o.p, 'q', o.q, 'val', o.val, 'test', o.test))")
    best = F.expr(f"array_min(filter({scored}, o -> o.aic IS NOT NULL))").alias("_b")
    return fits.select(*key, "long_val", "long_test", best).select(
        *key, "long_val", "long_test", "_b.p", "_b.q", "_b.val", "_b.test")


def arma_forecast(feat: DataFrame, fit: DataFrame, key=SERIES_KEY, before_test_col: str = "before_split") -> DataFrame:
    """Adds ``p``, ``q``, ``coef`` and ``ar_log``, the forecast of the next
    row's log price: the ``val`` coefficients of :func:`arma_fit` forecast up to
    the end of validation, the ``test`` coefficients the test span. Lags that a
    row lacks, and coefficients that a series lacks, count as zero."""
    key = list(key)
    rows = _with_residuals(_with_lags(feat.join(fit, key, "left"), key), key)
    rows = rows.withColumn("coef", F.when(F.col(before_test_col), F.col("val")).otherwise(F.col("test")))
    residuals = [f"coalesce(IF({before_test_col}, _{e}_val, _{e}_test), 0D)" for e in ("e", "e1")]
    step = dot("coef", _array(["log_ret", "coalesce(_r1, 0D)", *residuals]))
    return rows.withColumn("ar_log", F.expr(f"log_price + {step}")).select(*feat.columns, "p", "q", "coef", "ar_log")


def _window_inputs(feat: DataFrame, features, key, before_test_col: str, lookback: int):
    """(rows, inputs, usable rows): the last two as SQL texts, an array and a
    condition on ``rows``."""
    by = ", ".join(f"`{c}`" for c in key)
    whole, along = f"(PARTITION BY {by})", f"(PARTITION BY {by} ORDER BY ts)"
    before = f"(PARTITION BY {by} ORDER BY ts ROWS BETWEEN {lookback} PRECEDING AND 1 PRECEDING)"
    rows = feat.selectExpr("*", *(f"{how}(IF({before_test_col}, {c}, NULL)) OVER {whole} AS _{n}_{c}"
                                  for c in features for n, how in (("m", "avg"), ("s", "stddev_pop"))))
    rows = rows.selectExpr("*", *(f"({c} - _m_{c}) / IF(_s_{c} < 1e-8, 1D, _s_{c}) AS _z_{c}" for c in features))
    rows = rows.selectExpr("*", *(f"lag(_z_{c}) OVER {along} AS _l_{c}" for c in features),
                           *(f"avg(_z_{c}) OVER {before} AS _a_{c}" for c in features), f"count(*) OVER {before} = {lookback} AS _full")
    names = [f"_{n}_{c}" for n in ("l", "a") for c in features]
    return rows, _array(["1D", *names]), " AND ".join(["_full", *(f"{c} IS NOT NULL" for c in names)])


def window_return_fit(feat: DataFrame, features, key=SERIES_KEY, train_col: str = "is_train",
                      before_test_col: str = "before_split", lookback: int = LOOKBACK, ridge: float = RIDGE) -> DataFrame:
    """One row per series with ``beta``, a ridge regression of the next log
    return on the feature window before each row.

    Features are standardised with the mean and scale of the rows before the
    test span (A17). A window of ``lookback`` rows enters by its last row and
    its mean, per feature; training rows with a full window are fitted: one
    grouped aggregate of products and one small system per series."""
    key = list(key)
    rows, inputs, usable = _window_inputs(feat.select(*key, "ts", *features, "target", train_col, before_test_col),
                                          features, key, before_test_col, lookback)
    k = 2 * len(features) + 1
    rows = rows.where(f"{usable} AND {train_col} AND target IS NOT NULL").withColumn("_x", products(inputs, "target"))
    sums = rows.groupBy(*key).agg(product_sums("_x").alias("_g"))
    return sums.select(*key, F.expr(solved(system("_g", k, ridge=f"{ridge!r}D * {row_count('_g', k)}", unpenalised=(0,)), k)).alias("beta"))


def window_return_forecast(feat: DataFrame, fit: DataFrame, features, key=SERIES_KEY,
                           before_test_col: str = "before_split", lookback: int = LOOKBACK) -> DataFrame:
    """Adds ``ret_hat``, the next log return by :func:`window_return_fit`,
    and ``lr_log``, the log price it implies. Both are null on rows without a
    full window; a series without training windows forecasts a return of 0."""
    key = list(key)
    rows, inputs, usable = _window_inputs(feat, features, key, before_test_col, lookback)
    rows = rows.join(fit, key, "left").withColumn("ret_hat", F.expr(f"IF({usable}, {dot('beta', inputs)}, NULL)"))
    return rows.withColumn("lr_log", F.col("log_price") + F.col("ret_hat")).select(*feat.columns, "ret_hat", "lr_log")


def _mse_grid(n, saa, sab, sbb, steps: int):
    """Closed-form MSE of w*a + (1-w)*b for w = i/steps, as an array of
    (mse, i) structs; ``array_min`` picks the lowest MSE, then the lowest i."""
    def one(i):
        w = i / F.lit(float(steps))
        mse = (w * w * saa + 2 * w * (1 - w) * sab + (1 - w) * (1 - w) * sbb) / n
        return F.struct(mse.alias("mse"), i.alias("i"))
    return F.transform(F.sequence(F.lit(0), F.lit(steps)), one)


def with_blend_weight(df: DataFrame, a_log: str, b_log: str, actual_log: str, val_col: str,
                      key=SERIES_KEY, steps: int = 100) -> DataFrame:
    """A14 as window aggregates over the series partition: adds ``best_w`` and
    ``best_mse`` to every row (see :func:`blend_weight`)."""
    whole = Window.partitionBy(*key)
    v = F.col(val_col)
    ea = F.col(a_log) - F.col(actual_log)
    eb = F.col(b_log) - F.col(actual_log)
    n = F.count(F.when(v, ea)).over(whole)
    saa = F.sum(F.when(v, ea * ea)).over(whole)
    sab = F.sum(F.when(v, ea * eb)).over(whole)
    sbb = F.sum(F.when(v, eb * eb)).over(whole)
    best = F.when(n > 0, F.array_min(_mse_grid(n, saa, sab, sbb, steps)))
    return (df.withColumn("_best", best)
            .withColumn("best_w", F.col("_best.i") / F.lit(float(steps)))
            .withColumn("best_mse", F.col("_best.mse")).drop("_best"))


def blend_weight(val: DataFrame, a_log: str, b_log: str, actual_log: str,
                 key=SERIES_KEY, steps: int = 100) -> DataFrame:
    """Weight w in {0, 1/steps, ..., 1} minimising the validation MSE of
    w*a + (1-w)*b in log space; the lowest weight wins ties.

    One pass computes three sums per series (sum ea^2, sum ea*eb, sum eb^2);
    the MSE of every weight follows in closed form on the tiny per-series row,
    so the data is never replicated per candidate weight."""
    ea = F.col(a_log) - F.col(actual_log)
    eb = F.col(b_log) - F.col(actual_log)
    sums = val.groupBy(*key).agg(F.count(ea).alias("n_val"), F.sum(ea * ea).alias("saa"),
                                 F.sum(ea * eb).alias("sab"), F.sum(eb * eb).alias("sbb"))
    best = F.array_min(_mse_grid(F.col("n_val"), F.col("saa"), F.col("sab"), F.col("sbb"), steps))
    return sums.select(*key, (best.getField("i") / F.lit(float(steps))).alias("best_w"),
                       best.getField("mse").alias("best_mse"))


def blended_forecast(df: DataFrame, weights: DataFrame | None, a_log: str, b_log: str,
                     key=SERIES_KEY) -> DataFrame:
    """exp(w*a + (1-w)*b); ``collapsed`` when w is outside (0.05, 0.95).
    ``weights`` is a per-series table, or None when ``df`` already carries
    ``best_w`` (see :func:`with_blend_weight`)."""
    w = F.col("best_w")
    out = df if weights is None else df.join(weights, list(key), "inner")
    return (out.withColumn("hybrid", F.exp(w * F.col(a_log) + (1 - w) * F.col(b_log)))
            .withColumn("collapsed", ~((w > 0.05) & (w < 0.95))))


def forecast_returns(df: DataFrame, models, prev: str = "prev_close",
                     actual: str = "actual") -> DataFrame:
    """Returns of actual and predicted prices relative to the origin close."""
    out = df.withColumn("actual_ret", F.col(actual) / F.col(prev) - 1)
    for m in models:
        out = out.withColumn(f"{m}_ret", F.col(m) / F.col(prev) - 1)
    return out


def align_forecast(pred: DataFrame, actual: DataFrame, key=("ticker", "ts")) -> DataFrame:
    """Predictions and actuals on shared keys; unmatched rows dropped."""
    return pred.join(actual, list(key), "inner")
