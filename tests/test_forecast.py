"""Order choice, window regression and blend against plain numpy versions."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from barforge.operators import forecast as FC
from barforge.operators.regression import product_sums, products, row_count, solved, system

UTC = dt.timezone.utc
KEY = ["asset_class", "interval", "ticker"]
FEATURES = ["f1", "f2", "f3"]


def arma(n, phi, theta, seed):
    rng = np.random.default_rng(seed)
    e, r = rng.normal(0, 0.02, n), np.zeros(n)
    for t in range(n):
        r[t] = e[t] + sum(c * r[t - i - 1] for i, c in enumerate(phi) if t > i) + sum(c * e[t - i - 1] for i, c in enumerate(theta) if t > i)
    return r


SERIES = {"AR": arma(700, [0.6], [], 1), "MA": arma(700, [], [0.7], 2), "AR2": arma(700, [0.3, -0.5], [], 3), "MIX": arma(900, [0.5], [0.4], 4),
          "FLAT": np.zeros(200), "SHORT": arma(9, [0.5], [], 5), "ONE": arma(1, [], [], 6)}


def frame(spark):
    rng = np.random.default_rng(9)
    rows = []
    for name, r in SERIES.items():
        test, val = len(r) - min(90, len(r) // 3), int(0.85 * (len(r) - min(90, len(r) // 3)))
        p = np.cumsum(r) + 4
        f = rng.normal(0, [1, 3, 0.5], (len(r), 3)) + np.outer(r, [10, 0, 1])
        f[:, 2] = 2.0 if name == "FLAT" else f[:, 2]
        for t in range(len(r)):
            target = float(r[t + 1]) if t + 1 < len(r) else None
            rows.append(("c", "1d", name, dt.datetime(2020, 1, 1, tzinfo=UTC) + dt.timedelta(days=t), float(r[t]), float(p[t]),
                         *map(float, f[t]), target, t < val, t < test))
    ddl = "asset_class string, interval string, ticker string, ts timestamp, log_ret double, log_price double, f1 double, f2 double, f3 double, "
    return spark.createDataFrame(rows, ddl + "target double, is_train boolean, before_split boolean").repartition(4)


def least_squares(x, y):
    return np.linalg.solve(x.T @ x, x.T @ y)


def plain_arma(r, val, test):
    """Order and coefficients of both fits, by dense least squares."""
    n, m = len(r), FC.LONG_LAGS
    lags = np.array([[r[t - i] if t >= i else np.nan for i in range(1, m + 1)] for t in range(n)])
    out = {}
    for name, end in (("val", val), ("test", test)):
        long = least_squares(lags[m:end], r[m:end])
        e = np.full(n, np.nan)
        e[m:] = r[m:] - lags[m:] @ long
        x = np.column_stack([lags[:, :2], np.roll(e, 1), np.roll(e, 2)])
        out[name] = x, e, {}
        for p, q in FC.ORDERS:
            use = [*range(p), *range(2, 2 + q)]
            rows = slice(m + 2, end)
            beta = least_squares(x[rows][:, use], r[rows])
            rest = r[rows] - x[rows][:, use] @ beta
            k = end - m - 2
            out[name][2][p, q] = (dict(zip(use, beta)), k * math.log(rest @ rest / k) + 2 * (p + q + 1))
    best = min(FC.ORDERS, key=lambda o: out["test"][2][o][1])
    return best, {k: [v[2][best][0].get(i, 0.0) for i in range(4)] for k, v in out.items()}, {k: v[1] for k, v in out.items()}


def test_order_and_coefficients_equal_numpy(spark):
    feat = frame(spark)
    fit = {r["ticker"]: r for r in FC.arma_fit(feat).collect()}
    for name in ("AR", "MA", "AR2", "MIX"):
        r = SERIES[name]
        test, val = len(r) - 90, int(0.85 * (len(r) - 90))
        order, coef, _ = plain_arma(r, val, test)
        got = fit[name]
        assert (got["p"], got["q"]) == order
        assert np.allclose([c or 0.0 for c in got["test"]], coef["test"], atol=1e-9)
        assert np.allclose([c or 0.0 for c in got["val"]], coef["val"], atol=1e-9)
    assert abs(fit["AR2"]["test"][1] + 0.5) < 0.1 and fit["MA"]["q"] >= 1


def test_forecasts_equal_numpy(spark):
    feat = frame(spark)
    rows = FC.arma_forecast(feat, FC.arma_fit(feat)).where("ticker = 'MIX'").orderBy("ts").collect()
    r = SERIES["MIX"]
    test, val = len(r) - 90, int(0.85 * (len(r) - 90))
    _, coef, residual = plain_arma(r, val, test)
    p = np.cumsum(r) + 4
    for t in (20, val, test - 1, test, len(r) - 1):
        c, e = (coef["val"], residual["val"]) if t < test else (coef["test"], residual["test"])
        want = p[t] + c[0] * r[t] + c[1] * r[t - 1] + c[2] * e[t] + c[3] * e[t - 1]
        assert math.isclose(rows[t]["ar_log"], want, abs_tol=1e-9)


def test_series_without_a_fit_forecast_their_price(spark):
    feat = frame(spark)
    rows = FC.arma_forecast(feat, FC.arma_fit(feat)).where("ticker in ('FLAT', 'ONE', 'SHORT')")
    assert rows.where("ar_log is null").count() == 0 and rows.count() == 210
    assert rows.where("ticker = 'FLAT' and ar_log != log_price").count() == 0


def test_window_model_equals_numpy(spark):
    feat = frame(spark)
    fit = FC.window_return_fit(feat, FEATURES)
    rows = FC.window_return_forecast(feat, fit, FEATURES)
    whole = {n: rows.where(F.col("ticker") == n).orderBy("ts").collect() for n in ("AR", "MIX", "SHORT", "FLAT")}
    for name in ("AR", "MIX"):
        got = whole[name]
        n, r = len(got), SERIES[name]
        test, val = n - 90, int(0.85 * (n - 90))
        f = np.array([[g[c] for c in FEATURES] for g in got])
        z = (f - f[:test].mean(0)) / f[:test].std(0)
        x = np.array([[1.0, *z[t - 1], *z[t - FC.LOOKBACK:t].mean(0)] for t in range(FC.LOOKBACK, n)])
        train, y = x[:val - FC.LOOKBACK], r[FC.LOOKBACK + 1:val + 1]
        ridge = np.diag([0.0] + [FC.RIDGE * len(train)] * 6)
        beta = np.linalg.solve(train.T @ train + ridge, train.T @ y)
        assert [g["ret_hat"] for g in got[:FC.LOOKBACK]] == [None] * FC.LOOKBACK
        assert np.allclose([g["ret_hat"] for g in got[FC.LOOKBACK:]], x @ beta, atol=1e-10)
        assert all(g["lr_log"] == g["log_price"] + g["ret_hat"] for g in got[FC.LOOKBACK:])
    assert all(g["ret_hat"] is None for g in whole["SHORT"])
    assert all(abs(g["ret_hat"]) < 1e-12 for g in whole["FLAT"][FC.LOOKBACK:])


@pytest.mark.parametrize("k", [1, 3, 9])
def test_solved_equals_numpy(spark, k):
    rng = np.random.default_rng(k)
    x, y = rng.normal(0, 1, (50, k)), rng.normal(0, 1, 50)
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y)], ", ".join(f"x{i} double" for i in range(k)) + ", y double")
    df = df.withColumn("p", products(f"array({', '.join(f'x{i}' for i in range(k))})", "y"))
    sums = df.groupBy().agg(product_sums("p").alias("s"))
    got = sums.selectExpr(solved(system("s", k, ridge="0.5D"), k) + " AS b", row_count("s", k) + " AS n").first()
    assert np.allclose(got["b"], np.linalg.solve(x.T @ x + 0.5 * np.eye(k), x.T @ y), atol=1e-12) and got["n"] == 50
    only = f"array({', '.join(str(i == 0) for i in range(k))})"
    part = sums.selectExpr(solved(system("s", k, used=only), k) + " AS b").first()["b"]
    assert math.isclose(part[0], x[:, 0] @ y / (x[:, 0] @ x[:, 0])) and part[1:] == [0.0] * (k - 1)
