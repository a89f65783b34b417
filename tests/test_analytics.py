"""Series windows, statistics and forecasts against brute force."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barforge.operators import bars as B
from barforge.operators import forecast as FC
from barforge.operators import series as S
from barforge.operators import blocks as BL
from barforge.operators import stats as ST
from conftest import BAR_DDL, ts


def _series(spark, closes, ticker="X", adj=None):
    rows = [("c", "1d", ticker, ts(2024, 1, 1) + dt.timedelta(days=i), c, c, c, c,
             None if adj is None else adj[i], 10 + i % 3) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, BAR_DDL)


def test_returns_and_rolling(spark):
    closes = [10.0, 11.0, 12.1, 11.0, 12.0, 13.0, 12.5]
    r = S.returns(_series(spark, closes), "close").orderBy("ts").collect()
    assert len(r) == 6 and abs(r[0].ret - 0.1) < 1e-12
    assert abs(r[0].log_ret - math.log(1.1)) < 1e-12
    f = _series(spark, closes).select("ts", S.rolling_mean(F.col("close"), 3).alias("m"),
                                      S.rolling_std(F.col("close"), 3).alias("s")).orderBy("ts").collect()
    exp = pd.Series(closes).rolling(3)
    for row, m, s in zip(f, exp.mean(), exp.std()):
        assert (row.m is None and math.isnan(m)) or abs(row.m - m) < 1e-12
        assert (row.s is None and math.isnan(s)) or abs(row.s - s) < 1e-12


def test_adjusted_close_is_series_level(spark):
    a = _series(spark, [1.0, 2.0], "A", adj=[None, 1.9])
    b = _series(spark, [1.0, 2.0], "B")
    out = {(r.ticker, r.close): r.price for r in B.adjusted_close(a.unionByName(b)).collect()}
    assert out[("A", 1.0)] is None and out[("A", 2.0)] == 1.9 and out[("B", 1.0)] == 1.0


def test_row_tail_and_split(spark):
    s = _series(spark, [float(i + 1) for i in range(200)])
    assert S.row_tail(s, 5).count() == 5
    lab = S.positional_split(s, 90, 0.85).groupBy("split_label").count().collect()
    counts = {r.split_label: r["count"] for r in lab}
    assert counts == {"test": 90, "val": 110 - int(110 * 0.85), "train": int(110 * 0.85)}


def test_feature_windows_exclude_current(spark):
    s = _series(spark, [float(i + 1) for i in range(8)]).withColumn("x", F.col("close"))
    w = S.feature_windows(s, ["x"], 3).orderBy("ts").collect()
    assert [v[0] for v in w[0].window] == [1.0, 2.0, 3.0] and w[0].x == 4.0


def test_blend_weight_equals_brute_force(spark):
    rng = np.random.default_rng(7)
    a, b, y = rng.normal(size=50), rng.normal(size=50), rng.normal(size=50)
    rows = [("c", "1d", "X", float(a[i]), float(b[i]), float(y[i])) for i in range(50)]
    df = spark.createDataFrame(rows, "asset_class string, interval string, ticker string, a double, b double, y double")
    got = FC.blend_weight(df, "a", "b", "y").first().best_w
    best_w, best = 0.5, np.inf
    for w in np.linspace(0, 1, 101):
        mse = float(np.mean((w * a + (1 - w) * b - y) ** 2))
        if mse < best:
            best, best_w = mse, w
    assert abs(got - best_w) < 1e-9


def aligned_series(spark, n, rows, seed=3):
    rng = np.random.default_rng(seed)
    common = rng.normal(size=rows)
    data = {f"S{i:04d}": rng.normal(size=rows) + common * (i % 7) / 3 for i in range(n)}
    frame = pd.DataFrame(data)
    long = [(t, ts(2024, 1, 1) + dt.timedelta(days=i), float(v)) for t in data for i, v in enumerate(data[t])]
    return frame, spark.createDataFrame(pd.DataFrame(long, columns=["ticker", "ts", "ret"]))


def test_correlations_match_pandas(spark):
    frame, df = aligned_series(spark, 23, 40)
    exp = frame.corr()
    for block, chunk in ((256, 1024), (5, 7), (1, 40)):
        got = {(r.a, r.b): r["corr"] for r in BL.correlations(df, block=block, chunk=chunk).collect()}
        assert len(got) == 23 * 24 // 2 and all(a <= b for a, b in got)
        assert all(abs(v - exp.loc[k]) < 1e-9 for k, v in got.items())


def test_correlations_of_a_thousand_series(spark):
    frame, df = aligned_series(spark, 1000, 30)
    exp = np.corrcoef(frame.to_numpy().T)
    got = BL.correlations(df, block=128, top=3).toPandas()
    assert len(got) == 3000
    np.fill_diagonal(exp, -2)
    for a, own in got[got.a.isin([f"S{i:04d}" for i in (0, 5, 500, 999)])].groupby("a"):
        i = int(a[1:])
        want = sorted(range(1000), key=lambda j: (-exp[i, j], j))[:3]
        assert [int(b[1:]) for b in own.sort_values("rank").b] == want
    asked = spark.createDataFrame([("S0007", "S0003"), ("S0900", "S0001"), ("S0002", "S0002"), ("S0001", "none")], "a string, b string")
    got = {(r.a, r.b): r["corr"] for r in BL.correlations(df, block=128, pairs=asked).collect()}
    full = np.corrcoef(frame.to_numpy().T)
    assert set(got) == {("S0003", "S0007"), ("S0001", "S0900"), ("S0002", "S0002")}
    assert all(abs(v - full[int(a[1:]), int(b[1:])]) < 1e-9 for (a, b), v in got.items())


def test_correlations_of_constant_and_unaligned_series(spark):
    rows = [(t, ts(2024, 1, 1 + i), 1.0 if t == "B" else float(i * i)) for t in "ABC" for i in range(5)]
    df = spark.createDataFrame(rows, "ticker string, ts timestamp, ret double")
    got = {(r.a, r.b): r["corr"] for r in BL.correlations(df).collect()}
    assert got["A", "B"] is None and abs(got["A", "C"] - 1) < 1e-12
    with pytest.raises(Exception, match="not aligned"):
        BL.correlations(df.where("not (ticker = 'C' and day(ts) = 2)")).collect()
    assert BL.correlations(df.limit(0)).collect() == []


def test_align_arrays(spark):
    rows = [("B", ts(2024, 1, 2), 2.0), ("A", ts(2024, 1, 1), 9.0), ("A", ts(2024, 1, 2), 1.0)]
    got = ST.align_arrays(spark.createDataFrame(rows, "ticker string, ts timestamp, price double")).collect()
    assert [(r.series, r["values"]) for r in got] == [(["A", "B"], [1.0, 2.0])]


def test_align_long_keeps_common_timestamps(spark):
    rows = [("A", ts(2024, 1, 1)), ("A", ts(2024, 1, 2)), ("B", ts(2024, 1, 2))]
    df = spark.createDataFrame(rows, "ticker string, ts timestamp")
    assert ST.align_long(df, "ticker", 2).count() == 2


def test_bars_from_ticks_rollup(spark):
    rows = [("c", "X", ts(2024, 1, 1, 0, m, s), float(p), 1, i)
            for i, (m, s, p) in enumerate([(0, 5, 10), (0, 50, 12), (1, 10, 9), (7, 0, 11)])]
    t = spark.createDataFrame(rows, "asset_class string, ticker string, ts timestamp, price double, size long, seq long")
    out = {(r.interval, r.ts.replace(tzinfo=None)): r for r in B.bars_from_ticks(t, ["1m", "5m"]).collect()}
    five = out[("5m", dt.datetime(2024, 1, 1, 0, 0))]
    assert (five.open, five.high, five.low, five.close, five.volume) == (10.0, 12.0, 9.0, 9.0, 3)
    assert out[("1m", dt.datetime(2024, 1, 1, 0, 0))].close == 12.0
    assert out[("5m", dt.datetime(2024, 1, 1, 0, 5))].n_ticks == 1


def test_bars_from_ticks_hot_ticker_matches_pandas(spark):
    rng = np.random.default_rng(11)
    n = 3000
    tickers = np.where(np.arange(n) < n // 3, "HOT", np.array([f"T{i % 40}" for i in range(n)]))
    base = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
    secs = rng.integers(0, 6 * 3600, size=n)
    rows = [("c", str(tickers[i]), base + dt.timedelta(seconds=int(secs[i]), microseconds=int(i % 7)),
             float(rng.integers(100, 200)), int(rng.integers(1, 9)), i) for i in range(n)]
    t = spark.createDataFrame(rows, "asset_class string, ticker string, ts timestamp, price double, size long, seq long")
    got = {(r.ticker, r.interval, r.ts.replace(tzinfo=None)): (r.open, r.high, r.low, r.close, r.volume)
           for r in B.bars_from_ticks(t, ["5m", "1h"]).collect()}
    pdf = pd.DataFrame(rows, columns=["asset_class", "ticker", "ts", "price", "size", "seq"])
    pdf["ts"] = pd.to_datetime(pdf["ts"], utc=True).dt.tz_localize(None)
    for iv, freq in (("5m", "5min"), ("1h", "1h")):
        g = pdf.sort_values(["ts", "seq"]).assign(b=lambda d: d["ts"].dt.floor(freq)).groupby(["ticker", "b"])
        exp = g.agg(open=("price", "first"), high=("price", "max"), low=("price", "min"),
                    close=("price", "last"), volume=("size", "sum"))
        for (tk, b), r in exp.iterrows():
            assert got[(tk, iv, b.to_pydatetime())] == (r.open, r.high, r.low, r.close, r.volume)
    assert len(got) == sum(len(pdf.assign(b=pdf["ts"].dt.floor(f)).groupby(["ticker", "b"])) for f in ("5min", "1h"))


def _shuffled_rows(df):
    """Rows written to shuffles when ``df`` runs, by the plan's own counters."""
    df.collect()
    plan, seen, total = [df._jdf.queryExecution().executedPlan()], set(), 0
    while plan:
        node = plan.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            plan.append(node.executedPlan())
            continue
        if name in ("ShuffleQueryStageExec", "BroadcastQueryStageExec"):
            plan.append(node.plan())
            continue
        if name == "ShuffleExchangeExec" and node.id() not in seen:
            seen.add(node.id())
            total += node.metrics().apply("shuffleRecordsWritten").value()
        for i in range(node.children().size()):
            plan.append(node.children().apply(i))
    return total


def test_interval_lattice_shuffles_minute_bars_once(spark):
    """Every interval equals a direct roll-up, and the rows that travel are a
    third of one row per minute bar and interval at most."""
    from barforge.schema import ALL_INTERVALS
    rng = np.random.default_rng(8)
    start = dt.datetime(2024, 1, 30, 22, tzinfo=dt.timezone.utc)
    rows = [("c", f"X{rng.integers(0, 3)}", start + dt.timedelta(seconds=int(s)), float(rng.integers(1, 99)), int(rng.integers(0, 5)), i)
            for i, s in enumerate(rng.integers(0, 5 * 86400, 6000))]
    ticks = spark.createDataFrame(rows, "asset_class string, ticker string, ts timestamp, price double, size long, seq long").repartition(4)
    df = B.bars_from_ticks(ticks, ALL_INTERVALS)
    got = {(r.ticker, r.interval, r.ts): (r.open, r.high, r.low, r.close, r.volume, r.n_ticks) for r in df.collect()}
    want = {}
    for iv in ALL_INTERVALS:
        t = ticks.withColumn("b", B.bar_start("ts", iv)).orderBy("ts", "seq").toPandas()
        for (x, b), g in t.groupby(["ticker", "b"], sort=False):
            want[x, iv, b.to_pydatetime()] = (g.price.iloc[0], g.price.max(), g.price.min(), g.price.iloc[-1], g["size"].sum(), len(g))
    assert {(a, i, t.replace(tzinfo=None)): v for (a, i, t), v in got.items()} == {(a, i, t.replace(tzinfo=None)): v for (a, i, t), v in want.items()}
    minutes = sum(1 for k in want if k[1] == "1m")
    assert _shuffled_rows(df) - 6000 <= minutes * len(ALL_INTERVALS) / 3


def test_rollup_partitions_follow_the_ticks_files(spark, tmp_path, monkeypatch):
    """More tick bytes, more roll-up partitions: a task's share stays the same
    though the shuffle's own bytes would let them be joined."""
    rows = [("c", f"X{i % 7}", dt.datetime(2024, 1, 1 + i % 9, i % 24, i % 60, tzinfo=dt.timezone.utc), float(i % 13), 1, i) for i in range(4000)]
    path = f"{tmp_path}/ticks of a%b"
    spark.createDataFrame(rows, "asset_class string, ticker string, ts timestamp, price double, size long, seq long").repartition(4).write.parquet(path)
    ticks = spark.read.parquet(path)
    size = sum(f.stat().st_size for f in (tmp_path / "ticks of a%b").glob("*.parquet"))
    small = B.bars_from_ticks(ticks, ["1m", "5m"])
    want = sorted(small.collect())
    monkeypatch.setattr(B, "ROLLUP_BYTES", size // 20)
    large = B.bars_from_ticks(ticks, ["1m", "5m"])
    assert sorted(large.collect()) == want
    assert small.rdd.getNumPartitions() < 40 <= large.rdd.getNumPartitions() <= 42
