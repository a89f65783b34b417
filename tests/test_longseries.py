"""Bucketed windows equal the plain ones, on one long series too."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barforge.operators import longseries as LS
from barforge.operators import series as S

UTC = dt.timezone.utc
KEY = ["asset_class", "interval", "ticker"]


@pytest.fixture(scope="module")
def bars(spark):
    """One series with a third of all rows, sparse ones, one with long gaps, a null key."""
    rng, rows = random.Random(4), []
    for t, n, gap in [("HOT", 900, 1), *((f"T{i}", 150, 3) for i in range(10)), ("GAPS", 120, 400), ("ONE", 1, 1), (None, 40, 9)]:
        at = dt.datetime(2024, 1, 1, tzinfo=UTC)
        for _ in range(n):
            at += dt.timedelta(minutes=rng.randint(1, 2 * gap - 1))
            rows.append(("c", "1m", t, at, rng.uniform(50, 150), rng.randint(0, 9)))
    return spark.createDataFrame(rows, "asset_class string, interval string, ticker string, ts timestamp, close double, volume bigint").repartition(5)


def same(a, b):
    def rows(df):
        return sorted((tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(*sorted(df.columns)).collect()), key=str)
    left, right = rows(a), rows(b)
    assert left == right and left


@pytest.mark.parametrize("steps", [8, 64, 100_000])
def test_equal_to_plain_windows(bars, steps):
    same(LS.returns(bars, steps=steps), S.returns(bars))
    same(LS.feature_frame(bars, "close", steps=steps), S.feature_frame(bars, "close"))


def test_feature_windows_and_errors(bars):
    f = bars.select(*KEY, "ts", "close", F.col("volume").cast("double").alias("v"))
    got = LS.feature_windows(f, ["close", "v"], 30, steps=16).withColumn("window", F.to_json("window"))
    same(got, S.feature_windows(f, ["close", "v"], 30).withColumn("window", F.to_json("window")))
    e = f.withColumn("err", F.col("close") - 100)
    same(LS.smoothed_abs_error(e, "err", steps=16), e.withColumn("smoothed", S.smoothed_abs_error(F.col("err"), 5)))


def test_halo_holds_exactly_the_rows_asked_for(bars):
    halo = LS.with_halo(bars, 7, 2, steps=16)
    rows = {}
    for r in bars.collect():
        rows.setdefault(r["ticker"], []).append(r["ts"])
    got = {}
    for r in halo.collect():
        got.setdefault((r["ticker"], r[LS.BUCKET]), []).append((r["ts"], r[LS.COPY]))
    for (t, _), held in got.items():
        series, own = sorted(rows[t]), sorted(x for x, copy in held if not copy)
        a, b = series.index(own[0]), series.index(own[-1])
        assert own == series[a:b + 1] and len(own) <= 17
        assert sorted(x for x, copy in held if copy) == series[max(0, a - 7):a] + series[b + 1:b + 3]


def test_plan_partitions_by_bucket(bars):
    plan = LS.feature_frame(bars, "close", steps=64)._jdf.queryExecution().executedPlan().toString()
    windows = [x for x in plan.splitlines() if " Window " in x or x.strip().startswith("Window")]
    assert any("avg" in x for x in windows)
    assert all(LS.BUCKET in x for x in windows if "lag(" in x or "avg(" in x or "lead(" in x)


def test_empty(spark, bars):
    assert LS.returns(bars.limit(0)).collect() == []
