"""Counts, guard, readiness, slices."""

from barforge.plans import publish as P
from barforge.schema import slice_dim
from barforge.sources import store as ST
from conftest import BAR_DDL, daily_bars


def _tree(spark, paths):
    return ST.file_tree(spark.createDataFrame([(p,) for p in paths], "path string"))


def _counts(spark, d):
    return spark.createDataFrame(list(d.items()), "interval string, n_files long")


def _verdict(spark, prev, cur, required=(), include=None):
    g = P.publish_guard(_counts(spark, prev), _counts(spark, cur), required, include)
    return P.guard_verdict(g).first().refused


def test_counts_skip_control_files(spark):
    t = _tree(spark, ["crypto/1d/BTC-USD.csv", "crypto/1d/.gitkeep", "crypto/1m/ETH-USD.txt",
                      "dataset-metadata.json", "notes.md", ".kaggle-pull-state.json"])
    per, total = P.tree_counts(t)
    assert {r.interval: r.n_files for r in per.collect()} == {"1d": 1, "1m": 1}
    assert total.first().n_files == 3
    per_d, total_d = P.tree_counts(t, ["1d"])
    assert total_d.first().n_files == 1


def test_guard_cases(spark):
    assert _verdict(spark, {"1d": 100}, {"1d": 1}) is True                      # total shrink
    assert _verdict(spark, {}, {"1d": 5}, required=("1m",)) is True            # required missing
    assert _verdict(spark, {"1m": 1, "1d": 1}, {"1m": 0, "1d": 5}) is True     # 1m 1 -> 0
    assert _verdict(spark, {"1d": 3, "1m": 9}, {"1d": 3}, include=("1d",)) is False  # other slice ignored
    assert _verdict(spark, {"5m": 1}, {"5m": 1}) is False  # re-based after consolidation


def _ready(spark, current, versions, status="READY"):
    v = spark.createDataFrame(versions, "version int, status string").selectExpr("'d' AS dataset", "*")
    d = spark.createDataFrame([("d", current, status)], "dataset string, current_version int, status string")
    return P.version_readiness(v, d).first()


def test_version_readiness(spark):
    assert _ready(spark, 7, [(7, "READY"), (8, "FAILED")]).ready is True
    assert _ready(spark, 11, [(11, "READY"), (14, "PENDING")]).ready is False
    assert _ready(spark, 14, [(8, "FAILED"), (10, "FAILED"), (12, "FAILED"), (13, "FAILED"), (14, "READY")]).ready is True
    assert _ready(spark, 1, [(1, "READY"), (2, "DatasetStatus.PENDING")]).ready is False
    r = _ready(spark, 11, [(11, "READY"), (13, "FAILED")])
    assert r.ready is False and r.next_version == 14  # gap at 12 -> not ready
    assert _ready(spark, 7, [(7, "READY"), (8, "deleted")]).ready is True


def test_slices_and_split(spark):
    t = _tree(spark, ["c/1d/A.csv", "c/1m/A.csv", "c/5m/A.csv", "c/2h/A.csv", "c/.gitkeep"])
    dim = slice_dim(spark)
    assert sorted(r.interval for r in P.slice_files(t, dim, "daily").collect()) == ["1d"]
    parts = {(r.slice, r.interval) for r in P.split_slices(t, dim).collect()}
    assert parts == {("daily", "1d"), ("intraday", "1m"), ("intraday", "5m")}
    pats = sorted(r.pattern for r in P.ignore_patterns(spark, "daily").collect())
    assert "**/1m/**" in pats and "**/1d/**" not in pats


def test_split_requires_non_empty_source(spark):
    import pytest
    with pytest.raises(RuntimeError, match="No files"):
        P.split_slices(_tree(spark, ["c/.gitkeep", "notes.md"]), slice_dim(spark))


def test_shrink_permission_does_not_excuse_a_missing_interval(spark):
    import uuid

    from barforge.session import checkpoint_dir
    from conftest import BAR_DDL, daily_bars
    root = f"{checkpoint_dir(spark)}/publish-{uuid.uuid4().hex}"
    two = spark.createDataFrame(daily_bars(2) + daily_bars(2, ticker="B"), BAR_DDL)
    one = spark.createDataFrame(daily_bars(2), BAR_DDL)
    assert P.publish_snapshot(spark, two, root, "daily", required=["1d"])["version"] == 1
    assert P.publish_snapshot(spark, one, root, "daily", required=["1d"])["version"] is None
    assert P.publish_snapshot(spark, one, root, "daily", required=["1d"], allow_shrink=True)["version"] == 3
    gone = spark.createDataFrame(daily_bars(2, iv="1wk"), BAR_DDL)
    assert P.publish_snapshot(spark, gone, root, "daily", required=["1d"], allow_shrink=True)["version"] is None


def test_refused_version_is_removed_and_its_number_is_not_used_again(spark, tmp_path):
    import os
    root = str(tmp_path / "pub")
    full = spark.createDataFrame(daily_bars(3) + daily_bars(3, ticker="MSFT"), BAR_DDL)
    assert P.publish_snapshot(spark, full, root, "d")["version"] == 1
    out = P.publish_snapshot(spark, full.where("ticker = 'AAPL'"), root, "d")
    assert out["version"] is None and out["refused"]
    assert sorted(os.listdir(f"{root}/data")) == ["version=1"]
    assert P.publish_snapshot(spark, full, root, "d")["version"] == 3
    assert sorted(x for x in os.listdir(f"{root}/data")) == ["version=1", "version=3"]
