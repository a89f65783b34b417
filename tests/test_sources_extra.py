"""Stem resolution, tree listing, versioned publish, universe from config."""

from pyspark.sql import functions as F

from barforge.plans import publish as P
from barforge.sources import listings as L
from barforge.sources import store as ST
from conftest import BAR_DDL, daily_bars


def test_resolve_stems_reports_collisions(spark):
    bars = spark.createDataFrame([("indices", "GSPC", 1), ("currencies", "EURUSD_X", 2), ("crypto", "NEW", 3)],
                                 "asset_class string, stem string, v int")
    uni = spark.createDataFrame([("indices", "^GSPC"), ("indices", "GSPC"), ("currencies", "EURUSD=X")],
                                "asset_class string, ticker string")
    out, clashes = ST.resolve_stems(bars, uni)
    got = {r.stem: r.ticker for r in out.collect()}
    assert got == {"GSPC": None, "EURUSD_X": "EURUSD=X", "NEW": "NEW"}
    assert [r.tickers for r in clashes.collect()] == [["GSPC", "^GSPC"]]


def test_scan_tree_counts(spark, tmp_path):
    for rel in ["crypto/1d/BTC-USD.csv", "crypto/1d/.gitkeep", "crypto/5m/ETH-USD.csv", "dataset-metadata.json"]:
        p = tmp_path / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text("x")
    per, total = P.tree_counts(ST.scan_tree(spark, str(tmp_path)))
    assert {r.interval: r.n_files for r in per.collect()} == {"1d": 1, "5m": 1}
    assert total.first().n_files == 2


def test_publish_snapshot_versions_and_guard(spark, tmp_path):
    root = str(tmp_path / "pub")
    full = spark.createDataFrame(daily_bars(3) + daily_bars(3, ticker="MSFT"), BAR_DDL)
    r1 = P.publish_snapshot(spark, full, root, "daily", required=("1d",))
    assert r1["version"] == 1 and not r1["refused"]
    shrunk = full.where(F.col("ticker") == "AAPL")
    r2 = P.publish_snapshot(spark, shrunk, root, "daily", required=("1d",))
    assert r2["refused"] and r2["version"] is None
    r3 = P.publish_snapshot(spark, full, root, "daily", required=("1d",))
    assert r3["version"] == 3  # version 2 was written but refused (never READY)
    assert spark.read.parquet(f"{root}/data/version=3").count() == 6
    log = {r.version: r.status for r in spark.read.parquet(f"{root}/versions").collect()}
    assert log == {1: "READY", 2: "REFUSED", 3: "READY"}


def test_universe_from_config(spark, tmp_path):
    (tmp_path / "listings").mkdir()
    (tmp_path / "listings" / "us.csv").write_text("Symbol,Name\nZZZZ,Zed\nAAPL,Apple\nBRK.B,Berkshire\n")
    cfg = tmp_path / "tickers.yaml"
    cfg.write_text("stocks_us:\n  - AAPL\n  - MSFT\nindices:\n  - ^GSPC\nlistings:\n  stocks_us:\n"
                   "    - listings/us.csv\n    - path: listings/missing.csv\n      url: https://x.invalid/m.csv\n")
    u = L.universe_from_config(spark, str(cfg))
    got = {(r.asset_class, r.pos): r.ticker for r in u.collect()}
    assert [got[("stocks_us", i)] for i in range(4)] == ["AAPL", "MSFT", "ZZZZ", "BRK-B"]
    assert got[("indices", 0)] == "^GSPC"
