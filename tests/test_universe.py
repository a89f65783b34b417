"""Universe, shards, class selection (F6) and refresh planning."""

import pytest
from pyspark.sql import functions as F

from barforge.plans import refresh as R
from barforge.sources import listings as L


def test_inline_then_listing(spark):
    inline = spark.createDataFrame([("stocks_us", 0, "AAPL"), ("stocks_us", 1, "MSFT")],
                                   "asset_class string, pos int, ticker string")
    listed = spark.createDataFrame([("stocks_us", "ZZZZ", 0, 0), ("stocks_us", "AAPL", 0, 1)],
                                   "asset_class string, symbol string, file_pos int, pos int")
    u = L.build_universe(inline, listed).orderBy("pos").collect()
    assert [r.ticker for r in u] == ["AAPL", "MSFT", "ZZZZ"]


def test_stable_shards(spark):
    u = spark.createDataFrame([("x", t) for t in ["C", "A", "B", "D"]], "asset_class string, ticker string")
    s0 = sorted(r.ticker for r in R.stable_shards(u, 2, 0).collect())
    s1 = sorted(r.ticker for r in R.stable_shards(u, 2, 1).collect())
    assert (s0, s1) == (["A", "C"], ["B", "D"])


def test_single_shard_keeps_order_and_duplicates(spark):
    u = spark.createDataFrame([("x", t) for t in ["B", "A", "B"]], "asset_class string, ticker string")
    assert [r.ticker for r in R.stable_shards(u, 1).collect()] == ["B", "A", "B"]


@pytest.mark.parametrize("count,index", [(0, 0), (2, 2), (2, -1)])
def test_shard_arguments_validated(spark, count, index):
    u = spark.createDataFrame([("x", "A")], "asset_class string, ticker string")
    with pytest.raises(ValueError):
        R.stable_shards(u, count, index)


def test_unknown_class_raises(spark):
    u = spark.createDataFrame([("crypto", "BTC-USD")], "asset_class string, ticker string")
    req = spark.createDataFrame([("crypto",), ("nope",)], "asset_class string")
    with pytest.raises(ValueError, match="Unknown asset class.*nope.*Known: crypto"):
        R.select_classes(u, req)


def test_work_plan_and_resume(spark):
    u = spark.createDataFrame([("c", "A"), ("c", "B")], "asset_class string, ticker string")
    plan = R.work_plan(u, ("1d", "1wk"))
    assert plan.count() == 4
    done = spark.createDataFrame([("c", "1d", "A")], "asset_class string, interval string, ticker string")
    remaining, skipped = R.resume(plan, done)
    assert remaining.count() == 3 and skipped.count() == 1


def test_period_fallback_keeps_first_nonempty(spark):
    rows = [("c", "A", "1d", 1, 10), ("c", "A", "1d", 2, 11), ("c", "B", "1d", 0, 12)]
    df = spark.createDataFrame(rows, "asset_class string, ticker string, interval string, period_rank int, v int")
    out = sorted((r.ticker, r.period_rank) for r in R.period_fallback(df).collect())
    assert out == [("A", 1), ("B", 0)]


def test_positions_match_row_number_with_hot_group(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    # one group holds 90% of the rows and is spread over several range partitions
    df = spark.range(2000).select(F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("g"),
                                  ((F.col("id") * 7919) % 2003).alias("k"))
    got = R.positions(df, ["g"], ["k"], "pos", partitions=6)
    exp = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1)
    assert sorted(map(tuple, got.select("g", "k", "pos").collect())) == \
        sorted(map(tuple, exp.select("g", "k", F.col("pos").cast("long")).collect()))


def test_positions_of_wide_rows_match_row_number(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    # wide rows: the counts need fewer columns than the numbered rows, so two exchanges
    # would be planned (and sampled) differently if the ranges were computed twice
    df = spark.range(0, 500_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"), ((F.col("id") * 7919) % 500_009).alias("k"),
        F.repeat(F.lit("x"), 40).alias("payload"), F.xxhash64("id").alias("more"))
    got = R.positions(df, ["g"], ["k"], "pos", partitions=12)
    exp = df.withColumn("exp", F.row_number().over(Window.partitionBy("g").orderBy("k")) - 1).select("g", "k", "exp")
    wrong = got.join(exp, ["g", "k"], "full").where(~F.col("pos").eqNullSafe(F.col("exp"))).count()
    assert got.count() == 500_000 and wrong == 0


def test_universe_keeps_every_row_over_many_files(spark):
    from pyspark.sql import functions as F
    from barforge.sources.listings import build_universe
    listed = spark.range(0, 300_000, 1, 12).select(
        F.lit("c").alias("asset_class"), F.concat(F.lit("S"), "id").alias("symbol"),
        (F.col("id") % 5).cast("int").alias("file_pos"), (F.col("id") + (1 << 41)).alias("pos"))
    inline = spark.range(0, 1000).select(F.lit("c").alias("asset_class"), F.col("id").cast("int").alias("pos"),
                                         F.concat(F.lit("I"), "id").alias("ticker"))
    u = build_universe(inline, listed)
    assert u.count() == 301_000
    assert u.agg(F.countDistinct("pos"), F.max("pos"), F.min("pos")).first() == (301_000, 300_999, 0)


def test_first_seen_beyond_packed_ranges(spark):
    from barforge.sources.listings import first_seen
    rows = [("c", "A", 0, (1 << 40) + 5), ("c", "A", 1, 3), ("c", "B", 2, 1 << 62), ("c", "B", 2, (1 << 62) - 1)]
    df = spark.createDataFrame(rows, "asset_class string, symbol string, file_pos int, pos long")
    got = {r.symbol: (r.file_pos, r.pos) for r in first_seen(df, ["asset_class"], "symbol", ["file_pos", "pos"]).collect()}
    assert got == {"A": (0, (1 << 40) + 5), "B": (2, (1 << 62) - 1)}


def test_shard_audit_entries(spark):
    u = spark.createDataFrame([("stocks_us", t) for t in "ABCD"] + [("indices", "X")], "asset_class string, ticker string")
    plan = spark.createDataFrame([(0, "stocks_us", 0, 2), (1, "stocks_us", 1, 2), (2, "stocks_us", 1, 2), (3, "rates", 0, 1)],
                                 "entry_id int, asset_class string, shard_index int, shard_count int")
    entries, uncovered = R.shard_audit(plan, u)
    got = {r.entry_id: (r.tickers, r.duplicated) for r in entries.collect()}
    assert got == {0: (2, False), 1: (2, True), 2: (2, True), 3: (0, False)}
    assert [r.asset_class for r in uncovered.collect()] == ["indices"]
    bad = spark.createDataFrame([(None, "stocks_us", 0, 1)], "entry_id int, asset_class string, shard_index int, shard_count int")
    with pytest.raises(ValueError, match="Invalid shard entry"):
        R.shard_audit(bad, u)


def test_job_outcome_rules(spark):
    from conftest import BAR_DDL, daily_bars
    from pyspark.sql import functions as F
    stored = spark.createDataFrame(daily_bars(25, ticker="OLD") + daily_bars(3, ticker="NEW")
                                   + daily_bars(2, ticker="OLD", iv="5m"), BAR_DDL)
    plan = spark.createDataFrame([("stocks_us", t, iv) for t in ("OLD", "NEW", "NONE") for iv in ("1d", "5m", "2h")],
                                 "asset_class string, ticker string, interval string")
    staged = stored.limit(0)  # the provider returned nothing at all
    errors = spark.createDataFrame([], "asset_class string, interval string, ticker string, error string")
    got = {(r.ticker, r.interval): (r.status, r.message) for r in
           R.job_outcomes(R.staged_load(R.refresh_plan(plan, stored), staged), errors).collect()}
    assert got[("OLD", "1d")] == ("success", "0 row(s) loaded")           # incremental, nothing new
    assert got[("NEW", "1d")] == ("failed", "No 1d data returned")       # untrusted -> full load, empty
    assert got[("OLD", "5m")] == ("failed", "No 5m data (illiquid, halted, or unsupported)")
    assert got[("NONE", "2h")] == ("skipped", "unsupported interval '2h'")
    skip = {(r.ticker, r.interval): (r.status, r.message) for r in
            R.job_outcomes(R.staged_load(R.refresh_plan(plan, stored, skip_existing=True), staged), errors).collect()}
    assert skip[("OLD", "1d")] == ("success", "skipped (exists)")
    assert skip[("OLD", "5m")] == ("success", "skipped (exists)")
    assert skip[("NEW", "1d")][0] == "failed"                            # untrusted history is not skipped


def test_positions_across_blocks_of_partitions(spark, monkeypatch):
    """Groups over many partitions, more than one block of them; no groups; null groups."""
    monkeypatch.setattr(R, "PREFIX_BLOCK", 3)
    df = spark.range(4000).select(F.when(F.col("id") % 5 != 0, F.when(F.col("id") % 3 == 0, "hot").otherwise("b")).alias("g"),
                                  (F.col("id") * 7919 % 4001).alias("k"))
    got = R.positions(df, [], ["k"], "pos", partitions=17)
    assert sorted((r["k"], r["pos"]) for r in got.collect()) == [(k, i) for i, k in enumerate(sorted(r["k"] for r in df.collect()))]
    by_group = {}
    for r in df.collect():
        by_group.setdefault(r["g"], []).append(r["k"])
    want = sorted((str(g), k, i) for g, ks in by_group.items() for i, k in enumerate(sorted(ks)))
    got = R.positions(df, ["g"], ["k"], "pos", partitions=17)
    assert sorted((str(r["g"]), r["k"], r["pos"]) for r in got.collect()) == want
    assert R.positions(df.limit(0), [], ["k"]).collect() == []
