"""Bar merges, retention, consolidation (F1, F2, F3) and merge invariants."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barforge.operators import bars as B
from barforge.operators import merge as M
from conftest import BAR_DDL, daily_bars, ts


def bars(spark, rows):
    return spark.createDataFrame(rows, BAR_DDL)


def test_cumulative_merge_fresh_wins(spark):
    stored = bars(spark, daily_bars(3))
    fresh_rows = [r for r in daily_bars(4)[2:]]
    fresh_rows[0] = fresh_rows[0][:7] + (99.0,) + fresh_rows[0][8:]
    fresh_rows[1] = fresh_rows[1][:7] + (100.0,) + fresh_rows[1][8:]
    merged = M.merge_cumulative(stored, bars(spark, fresh_rows)).cache()
    assert merged.count() == 4
    assert merged.where(F.col("ts") == ts(2024, 1, 3)).first().close == 99.0
    rep = M.merge_report(merged).first()
    assert (rep.rows, rep.new_rows, rep.updated_rows) == (4, 1, 1)


def test_trusted_history(spark):
    short = bars(spark, daily_bars(5))
    long = bars(spark, daily_bars(25, ticker="MSFT"))
    out = {r.ticker: r.last_ts for r in M.trusted_last_ts(short.unionByName(long)).collect()}
    assert out["AAPL"] is None
    assert out["MSFT"].replace(tzinfo=None) == dt.datetime(2024, 1, 25)


def test_optional_columns_kept(spark):
    b = bars(spark, daily_bars(2)).withColumn("dividends", F.lit(0.5)).withColumn("stock_splits", F.lit(0.0))
    merged = M.merge_cumulative(b.limit(0), b)
    r = merged.first()
    assert r.dividends == 0.5 and r.stock_splits == 0.0


def test_normalise_two_level_duplicates(spark):
    rows = [("2024-01-02", 1.0, 2.0, 10, 0), ("2024-01-02", 1.5, 2.5, 11, 1), ("2024-01-03", 3.0, 4.0, 12, 2)]
    raw = spark.createDataFrame(rows, "Datetime string, o double, c double, v bigint, seq int").select(
        "Datetime", F.struct(F.col("o").alias("AAPL")).alias("Open"), F.struct(F.col("c").alias("AAPL")).alias("Close"),
        F.struct(F.col("v").alias("AAPL")).alias("Volume"), F.lit("x").alias("Repaired?"), "seq")
    out = B.normalise_bars(raw, (), "Datetime", "seq").orderBy("ts").collect()
    assert len(out) == 2 and out[0].open == 1.5
    assert set(out[0].asDict()) == {"ts", "open", "close", "volume"}


def _intraday(spark, times, ticker="AAPL", iv="1m", cls="stocks_us"):
    return bars(spark, [(cls, iv, ticker, t, 1.0, 1.0, 1.0, 1.0, None, 1) for t in times])


def test_intraday_consolidate_1m(spark):
    fresh = _intraday(spark, [ts(2024, 6, 1, 14, 30), ts(2024, 6, 1, 14, 31), ts(2024, 6, 2, 14, 30)])
    out = M.merge_intraday(fresh, fresh.limit(0), None, ts(2024, 6, 2, 20))
    assert out.count() == 3


def test_retention_1m(spark):
    b = _intraday(spark, [ts(2024, 6, 1, 14, 30), ts(2024, 6, 18, 14, 30), ts(2024, 6, 19, 14, 30)])
    out = B.prune_retention(b, ts(2024, 6, 20, 12))
    assert out.count() == 2
    assert out.agg(F.min("ts")).first()[0].replace(tzinfo=None) >= dt.datetime(2024, 6, 13, 12)


def test_retention_cutoff_inclusive_and_cumulative_untouched(spark):
    b = _intraday(spark, [ts(2024, 6, 13, 12), ts(2024, 6, 13, 11, 59)])
    assert B.prune_retention(b, ts(2024, 6, 20, 12)).count() == 1
    d = bars(spark, daily_bars(3))
    assert B.prune_retention(d, ts(2030, 1, 1)).count() == 3


def test_absorb_dated_file(spark):
    dated = _intraday(spark, [ts(2024, 6, 1, 14, 30)], "BTC-USD", "5m", "crypto").withColumn(
        "day", F.to_date("ts"))
    fresh = _intraday(spark, [ts(2024, 6, 2, 14, 30)], "BTC-USD", "5m", "crypto")
    out = M.merge_intraday(fresh, fresh.limit(0), dated, ts(2024, 6, 2, 20))
    assert out.count() == 2


def test_consolidation_job(spark):
    dated = _intraday(spark, [ts(2024, 6, 1, 14, 30), ts(2024, 6, 2, 14, 30)], "AAPL", "5m").withColumn(
        "day", F.to_date("ts"))
    merged, report = M.consolidate(dated.drop("day").limit(0), dated, ts(2024, 6, 2, 20))
    r = report.first()
    assert (r.removed, r.consolidated, r.pruned) == (2, 1, 0)
    assert merged.count() == 2


def test_empty_merge(spark):
    e = bars(spark, [])
    assert M.merge_intraday(e, e, None, ts(2024, 6, 2)).count() == 0


def test_precedence_policies_same_timestamp(spark):
    t = ts(2024, 6, 2, 14, 30)

    def one(close):
        return bars(spark, [("c", "5m", "X", t, 1.0, 1.0, 1.0, close, None, 1)])
    dated = one(3.0).withColumn("day", F.to_date("ts"))
    stored_wins = M.merge_intraday(one(1.0), one(2.0), dated, ts(2024, 6, 3)).first().close
    assert stored_wins == 3.0  # legacy > stored > fresh
    no_legacy = M.merge_intraday(one(1.0), one(2.0), None, ts(2024, 6, 3)).first().close
    assert no_legacy == 2.0
    fresh_wins = M.merge_cumulative(one(2.0), one(1.0)).first().close
    assert fresh_wins == 1.0


def test_parse_dated_names(spark):
    df = spark.createDataFrame([("BTC-USD_2024-06-01.csv",), ("A_B_2024-06-02.csv",), ("AAPL.csv",)], "file_name string")
    out = df.select("file_name", *M.parse_dated_name()).collect()
    assert [(r.stem, str(r.day) if r.day else None) for r in out] == [
        ("BTC-USD", "2024-06-01"), ("A_B", "2024-06-02"), (None, None)]


def test_overlay_keeps_other_series(spark):
    dest = bars(spark, daily_bars(2, ticker="ETH-USD", cls="crypto"))
    inc = bars(spark, daily_bars(1, ticker="BTC-USD", cls="crypto"))
    out = {r.ticker: r.origin for r in M.overlay(dest, inc).collect()}
    assert out == {"ETH-USD": "kept", "BTC-USD": "incoming"}


day = st.integers(min_value=0, max_value=15)
series = st.lists(st.tuples(day, st.floats(min_value=1, max_value=100, allow_nan=False)), max_size=12)


@settings(max_examples=15, deadline=None)
@given(a=series, b=series)
def test_merge_invariants(spark, a, b):
    def mk(rows):
        return bars(spark, [("c", "1d", "X", ts(2024, 1, 1) + dt.timedelta(days=d), p, p, p, p, None, 1)
                            for d, p in rows])
    # stored series are unique per timestamp
    sa = mk(list({d: (d, p) for d, p in a}.values()))
    sb = mk(b)
    m1 = M.merge_cumulative(sa, sb).drop("in_stored", "in_fresh", "changed").cache()
    keys = m1.select("ts").distinct().count()
    assert m1.count() == keys  # unique keys
    m2 = M.merge_cumulative(m1, sb).drop("in_stored", "in_fresh", "changed")
    assert sorted(map(tuple, m2.collect())) == sorted(map(tuple, m1.collect()))  # idempotent
    rep = M.merge_report(M.merge_cumulative(sa, sb)).collect()
    assert all(r.new_rows >= 0 for r in rep)
    m1.unpersist()


def test_consolidation_only_touches_intraday_intervals(spark):
    d5 = _intraday(spark, [ts(2024, 6, 1, 14, 30)], "AAPL", "5m").withColumn("day", F.to_date("ts"))
    dd = _intraday(spark, [ts(2024, 6, 1)], "AAPL", "1d").withColumn("day", F.to_date("ts"))
    merged, report = M.consolidate(d5.drop("day").limit(0), d5.unionByName(dd), ts(2024, 6, 2, 20))
    assert {r.interval for r in merged.collect()} == {"5m"}
    merged2, _ = M.consolidate(d5.drop("day").limit(0), d5, ts(2024, 6, 2, 20), intervals=["1m"])
    assert merged2.count() == 0


def test_value_moving_between_nullable_columns_is_an_update(spark):
    ddl = BAR_DDL + ", dividends double, stock_splits double"
    row = ("c", "1d", "X", ts(2024, 1, 1), 1.0, 1.0, 1.0, 1.0, None, 1)
    stored = spark.createDataFrame([(*row, 2.0, None)], ddl)
    fresh = spark.createDataFrame([(*row, None, 2.0)], ddl)
    assert [r.updated_rows for r in M.merge_report(M.merge_cumulative(stored, fresh)).collect()] == [1]
    assert [r.updated_rows for r in M.merge_report(M.merge_cumulative(stored, stored)).collect()] == [0]


def test_ranks_beyond_packed_ranges(spark):
    from barforge.operators.bars import last_write_wins
    rows = [("k", 0, (1 << 48) + 1, "low"), ("k", 1, 0, "high"), ("m", 1, (1 << 62) + 1, "late"), ("m", 1, 1 << 62, "early"),
            ("n", 0, -5, "a"), ("n", 0, -6, "b")]
    df = spark.createDataFrame(rows, "k string, src_rank int, seq long, v string")
    assert {r.k: r.v for r in last_write_wins(df, ["k"]).collect()} == {"k": "high", "m": "late", "n": "a"}


def test_overlay_sorts_no_bars(spark):
    """The stored bars stream past the incoming series' names; a sort of them
    would hold a partition's bars in a task."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = M.overlay(bars(spark, daily_bars(3) + daily_bars(3, ticker="MSFT")), bars(spark, daily_bars(2, ticker="MSFT")))
        rows = out.groupBy("ticker", "origin").count().collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert sorted(map(tuple, rows)) == [("AAPL", "kept", 3), ("MSFT", "incoming", 2)]
    assert "ShuffledHashJoin" in plan and "Sort" not in plan
