"""Streamed upsert equals the batch merge."""

import uuid

from pyspark.sql import functions as F

from barforge.operators import merge as M
from barforge.session import checkpoint_dir
from barforge.streaming import upsert as U
from conftest import BAR_DDL, ts


def test_stream_equals_batch(spark):
    def mk(vals, day0):
        return spark.createDataFrame(
            [("c", "5m", "X", ts(2024, 6, day0 + i), v, v, v, v, None, 1) for i, v in enumerate(vals)], BAR_DDL)
    stored, fresh, legacy = mk([1.0, 2.0], 1), mk([10.0, 20.0, 30.0], 2), mk([100.0], 3).withColumn("day", F.to_date("ts"))
    as_of = ts(2024, 6, 10)
    batch = M.merge_intraday(fresh, stored, legacy, as_of).select("ts", "close")
    base = f"{checkpoint_dir(spark)}/test-i2-{uuid.uuid4().hex}"
    cols = ["asset_class", "interval", "ticker", "ts", *U.PAYLOAD, "src_rank", "seq"]
    U.seed_store(spark, f"{base}/store", stored.withColumn("src_rank", F.lit(1)).withColumn("seq", F.lit(0).cast("long")).select(*cols))
    for df, rank in ((fresh, 0), (legacy.drop("day"), 2), (fresh, 0)):
        df.withColumn("src_rank", F.lit(rank)).withColumn("seq", F.lit(0).cast("long")).select(*cols) \
            .coalesce(1).write.mode("append").parquet(f"{base}/staged")
    schema = spark.read.parquet(f"{base}/staged").schema
    U.start_upsert(spark, f"{base}/staged", schema, f"{base}/store", f"{base}/ckpt", as_of).awaitTermination()
    got = U.read_version(spark, f"{base}/store").select("ts", "close")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))
    assert U.latest_version(spark, f"{base}/store") >= 1


RANKED = ["asset_class", "interval", "ticker", "ts", *U.PAYLOAD, "src_rank", "seq"]


def ranked(spark, spec, rank=0, iv="5m", seq=0):
    """Rows (ts, value) of one series with a source rank."""
    return (spark.createDataFrame([("c", iv, "X", t, v, v, v, v, None, 1) for t, v in spec], BAR_DDL)
            .withColumn("src_rank", F.lit(rank)).withColumn("seq", F.lit(seq).cast("long")).select(*RANKED))


def contents(spark, base):
    return sorted((r.interval, r.ts.strftime("%Y-%m-%d"), r.close) for r in U.read_current(spark, f"{base}/store").collect())


def test_replayed_batch_is_idempotent(spark):
    base = f"{checkpoint_dir(spark)}/test-i2-replay-{uuid.uuid4().hex}"
    U.seed_store(spark, f"{base}/store", ranked(spark, [(ts(2024, 6, 1), 1.0)], 1))
    batch = ranked(spark, [(ts(2024, 6, 2), 5.0)])
    fn = U.upsert_batch_fn(f"{base}/store", ts(2024, 6, 10))
    fn(batch, 0)
    first = contents(spark, base)
    fn(batch, 0)  # the same micro-batch delivered again after a failure
    assert contents(spark, base) == first and len(first) == 2


def test_late_cumulative_bar_is_kept(spark):
    base = f"{checkpoint_dir(spark)}/test-i2-late-{uuid.uuid4().hex}"
    for rows in ([(ts(2024, 6, 3), 1.0), (ts(2024, 5, 27), 2.0)], [(ts(2024, 1, 1), 3.0)], [(ts(2024, 6, 10), 4.0)]):
        ranked(spark, rows, iv="1wk").coalesce(1).write.mode("append").parquet(f"{base}/staged")
    schema = ranked(spark, [(ts(2024, 6, 3), 1.0)]).schema
    U.start_upsert(spark, f"{base}/staged", schema, f"{base}/store", f"{base}/ckpt", ts(2024, 6, 11)).awaitTermination()
    assert contents(spark, base) == [("1wk", "2024-01-01", 3.0), ("1wk", "2024-05-27", 2.0),
                                     ("1wk", "2024-06-03", 1.0), ("1wk", "2024-06-10", 4.0)]


def test_daily_only_store_reads_back(spark):
    base = f"{checkpoint_dir(spark)}/test-i2-1d-{uuid.uuid4().hex}"
    fn = U.upsert_batch_fn(f"{base}/store", ts(2024, 6, 10))
    fn(ranked(spark, [(ts(2024, 6, 1), 1.0), (ts(2024, 6, 2), 2.0)], iv="1d"), 0)
    assert contents(spark, base) == [("1d", "2024-06-01", 1.0), ("1d", "2024-06-02", 2.0)]


def test_new_checkpoint_takes_new_data_and_restart_after_crash(spark, monkeypatch):
    base = f"{checkpoint_dir(spark)}/test-i2-restart-{uuid.uuid4().hex}"
    schema = ranked(spark, [(ts(2024, 6, 3), 1.0)]).schema

    def stage(rows):
        ranked(spark, rows).coalesce(1).write.mode("append").parquet(f"{base}/staged")

    def run(ckpt):
        U.start_upsert(spark, f"{base}/staged", schema, f"{base}/store", f"{base}/{ckpt}", ts(2024, 6, 10)).awaitTermination()
    stage([(ts(2024, 6, 3), 1.0)])
    run("a")
    # the process dies after the data and log are written, before the stream's own commit
    stage([(ts(2024, 6, 4), 2.0)])
    whole = U.commit

    def dies(*args, **kw):
        whole(*args, **kw)
        raise RuntimeError("lost")
    monkeypatch.setattr(U, "commit", dies)
    try:
        run("a")
    except Exception as e:  # noqa: BLE001 - the stream reports it as its own failure
        assert "lost" in str(e)
    monkeypatch.setattr(U, "commit", whole)
    run("a")  # replays the batch
    stage([(ts(2024, 6, 5), 3.0)])
    run("b")  # a new checkpoint sees all staged files again, and the new one
    assert contents(spark, base) == [("5m", "2024-06-03", 1.0), ("5m", "2024-06-04", 2.0), ("5m", "2024-06-05", 3.0)]


def test_optional_columns_survive_and_vacuum_keeps_live(spark):
    base = f"{checkpoint_dir(spark)}/test-i2-vacuum-{uuid.uuid4().hex}"
    fn = U.upsert_batch_fn(f"{base}/store", ts(2024, 6, 10))
    for i, v in enumerate((1.0, 2.0, 3.0)):
        fn(ranked(spark, [(ts(2024, 6, 2), v)], seq=i).withColumn("dividends", F.lit(v / 10)), i)
    before = contents(spark, base)
    assert U.vacuum(spark, f"{base}/store") == 2
    assert contents(spark, base) == before == [("5m", "2024-06-02", 3.0)]
    assert [r.dividends for r in U.read_current(spark, f"{base}/store").collect()] == [0.3]
    fn(ranked(spark, [(ts(2024, 6, 3), 9.0)]), 3)
    assert len(contents(spark, base)) == 2


def test_unreadable_log_is_an_error(spark):
    base = f"{checkpoint_dir(spark)}/test-i2-bad-{uuid.uuid4().hex}"
    spark.createDataFrame([("broken",)], "value string").coalesce(1).write.text(f"{base}/store/log/stream=main")
    import glob
    import os
    for f in glob.glob(f"{base.removeprefix('file://')}/store/log/stream=main/*.txt"):
        os.rename(f, f[:-4] + ".parquet")
    import pytest
    with pytest.raises(Exception, match="(?i)parquet|footer|magic|FAILED_READ"):
        U.latest_version(spark, f"{base}/store")


def test_stream_bars_equal_batch_bars_for_closed_windows(spark):
    import datetime as dt
    from barforge.operators.bars import bars_from_ticks
    from barforge.streaming import bars as SB
    base = f"{checkpoint_dir(spark)}/test-bars-{uuid.uuid4().hex}"
    rows = [("c", "X" if i % 2 else "Y", ts(2024, 6, 3, 9, 0) + dt.timedelta(seconds=37 * i), float(100 + i % 13), 1 + i % 3, i)
            for i in range(400)]
    ddl = "asset_class string, ticker string, ts timestamp, price double, size long, seq long"
    t = spark.createDataFrame(rows, ddl)
    half = ts(2024, 6, 3, 11, 0)
    t.where(F.col("ts") < half).coalesce(1).write.mode("append").parquet(f"{base}/staged")
    t.where(F.col("ts") >= half).coalesce(1).write.mode("append").parquet(f"{base}/staged")
    q = SB.start_bar_stream(spark, f"{base}/staged", t.schema, f"{base}/out", f"{base}/ckpt", "15m", "1 minute")
    q.awaitTermination()
    got = {(r.ticker, r.ts): (r.open, r.high, r.low, r.close, r.volume) for r in spark.read.parquet(f"{base}/out").collect()}
    exp = {(r.ticker, r.ts): (r.open, r.high, r.low, r.close, r.volume)
           for r in bars_from_ticks(t, ["15m"]).collect()}
    assert got and all(exp[k] == v for k, v in got.items())  # every emitted bar is final and exact
    # all windows closed before the last batch were emitted
    closed = {k for k in exp if k[1].replace(tzinfo=None) + dt.timedelta(minutes=15) <= half.replace(tzinfo=None)}
    assert closed <= set(got)


def test_stream_window_alignment():
    from barforge.streaming import bars as SB
    assert SB.window_spec("90m") == ("90 minutes", None)
    assert SB.window_spec("1wk") == ("7 days", "4 days")
    import pytest
    with pytest.raises(ValueError):
        SB.window_spec("1mo")


def test_two_streams_split_by_interval(spark):
    def mk(vals, iv, day0, rank):
        return (spark.createDataFrame([("c", iv, "X", ts(2024, 6, day0 + i), v, v, v, v, None, 1) for i, v in enumerate(vals)],
                                      BAR_DDL).withColumn("src_rank", F.lit(rank)).withColumn("seq", F.lit(0).cast("long")))
    base = f"{checkpoint_dir(spark)}/test-i2-split-{uuid.uuid4().hex}"
    cols = ["asset_class", "interval", "ticker", "ts", *U.PAYLOAD, "src_rank", "seq"]
    U.seed_store(spark, f"{base}/store", mk([1.0], "1m", 8, 1).unionByName(mk([1.0], "5m", 1, 1)).select(*cols))
    staged = mk([5.0, 6.0], "1m", 8, 0).unionByName(mk([7.0, 8.0], "5m", 1, 0)).select(*cols)
    staged.coalesce(1).write.mode("append").parquet(f"{base}/staged")
    as_of = ts(2024, 6, 10)
    q1 = U.start_upsert(spark, f"{base}/staged", staged.schema, f"{base}/store", f"{base}/ck1", as_of,
                        intervals=["1m"], stream="m1")
    q2 = U.start_upsert(spark, f"{base}/staged", staged.schema, f"{base}/store", f"{base}/ck2", as_of,
                        intervals=["5m"], stream="other")
    q1.awaitTermination()
    q2.awaitTermination()
    got = sorted((r.interval, r.ts.day, r.close) for r in U.read_current(spark, f"{base}/store").collect())
    # stored wins on 06-08 (1m) and 06-01 (5m); fresh adds the rest; 1m keeps 7 days
    assert got == [("1m", 8, 1.0), ("1m", 9, 6.0), ("5m", 1, 1.0), ("5m", 2, 8.0)]


def test_month_partitions_touched_expired_straddling(spark):
    base = f"{checkpoint_dir(spark)}/test-i2-months-{uuid.uuid4().hex}"
    cols = ["asset_class", "interval", "ticker", "ts", *U.PAYLOAD, "src_rank", "seq"]

    def rows(spec, rank):
        return (spark.createDataFrame([("c", iv, "X", t, v, v, v, v, None, 1) for iv, t, v in spec], BAR_DDL)
                .withColumn("src_rank", F.lit(rank)).withColumn("seq", F.lit(0).cast("long")).select(*cols))
    U.seed_store(spark, f"{base}/store", rows([("1d", ts(2024, 1, 5), 1.0), ("1d", ts(2024, 2, 5), 2.0),
                                               ("1m", ts(2024, 5, 20), 3.0), ("1m", ts(2024, 6, 2), 4.0),
                                               ("1m", ts(2024, 6, 9), 5.0)], 1))
    fn = U.upsert_batch_fn(f"{base}/store", ts(2024, 6, 10))
    fn(rows([("1d", ts(2024, 2, 6), 6.0), ("1m", ts(2024, 6, 10), 7.0)], 0), 0)
    live = {(i, m): v for c, i, m, v, s in U.current_partitions(spark, f"{base}/store")}
    assert live[("1d", "2024-01")] == 0          # untouched month: not rewritten
    assert live[("1d", "2024-02")] == 1          # touched month
    assert ("1m", "2024-05") not in live         # wholly past the 7-day retention: dropped by the log
    assert live[("1m", "2024-06")] == 1          # straddles the cutoff: re-pruned
    got = sorted((r.interval, r.ts.day, r.ts.month, r.close) for r in U.read_current(spark, f"{base}/store").collect())
    assert got == [("1d", 5, 1, 1.0), ("1d", 5, 2, 2.0), ("1d", 6, 2, 6.0), ("1m", 9, 6, 5.0), ("1m", 10, 6, 7.0)]


def test_names_that_paths_escape(spark):
    """Class and stream names with characters that directories escape are read,
    merged and kept by vacuum."""
    base = f"{checkpoint_dir(spark)}/test-i2-names-{uuid.uuid4().hex}"
    names = ["fx:spot", "a%b", "c d", "x=y", "p{q}[r]"]

    def rows(day, value):
        parts = [ranked(spark, [(ts(2024, 6, day), value)], iv="1d").withColumn("asset_class", F.lit(n)) for n in names]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out
    U.seed_store(spark, f"{base}/store", rows(1, 1.0))
    for batch in (rows(2, 2.0), rows(2, 3.0)):
        U.upsert_batch_fn(f"{base}/store", ts(2024, 6, 10), stream="a%b:c")(batch, 0)

    def now():
        return sorted((r.asset_class, r.ts.day, r.close) for r in U.read_current(spark, f"{base}/store").collect())
    want = sorted((n, d, v) for n in names for d, v in ((1, 1.0), (2, 3.0)))
    assert now() == want
    assert U.vacuum(spark, f"{base}/store") == 2 * len(names)
    assert now() == want
    assert U.vacuum(spark, f"{base}/store") == 0 and now() == want


def _ticks(spark, spec):
    rows = [("c", t, ts(2024, 6, 1, h, m, s), float(p), 1, i) for i, (t, h, m, s, p) in enumerate(spec)]
    return spark.createDataFrame(rows, "asset_class string, ticker string, ts timestamp, price double, size long, seq long")


def test_bar_updates_over_batches_with_late_ticks(spark):
    """Bars are current after every batch, late ticks are in their bars and the
    side table, replays and compaction change nothing, open bars are flushed."""
    from barforge.operators.bars import bars_from_ticks
    from barforge.streaming import bars as SB
    root = f"{checkpoint_dir(spark)}/test-i6u-{uuid.uuid4().hex}"
    batches = [_ticks(spark, [("X", 9, 1, 0, 5), ("X", 9, 14, 59, 7), ("Y", 9, 3, 0, 1)]),
               _ticks(spark, [("X", 9, 16, 0, 6), ("X", 9, 40, 0, 8)]),
               _ticks(spark, [("X", 9, 0, 30, 4), ("X", 9, 41, 0, 9), ("Y", 9, 20, 0, 2)]),    # 9:00 and 9:15 are closed
               _ticks(spark, [])]
    fn = SB.update_batch_fn(root, "15m", 5)

    def bars(**more):
        out = SB.read_bar_updates(spark, root, "15m", **more)
        return sorted((r.ticker, r.ts.hour * 60 + r.ts.minute, r.open, r.high, r.low, r.close, r.volume, r.n_ticks, r.final) for r in out.collect())
    fn(batches[0], 0)
    assert bars() == [("X", 540, 5, 7, 5, 7, 2, 2, False), ("Y", 540, 1, 1, 1, 1, 1, 1, False)]
    fn(batches[1], 1)
    assert [x[-1] for x in bars()] == [True, True, False, True]
    for _ in range(2):  # the second is a replay
        fn(batches[2], 2)
        assert bars()[0] == ("X", 540, 4, 7, 4, 7, 3, 3, True)
        late = SB.read_late_ticks(spark, root, batches[0].schema)
        assert sorted((r.ticker, r.price) for r in late.collect()) == [("X", 4.0), ("Y", 2.0)]
    fn(batches[3], 3)
    before = bars(drained=True)
    assert all(x[-1] for x in before) and sum(x[-2] for x in before) == 8
    everything = batches[0].unionByName(batches[1]).unionByName(batches[2])
    want = bars_from_ticks(everything, ["15m"]).collect()
    assert sorted((r.ticker, r.ts.hour * 60 + r.ts.minute, r.open, r.high, r.low, r.close, r.volume, r.n_ticks, True) for r in want) == before
    assert SB.compact(spark, root) == 3 and bars(drained=True) == before
    fn(_ticks(spark, [("X", 9, 2, 0, 99)]), 4)
    assert bars()[0][3] == 99 and SB.compact(spark, root) == 4 and bars()[0][3] == 99


def test_bar_update_stream_takes_many_batches(spark):
    from barforge.streaming import bars as SB
    base = f"{checkpoint_dir(spark)}/test-i6s-{uuid.uuid4().hex}"
    t = _ticks(spark, [(f"T{i % 3}", 9 + i // 60, i % 60, 0, i) for i in range(180)])
    t.repartitionByRange(6, "ts").write.parquet(f"{base}/staged")
    SB.start_bar_updates(spark, f"{base}/staged", t.schema, f"{base}/bars", f"{base}/ckpt", "1h", files_per_batch=2).awaitTermination()
    out = SB.read_bar_updates(spark, f"{base}/bars", "1h", drained=True)
    assert out.agg(F.sum("n_ticks")).first()[0] == 180 and out.count() == 9
    assert spark.read.parquet(f"{base}/bars/marks").select("batch").distinct().count() >= 3


def test_series_counts_equal_a_recount(spark):
    """Counts from the touched partitions equal a recount of the bars after
    inserts, a replay, an expired month and vacuum."""
    base = f"{checkpoint_dir(spark)}/test-i5-{uuid.uuid4().hex}"
    root = f"{base}/store"

    def rows(spec):
        return (spark.createDataFrame([(c, iv, t, at, 1.0, 1.0, 1.0, 1.0, None, 1) for c, iv, t, at in spec], BAR_DDL)
                .withColumn("src_rank", F.lit(0)).withColumn("seq", F.lit(0).cast("long")).select(*RANKED))

    def check():
        bars = U.read_current(spark, root)
        want = bars.groupBy("interval").agg(F.count_distinct("asset_class", "ticker").alias("series"), F.count(F.lit(1)).alias("bars"))
        got = U.series_counts(spark, root).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want.collect()))
        spans = bars.groupBy("asset_class", "interval", "ticker").agg(F.count(F.lit(1)), F.min("ts"), F.max("ts"))
        assert sorted(map(tuple, U.live_series(spark, root).collect())) == sorted(map(tuple, spans.collect()))
        return {r["interval"]: r["series"] for r in got}
    U.seed_store(spark, root, rows([("c", "1d", t, ts(2024, m, 1)) for t in "ABC" for m in (4, 5)] + [("c", "5m", "A", ts(2024, 3, 2))]))
    assert check() == {"1d": 3, "5m": 1}
    fn = U.upsert_batch_fn(root, ts(2024, 4, 20))
    for _ in range(2):
        fn(rows([("c", "1d", "D", ts(2024, 5, 2)), ("k", "1d", "A", ts(2024, 5, 2)), ("c", "5m", "B", ts(2024, 4, 19))]), 0)
        assert check() == {"1d": 5, "5m": 2}
    U.upsert_batch_fn(root, ts(2024, 7, 1))(rows([("c", "5m", "E", ts(2024, 6, 30))]), 1)   # March and April have expired
    assert check() == {"1d": 5, "5m": 1}
    U.vacuum(spark, root)
    assert check() == {"1d": 5, "5m": 1}
    assert {r["interval"]: (r["version"], r["n_files"]) for r in U.live_manifest(spark, root, "bars").collect()} == {"1d": (3, 5), "5m": (3, 1)}


def test_merge_moves_rows_once_in_file_order(spark):
    """A batch's merge shuffles each row once, and its one sort is the files'."""
    stored = ranked(spark, [(ts(2024, 6, d), 1.0) for d in range(1, 9)], 1)
    fresh = ranked(spark, [(ts(2024, 6, d), 2.0) for d in range(5, 13)])
    merged = U.merge_ranked(stored, fresh).sortWithinPartitions(*U.FILE_ORDER)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == plan.count("Exchange rangepartitioning") == 1 and plan.count("Sort [") == 1
    assert sorted((r.ts.day, r.close) for r in merged.collect()) == [(d, 1.0 if d < 9 else 2.0) for d in range(1, 13)]


def test_micro_batches_do_not_grow_with_the_staged_files(spark, tmp_path, monkeypatch):
    """Three micro-batches at most, each a rewrite of the store, however many files are staged."""
    from barforge.operators import bars as B
    from barforge.plans import stream_q
    from barforge.session import input_bytes
    kinds = ["view", "click", "error", "purchase", "signup"]
    rows = [(i, ts(2024, 1, 25 + i // 100, i % 3), i // 5 % 20, kinds[i % 5], float(i), '{"k": 2}') for i in range(300)]
    path = f"{tmp_path}/sf/events.parquet"
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string") \
        .coalesce(1).write.parquet(path)
    monkeypatch.setattr(B, "ROLLUP_BYTES", input_bytes(spark.read.parquet(path)) * 8 // 16)
    root = stream_q._streamed_store(spark, f"{tmp_path}/sf")
    staged = len(spark.read.parquet(root.replace("/store", "/staged")).inputFiles())
    assert staged > 8 * 3 and 1 < U.latest_version(spark, root) <= 3
