"""Steps over bars rolled up from ticks take as many tasks as the ticks' files
need (F7-F12): a task's part stays the same however many ticks there are."""

import datetime as dt
import os
import re

import pytest

import __spark_entry__ as E
from barforge.operators import bars as B
from barforge.plans import publish_q

EVENT_DDL = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
ORDER_DDL = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"


@pytest.fixture()
def tables(spark, tmp_path):
    """Own events (some without a user or a price) and orders, a folder each."""
    start = dt.datetime(2024, 1, 20)
    events = [(i, start + dt.timedelta(minutes=i * 7 % 15000, seconds=i % 60), None if i % 97 == 0 else i % 9,
               ("click", "view", "error", "purchase")[i % 4], None if i % 89 == 0 else float(i % 31), f'{{"k": {i % 5}}}')
              for i in range(3000)]
    orders = [(i, i % 20, "FOP"[i % 3], float(i % 17), dt.datetime(2020, 1, 1) + dt.timedelta(days=i % 40)) for i in range(400)]
    spark.createDataFrame(events, EVENT_DDL).repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame(orders, ORDER_DDL).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def _many_tasks(monkeypatch, tables, name="BAR_BYTES", tasks=20):
    size = sum(f.stat().st_size for f in os.scandir(f"{tables}/events.parquet") if f.name.endswith(".parquet"))
    monkeypatch.setattr(B, name, size * 8 // tasks)


def _rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name,share", [
    ("w12_last_n_days", "BAR_BYTES"), ("w13_latest_session", "BAR_BYTES"), ("a9_session_stats", "BAR_BYTES"),
    ("a11_consolidated_bars", "ROLLUP_BYTES"), ("a2_intraday_merge", "ROLLUP_BYTES")])
def test_tasks_follow_the_ticks_files(spark, tables, monkeypatch, name, share):
    query = E.queries()[name]
    few = query(spark, tables)
    want = _rows(few)
    _many_tasks(monkeypatch, tables, share)
    many = query(spark, tables)
    assert len(want) > 8 and _rows(many) == want
    assert few.rdd.getNumPartitions() <= 8 and 20 <= many.rdd.getNumPartitions() <= 21


def _parts(root):
    """The write tasks whose files lie below ``root``."""
    return {m.group(1) for _, _, files in os.walk(root) for f in files if (m := re.match(r"part-(\d+)", f))}


@pytest.mark.parametrize("name,written", [("s11_partitioned_store", ""), ("p6_retention_prune", None),
                                          ("i5_publish_plan", "data/version=1"), ("i5_publish_plan", "data/version=2")])
def test_written_ranges_follow_the_ticks_files(spark, tables, tmp_path, monkeypatch, name, written):
    monkeypatch.setattr(publish_q, "_scratch", lambda spark, tag: f"{tmp_path}/{tag}-{len(os.listdir(tmp_path))}")
    query = E.queries()[name]
    want = _rows(query(spark, tables))
    before = set(os.listdir(tmp_path))
    _many_tasks(monkeypatch, tables)
    assert len(want) > 8 and _rows(query(spark, tables)) == want
    if written is not None:
        new, = set(os.listdir(tmp_path)) - before
        assert len(_parts(f"{tmp_path}/{new}/{written}")) >= 15


def test_a_roll_up_task_takes_few_ticks(spark, tables, monkeypatch):
    """48 MB of ticks and eight intervals: some 60,000 minute bars a task at 8 bytes
    a tick, not twice that (o2_sample_catalogue held 400 MB a task)."""
    monkeypatch.setattr(B, "input_bytes", lambda df: 48 << 20)
    ticks = spark.read.parquet(f"{tables}/events.parquet")
    assert B.by_series_day(ticks, ticks, ["user_id"], 8).rdd.getNumPartitions() >= 96
