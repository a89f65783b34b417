"""CSV scan bound by header, sink format, partitioned store."""

import datetime as dt

from pyspark.sql import functions as F

from barforge.sources import store as ST
from conftest import BAR_DDL, daily_bars


def test_scan_binds_by_header_and_quarantines(spark, tmp_path):
    d = tmp_path / "stocks_us" / "1d"
    d.mkdir(parents=True)
    (d / "AAPL.csv").write_text("Datetime,Open,High,Low,Close,Adj Close,Volume\n"
                                "2024-01-01T00:00:00+0000,1.0,2.0,0.5,1.5,1.5,100\n")
    (d / "MSFT.csv").write_text("Datetime,Close,Volume,Open,Extra\n"
                                "2024-01-02 00:00:00+00:00,9.0,7,8.0,zzz\n")
    (d / "EMPTY.csv").write_text("Datetime,Open,High,Low,Close,Adj Close,Volume\n")
    (d / "BAD.csv").write_text("not,a,valid,csv\n{{{\n")
    bars, quarantine = ST.read_bar_csv(spark, str(tmp_path))
    rows = {r.stem: r for r in bars.collect()}
    assert set(rows) == {"AAPL", "MSFT"}
    assert rows["MSFT"].open == 8.0 and rows["MSFT"].close == 9.0 and rows["MSFT"].volume == 7
    assert rows["AAPL"].ts.replace(tzinfo=None) == dt.datetime(2024, 1, 1)
    assert rows["AAPL"].asset_class == "stocks_us" and rows["AAPL"].interval == "1d"
    bad = {r.path.rsplit("/", 1)[-1] for r in quarantine.collect()}
    assert "BAD.csv" in bad


def test_sink_format(spark):
    b = spark.createDataFrame(daily_bars(1), BAR_DDL)
    r = ST.csv_frame(b).first()
    assert r.Datetime == "2024-01-01T00:00:00+0000" and r.Open == "0.0000000000" and r.Volume == "100"


def test_csv_store_round_trip(spark, tmp_path):
    b = spark.createDataFrame(daily_bars(30) + daily_bars(5, ticker="BTC-USD", cls="crypto"), BAR_DDL)
    ST.write_bar_csv(b, str(tmp_path / "csv"))
    back = ST.read_store_csv(spark, str(tmp_path / "csv"))
    assert back.count() == 35
    assert sorted(map(tuple, back.select("ticker", "ts", "close").collect())) == \
        sorted(map(tuple, b.select("ticker", "ts", "close").collect()))


def test_parquet_store_prunes_partitions(spark, tmp_path):
    b = spark.createDataFrame(daily_bars(10) + daily_bars(4, iv="1wk"), BAR_DDL)
    ST.write_store(b, str(tmp_path / "pq"))
    q = ST.read_store(spark, str(tmp_path / "pq")).where(F.col("interval") == "1wk")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "1wk" in plan
    assert q.count() == 4


def test_scan_quarantines_unparseable_rows(spark, tmp_path):
    d = tmp_path / "crypto" / "5m"
    d.mkdir(parents=True)
    (d / "BTC-USD.csv").write_text("Datetime,Open,Close,Volume\n"
                                   "2024-06-01T00:00:00+0000,1.0,2.0,5\n"
                                   "not-a-time,3.0,4.0,6\n")
    bars, quarantine = ST.read_bar_csv(spark, str(tmp_path))
    assert [(r.stem, r.close) for r in bars.collect()] == [("BTC-USD", 2.0)]
    bad = [(r.reason, r.rows) for r in quarantine.collect()]
    assert bad == [("bad time", 1)]


def test_daily_store_keeps_interval_names(spark, tmp_path):
    """1d and 5d are also numbers to Spark's partition inference."""
    for n, intervals in enumerate((["1d"], ["1d", "5d"])):
        rows = [r for iv in intervals for r in daily_bars(3, iv=iv)]
        bars = spark.createDataFrame(rows, BAR_DDL).withColumn("dividends", F.lit(0.5))
        ST.write_store(bars, str(tmp_path / f"p{n}"))
        back = ST.read_store(spark, str(tmp_path / f"p{n}"))
        assert sorted({r.interval for r in back.collect()}) == intervals and back.count() == len(rows)
        ST.write_bar_csv(bars, str(tmp_path / f"c{n}"))
        back = ST.read_store_csv(spark, str(tmp_path / f"c{n}"))
        assert sorted({r.interval for r in back.collect()}) == intervals
        assert {r.dividends for r in back.collect()} == {0.5}


def test_time_formats_and_header_position(spark, tmp_path):
    d = tmp_path / "c" / "1d"
    d.mkdir(parents=True)
    times = ["2024-01-02 09:30:00", "2024-01-02T09:30:00", "2024-01-02T09:30:00Z", "2024-01-02 09:30:00+00:00",
             "2024-01-02T11:30:00.000+0200", "2024-01-02T09:30:00+0000"]
    (d / "A.csv").write_text("Open,Datetime,Close\n" + "".join(f"1,{t},{i}\n" for i, t in enumerate(times)))
    (d / "B.csv").write_text("Date,Close\n2024-01-02,7\nnonsense,8\n")
    (d / "C.csv").write_text("broken\n")
    bars, bad = ST.read_bar_csv(spark, str(tmp_path))
    got = {(r.stem, r.close): r.ts for r in bars.collect()}
    assert {str(t) for (s, _), t in got.items() if s == "A"} == {"2024-01-02 09:30:00"} and len(got) == 7
    assert sorted(r.reason for r in bad.collect()) == ["bad time", "no header"]


def test_retained_read_pushes_time_to_the_scan(spark, tmp_path):
    import datetime as dt
    from barforge.operators.bars import prune_retention
    rows = [r for iv in ("1d", "1m", "5m") for r in daily_bars(90, iv=iv)]
    ST.write_store(spark.createDataFrame(rows, BAR_DDL), str(tmp_path / "r"))
    as_of = dt.datetime(2024, 3, 30, tzinfo=dt.timezone.utc)
    kept = ST.read_retained(spark, str(tmp_path / "r"), as_of)
    exp = prune_retention(ST.read_store(spark, str(tmp_path / "r")), as_of)
    assert sorted(map(str, kept.collect())) == sorted(map(str, exp.collect()))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan


def test_optional_columns_of_some_files_are_read(spark, tmp_path):
    """A store written with and without dividends keeps the column, whichever
    file is listed first."""
    b = spark.createDataFrame(daily_bars(3), BAR_DDL)
    for i in range(4):
        part = b.withColumn("ticker", F.lit(f"T{i}"))
        part = part.withColumn("dividends", F.lit(float(i))) if i % 2 else part
        ST.write_store(part, str(tmp_path / "mixed"), "append")
    got = {r.ticker: r.dividends for r in ST.read_store(spark, str(tmp_path / "mixed")).collect()}
    assert got == {"T0": None, "T1": 1.0, "T2": None, "T3": 3.0}


def test_many_headers_are_bound_in_one_scan(spark, tmp_path):
    """As many headers as files: every row is bound by its own file's header, and
    the rows' plan scans the tree once."""
    import itertools
    d = tmp_path / "stocks_us" / "1d"
    d.mkdir(parents=True)
    columns = ["Datetime", "Open", "Close", "Volume", "Extra"]
    for i, order in enumerate(itertools.permutations(columns)):
        cells = {"Datetime": f"2024-01-{1 + i % 28:02d}", "Open": f"{i}.5", "Close": f'"{i}.25"', "Volume": f"{i}.0", "Extra": "x"}
        (d / f"T{i:03d}.csv").write_text(", ".join(order) + "\n" + ",".join(cells[c] for c in order) + "\n\n")
    (d / "SHORT.csv").write_text("Date,Close\n2024-02-01\n")
    bars, quarantine = ST.read_bar_csv(spark, str(tmp_path))
    rows = {r.stem: r for r in bars.collect()}
    assert len(rows) == 121 and quarantine.count() == 0
    for i in range(120):
        r = rows[f"T{i:03d}"]
        assert (r.open, r.close, r.volume, r.ts.day) == (i + 0.5, i + 0.25, i, 1 + i % 28)
    assert rows["SHORT"].close is None and "dividends" not in bars.columns
    plan = bars._jdf.queryExecution().optimizedPlan().toString()
    assert sum(" text" in x and "Relation" in x for x in plan.splitlines()) == 1


def test_headers_beyond_the_limit_are_joined(spark, tmp_path, monkeypatch):
    d = tmp_path / "crypto" / "5m"
    d.mkdir(parents=True)
    (d / "A.csv").write_text("Datetime,Close\n2024-06-01T00:00:00+0000,2.0\n")
    (d / "B.csv").write_text("Close,Datetime\n3.0,2024-06-01T00:05:00+0000\n")
    monkeypatch.setattr(ST, "HEADER_BYTES", 0)
    bars, _ = ST.read_bar_csv(spark, str(tmp_path))
    assert sorted((r.stem, r.close) for r in bars.collect()) == [("A", 2.0), ("B", 3.0)]
