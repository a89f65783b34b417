"""Symbol rules and listing sources."""

import pytest
from pyspark.sql import functions as F

from barforge.functions import symbols as SY
from barforge.sources import listings as L


def test_market_symbol_mapping(spark):
    cases = [("BRK.B", "BRK-B"), ("BF.B", "BF-B"), ("  MSFT  ", "MSFT"), ("AAPL", "AAPL"),
             ("005930.KS", "005930.KS"), ("035420.KQ", "035420.KQ"), ("7203.T", "7203.T"),
             ("0700.HK", "0700.HK"), ("2330.TW", "2330.TW"), ("6488.TWO", "6488.TWO"),
             ("EURUSD=X", "EURUSD=X"), ("CL=F", "CL=F"), ("BTC-USD", "BTC-USD"), ("SAP.DE", "SAP.DE"),
             ("BF.b", "BF-b"), (".B", ".B"), ("A.BC", "A.BC"), ("X.F", "X.F")]
    df = spark.createDataFrame(cases, "raw string, expected string")
    got = SY.with_market_symbol(df, "raw", "got").collect()
    assert [(r.raw, r.got) for r in got] == [(r, e) for r, e in cases]
    got2 = df.select(SY.to_market_symbol(F.col("raw")).alias("g")).collect()
    assert [r.g for r in got2] == [e for _, e in cases]


def test_safe_filename(spark):
    df = spark.createDataFrame([("^GSPC",), ("CL=F",), ("A/B",)], "t string")
    assert [r[0] for r in df.select(SY.safe_filename(F.col("t"))).collect()] == ["GSPC", "CL_F", "A_B"]


def test_listing_filters_and_dedupes(spark, tmp_path):
    p = tmp_path / "listings.csv"
    p.write_text("Symbol,Security Name,Test Issue\nAAPL,Apple Inc.,N\nBRK.B,Berkshire Hathaway Class B,N\n"
                 "TEST,Fake Test Co,Y\nFOOW,Foo Warrant,N\nBARR,Bar Rights,N\nBAZU,Baz Unit,N\n"
                 "AAPL,Apple duplicate,N\nMSFT,Microsoft Corporation,N\n")
    rows = L.read_listing_csv(spark, str(p)).withColumn("asset_class", F.lit("x"))
    out = L.listing_symbols(rows, order=("pos",)).orderBy("pos").collect()
    assert [r.symbol for r in out] == ["AAPL", "BRK-B", "MSFT"]


def test_listing_requires_symbol_column(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("Ticker\nAAPL\n")
    with pytest.raises(ValueError, match="Symbol"):
        L.read_listing_csv(spark, str(p))


def test_unity_is_not_a_unit(spark):
    df = spark.createDataFrame([("Unity Software",), ("Foo Units",), ("X rights",)], "n string")
    kept = [r.n for r in df.where(SY.not_skipped_security(F.col("n"))).collect()]
    assert kept == ["Unity Software"]


def test_exchange_directory_pads_without_truncating(spark):
    kospi = spark.createDataFrame([("5930", "Samsung", 0), ("123", "Small", 1)], "code string, name string, row_no int")
    kosdaq = spark.createDataFrame([("35420", "Naver", 0), ("1234567", "Long", 1)], "code string, name string, row_no int")
    out = L.exchange_directory_listing({"KOSPI": kospi, "KOSDAQ": kosdaq}, {"KOSPI": ".KS", "KOSDAQ": ".KQ"}).collect()
    assert [r.symbol for r in out] == ["000123.KS", "005930.KS", "035420.KQ", "1234567.KQ"]


def test_plain_suffix_directory(spark):
    tse = spark.createDataFrame([("7203", "Toyota", 0), ("6758", "Sony", 1)], "code string, name string, row_no int")
    out = L.exchange_directory_listing({"TSE": tse}, {"TSE": ".T"}, pad=None).collect()
    assert [r.symbol for r in out] == ["6758.T", "7203.T"]


def test_nested_constituents(spark):
    rows = [("DAX", 0, 0, "SAP", [("SAP.DE",), ("0A2W.L",)]), ("DAX", 0, 1, "ASML", [("ASML.AS",)]),
            ("DAX", 0, 2, "NoMatch", [("XYZ.US",)])]
    df = spark.createDataFrame(rows, "index_name string, index_pos int, stock_pos int, name string, "
                                     "symbols array<struct<yahoo: string>>")
    out = [r.symbol for r in L.nested_constituents_listing(df).collect()]
    assert out == ["ASML.AS", "SAP.DE"]


def test_json_directory(spark):
    rows = [(0, "2330", "台積電", "24"), (1, "1101", "台泥", "01"), (2, "skip", "bad", None)]
    df = spark.createDataFrame(rows, "row_no int, `公司代號` string, `公司簡稱` string, `產業別` string")
    out = L.json_directory_listing(df, ["公司代號", "Code"], ["公司簡稱", "Name"], ["產業別", "Industry"]).collect()
    assert [r.symbol for r in out] == ["1101.TW", "2330.TW"]


def test_plain_ticker_text(spark):
    lines = ["AAPL", "aap", "# comment", "NYSE:BRK.B", "CASH", "USD", "XTSLA", "P5N994", "1BAD", "AAPL"]
    df = spark.createDataFrame(list(enumerate(lines)), "line_no int, value string")
    out = [r.symbol for r in L.plain_ticker_listing(df).collect()]
    assert out == ["AAP", "AAPL", "BRK.B"]


def _fp(spark, rows):
    df = spark.createDataFrame(rows, "src string, symbol string")
    return L.content_fingerprint(df, ["src"], ["symbol"])


def _entries(spark, rows):
    return spark.createDataFrame(rows, "src string, source string, url string")


def _report(spark, entries, stored, staged):
    out = L.entry_outcomes(_entries(spark, entries), stored, staged, ["src"])
    r = L.refresh_report(out).first()
    return (r.checked, r.updated, r.failed)


def test_refresh_report_cases(spark):
    six = [(f"s{i}", src, None) for i, src in enumerate(["krx", "tse", "europe", "twse", "russell2000", "krx"])]
    staged = _fp(spark, [(f"s{i}", "AAA") for i in range(6)])
    empty = _fp(spark, [("x", "A")]).limit(0)
    assert _report(spark, six, empty, staged) == (6, 6, 0)
    url = [("u", None, "https://x.invalid/l.csv")]
    one = _fp(spark, [("u", "AAPL"), ("u", "MSFT")])
    assert _report(spark, url, empty, one) == (1, 1, 0)      # first run: created
    assert _report(spark, url, one, one) == (1, 0, 0)        # identical rerun
    assert _report(spark, url, one, empty) == (1, 0, 1)      # empty body fails, copy kept
    assert _report(spark, [("p", "plain_tickers", None)], empty, one.where("false")) == (1, 0, 1)
    five = [(f"f{i}", "europe", None) for i in range(5)]
    assert _report(spark, five, empty, empty) == (5, 0, 5)
    assert _report(spark, [("local", None, None)], empty, empty) == (0, 0, 0)  # not checked


def test_fingerprint_sees_where_nulls_are(spark):
    from barforge.sources import listings as L
    df = spark.createDataFrame([("a", "x", None), ("b", None, "x")], "g string, p string, q string")
    got = {tuple(r)[1:] for r in L.content_fingerprint(df, ["g"], ["p", "q"]).collect()}
    assert len(got) == 2


def test_empty_sources_raise(spark):
    from barforge.sources import listings as L
    lines = spark.createDataFrame([("  ", 1)], "value string, line_no int")
    with pytest.raises(ValueError, match="no usable symbol"):
        L.plain_ticker_listing(lines)
    market = spark.createDataFrame([], "code string, name string, row_no int")
    with pytest.raises(ValueError, match="no usable symbol"):
        L.exchange_directory_listing({"M": market}, {"M": ".X"})
    with pytest.raises(ValueError, match="no column"):
        L.exchange_directory_listing({"M": market.drop("name")}, {"M": ".X"})


def test_exchange_directory_keeps_industry(spark):
    from barforge.sources import listings as L
    market = spark.createDataFrame([("20", "N1", "steel", 1), ("20", "N2", "gas", 2)], "code string, name string, industry string, row_no int")
    got = [tuple(r) for r in L.exchange_directory_listing({"M": market}, {"M": ".X"}).collect()]
    assert got == [("000020.X", "N1", "M", "steel")]
