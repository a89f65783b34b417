"""Plain lists and JSON directories from files."""

import json

import pytest

from barforge.sources import files as SF
from barforge.sources import listings as L

CODES, NAMES, INDUSTRIES = ["公司代號", "Code"], ["公司簡稱", "公司名稱", "Name"], ["產業別", "Industry"]


def test_plain_list(spark, tmp_path):
    (tmp_path / "mdy.txt").write_bytes(b"AAPL\naap\n# comment\nNYSE:BRK.B\nCASH\r\nUSD\nXTSLA\nP5N994\n1BAD\nAAPL\n")
    lines = SF.read_lines(spark, str(tmp_path))
    assert [r.value for r in lines.orderBy("line_no").collect()][:5] == ["AAPL", "aap", "# comment", "NYSE:BRK.B", "CASH"]
    assert [r.symbol for r in L.plain_ticker_listing(lines).collect()] == ["AAP", "AAPL", "BRK.B"]
    (tmp_path / "mdy.txt").write_text("# nothing\nCASH\n")
    with pytest.raises(ValueError):
        L.plain_ticker_listing(SF.read_lines(spark, str(tmp_path)))


def directory(spark, path):
    rows = SF.read_json_records(spark, str(path), [*CODES, *NAMES, *INDUSTRIES])
    return [tuple(r) for r in L.json_directory_listing(rows, CODES, NAMES, INDUSTRIES).collect()]


def test_json_directory(spark, tmp_path):
    records = [{"公司代號": "2330", "公司簡稱": "台積電", "產業別": "24"}, "text", None, 7, ["x"],
               {"公司代號": "1101", "公司簡稱": "台泥", "產業別": "01"}, {"公司代號": "skip", "公司簡稱": "bad"},
               {"公司代號": "", "Code": 1102, "公司名稱": "second", "Industry": "02"}, {"Code": "2330", "Name": "later"}, {}]
    (tmp_path / "a.json").write_text(json.dumps(records, ensure_ascii=False, indent=1), encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps([{"Code": "1101", "Name": "other file"}, {"Code": "9"}]))
    assert directory(spark, tmp_path) == [("1101.TW", "台泥", "01"), ("1102.TW", "second", "02"), ("2330.TW", "台積電", "24"), ("9.TW", "", "")]


@pytest.mark.parametrize("text,why", [("[{\"Code\": ", "no valid JSON"), ("", "no valid JSON"), ("{\"Code\": \"1\"}", "no array"), (" [ \n]", "empty array")])
def test_broken_directories_raise_with_their_name(spark, tmp_path, text, why):
    (tmp_path / "good.json").write_text("[{\"Code\": \"1\"}]")
    (tmp_path / "broken.json").write_text(text)
    with pytest.raises(ValueError, match=f"broken.json .*{why}"):
        directory(spark, tmp_path)


def test_directory_without_a_code_raises(spark, tmp_path):
    (tmp_path / "a.json").write_text("[{\"Code\": \"x\"}, 3]")
    with pytest.raises(ValueError, match="company directory"):
        directory(spark, tmp_path)
