"""Run summaries and failure reporting."""

from pyspark.sql import functions as F

from barforge.operators import report as RP

JOB_DDL = "status string, ticker string, asset_class string, interval string, message string, seq long"


def _summary_rows(df):
    return {(r.scope, r.key): r for r in df.collect()}


def test_run_summary_rate(spark):
    jobs = spark.createDataFrame([("success", "AAPL", "stocks_us", "1d", "ok", 0),
                                  ("failed", "AAPL", "stocks_us", "1m", "boom", 1)], JOB_DDL)
    s = _summary_rows(RP.run_summary(jobs))
    t = s[("total", "")]
    assert (t.total, t.success, t.failed, t.attempted, t.failure_rate) == (2, 1, 1, 2, 0.5)
    assert s[("interval", "1m")].failed == 1 and s[("asset_class", "stocks_us")].success == 1


def test_unknown_status_and_blank_keys(spark):
    jobs = spark.createDataFrame([("weird", "X", "", None, "?", 0), ("skipped", "Y", "c", "2h", "", 1)], JOB_DDL)
    s = _summary_rows(RP.run_summary(jobs))
    assert s[("total", "")].failed == 1 and s[("total", "")].skipped == 1
    assert s[("interval", "(unknown)")].failed == 1 and s[("asset_class", "(unknown)")].failed == 1
    assert s[("total", "")].failure_rate == 1.0


def test_merge_partial_summaries(spark):
    rows = [("success", "A", "c", "1m", "", 0), ("success", "B", "c", "1m", "", 1), ("failed", "C", "c", "1m", "x", 2),
            ("success", "D", "c", "1m", "", 3), ("success", "E", "c", "1m", "", 4), ("success", "F", "c", "1m", "", 5),
            ("skipped", "G", "c", "1m", "", 6)]
    jobs = spark.createDataFrame(rows, JOB_DDL).withColumn("shard", F.when(F.col("seq") < 3, 0).otherwise(1))
    parts = RP.run_summary(jobs, ["shard"])
    t = _summary_rows(RP.merge_summaries(parts))[("total", "")]
    assert (t.success, t.failed, t.skipped) == (5, 1, 1)


def test_failure_rate_pct(spark):
    rows = [(0.25, 0, 0, 0, 0), (None, 3, 1, 0, 4), (None, 0, 0, 0, 0)]
    df = spark.createDataFrame(rows, "failure_rate double, success long, failed long, skipped long, attempted long")
    pct = [r.failure_rate_pct for r in RP.failure_rate_pct(df).collect()]
    assert pct == [25.0, 25.0, 0.0]


def test_first_100_failures(spark):
    rows = [("failed", f"T{i}", "c", "1d", "x", i) for i in range(125)]
    f = RP.first_failures(spark.createDataFrame(rows, JOB_DDL)).collect()
    assert len(f) == 100 and f[0].seq == 0 and f[-1].seq == 99


def test_failure_triage(spark):
    msgs = [("404 Not Found", "missing"), ("Dataset does not exist", "missing"),
            ("403 Client Error. You don't have permission to access", "transient"),
            ("401 unauthorized", "permanent"), ("timeout", "other")]
    df = spark.createDataFrame(msgs, "message string, label string")
    got = [(r.label, r.got) for r in df.select("label", RP.triage(F.col("message")).alias("got")).collect()]
    assert all(a == b for a, b in got)


def test_summary_document(spark):
    import json
    jobs = spark.createDataFrame([("success", "A", "c", "1d", "ok", 0), ("failed", "B", "c", "1m", "boom", 1)], JOB_DDL)
    doc = json.loads(RP.summary_document(RP.run_summary(jobs), RP.first_failures(jobs)).first()[0])
    assert doc["total"] == 2 and doc["failure_rate_pct"] == 50.0
    assert doc["by_interval"]["1m"]["failed"] == 1 and doc["failures"][0]["ticker"] == "B"
