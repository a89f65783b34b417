"""Registered listing / universe / planning queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from barforge.functions import symbols as SY
from barforge.plans import refresh as R
from barforge.plans import sqlparts as Q
from barforge.plans.registry import register
from barforge.schema import (ALL_INTERVALS, EUROPE_SUFFIXES, EXCHANGE_SUFFIXES, INTRADAY_INTERVALS,
                             PLAIN_TICKER_PATTERN, PLAIN_TICKER_SKIP, SKIP_SECURITY_NAME_PATTERN,
                             interval_dim)
from barforge.session import checkpoint_dir
from barforge.sources import derived as D
from barforge.sources import files as SF
from barforge.sources import listings as L

# ---- SQL twins of the symbol expressions ---------------------------------
_SUFFIX_RE = "(?:" + "|".join(s.replace(".", r"\.") for s in EXCHANGE_SUFFIXES) + ")$"


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def sql_symbol(x: str) -> str:
    s = sql_strip(x)
    return (f"CASE WHEN regexp_matches(upper({s}), '{_SUFFIX_RE}') OR suffix(upper({s}), '=X') "
            f"OR suffix(upper({s}), '=F') OR contains({s}, '-') THEN {s} "
            rf"ELSE regexp_replace({s}, '^(.+)\.(\pL)$', '\1-\2') END")


SQL_NOT_TEST = "upper(coalesce(test_issue, 'N')) <> 'Y'"
SQL_NOT_SKIP = f"NOT regexp_matches(coalesce(security_name, ''), '{SKIP_SECURITY_NAME_PATTERN}')"
SQL_USABLE = "symbol IS NOT NULL AND symbol <> '' AND lower(symbol) <> 'nan'"
SQL_SAFE = "replace(replace(replace(ticker, '^', ''), '=', '_'), '/', '_')"

_LISTED = [Q.listing_rows(), f"""clean AS (
  SELECT asset_class, file_pos, pos, {sql_symbol('symbol')} AS symbol FROM listing
  WHERE {SQL_NOT_TEST} AND {SQL_NOT_SKIP} AND symbol IS NOT NULL)""", f"""listed AS (
  SELECT asset_class, symbol, arg_min(file_pos, (file_pos, pos)) AS file_pos, arg_min(pos, (file_pos, pos)) AS pos
  FROM clean WHERE {SQL_USABLE} GROUP BY asset_class, symbol)"""]


def _listed(spark, sf):
    return L.listing_symbols(D.listing_rows(spark, sf))


# --------------------------------------------------------------------------- P1-P4
@register("p1_symbol_normalise", Q.with_(Q.listing_rows()) + f"""
SELECT pos, symbol AS raw, {sql_symbol('symbol')} AS symbol FROM listing""")
def p1_symbol_normalise(spark, sf):
    r = D.listing_rows(spark, sf)
    return SY.with_market_symbol(r.select("pos", F.col("symbol").alias("raw")), "raw", "symbol")


@register("p2_file_safe_ticker", Q.with_(Q.TICKS) + f"""
SELECT DISTINCT asset_class, ticker, {SQL_SAFE} AS file_stem FROM ticks""")
def p2_file_safe_ticker(spark, sf):
    t = D.ticks(spark, sf).select("asset_class", "ticker").distinct()
    return t.select("asset_class", "ticker", SY.safe_filename(F.col("ticker")).alias("file_stem"))


@register("p3_test_issue_filter", Q.with_(Q.listing_rows()) + f"""
SELECT pos, symbol FROM listing WHERE {SQL_NOT_TEST}""")
def p3_test_issue_filter(spark, sf):
    r = D.listing_rows(spark, sf)
    return r.where(SY.not_test_issue(F.col("test_issue"))).select("pos", "symbol")


@register("p4_security_name_filter", Q.with_(Q.listing_rows()) + f"""
SELECT pos, security_name FROM listing WHERE {SQL_NOT_SKIP}""")
def p4_security_name_filter(spark, sf):
    r = D.listing_rows(spark, sf)
    return r.where(SY.not_skipped_security(F.col("security_name"))).select("pos", "security_name")


# --------------------------------------------------------------------------- S4 / W2 / U2 / S5
@register("s4_listing_scan", Q.with_(*_LISTED[:2]) + f"""
SELECT asset_class, file_pos, symbol, min(pos) AS pos FROM clean WHERE {SQL_USABLE}
GROUP BY asset_class, file_pos, symbol""")
def s4_listing_scan(spark, sf):
    """Each listing file on its own: its clean, de-duplicated symbols."""
    return L.listing_symbols(D.listing_rows(spark, sf), ("asset_class", "file_pos"), ("pos",)).select(
        "asset_class", "file_pos", "symbol", "pos")


@register("w2_first_seen_dedupe", Q.with_(*_LISTED) + """
SELECT asset_class, symbol, file_pos, pos FROM listed""")
def w2_first_seen_dedupe(spark, sf):
    return _listed(spark, sf).select("asset_class", "symbol", "file_pos", "pos")


@register("u2_distinct_union", Q.with_(*_LISTED) + """
SELECT asset_class, count(*) AS symbols, count(*) FILTER (WHERE file_pos = 1) AS from_second_file
FROM listed GROUP BY asset_class""")
def u2_distinct_union(spark, sf):
    """Union of the listing files of each class without repeats."""
    return _listed(spark, sf).groupBy("asset_class").agg(
        F.count(F.lit(1)).alias("symbols"), F.count_if(F.col("file_pos") == 1).alias("from_second_file"))


_UNIVERSE = _LISTED + [Q.INLINE, """uni_u AS (
  SELECT asset_class, ticker, 0 AS src, 0 AS p1, pos AS p2 FROM inline_t
  UNION ALL
  SELECT asset_class, symbol, 1, file_pos, pos FROM listed l
  WHERE NOT EXISTS (SELECT 1 FROM inline_t i WHERE i.asset_class = l.asset_class AND i.ticker = l.symbol))""",
                       """universe AS (
  SELECT asset_class, ticker, row_number() OVER (PARTITION BY asset_class ORDER BY src, p1, p2) - 1 AS pos
  FROM uni_u)"""]


def _universe(spark, sf):
    return L.build_universe(D.inline_tickers(spark, sf), _listed(spark, sf))


@register("s5_universe_build", Q.with_(*_UNIVERSE) + "SELECT asset_class, ticker, pos FROM universe")
def s5_universe_build(spark, sf):
    return _universe(spark, sf)


# --------------------------------------------------------------------------- W4
@register("w4_stable_shard", Q.with_(*_UNIVERSE) + """
SELECT asset_class, ticker, CAST((row_number() OVER (PARTITION BY asset_class ORDER BY ticker) - 1) % 4 AS INTEGER) AS shard
FROM (SELECT DISTINCT asset_class, ticker FROM universe)""")
def w4_stable_shard(spark, sf):
    return R.stable_shards(_universe(spark, sf), 4).select("asset_class", "ticker", "shard")


# --------------------------------------------------------------------------- S6
_PLAIN_LINE_SQL = """
CASE p_size % 7 WHEN 0 THEN '# ' || p_name WHEN 1 THEN 'NASDAQ:' || base WHEN 2 THEN lower(base)
  WHEN 3 THEN 'CASH' WHEN 4 THEN '1' || base WHEN 5 THEN '  ' || base || '.B  '
  ELSE base || '-' || substr(p_brand, 7) END"""


@register("s6_plain_ticker_text", f"""
WITH lines AS (
  SELECT p_partkey AS line_no, {_PLAIN_LINE_SQL} AS value
  FROM (SELECT *, upper(substr(split_part(p_name, ' ', 1), 1, 2) || substr(split_part(p_name, ' ', 2), 1, 3)) AS base FROM part)),
t AS (
  SELECT line_no, upper({sql_strip('value')}) AS raw FROM lines),
b AS (
  SELECT line_no, raw, CASE WHEN contains(raw, ':') THEN split_part(raw, ':', -1) ELSE raw END AS bare FROM t)
SELECT DISTINCT bare AS symbol FROM b
WHERE raw <> '' AND NOT starts_with(raw, '#')
  AND bare NOT IN ({", ".join(f"'{s}'" for s in PLAIN_TICKER_SKIP)})
  AND regexp_matches(bare, '{PLAIN_TICKER_PATTERN}')
ORDER BY symbol""")
def s6_plain_ticker_text(spark, sf):
    p = D.table(spark, sf, "part").withColumn("base", F.upper(F.concat(
        F.substring(F.substring_index("p_name", " ", 1), 1, 2),
        F.substring(F.substring_index("p_name", " ", -1), 1, 3))))
    path = f"{checkpoint_dir(spark).rstrip('/')}/s6-{uuid.uuid4().hex}"
    p.select(F.expr(_PLAIN_LINE_SQL).alias("value")).where("value is not null").write.text(path)  # as the lists arrive
    return L.plain_ticker_listing(SF.read_lines(spark, path))


# --------------------------------------------------------------------------- S7
_JSON_ROWS_SQL = {
    "公司代號": "CASE WHEN s_suppkey % 3 = 0 THEN CAST(1000 + s_suppkey % 50 AS VARCHAR) ELSE '' END",
    "Code": "CASE WHEN s_suppkey % 3 = 1 THEN ' ' || CAST(2000 + s_nationkey AS VARCHAR) "
            "WHEN s_suppkey % 3 = 2 THEN 'X' || CAST(s_nationkey AS VARCHAR) END",
    "公司簡稱": "CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE '' END",
    "Name": "'N' || CAST(s_suppkey AS VARCHAR)",
    "產業別": "CAST(s_nationkey AS VARCHAR)",
}


@register("s7_json_directory", f"""
WITH r AS (SELECT s_suppkey AS row_no, {", ".join(f'{v} AS "{k}"' for k, v in _JSON_ROWS_SQL.items())} FROM supplier),
c AS (
  SELECT row_no, {sql_strip("coalesce(nullif(\"公司代號\", ''), nullif(\"Code\", ''), '')")} AS code,
         {sql_strip("coalesce(nullif(\"公司簡稱\", ''), nullif(\"Name\", ''), '')")} AS name,
         {sql_strip("coalesce(nullif(\"產業別\", ''), '')")} AS industry
  FROM r)
SELECT code || '.TW' AS symbol, arg_min(name, row_no) AS name, arg_min(industry, row_no) AS industry
FROM c WHERE regexp_matches(code, '^[0-9]+$') GROUP BY code ORDER BY symbol""")
def s7_json_directory(spark, sf):
    s = D.table(spark, sf, "supplier")
    rows = s.select(F.col("s_suppkey").alias("row_no"),
                    *[F.expr(v.replace("VARCHAR", "STRING")).alias(k) for k, v in _JSON_ROWS_SQL.items()])
    # staged as the directories arrive: a JSON array a file, with an element that is no object
    js = rows.select("row_no", F.to_json(F.struct(*[F.col(f"`{k}`") for k in _JSON_ROWS_SQL])).alias("j"))
    arrays = js.groupBy(F.expr("row_no div 100").alias("file")).agg(F.sort_array(F.collect_list(F.struct("row_no", "j"))).alias("r"))
    text = arrays.select("file", F.concat(F.lit('["no object", '), F.array_join("r.j", ",\n"), F.lit("]")).alias("value"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/s7-{uuid.uuid4().hex}"
    text.repartitionByRange("file").sortWithinPartitions("file").select("value").write.option("maxRecordsPerFile", 1).text(path)
    return L.json_directory_listing(SF.read_json_records(spark, path, list(_JSON_ROWS_SQL)), ["公司代號", "Code"],
                                    ["公司簡稱", "公司名稱", "Name"], ["產業別", "Industry"])


# --------------------------------------------------------------------------- S8
_CANDIDATES_SQL = [
    "base || '.L'", "base || '.de'", "'0' || base || '.L'", "base || '.US'",
    "CASE WHEN p_size % 3 = 0 THEN substr(base, 1, 3) || '.PA' END",
    "CASE WHEN p_size % 4 = 0 THEN base || '.LS' END", "substr(base, 1, 2) || '.F'"]
_CAND_ORDER = "CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'LARGE' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'PROMO' THEN 3 WHEN 'SMALL' THEN 4 ELSE 5 END"


def _rank_sql(x: str) -> str:
    arms = " ".join(f"WHEN suffix(upper({x}), '{s}') THEN {i}" for i, s in enumerate(EUROPE_SUFFIXES))
    return f"CASE {arms} ELSE 100 END"


@register("s8_nested_constituents", f"""
WITH p AS (SELECT *, upper(substr(split_part(p_name, ' ', 1), 1, 2) || substr(split_part(p_name, ' ', 2), 1, 3)) AS base FROM part),
c AS (
  SELECT p_type AS index_name, {_CAND_ORDER} AS index_pos, p_partkey AS stock_pos, p_name AS name,
         unnest([{", ".join(_CANDIDATES_SQL)}]) AS sym FROM p),
k AS (
  SELECT *, {_rank_sql('sym')} AS rk FROM c
  WHERE sym IS NOT NULL AND sym <> '' AND NOT regexp_matches(sym, '^[0-9]')),
best AS (
  SELECT index_name, index_pos, stock_pos, name, arg_min(sym, (rk, length(sym), sym)) AS symbol
  FROM k WHERE rk < 100 GROUP BY ALL)
SELECT symbol, arg_min(name, (index_pos, stock_pos)) AS name, arg_min(index_name, (index_pos, stock_pos)) AS index_name
FROM best GROUP BY symbol ORDER BY symbol""")
def s8_nested_constituents(spark, sf):
    p = D.table(spark, sf, "part").withColumn("base", F.upper(F.concat(
        F.substring(F.substring_index("p_name", " ", 1), 1, 2),
        F.substring(F.substring_index("p_name", " ", -1), 1, 3))))
    cands = F.array(*[F.struct(F.expr(c).alias("yahoo")) for c in _CANDIDATES_SQL])
    stocks = p.select(F.col("p_type").alias("index_name"), F.expr(_CAND_ORDER).alias("index_pos"),
                      F.col("p_partkey").alias("stock_pos"), F.col("p_name").alias("name"),
                      cands.alias("symbols"))
    return L.nested_constituents_listing(stocks)


# --------------------------------------------------------------------------- S9
@register("s9_exchange_directory", """
WITH m AS (
  SELECT CASE WHEN length(code) < 6 THEN lpad(code, 6, '0') ELSE code END
           || CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN '.KS' ELSE '.KQ' END AS symbol,
         c_name AS name, CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'KOSPI' ELSE 'KOSDAQ' END AS market,
         CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 0 ELSE 1 END AS m_pos, c_custkey AS r_pos
  FROM (SELECT *, CAST(c_custkey * 7 % 1234567 AS VARCHAR) AS code FROM customer))
SELECT symbol, arg_min(name, (m_pos, r_pos)) AS name, arg_min(market, (m_pos, r_pos)) AS market
FROM m GROUP BY symbol ORDER BY symbol""")
def s9_exchange_directory(spark, sf):
    c = D.table(spark, sf, "customer").select(
        (F.col("c_custkey") * 7 % 1234567).cast("string").alias("code"), F.col("c_name").alias("name"),
        F.col("c_custkey").alias("row_no"), "c_mktsegment")
    kospi = c.where(F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"))
    kosdaq = c.where(~F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE"))
    return L.exchange_directory_listing({"KOSPI": kospi, "KOSDAQ": kosdaq}, {"KOSPI": ".KS", "KOSDAQ": ".KQ"})


# --------------------------------------------------------------------------- S12 / S13
# one refresh entry per listing file: its builder (source) and url
_ENTRY_SOURCE_SQL = """CASE asset_class || '/' || CAST(file_pos AS STRING)
  WHEN 'stocks_us/1' THEN 'plain_tickers' WHEN 'stocks_eu/0' THEN 'europe'
  WHEN 'indices/0' THEN 'russell2000' WHEN 'indices/1' THEN 'plain_tickers' END"""
_ENTRY_URL_SQL = """CASE asset_class || '/' || CAST(file_pos AS STRING)
  WHEN 'stocks_us/0' THEN 'https://listings.invalid/us0.csv'
  WHEN 'stocks_us/1' THEN 'https://listings.invalid/us1.txt' END"""
_SOURCES = [Q.listing_rows(), f"""clean_all AS (
  SELECT asset_class, file_pos, p_type, pos, {sql_symbol('symbol')} AS symbol FROM (
    SELECT l.*, p.p_type, p.p_size FROM listing l JOIN part p ON l.pos = p.p_partkey)
  WHERE {SQL_NOT_TEST} AND {SQL_NOT_SKIP} AND symbol IS NOT NULL)""",
            f"""staged AS (SELECT DISTINCT asset_class, file_pos, symbol FROM clean_all
                WHERE {SQL_USABLE} AND p_type <> 'LARGE')""",
            f"""stored AS (SELECT DISTINCT asset_class, file_pos, symbol FROM clean_all c
                WHERE {SQL_USABLE} AND p_type <> 'PROMO'
                  AND NOT (p_type = 'SMALL' AND pos IN (SELECT p_partkey FROM part WHERE p_size > 45)))""",
            f"""src AS (SELECT asset_class, file_pos, {_ENTRY_SOURCE_SQL.replace("STRING", "VARCHAR")} AS source,
                       {_ENTRY_URL_SQL.replace("STRING", "VARCHAR")} AS url
                FROM (SELECT DISTINCT asset_class, file_pos FROM listing))""",
            """outcome AS (
  SELECT s.asset_class, s.file_pos,
         CASE WHEN NOT (coalesce(s.source IN ('krx', 'tse', 'europe', 'twse', 'plain_tickers', 'russell2000'), false)
                        OR s.url IS NOT NULL) THEN 'skipped'
              WHEN s.source = 'plain_tickers' AND s.url IS NULL THEN 'failed'
              WHEN n.n IS NULL THEN 'failed' WHEN o.n IS NULL THEN 'created'
              WHEN o.syms = n.syms THEN 'unchanged' ELSE 'updated' END AS status
  FROM src s
  LEFT JOIN (SELECT asset_class, file_pos, count(*) AS n, list(symbol ORDER BY symbol) AS syms FROM stored GROUP BY ALL) o
    USING (asset_class, file_pos)
  LEFT JOIN (SELECT asset_class, file_pos, count(*) AS n, list(symbol ORDER BY symbol) AS syms FROM staged GROUP BY ALL) n
    USING (asset_class, file_pos))"""]


def _outcomes(spark, sf):
    rows = D.listing_rows(spark, sf).join(
        D.table(spark, sf, "part").select(F.col("p_partkey").alias("pos"), "p_type", "p_size"), "pos")
    grp, order = ("asset_class", "file_pos"), ("pos",)
    staged = L.listing_symbols(rows.where(F.col("p_type") != "LARGE"), grp, order)
    stored = L.listing_symbols(rows.where((F.col("p_type") != "PROMO") & ~(
        (F.col("p_type") == "SMALL") & (F.col("p_size") > 45))), grp, order)
    fp_new = L.content_fingerprint(staged, grp, ["symbol"])
    fp_old = L.content_fingerprint(stored, grp, ["symbol"])
    entries = rows.select(*grp).distinct().select(
        *grp, F.expr(_ENTRY_SOURCE_SQL).alias("source"), F.expr(_ENTRY_URL_SQL).alias("url"))
    return L.entry_outcomes(entries, fp_old, fp_new, grp)


@register("s12_write_if_changed", Q.with_(*_SOURCES) + "SELECT asset_class, file_pos, status FROM outcome")
def s12_write_if_changed(spark, sf):
    return _outcomes(spark, sf)


@register("s13_listing_refresh_report", Q.with_(*_SOURCES) + """
SELECT count(*) FILTER (WHERE status <> 'skipped') AS checked,
       count(*) FILTER (WHERE status IN ('created', 'updated')) AS updated,
       count(*) FILTER (WHERE status = 'failed') AS failed FROM outcome""")
def s13_listing_refresh_report(spark, sf):
    return L.refresh_report(_outcomes(spark, sf))


# --------------------------------------------------------------------------- U3 / P9 / U4 / P10
@register("u3_unknown_classes", Q.with_(Q.TICKS, *_UNIVERSE) + """
SELECT DISTINCT asset_class FROM ticks EXCEPT SELECT DISTINCT asset_class FROM universe""")
def u3_unknown_classes(spark, sf):
    return R.unknown_names(D.ticks(spark, sf), _universe(spark, sf))


@register("p9_class_selection", Q.with_(Q.bars_1d(), *_UNIVERSE) + """
SELECT asset_class, ticker, pos FROM universe WHERE asset_class IN (SELECT DISTINCT asset_class FROM bars_1d)""")
def p9_class_selection(spark, sf):
    return R.select_classes(_universe(spark, sf), D.bars_1d(spark, sf).select("asset_class"))


_SUPPORTED_SQL = ", ".join(f"('{i}')" for i in INTRADAY_INTERVALS)


@register("u4_allowed_intervals", Q.with_(Q.JOBS) + f"""
SELECT interval FROM jobs WHERE interval IS NOT NULL
INTERSECT SELECT interval FROM (VALUES {_SUPPORTED_SQL}) v(interval)""")
def u4_allowed_intervals(spark, sf):
    supported = spark.createDataFrame([(i,) for i in INTRADAY_INTERVALS], "interval string")
    req = D.job_results(spark, sf).where(F.col("interval").isNotNull())
    return R.allowed_intervals(req, supported)


@register("p10_interval_classification", Q.with_(Q.JOBS) + f"""
SELECT interval, CASE WHEN interval IN ({", ".join(f"'{i}'" for i in INTRADAY_INTERVALS)}) THEN 'intraday'
                      WHEN interval IN ({", ".join(f"'{i}'" for i in ALL_INTERVALS if i not in INTRADAY_INTERVALS)}) THEN 'cumulative'
                      ELSE 'unsupported' END AS kind, count(*) AS jobs
FROM jobs GROUP BY ALL""")
def p10_interval_classification(spark, sf):
    j = R.classify_intervals(D.job_results(spark, sf), interval_dim(spark))
    return j.groupBy("interval", "kind").agg(F.count(F.lit(1)).alias("jobs"))


# --------------------------------------------------------------------------- J4 / J5 / A18
@register("j4_work_plan", Q.with_(*_UNIVERSE) + """
SELECT asset_class, ticker, interval FROM universe, (VALUES ('1d'), ('1wk')) v(interval)""")
def j4_work_plan(spark, sf):
    return R.work_plan(_universe(spark, sf), ("1d", "1wk")).select("asset_class", "ticker", "interval")


_J5 = [Q.bars_1d("stored_1d", ["F"]), Q.rollup("stored_1d", "1wk", "stored_1wk"),
       "stored AS (SELECT * FROM stored_1d UNION ALL SELECT * FROM stored_1wk)",
       f"done AS (SELECT {Q.SERIES} FROM stored GROUP BY ALL HAVING count(*) >= 20)",
       "plan AS (SELECT DISTINCT asset_class, ticker, unnest(['1d', '1wk', '1mo']) AS interval FROM stored_1d)"]


@register("j5_resume", Q.with_(*_J5) + f"""
SELECT p.asset_class, p.interval, p.ticker,
       CASE WHEN EXISTS (SELECT 1 FROM done d WHERE d.asset_class = p.asset_class AND d.interval = p.interval
                         AND d.ticker = p.ticker) THEN 'skipped' ELSE 'remaining' END AS state
FROM plan p""")
def j5_resume(spark, sf):
    from barforge.operators.bars import rollup_bars
    from barforge.operators.merge import trusted_last_ts
    s1 = D.bars_1d(spark, sf, ("F",))
    stored = s1.unionByName(rollup_bars(s1, "1wk"))
    done = trusted_last_ts(stored).where(F.col("last_ts").isNotNull()).select("asset_class", "interval", "ticker")
    plan = R.work_plan(s1.select("asset_class", "ticker").distinct(), ("1d", "1wk", "1mo"))
    remaining, skipped = R.resume(plan, done)
    return (remaining.withColumn("state", F.lit("remaining"))
            .unionByName(skipped.withColumn("state", F.lit("skipped")))
            .select("asset_class", "interval", "ticker", "state"))


@register("a18_distinct_requests", Q.with_(*_UNIVERSE) + """
SELECT ticker, '1d' AS interval, count(DISTINCT asset_class) AS classes FROM universe GROUP BY ticker""")
def a18_distinct_requests(spark, sf):
    plan = R.work_plan(_universe(spark, sf), ("1d",)).withColumn("start", F.lit(None).cast("date")) \
        .withColumn("period", F.lit("max"))
    uniq, tagged = R.distinct_requests(plan)
    served = tagged.groupBy("request_id").agg(F.count_distinct("asset_class").alias("classes"))
    return uniq.join(served, "request_id").select("ticker", "interval", "classes")


# --------------------------------------------------------------------------- J7 / J8
_J7 = [Q.TICKS, Q.TICK_SOURCES, Q.source_bars(), """cand AS (
  SELECT DISTINCT asset_class, ticker, interval,
         CASE interval WHEN '5m' THEN 0 ELSE 1 END AS iv_rank FROM src_bars WHERE interval IN ('5m', '15m'))""",
       f"""avail AS (SELECT {Q.SERIES} FROM src_bars WHERE src = 'stored' GROUP BY ALL HAVING count(*) >= 20)"""]


@register("j7_first_available", Q.with_(*_J7) + """
SELECT asset_class, arg_min(ticker, (iv_rank, ticker)) AS ticker, arg_min(interval, (iv_rank, ticker)) AS interval
FROM cand c WHERE EXISTS (SELECT 1 FROM avail a WHERE a.asset_class = c.asset_class AND a.ticker = c.ticker
                          AND a.interval = c.interval)
GROUP BY asset_class""")
def j7_first_available(spark, sf):
    from barforge.operators.merge import trusted_last_ts
    b = D.intraday_source_bars(spark, sf, ["5m", "15m"])
    cand = (b.select("asset_class", "ticker", "interval").distinct()
            .withColumn("priority", F.struct(F.when(F.col("interval") == "5m", 0).otherwise(1), "ticker")))
    avail = trusted_last_ts(b.where(F.col("src") == "stored")).where(F.col("last_ts").isNotNull())
    return R.first_available(cand, avail, ("asset_class", "ticker", "interval"), ("asset_class",))


_PERIOD_RANK = "CASE event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END"


@register("j8_period_fallback", Q.with_(Q.TICKS) + f"""
SELECT asset_class, ticker, period_rank, count(*) AS rows FROM (
  SELECT asset_class, ticker, {_PERIOD_RANK} AS period_rank FROM ticks
  QUALIFY {_PERIOD_RANK} = min({_PERIOD_RANK}) OVER (PARTITION BY asset_class, ticker))
GROUP BY ALL""")
def j8_period_fallback(spark, sf):
    t = D.ticks(spark, sf).withColumn("period_rank", F.expr(_PERIOD_RANK))
    kept = R.period_fallback(t, ("asset_class", "ticker"))
    return kept.groupBy("asset_class", "ticker", "period_rank").agg(F.count(F.lit(1)).alias("rows"))


# --------------------------------------------------------------------------- A12
_PLAN_SQL = """
SELECT n_nationkey AS entry_id,
       CASE n_regionkey WHEN 0 THEN 'stocks_us' WHEN 1 THEN 'stocks_eu' WHEN 2 THEN 'crypto'
                        WHEN 3 THEN 'rates' ELSE 'stocks_us' END AS asset_class,
       CAST(n_nationkey // 5 AS INTEGER) AS shard_index, 5 AS shard_count
FROM nation"""


def _shard_plan(spark, sf):
    return D.table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("entry_id"),
        F.expr("CASE n_regionkey WHEN 0 THEN 'stocks_us' WHEN 1 THEN 'stocks_eu' WHEN 2 THEN 'crypto' "
               "WHEN 3 THEN 'rates' ELSE 'stocks_us' END").alias("asset_class"),
        (F.col("n_nationkey") / 5).cast("int").alias("shard_index"), F.lit(5).alias("shard_count"))


@register("a12_shard_audit", Q.with_(*_UNIVERSE, f"plan AS ({_PLAN_SQL})", """sh AS (
  SELECT asset_class, (row_number() OVER (PARTITION BY asset_class ORDER BY ticker) - 1) % 5 AS shard_index,
         ticker FROM (SELECT DISTINCT asset_class, ticker FROM universe))""") + """
SELECT p.entry_id, p.asset_class, p.shard_index,
       (SELECT count(*) FROM sh WHERE sh.asset_class = p.asset_class AND sh.shard_index = p.shard_index) AS tickers,
       count(*) OVER (PARTITION BY p.asset_class, p.shard_index) > 1 AS duplicated
FROM plan p""")
def a12_shard_audit(spark, sf):
    entries, _ = R.shard_audit(_shard_plan(spark, sf), _universe(spark, sf))
    return entries.select("entry_id", "asset_class", "shard_index", "tickers", "duplicated")


@register("a12_uncovered_classes", Q.with_(*_UNIVERSE, f"plan AS ({_PLAN_SQL})") + """
SELECT DISTINCT asset_class FROM universe WHERE asset_class NOT IN (SELECT asset_class FROM plan)""")
def a12_uncovered_classes(spark, sf):
    _, uncovered = R.shard_audit(_shard_plan(spark, sf), _universe(spark, sf))
    return uncovered
