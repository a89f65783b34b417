"""DuckDB statements that define the derived inputs exactly as
``barforge.sources.derived`` does, for the oracle side of each query."""

from __future__ import annotations

from barforge.schema import INTRADAY_MINUTES, INTRADAY_INTERVALS
from barforge.sources.derived import (JOB_CLASS_SQL, JOB_INTERVAL_SQL, JOB_MESSAGE_SQL,
                                      JOB_STATUS_SQL, LISTING_CLASS_SQL, LISTING_SYMBOL_SQL,
                                      SECURITY_NAME_SQL, TEST_ISSUE_SQL,
                                      TICK_SOURCE_SQL)

SERIES = "asset_class, interval, ticker"
_CAL = {"1d": "day", "1wk": "week", "1mo": "month", "3mo": "quarter"}


def r6(expr: str) -> str:
    return f"round({expr}, 6)"


def bar_start(interval: str, ts: str = "ts") -> str:
    if interval in _CAL:
        return f"date_trunc('{_CAL[interval]}', {ts})"
    minutes = INTRADAY_MINUTES.get(interval) or {"5d": 7200}[interval]
    w = minutes * 60_000_000
    return f"make_timestamp(epoch_us({ts}) - epoch_us({ts}) % {w})"


def bars_1d(name: str = "bars_1d", statuses=None) -> str:
    where = ""
    if statuses:
        where = "WHERE o_orderstatus IN (" + ", ".join(f"'{s}'" for s in statuses) + ")"
    return f"""{name} AS (
  SELECT CASE WHEN k < 4 THEN 'stocks_us' WHEN k < 7 THEN 'crypto' ELSE 'indices' END AS asset_class,
         '1d' AS interval, 'T' || CAST(k AS VARCHAR) AS ticker, ts,
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
         min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
         CASE WHEN k % 2 = 0 THEN arg_max(o_totalprice, o_orderkey) * 0.98 END AS adj_close,
         CAST(count(*) AS BIGINT) AS volume
  FROM (SELECT o_custkey % 10 AS k, CAST(o_orderdate AS TIMESTAMP) AS ts, o_orderkey, o_totalprice
        FROM orders {where}) o
  GROUP BY k, ts)"""


def bars_many(n: int = 40, name: str = "bars_3mo") -> str:
    return f"""{name} AS (
  SELECT 'Q' || CAST(o_custkey % {n} AS VARCHAR) AS ticker, date_trunc('quarter', CAST(o_orderdate AS TIMESTAMP)) AS ts,
         arg_max(o_totalprice, o_orderkey) AS close
  FROM orders GROUP BY ALL)"""


TICKS = r"""ticks AS (
  SELECT CASE WHEN user_id % 3 = 0 THEN 'crypto' WHEN user_id % 3 = 1 THEN 'stocks_us'
              ELSE 'currencies' END AS asset_class,
         'U' || CAST(user_id AS VARCHAR)
           || CASE WHEN user_id % 3 = 0 THEN '-USD' WHEN user_id % 3 = 2 THEN '=X' ELSE '' END AS ticker, CAST(ts AS TIMESTAMP) AS ts, value AS price,
         TRY_CAST(NULLIF(regexp_extract(props, '"k":\s*(-?\d+)', 1), '') AS BIGINT) AS size,
         event_id AS seq, event_type
  FROM events)"""


def bars_from_ticks(intervals=INTRADAY_INTERVALS, name: str = "bars_intraday",
                    ticks: str = "ticks") -> str:
    arms = "\n    UNION ALL ".join(
        f"SELECT asset_class, ticker, ts, price, size, '{iv}' AS interval, {bar_start(iv)} AS bts FROM {ticks}"
        for iv in intervals)
    return f"""{name} AS (
  SELECT asset_class, interval, ticker, bts AS ts, arg_min(price, ts) AS open, max(price) AS high,
         min(price) AS low, arg_max(price, ts) AS close, CAST(NULL AS DOUBLE) AS adj_close,
         CAST(sum(size) AS BIGINT) AS volume, CAST(count(*) AS BIGINT) AS n_ticks
  FROM ({arms}) x
  GROUP BY asset_class, interval, ticker, bts)"""


def rollup(src: str, interval: str, name: str) -> str:
    return f"""{name} AS (
  SELECT asset_class, '{interval}' AS interval, ticker, {bar_start(interval)} AS ts,
         arg_min(open, ts) AS open, max(high) AS high, min(low) AS low,
         arg_max(close, ts) AS close, arg_max(adj_close, ts) AS adj_close,
         CAST(sum(volume) AS BIGINT) AS volume
  FROM {src} GROUP BY asset_class, ticker, {bar_start(interval)})"""


def adjusted(src: str, name: str = "px") -> str:
    return f"""{name} AS (
  SELECT *, CASE WHEN count(adj_close) OVER (PARTITION BY {SERIES}) > 0
                 THEN adj_close ELSE close END AS price
  FROM {src})"""


def features(src: str = "px", name: str = "feat") -> str:
    """Feature frame (W7-W10) on ``src(price, volume)`` with nulls dropped."""
    def roll(fn, width, x="log_ret"):
        return (f"CASE WHEN count({x}) OVER (PARTITION BY {SERIES} ORDER BY ts ROWS BETWEEN "
                f"{width - 1} PRECEDING AND CURRENT ROW) = {width} THEN {fn}({x}) OVER "
                f"(PARTITION BY {SERIES} ORDER BY ts ROWS BETWEEN {width - 1} PRECEDING AND CURRENT ROW) END")
    cols = []
    for w in (5, 10, 20):
        cols.append(f"{roll('avg', w)} AS sma_{w}")
        cols.append(f"{roll('stddev_samp', w)} AS vol_{w}")
    return f"""{name}_base AS (
  SELECT {SERIES}, ts, price, ln(price) AS log_price,
         ln(price) - lag(ln(price)) OVER (PARTITION BY {SERIES} ORDER BY ts) AS log_ret,
         lead(price) OVER (PARTITION BY {SERIES} ORDER BY ts) AS next_price,
         ln(1 + CAST(volume AS DOUBLE)) AS lv
  FROM {src}),
{name}_roll AS (
  SELECT {SERIES}, ts, price, log_price, log_ret, next_price, {", ".join(cols)},
         {roll('avg', 20, 'lv')} AS lv_m, {roll('stddev_samp', 20, 'lv')} AS lv_s, lv,
         lead(log_ret) OVER (PARTITION BY {SERIES} ORDER BY ts) AS target
  FROM {name}_base),
{name} AS (
  SELECT {SERIES}, ts, price, log_price, log_ret, next_price, sma_5, vol_5, sma_10, vol_10,
         sma_20, vol_20,
         CASE WHEN lv_s IS NULL OR lv_s = 0 OR lv_m IS NULL THEN 0.0 ELSE (lv - lv_m) / lv_s END AS volume_z,
         target
  FROM {name}_roll
  WHERE log_ret IS NOT NULL AND next_price IS NOT NULL AND sma_5 IS NOT NULL AND vol_5 IS NOT NULL
    AND sma_10 IS NOT NULL AND vol_10 IS NOT NULL AND sma_20 IS NOT NULL AND vol_20 IS NOT NULL
    AND target IS NOT NULL)"""


def split(src: str = "feat", name: str = "fs", test_rows: int = 90, frac: float = 0.85) -> str:
    return f"""{name}_i AS (
  SELECT *, row_number() OVER (PARTITION BY {SERIES} ORDER BY ts) - 1 AS row_idx,
         count(*) OVER (PARTITION BY {SERIES}) AS n_rows
  FROM {src}),
{name} AS (
  SELECT *, CASE WHEN row_idx >= n_rows - {test_rows} THEN 'test'
                 WHEN row_idx >= floor((n_rows - {test_rows}) * {frac}) THEN 'val'
                 ELSE 'train' END AS split_label,
         (row_idx < floor((n_rows - {test_rows}) * {frac})) AS is_train,
         (row_idx < n_rows - {test_rows}) AS before_split
  FROM {name}_i)"""


def _system(regressors, target: str, rows: str, used=None, ridge: str = "0.0", unpenalised=()) -> str:
    """Normal equations as a list of rows, the right-hand side last."""
    k = len(regressors)
    used = range(k) if used is None else used

    def entry(i: int, j: int) -> str:
        if i not in used or (j < k and j not in used):
            return "1.0::DOUBLE" if i == j else "0.0::DOUBLE"
        other = target if j == k else regressors[j]
        extra = f" + {ridge}" if i == j and i not in unpenalised else ""
        return f"coalesce(sum(({regressors[i]}) * ({other})) FILTER ({rows}), 0.0)::DOUBLE{extra}"
    return "[" + ", ".join("[" + ", ".join(entry(i, j) for j in range(k + 1)) + "]" for i in range(k)) + "]"


def _solved(src: str, key: str, k: int, name: str) -> str:
    """``name(key, x)``: the solutions of ``src(key, m)``, k unknowns each."""
    return f"""{name}_gj AS (
  SELECT {key}, 0 AS k, m FROM {src}
  UNION ALL
  SELECT {key}, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k + 1 THEN r ELSE
    list_transform(r, lambda v, j: v - m[k + 1][j] * (r[k + 1] / nullif(m[k + 1][k + 1], 0))) END)
  FROM {name}_gj WHERE k < {k}),
{name} AS (
  SELECT {key}, list_transform(m, lambda r, i: r[{k + 1}] / nullif(r[i], 0)) AS x FROM {name}_gj WHERE k = {k})"""


def _dot(coefficients: str, values) -> str:
    return "(" + " + ".join(f"coalesce({coefficients}[{i + 1}], 0.0) * ({v})" for i, v in enumerate(values)) + ")"


def arma(src: str = "fs") -> str:
    """Two-stage regression, order by AIC, one-step forecast: ``arma_fc``."""
    from barforge.operators.forecast import LONG_LAGS, ORDERS
    lags = [f"r{i}" for i in range(1, LONG_LAGS + 1)]
    spans = {"val": "is_train", "test": "before_split"}
    win = f"PARTITION BY {SERIES} ORDER BY ts"
    lag_cols = ", ".join(f"lag(log_ret, {i + 1}) OVER ({win}) AS {c}" for i, c in enumerate(lags))
    arms = "\n  UNION ALL ".join(f"SELECT {SERIES}, '{f}' AS f, {_system(lags, 'log_ret', f'{on} AND r5 IS NOT NULL')} AS m "
                                 f"FROM al GROUP BY {SERIES}" for f, on in spans.items())
    res = ", ".join(f"CASE WHEN r5 IS NOT NULL THEN log_ret - {_dot(f'l_{f}.x', lags)} END AS e_{f}" for f in spans)
    res_lags = ", ".join(f"lag(e_{f}, {i}) OVER ({win}) AS e{i}_{f}" for f in spans for i in (1, 2))
    tries = []
    for f, on in spans.items():
        x = ["r1", "r2", f"e1_{f}", f"e2_{f}"]
        for at, (p, q) in enumerate(ORDERS):
            m = _system(x, "log_ret", f"{on} AND e2_test IS NOT NULL", [*range(p), *range(2, 2 + q)])
            tries.append(f"SELECT {SERIES}, '{f}' AS f, {at} AS nth, {p} AS p, {q} AS q, {m} AS m, "
                         f"[{', '.join(f'sum(({v}) * log_ret) FILTER ({on} AND e2_test IS NOT NULL)' for v in x)}] AS c, "
                         f"sum(log_ret * log_ret) FILTER ({on} AND e2_test IS NOT NULL) AS yy, "
                         f"(count(*) FILTER ({on} AND e2_test IS NOT NULL))::DOUBLE AS n FROM ar GROUP BY {SERIES}")
    split = ", ".join(f"s.{c}" for c in SERIES.split(", "))
    return f"""al AS (SELECT *, {lag_cols} FROM {src}),
a_long AS (
  {arms}),
{_solved("a_long", f"{SERIES}, f", LONG_LAGS, "a_fit")},
a_val AS (SELECT * FROM a_fit WHERE f = 'val'),
a_test AS (SELECT * FROM a_fit WHERE f = 'test'),
a_res AS (
  SELECT s.*, {res}
  FROM al s LEFT JOIN a_val l_val USING ({SERIES}) LEFT JOIN a_test l_test USING ({SERIES})),
ar AS (SELECT *, {res_lags} FROM a_res),
a_try AS (
  {(chr(10) + "  UNION ALL ").join(tries)}),
{_solved("a_try", f"{SERIES}, f, nth, p, q, c, yy, n", 4, "a_all")},
a_aic AS (
  SELECT *, CASE WHEN n > 0 AND yy - {_dot("x", [f"c[{i}]" for i in range(1, 5)])} > 0
    THEN n * ln((yy - {_dot("x", [f"c[{i}]" for i in range(1, 5)])}) / n) + 2 * (p + q + 1) END AS aic FROM a_all),
a_best AS (
  SELECT {SERIES}, nth, p, q FROM a_aic WHERE f = 'test' AND aic IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {SERIES} ORDER BY aic, nth) = 1),
a_coef AS (
  SELECT b.*, v.x AS x_val, t.x AS x_test
  FROM a_best b JOIN a_aic v USING ({SERIES}, nth) JOIN a_aic t USING ({SERIES}, nth) WHERE v.f = 'val' AND t.f = 'test'),
a_with AS (
  SELECT s.*, b.p, b.q, CASE WHEN before_split THEN b.x_val ELSE b.x_test END AS coef,
    CASE WHEN before_split THEN coalesce(e_val, 0.0) ELSE coalesce(e_test, 0.0) END AS e0,
    CASE WHEN before_split THEN coalesce(e1_val, 0.0) ELSE coalesce(e1_test, 0.0) END AS e1
  FROM ar s LEFT JOIN a_coef b USING ({SERIES})),
arma_fc AS (
  SELECT {split}, s.ts, s.p, s.q, s.coef, s.log_price + {_dot("s.coef", ["s.log_ret", "coalesce(s.r1, 0.0)", "s.e0", "s.e1"])} AS ar_log
  FROM a_with s)"""


def window_model(features, src: str = "fs") -> str:
    """Ridge regression on standardised feature windows: ``lr_fc``."""
    from barforge.operators.forecast import LOOKBACK, RIDGE
    whole, win = f"PARTITION BY {SERIES}", f"PARTITION BY {SERIES} ORDER BY ts"
    before = f"({win} ROWS BETWEEN {LOOKBACK} PRECEDING AND 1 PRECEDING)"
    stats = ", ".join(f"avg({c}) FILTER (before_split) OVER ({whole}) AS m_{c}, stddev_pop({c}) FILTER (before_split) OVER ({whole}) AS s_{c}"
                      for c in features)
    z = ", ".join(f"({c} - m_{c}) / CASE WHEN s_{c} < 1e-8 THEN 1.0 ELSE s_{c} END AS z_{c}" for c in features)
    parts = ", ".join(f"lag(z_{c}) OVER ({win}) AS l_{c}, avg(z_{c}) OVER {before} AS a_{c}" for c in features)
    names = [f"l_{c}" for c in features] + [f"a_{c}" for c in features]
    inputs = ["1.0::DOUBLE", *names]
    n = "(count(*) FILTER (is_train AND usable))::DOUBLE"
    k = len(inputs)
    return f"""w_stats AS (SELECT *, {stats} FROM {src}),
w_z AS (SELECT *, {z} FROM w_stats),
w_in AS (SELECT *, {parts}, count(*) OVER {before} = {LOOKBACK} AS is_full FROM w_z),
w_rows AS (SELECT *, is_full AND {" AND ".join(f"{c} IS NOT NULL" for c in names)} AS usable FROM w_in),
w_sys AS (
  SELECT {SERIES}, {_system(inputs, "target", "is_train AND usable", None, f"{RIDGE!r} * {n}", (0,))} AS m FROM w_rows GROUP BY {SERIES}),
{_solved("w_sys", SERIES, k, "w_fit")},
lr_fc AS (
  SELECT *, log_price + ret_hat AS lr_log
  FROM (SELECT s.*, CASE WHEN usable THEN {_dot("b.x", inputs)} END AS ret_hat
        FROM w_rows s LEFT JOIN w_fit b USING ({SERIES})))"""


def forecasts(features, src: str = "fs") -> str:
    """ARMA and return model on the windows, blend weight, blended forecast."""
    return f"""{arma(src)},
{window_model(features, src)},
fc AS (
  SELECT s.*, a.p, a.q, a.coef, a.ar_log, ln(s.next_price) AS actual_log
  FROM lr_fc s JOIN arma_fc a USING ({SERIES}, ts) WHERE lr_log IS NOT NULL),
bw_sums AS (
  SELECT {SERIES}, count(*) AS n_val,
         sum((ar_log - actual_log) * (ar_log - actual_log)) AS saa,
         sum((ar_log - actual_log) * (lr_log - actual_log)) AS sab,
         sum((lr_log - actual_log) * (lr_log - actual_log)) AS sbb
  FROM fc WHERE split_label = 'val' GROUP BY {SERIES}),
bw_grid AS (
  SELECT {SERIES}, i, i / 100.0 AS w,
         ((i / 100.0) * (i / 100.0) * saa + 2 * (i / 100.0) * (1 - i / 100.0) * sab
          + (1 - i / 100.0) * (1 - i / 100.0) * sbb) / n_val AS mse
  FROM bw_sums, range(0, 101) t(i)),
bw AS (
  SELECT {SERIES}, arg_min(w, (mse, i)) AS best_w, min(mse) AS best_mse
  FROM bw_grid GROUP BY {SERIES}),
fct AS (
  SELECT f.{SERIES.replace(", ", ", f.")}, f.ts, f.split_label, f.p, f.q, f.coef, f.ret_hat, f.next_price AS actual,
         f.price AS prev_close, exp(f.ar_log) AS ar, exp(f.lr_log) AS lr, f.price AS naive,
         exp(b.best_w * f.ar_log + (1 - b.best_w) * f.lr_log) AS hybrid, b.best_w
  FROM fc f JOIN bw b USING ({SERIES}))"""


def listing_rows(name: str = "listing") -> str:
    return f"""{name} AS (
  SELECT {LISTING_CLASS_SQL} AS asset_class,
         CASE WHEN p_type IN ('SMALL', 'MEDIUM', 'PROMO') THEN 1 ELSE 0 END AS file_pos,
         p_partkey AS pos,
         {LISTING_SYMBOL_SQL} AS symbol,
         {SECURITY_NAME_SQL} AS security_name,
         {TEST_ISSUE_SQL} AS test_issue
  FROM (SELECT *, upper(substr(split_part(p_name, ' ', 1), 1, 2)
                        || substr(split_part(p_name, ' ', 2), 1, 3)) AS base FROM part) p)"""


INLINE = """inline_t AS (
  SELECT CASE WHEN s_nationkey < 8 THEN 'stocks_us' WHEN s_nationkey < 16 THEN 'stocks_eu'
              ELSE 'crypto' END AS asset_class,
         s_suppkey AS pos, 'S' || right(s_name, 2) AS ticker
  FROM supplier)"""


JOBS = f"""jobs AS (
  SELECT {JOB_STATUS_SQL} AS status, 'P' || CAST(l_partkey AS VARCHAR) AS ticker,
         {JOB_CLASS_SQL} AS asset_class, {JOB_INTERVAL_SQL} AS interval,
         {JOB_MESSAGE_SQL} AS message,
         l_orderkey * 8 + l_linenumber AS seq, year(l_shipdate) AS shard
  FROM lineitem)"""


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


TICK_SOURCES = f"""tick_src AS (
  SELECT *, {TICK_SOURCE_SQL} AS src FROM ticks)"""


def source_bars(intervals=INTRADAY_INTERVALS) -> str:
    """Bars per tick source (fresh / stored / legacy) for the merge fixtures."""
    arms = "\n    UNION ALL ".join(
        f"SELECT src, asset_class, ticker, ts, price, size, '{iv}' AS interval, {bar_start(iv)} AS bts FROM tick_src"
        for iv in intervals)
    return f"""src_bars AS (
  SELECT src, asset_class, interval, ticker, bts AS ts, arg_min(price, ts) AS open, max(price) AS high,
         min(price) AS low, arg_max(price, ts) AS close, CAST(NULL AS DOUBLE) AS adj_close,
         CAST(sum(size) AS BIGINT) AS volume
  FROM ({arms}) x
  GROUP BY src, asset_class, interval, ticker, bts)"""


def retention_sql(as_of: str, ts: str = "ts", interval: str = "interval") -> str:
    from barforge.schema import RETENTION_DAYS
    arms = " OR ".join(
        f"({interval} = '{iv}' AND {ts} >= TIMESTAMP '{as_of}' - INTERVAL {d} DAY)"
        for iv, d in RETENTION_DAYS.items())
    ivs = ", ".join(f"'{iv}'" for iv in RETENTION_DAYS)
    return f"({interval} IS NULL OR {interval} NOT IN ({ivs}) OR {arms})"


def merged(sources: dict, name: str = "merged") -> str:
    """Union sources with (src_rank, seq); winner per (series, ts) + flags."""
    arms = "\n  UNION ALL ".join(
        f"SELECT asset_class, interval, ticker, ts, open, high, low, close, adj_close, volume, "
        f"'{src}' AS src, {rank} AS src_rank, {seq} AS seq FROM {tbl}"
        for src, (tbl, rank, seq) in sources.items())
    cols = ["open", "high", "low", "close", "adj_close", "volume"]
    same = " AND ".join(f"w.{c} IS NOT DISTINCT FROM s.{c}" for c in cols)
    return f"""{name}_u AS (
  {arms}),
{name}_r AS (
  SELECT *, row_number() OVER (PARTITION BY {SERIES}, ts ORDER BY src_rank DESC, seq DESC) AS rn
  FROM {name}_u),
{name} AS (
  SELECT w.asset_class, w.interval, w.ticker, w.ts, w.open, w.high, w.low, w.close, w.adj_close, w.volume,
         s.ts IS NOT NULL AS in_stored,
         EXISTS (SELECT 1 FROM {name}_u f WHERE f.src = 'fresh' AND f.asset_class = w.asset_class
                 AND f.interval = w.interval AND f.ticker = w.ticker AND f.ts = w.ts) AS in_fresh,
         s.ts IS NOT NULL AND NOT ({same}) AS changed
  FROM (SELECT * FROM {name}_r WHERE rn = 1) w
  LEFT JOIN (SELECT * FROM {name}_u WHERE src = 'stored') s
    ON w.asset_class = s.asset_class AND w.interval = s.interval AND w.ticker = s.ticker AND w.ts = s.ts)"""
