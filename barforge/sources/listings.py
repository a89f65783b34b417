"""Listing sources -> clean symbol lists, and the ticker universe (S4-S9, S12,
S13, W2, U2). Each builder is a DataFrame -> DataFrame transform; the readers
bind columns by header name (never by position)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.functions.symbols import (not_skipped_security, not_test_issue, plain_ticker,
                                        strip, usable_symbol, with_market_symbol)
from barforge.operators.bars import ordered_pair, split_pair
from barforge.schema import EUROPE_SUFFIXES
from barforge.session import path_exists


_INTEGRAL = ("byte", "short", "integer", "long")


def first_seen(df: DataFrame, group, value: str, order) -> DataFrame:
    """Keep the first occurrence of ``value`` per ``group`` by ``order``.

    With one or two integral position columns (the second non-negative) the
    position becomes one number taken with ``min`` - a hash aggregate with
    map-side combine - then split again (types preserved, exact for every
    BIGINT); other orderings fall back to the minimum of a struct (a sort-based
    aggregate)."""
    group, order = list(group), list(order)
    types = [df.schema[c].dataType for c in order]
    if 1 <= len(order) <= 2 and all(t.typeName() in _INTEGRAL for t in types):
        cols = [F.col(c).cast("bigint") for c in order]
        packed = cols[0] if len(cols) == 1 else ordered_pair(*cols)
        agg = df.groupBy(*group, value).agg(F.min(packed).alias("_p"))
        if len(order) == 1:
            parts = [F.col("_p")]
        else:
            parts = split_pair(F.col("_p"))
        return agg.select(*group, value, *[p.cast(t).alias(c) for p, t, c in zip(parts, types, order)])
    first = F.min(F.struct(*order)).alias("_first")
    return df.groupBy(*group, value).agg(first).select(
        *group, value, *[F.col(f"_first.{c}").alias(c) for c in order])


def read_listing_csv(spark: SparkSession, path: str) -> DataFrame:
    """S4 reader: header row kept as column names, everything a string, so
    symbols such as NA or 0700 survive; columns are then bound by name."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    if "Symbol" not in df.columns:
        raise ValueError(f"No 'Symbol' column in {path}")
    pick = {"Symbol": "symbol", "Security Name": "security_name", "Test Issue": "test_issue"}
    cols = [F.col(f"`{src}`").alias(dst) for src, dst in pick.items() if src in df.columns]
    return df.select(*cols, F.monotonically_increasing_id().alias("pos"))


def listing_symbols(rows: DataFrame, group=("asset_class",), order=("file_pos", "pos")) -> DataFrame:
    """S4 core: drop test issues (P3) and warrants/rights/units (P4), map to
    market symbols (P1), drop empty / 'nan', keep the first occurrence (W2)."""
    f = rows
    if "test_issue" in rows.columns:
        f = f.where(not_test_issue(F.col("test_issue")))
    if "security_name" in rows.columns:
        f = f.where(not_skipped_security(F.col("security_name")))
    f = with_market_symbol(f.where(F.col("symbol").isNotNull()))
    f = f.where(usable_symbol(F.col("symbol")))
    return first_seen(f, group, "symbol", [c for c in order if c in rows.columns])


def build_universe(inline: DataFrame, listed: DataFrame) -> DataFrame:
    """S5 + U2: per class, the inline list verbatim (order and duplicates
    kept), then listing symbols not already present, in listing order.
    ``inline(asset_class, pos, ticker)``, ``listed(asset_class, symbol, file_pos, pos)``."""
    from barforge.plans.refresh import positions
    inl = inline.select("asset_class", "ticker", F.lit(0).alias("src"), F.lit(0).alias("p1"),
                        F.col("pos").alias("p2"))
    lst = listed.select("asset_class", F.col("symbol").alias("ticker"), F.lit(1).alias("src"),
                        F.col("file_pos").alias("p1"), F.col("pos").alias("p2"))
    lst = lst.join(inl.select("asset_class", "ticker").distinct(), ["asset_class", "ticker"], "left_anti")
    u = inl.unionByName(lst)
    return positions(u, ["asset_class"], ["src", "p1", "p2"]).select("asset_class", "ticker", "pos")


def require_rows(rows: DataFrame, source: str) -> DataFrame:
    """``rows``, or ValueError when there are none: an empty download must not
    replace a listing. Looks at one row."""
    if rows.isEmpty():
        raise ValueError(f"{source}: no usable symbol in the source")
    return rows


def plain_ticker_listing(lines: DataFrame, value: str = "value", order: str = "line_no") -> DataFrame:
    """Plain text, one symbol per line -> distinct symbols, sorted."""
    t = lines.select(plain_ticker(F.col(value)).alias("symbol"), order).where(F.col("symbol").isNotNull())
    t = require_rows(t, "plain ticker listing")
    return first_seen(t, [], "symbol", [order]).select("symbol").orderBy("symbol")


def json_directory_listing(rows: DataFrame, code_keys, name_keys, industry_keys,
                           suffix: str = ".TW", order: str = "row_no") -> DataFrame:
    """Company directory records with alternative (localised) keys ->
    digits-only codes + suffix, first record per symbol, sorted."""
    def first_nonblank(keys) -> Column:
        present = [k for k in keys if k in rows.columns]
        if not present:
            return F.lit("")
        return F.coalesce(*[F.nullif(F.col(f"`{k}`").cast("string"), F.lit("")) for k in present], F.lit(""))
    r = rows.select(strip(first_nonblank(code_keys)).alias("code"),
                    strip(first_nonblank(name_keys)).alias("name"),
                    strip(first_nonblank(industry_keys)).alias("industry"), order)
    r = r.where(F.col("code").rlike(r"^\d+$")).withColumn("symbol", F.concat("code", F.lit(suffix)))
    r = require_rows(r, "company directory")
    # one min_by per column on the (unique) record position: a hash aggregate
    firsts = r.groupBy("symbol").agg(F.min_by("name", order).alias("name"),
                                     F.min_by("industry", order).alias("industry"))
    return firsts.select("symbol", "name", "industry").orderBy("symbol")


def suffix_rank(sym: Column) -> Column:
    """Position of the first preferred European suffix the symbol ends with."""
    u = F.upper(sym)
    expr = None
    for i, sfx in enumerate(EUROPE_SUFFIXES):
        expr = F.when(u.endswith(F.lit(sfx)), i) if expr is None else expr.when(u.endswith(F.lit(sfx)), i)
    return expr.otherwise(100)


def nested_constituents_listing(stocks: DataFrame) -> DataFrame:
    """``stocks(index_name, index_pos, stock_pos, name, symbols
    array<struct<yahoo>>)`` -> the best candidate per stock (preferred
    suffix, then shortest, then lexical; digit-leading symbols excluded), the
    first index listing a symbol wins; sorted by symbol."""
    c = stocks.select("index_name", "index_pos", "stock_pos", "name",
                      F.explode("symbols").alias("s")).select(
        "index_name", "index_pos", "stock_pos", "name", F.col("s.yahoo").alias("sym"))
    c = c.where(F.col("sym").isNotNull() & (F.col("sym") != "") & ~F.col("sym").rlike("^[0-9]"))
    c = c.withColumn("rank", suffix_rank(F.col("sym"))).where(F.col("rank") < 100)
    c = require_rows(c, "constituents listing")
    best = c.groupBy("index_name", "index_pos", "stock_pos", "name").agg(
        F.min_by("sym", F.struct("rank", F.length("sym"), "sym")).alias("symbol"))
    pos = ordered_pair(F.col("index_pos"), F.col("stock_pos"))
    firsts = best.withColumn("_pos", pos).groupBy("symbol").agg(
        F.min_by("name", "_pos").alias("name"), F.min_by("index_name", "_pos").alias("index_name"))
    return firsts.select("symbol", "name", "index_name").orderBy("symbol")


def pad_code(code: Column, width: int = 6) -> Column:
    """zfill semantics: left-pad with zeros to ``width`` but never truncate."""
    c = strip(code.cast("string"))
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def exchange_directory_listing(markets: dict[str, DataFrame], suffixes: dict[str, str],
                               pad: int | None = 6, order: str = "row_no") -> DataFrame:
    """Per market ``(code, name[, industry])`` -> code (zero-padded) +
    market suffix; markets unioned, one row per symbol (first market / first
    row wins), sorted; industry is kept when any market carries it. A market
    without its code or name column, and directories without any row, raise."""
    for market, df in markets.items():
        missing = [c for c in ("code", "name") if c not in df.columns]
        if missing:
            raise ValueError(f"exchange directory {market!r} has no column {', '.join(missing)}")
    parts = []
    for i, (market, df) in enumerate(markets.items()):
        code = pad_code(F.col("code"), pad) if pad else strip(F.col("code").cast("string"))
        parts.append(df.select(F.concat(code, F.lit(suffixes[market])).alias("symbol"),
                               F.col("name").cast("string").alias("name"),
                               (F.col("industry") if "industry" in df.columns else F.lit(None)).cast("string").alias("industry"),
                               F.lit(market).alias("market"), F.lit(i).alias("m_pos"),
                               F.col(order).alias("r_pos")))
    u = reduce(DataFrame.unionByName, parts)
    pos = ordered_pair(F.col("m_pos"), F.col("r_pos"))
    u = require_rows(u.where(F.col("symbol").isNotNull()), "exchange directory")
    kept = ["name", "market", *(["industry"] if any("industry" in df.columns for df in markets.values()) else [])]
    firsts = u.withColumn("_pos", pos).groupBy("symbol").agg(*[F.min_by(c, "_pos").alias(c) for c in kept])
    return firsts.select("symbol", *kept).orderBy("symbol")


def content_fingerprint(df: DataFrame, group, cols) -> DataFrame:
    """Order-insensitive content digest per group: row count plus two
    independent sums of 64-bit row hashes (as DECIMAL so ANSI mode cannot
    overflow). Partial-aggregatable, unlike hashing one sorted, concatenated
    string per group."""
    # the hash functions pass over nulls: which columns are null goes in as text
    nulls = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in cols])
    h = F.xxhash64(nulls, *[F.col(c) for c in cols])
    h2 = F.xxhash64(F.lit("second"), nulls, *[F.col(c) for c in cols])
    return df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(h.cast("decimal(38,0)")).alias("h_sum"),
        F.sum(h2.cast("decimal(38,0)")).alias("h2_sum"))


# Built-in listing sources of a refresh entry; the first one
# needs an explicit url, the others have a default or need none.
URL_REQUIRED_SOURCES = ("plain_tickers",)
KNOWN_SOURCES = ("krx", "tse", "europe", "twse", "plain_tickers", "russell2000")


def entry_outcomes(entries: DataFrame, stored: DataFrame, staged: DataFrame, key) -> DataFrame:
    """S12/S13 outcome per listing entry ``(key..., source, url)`` from the
    stored and freshly staged content fingerprints (:func:`content_fingerprint`):

    * ``skipped``   - neither a built-in source nor a url: not checked;
    * ``failed``    - a url-only source without url, or the staged content is
                      missing or empty (the stored copy is kept);
    * ``created`` / ``updated`` / ``unchanged`` - by fingerprint comparison.
    """
    key = list(key)
    s = stored.select(*key, F.struct("n_rows", "h_sum", "h2_sum").alias("old"))
    n = staged.select(*key, F.struct("n_rows", "h_sum", "h2_sum").alias("new"))
    j = entries.join(s, key, "left").join(n, key, "left")
    src, url = F.col("source"), F.col("url")
    checked = F.coalesce(src.isin(*KNOWN_SOURCES), F.lit(False)) | url.isNotNull()
    status = (F.when(~checked, "skipped")
              .when(F.coalesce(src.isin(*URL_REQUIRED_SOURCES), F.lit(False)) & url.isNull(), "failed")
              .when(F.col("new").isNull() | (F.col("new.n_rows") == 0), "failed")
              .when(F.col("old").isNull(), "created")
              .when(F.col("old") == F.col("new"), "unchanged").otherwise("updated"))
    return j.select(*key, status.alias("status"))


def change_status(stored: DataFrame, staged: DataFrame, key) -> DataFrame:
    """Created / Updated / Unchanged / failed for every key present on either
    side (all entries treated as checked url sources)."""
    key = list(key)
    entries = (stored.select(*key).unionByName(staged.select(*key)).distinct()
               .withColumn("source", F.lit(None).cast("string")).withColumn("url", F.lit("staged")))
    return entry_outcomes(entries, stored, staged, key)


def refresh_report(outcomes: DataFrame) -> DataFrame:
    """S13 roll-up: sources checked, updated (created or changed), failed."""
    return outcomes.agg(
        F.count_if(F.col("status") != "skipped").alias("checked"),
        F.count_if(F.col("status").isin("created", "updated")).alias("updated"),
        F.count_if(F.col("status") == "failed").alias("failed"))


def universe_from_config(spark: SparkSession, config: dict | str, base_dir: str | None = None) -> DataFrame:
    """S5 from a tickers config; see :func:`universe_and_skipped`, which also
    reports skipped listing files. Each skipped file is warned about here."""
    import warnings
    universe, skipped = universe_and_skipped(spark, config, base_dir)
    for cls, path in skipped:
        warnings.warn(f"listing file of {cls} is missing and was skipped: {path}", stacklevel=2)
    return universe


def universe_and_skipped(spark: SparkSession, config: dict | str,
                         base_dir: str | None = None) -> tuple[DataFrame, list[tuple[str, str]]]:
    """S5 from a tickers config (a dict, or a YAML file read on the driver -
    it is a small control file): ``{asset_class: [inline tickers],
    listings: {asset_class: [path | {path, url, source}]}}``. Inline entries
    are kept verbatim (as text); listing files are read with Spark from any
    file system it knows, bound by header. Returns the universe and the
    (asset_class, path) of listing files that do not exist."""
    import os
    if isinstance(config, str):
        import yaml
        base_dir = base_dir or os.path.dirname(config)
        with open(config, encoding="utf-8") as fh:
            config = yaml.safe_load(fh) or {}
    config = dict(config)
    listings = config.pop("listings", None) or {}
    inline = [(str(cls), i, str(t)) for cls, syms in config.items() if syms
              for i, t in enumerate(syms)]
    inline_df = spark.createDataFrame(inline, "asset_class string, pos int, ticker string")
    parts, skipped = [], []
    for cls, entries in listings.items():
        for file_pos, entry in enumerate(entries or []):
            path = entry if isinstance(entry, str) else entry.get("path")
            if not path:
                raise ValueError(f"Listing entry missing 'path': {entry!r}")
            absolute = os.path.isabs(path) or ":/" in path or base_dir is None
            full = path if absolute else f"{base_dir.rstrip('/')}/{path}"
            if not path_exists(spark, full):
                skipped.append((str(cls), full))
                continue
            rows = read_listing_csv(spark, full)
            parts.append(rows.withColumn("asset_class", F.lit(str(cls))).withColumn("file_pos", F.lit(file_pos)))
    if parts:
        listed = listing_symbols(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts))
    else:
        listed = spark.createDataFrame([], "asset_class string, symbol string, file_pos int, pos long")
    return build_universe(inline_df, listed), skipped
