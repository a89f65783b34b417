"""Incremental bar merges, retention, dated-snapshot consolidation (A1, A2,
A11, P8, P13, J6, S14).

Precedence is explicit: every input row carries ``src_rank`` (higher wins)
and ``seq`` (order inside a source), so merges are deterministic. Two named
policies mirror the two code paths being reproduced:

* ``fresh_wins``  - cumulative series: stored < fresh
* ``stored_wins`` - intraday series:   fresh < stored < legacy dated files
                    (later dated file wins among legacy files)
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.operators.bars import packed_rank, prune_retention, retention_predicate
from barforge.schema import MIN_TRUSTED_ROWS, RETENTION_DAYS, SERIES_KEY

POLICIES = {
    "fresh_wins": {"stored": 0, "fresh": 1, "legacy": 2},
    "stored_wins": {"fresh": 0, "stored": 1, "legacy": 2},
}
PAYLOAD = ("open", "high", "low", "close", "adj_close", "volume", "dividends", "stock_splits")


def rank_sources(df: DataFrame, policy: str = "fresh_wins", src_col: str = "src",
                 seq=None) -> DataFrame:
    """Attach ``src_rank`` (from the policy) and ``seq`` to a DataFrame whose
    ``src`` column says where each row came from."""
    ranks = POLICIES[policy]
    rank = None
    for name, r in ranks.items():
        rank = F.when(F.col(src_col) == name, r) if rank is None else rank.when(F.col(src_col) == name, r)
    out = df.withColumn("src_rank", rank)
    if seq is not None:
        out = out.withColumn("seq", seq)
    elif "seq" not in df.columns:
        out = out.withColumn("seq", F.lit(0).cast("bigint"))
    return out


def ranked_merge(union: DataFrame, key=SERIES_KEY) -> DataFrame:
    """One row per (series, ts): the payload of the greatest (src_rank, seq),
    plus per-key flags for the merge report - ``in_stored``, ``in_fresh``,
    ``changed`` (the winner differs from the stored row).

    A single hash aggregation does everything: (src_rank, seq) is one number
    and each column takes its own ``max_by`` on it, so duplicates
    combine map-side before the shuffle on (series, ts), which spreads even
    a hot ticker over its timestamps. Rows of one source are unique per
    (series, ts) (normalisation guarantees it), so the winner is one row."""
    key = list(key)
    payload = [c for c in PAYLOAD if c in union.columns]
    union = union.withColumn("_rk", packed_rank(F.col("src_rank"), F.col("seq")))
    stored = F.col("src") == "stored"
    # the (one) stored row's own values, null where it has none: compared as they are
    agg = union.groupBy(*key, "ts").agg(
        *[F.max_by(c, "_rk").alias(c) for c in payload],
        *[F.max(F.when(stored, F.col(c))).alias(f"_was_{c}") for c in payload],
        F.max((F.col("src") == "stored").cast("int")).alias("_in_stored"),
        F.max((F.col("src") == "fresh").cast("int")).alias("_in_fresh"))
    return agg.select(
        *key, "ts", *payload,
        (F.col("_in_stored") == 1).alias("in_stored"),
        (F.col("_in_fresh") == 1).alias("in_fresh"),
        ((F.col("_in_stored") == 1) & ~reduce(
            lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_was_{c}")) for c in payload])).alias("changed"))


def merge_sources(sources: dict[str, DataFrame], policy: str = "fresh_wins",
                  key=SERIES_KEY, seq_cols: dict | None = None) -> DataFrame:
    """Combine separate bar sources under ``policy`` (see :func:`ranked_merge`)."""
    seq_cols = seq_cols or {}
    parts = []
    for src, df in sources.items():
        if df is None:
            continue
        seq = seq_cols.get(src, F.lit(0).cast("bigint"))
        parts.append(df.withColumn("src", F.lit(src)).withColumn("seq", seq))
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p, allowMissingColumns=True)
    return ranked_merge(rank_sources(union, policy), key)


def merge_report(merged: DataFrame, key=SERIES_KEY) -> DataFrame:
    """A1 counts per series: rows after the merge, ``new_rows`` (timestamps
    not stored before - the reference's number), ``updated_rows`` (stored
    timestamps whose values changed)."""
    return merged.groupBy(*key).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~F.col("in_stored")).alias("new_rows"),
        F.count_if(F.col("changed")).alias("updated_rows"))


def merge_cumulative(stored: DataFrame, fresh: DataFrame, key=SERIES_KEY,
                     policy: str = "fresh_wins") -> DataFrame:
    """A1: incremental merge of cumulative bars, fresh rows win by default."""
    return merge_sources({"stored": stored, "fresh": fresh}, policy, key)


def merge_cumulative_sources(sources: DataFrame, key=SERIES_KEY, policy: str = "fresh_wins") -> DataFrame:
    """A1 over one DataFrame with ``src`` in {stored, fresh}: one scan."""
    return ranked_merge(rank_sources(sources, policy), key)


def merge_intraday(fresh: DataFrame, stored: DataFrame, legacy: DataFrame | None,
                   as_of: dt.datetime, key=SERIES_KEY, policy: str = "stored_wins") -> DataFrame:
    """A2: fresh + stored + legacy dated files, then retention prune.
    ``legacy`` must carry ``day`` (the dated file's day): later files win."""
    seq = {"legacy": F.unix_date(F.col("day")).cast("bigint")} if legacy is not None else {}
    merged = merge_sources({"fresh": fresh, "stored": stored, "legacy": legacy}, policy, key, seq)
    return prune_retention(merged, as_of)


def merge_intraday_sources(sources: DataFrame, as_of: dt.datetime, key=SERIES_KEY,
                           policy: str = "stored_wins") -> DataFrame:
    """A2 over one DataFrame with ``src`` in {fresh, stored, legacy} (legacy
    rows carry ``day``): one scan of the input for all three sources."""
    seq = F.coalesce(F.unix_date(F.col("day")).cast("bigint"), F.lit(0).cast("bigint")) \
        if "day" in sources.columns else None
    return prune_retention(ranked_merge(rank_sources(sources, policy, seq=seq), key), as_of)


DATED_NAME = r"^(.+)_(\d{4}-\d{2}-\d{2})\.csv$"


def parse_dated_name(name_col: str = "file_name") -> list:
    """``TICKER_YYYY-MM-DD.csv`` -> (stem, day); greedy stem, null when
    the name does not match."""
    m = F.col(name_col).rlike(DATED_NAME)
    return [F.when(m, F.regexp_extract(name_col, DATED_NAME, 1)).alias("stem"),
            F.when(m, F.to_date(F.regexp_extract(name_col, DATED_NAME, 2))).alias("day")]


def match_legacy(files: DataFrame, universe: DataFrame) -> DataFrame:
    """Dated snapshot files of each (class, interval, ticker) by safe stem."""
    from barforge.functions.symbols import safe_filename
    f = files.select("asset_class", "interval", "file_name", *parse_dated_name("file_name"))
    f = f.where(F.col("stem").isNotNull())
    u = universe.select("asset_class", "ticker", safe_filename(F.col("ticker")).alias("stem"))
    return f.join(u, ["asset_class", "stem"], "inner")


def trusted_last_ts(stored: DataFrame, key=SERIES_KEY, min_rows: int = MIN_TRUSTED_ROWS) -> DataFrame:
    """Last stored timestamp per series, null when fewer than ``min_rows``
    rows are stored (the series is then refetched in full)."""
    return stored.groupBy(*key).agg(
        F.count(F.lit(1)).alias("stored_rows"),
        F.when(F.count(F.lit(1)) >= min_rows, F.max("ts")).alias("last_ts"))


def consolidate(undated: DataFrame, dated: DataFrame, as_of: dt.datetime, key=SERIES_KEY, intervals=None):
    """A11 over two DataFrames; see :func:`consolidate_sources`."""
    u = undated.withColumn("src", F.lit("stored")).unionByName(
        dated.withColumn("src", F.lit("legacy")), allowMissingColumns=True)
    return consolidate_sources(u, as_of, key, intervals)


def consolidate_sources(sources: DataFrame, as_of: dt.datetime, key=SERIES_KEY, intervals=None):
    """Fold dated snapshot bars (``src = 'legacy'`` with ``day``) into the
    undated series (``src = 'stored'``) and prune retention everywhere.
    Only intraday intervals are consolidated (optionally a requested subset
    of them: requested INTERSECT intraday); other intervals are left out.

    Returns (bars, report). Report per (asset_class, interval): ``removed``
    dated files, ``consolidated`` series that had dated files (even when
    nothing survives the prune), ``pruned`` series without dated files that
    lost rows to the prune."""
    key = list(key)
    allowed = [iv for iv in RETENTION_DAYS if intervals is None or iv in set(intervals)]
    sources = sources.where(F.col("interval").isin(*allowed))
    ranked = rank_sources(sources, "stored_wins",
                          seq=F.coalesce(F.unix_date(F.col("day")).cast("bigint"), F.lit(0).cast("bigint")))
    merged = ranked_merge(ranked, key)
    # one aggregate of the merged rows gives both counts: before, and after the prune
    per = merged.groupBy(*key).agg(F.count_if("in_stored").alias("n_before"),
                                   F.count_if(retention_predicate(as_of)).alias("n_after"))
    # a file per day: the set is bounded by the series' time span
    files = sources.where(F.col("src") == "legacy").groupBy(*key).agg(F.size(F.collect_set("day")).alias("files"))
    per = per.join(files, key, "left").na.fill(0, ["files"])
    merged = prune_retention(merged, as_of).drop("in_stored", "in_fresh", "changed")
    report = per.groupBy("asset_class", "interval").agg(
        F.sum("files").alias("removed"),
        F.count_if(F.col("files") > 0).alias("consolidated"),
        F.count_if((F.col("files") == 0) & (F.col("n_after") < F.col("n_before"))).alias("pruned"))
    return merged, report


def overlay(dest: DataFrame, incoming: DataFrame, key=SERIES_KEY):
    """Incoming series replace the same series in ``dest``; other series
    are kept. Returns (bars, per-series origin) - the anti join drops the
    replaced series without shuffling the incoming rows twice. Its tasks hold
    the incoming series' names, one row each, and stream the stored bars past
    them: nothing is sorted, however many bars there are."""
    key = list(key)
    inc_keys = incoming.select(*key).distinct().hint("shuffle_hash")
    kept = dest.join(inc_keys, key, "left_anti")
    out = kept.withColumn("origin", F.lit("kept")).unionByName(
        incoming.withColumn("origin", F.lit("incoming")), allowMissingColumns=True)
    return out
