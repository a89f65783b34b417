"""Column expressions for ticker symbols (P1-P4) - all JVM built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barforge.schema import (EXCHANGE_SUFFIXES, PLAIN_TICKER_PATTERN, PLAIN_TICKER_SKIP,
                             SKIP_SECURITY_NAME_PATTERN)

_SUFFIX_RE = "(?:" + "|".join(s.replace(".", r"\.") for s in EXCHANGE_SUFFIXES) + ")$"
_SHARE_CLASS_RE = r"^(.+)\.(\p{L})$"


def strip(c: Column) -> Column:
    """Python-style strip of surrounding whitespace (SQL trim only removes spaces)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def to_market_symbol(c: Column) -> Column:
    """Listing symbol -> market-data form. Exchange suffixes (any case),
    ``=X`` / ``=F`` and hyphenated symbols are kept; a one-letter share class
    after the last dot becomes a hyphen (BRK.B -> BRK-B)."""
    s = strip(c)
    u = F.upper(s)
    keep = u.rlike(_SUFFIX_RE) | u.endswith(F.lit("=X")) | u.endswith(F.lit("=F")) | s.contains("-")
    return F.when(keep, s).otherwise(F.regexp_replace(s, _SHARE_CLASS_RE, "$1-$2"))


def with_market_symbol(df, src: str = "symbol", dst: str = "symbol"):
    """P1 on a DataFrame column. The stripped value is materialised once so
    the rule's several tests reference a column instead of repeating the
    strip expression (keeps the generated code small)."""
    s = F.col("_stripped")
    u = F.upper(s)
    keep = u.rlike(_SUFFIX_RE) | u.endswith(F.lit("=X")) | u.endswith(F.lit("=F")) | s.contains("-")
    out = df.withColumn("_stripped", strip(F.col(src)))
    return out.withColumn(dst, F.when(keep, s).otherwise(
        F.regexp_replace(s, _SHARE_CLASS_RE, "$1-$2"))).drop("_stripped")


def safe_filename(c: Column) -> Column:
    """File-safe ticker: drop ``^``, map ``=`` and ``/`` to ``_``."""
    return F.replace(F.replace(F.replace(c, F.lit("^"), F.lit("")), F.lit("="), F.lit("_")),
                     F.lit("/"), F.lit("_"))


def not_test_issue(c: Column) -> Column:
    """Keep rows whose test-issue flag is not Y (missing counts as N)."""
    return F.upper(F.coalesce(c.cast("string"), F.lit("N"))) != "Y"


def not_skipped_security(c: Column) -> Column:
    """Drop warrants / rights / units (whole word, any case)."""
    return ~F.coalesce(c, F.lit("")).rlike(SKIP_SECURITY_NAME_PATTERN)


def usable_symbol(c: Column) -> Column:
    """Non-null, non-blank and not the text 'nan' (any case)."""
    return ~F.coalesce(F.lower(c), F.lit("")).isin("", "nan")


def plain_ticker(c: Column) -> Column:
    """S6 line -> bare upper-case ticker or null (comments, blanks,
    ``EXCHANGE:TICKER`` reduced to the ticker, skip-list, shape check)."""
    raw = F.upper(strip(c))
    bare = F.when(raw.contains(":"), F.substring_index(raw, ":", -1)).otherwise(raw)
    ok = ((raw != "") & ~raw.startswith("#") & ~bare.isin(*PLAIN_TICKER_SKIP)
          & bare.rlike(PLAIN_TICKER_PATTERN))
    return F.when(ok, bare)
