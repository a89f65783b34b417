"""URL filter: hand-written rules first, Empirical-Bayes host reputation for the
rest. Built-in column functions only.

Labelled page outcomes (bad pages out of labelled pages) are counted per host
and summed up to the registered domain and the suffix. Each level's rate has a
beta prior around the posterior mean of the level above; the prior's strength
is estimated per level from the data (beta-binomial moments: how much the
groups differ beyond binomial noise). A host's rate is thus shrunk from its own
pages towards domain, suffix and corpus, and a page is blocked when even the
lower posterior bound of its host's bad rate exceeds a limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import written

#: Second-level names under two-letter suffixes that belong to the suffix.
SHARED_SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
#: Bounds of the share of variance between groups (the prior strength is 1 / share - 1).
LEAST_SHARE, MOST_SHARE = 0.001, 0.9
BAD_RATE_LIMIT = 0.5
BOUND_Z = 1.645


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """Between the first :// and the next / ? # (or the end), A-Z lower-cased;
    empty for null and for addresses without ://."""
    return _ascii_lower(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """Behind the host up to ? # or the end; empty for null or without ://."""
    return F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def registered_domain(host: Column) -> Column:
    """The last two labels, three behind a shared second level such as co.uk;
    numeric addresses and single labels as they are."""
    shared = "|".join(SHARED_SECOND_LEVEL)
    three = F.regexp_extract(host, rf"[^.]+\.(?:{shared})\.[a-z]{{2}}$", 0)
    two = F.regexp_extract(host, r"[^.]+\.[^.]+$", 0)
    return (F.when(host.rlike(r"^[0-9.]+$") | (two == "") | host.rlike(rf"^(?:{shared})\.[a-z]{{2}}$"), host)
            .when(three != "", three).otherwise(two))


def suffix_of(host: Column) -> Column:
    """What follows the registered domain's first label; the host if nothing does."""
    domain = registered_domain(host)
    rest = F.regexp_extract(domain, r"^[^.]*\.(.+)$", 1)
    return F.when((rest == "") | host.rlike(r"^[0-9.]+$"), domain).otherwise(rest)


def rule_match(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) columns for rules (verdict, "host/path-prefix"): a rule
    fits its host and all subdomains when the path starts with the rule's; the
    longest fitting rule wins, null when none fits."""
    rule = verdict = F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, prefix = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + prefix)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def _shrunk(level: DataFrame, key: str, parent_mean: str) -> DataFrame:
    """(key, mean, a, b) of one level ``(key, bad, n, <parent_mean>)``: posterior
    Beta(a, b) under a prior at the parent's mean. The prior's strength, one
    number per level, comes from the moments of all the level's groups."""
    m = F.col(parent_mean)
    off = F.pow(F.col("bad") / F.col("n") - m, F.lit(2.0)) * F.col("n") / (m * (1 - m))
    sums = level.where("n > 0").agg(F.sum(off).alias("s"), F.count(F.lit(1)).alias("k"), F.sum("n").alias("t"))
    share = F.when(F.col("t") > F.col("k"), (F.col("s") - F.col("k")) / (F.col("t") - F.col("k"))).otherwise(LEAST_SHARE)
    share = F.greatest(F.lit(LEAST_SHARE), F.least(F.lit(MOST_SHARE), F.coalesce(share, F.lit(LEAST_SHARE))))
    strength = sums.select((1 / share - 1).alias("strength")).first()["strength"]
    a, b = F.col("bad") + strength * m, F.col("n") - F.col("bad") + strength * (1 - m)
    return level.select(key, a.alias("a"), b.alias("b"), (a / (a + b)).alias("mean"))


def host_reputation(outcomes: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, a, b): the posterior Beta(a, b) of the bad-page rate of every host
    in ``hosts(host)``, from ``outcomes(host, bad, n)`` (bad and labelled pages;
    any number of rows per host). Hosts without labels carry their domain's
    expectation at the prior's strength. Without any label all rest on a
    uniform prior."""
    counts = outcomes.groupBy("host").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    base = hosts.select("host").distinct().join(counts, "host", "left").select(
        "host", registered_domain(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"),
        F.coalesce("bad", F.lit(0)).alias("bad"), F.coalesce("n", F.lit(0)).alias("n"))
    base = written(base, "url-hosts")  # a row per host, read by every level
    total = base.agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).first()
    corpus = ((total["bad"] or 0) + 1.0) / ((total["n"] or 0) + 2.0)
    # suffix and domain tables: a row per group, summed up from the host counts
    domains = base.groupBy("suffix", "domain").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    suffixes = domains.groupBy("suffix").agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
    suffixes = _shrunk(suffixes.withColumn("up", F.lit(corpus)), "suffix", "up")
    domains = _shrunk(domains.join(suffixes.select("suffix", F.col("mean").alias("up")), "suffix"), "domain", "up")
    return _shrunk(base.join(domains.select("domain", F.col("mean").alias("up")), "domain"), "host", "up").drop("mean")


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]], limit: float = BAD_RATE_LIMIT,
          z: float = BOUND_Z, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, bad_rate, bad_rate_low) per row of
    ``pages``. Rules decide where one fits; elsewhere a page is blocked when the
    lower bound (mean - z standard deviations) of its host's posterior bad rate
    is above ``limit``. Null addresses and those without :// have an empty host,
    which is judged like any other; null ids and repeated rows stay; an empty
    table gives an empty result; other columns are ignored."""
    url = F.col(url_col).cast("string")
    base = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.coalesce(host_of(url), F.lit("")).alias("host"),
                        F.coalesce(path_of(url), F.lit("")).alias("path"))
    known = host_reputation(outcomes, base)
    a, b = F.col("a"), F.col("b")
    mean = a / (a + b)
    low = mean - z * F.sqrt(a * b / (F.pow(a + b, F.lit(2.0)) * (a + b + 1)))
    rule, verdict = rule_match(F.col("host"), F.col("path"), rules)
    scored = base.join(known, "host", "left").withColumns({"bad_rate": mean, "bad_rate_low": low})
    return scored.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, F.when(F.col("bad_rate_low") > limit, "block").otherwise("allow")).alias("verdict"),
                         "bad_rate", "bad_rate_low")


def page_outcomes(pages: DataFrame, labels: DataFrame, url_col: str = "url") -> DataFrame:
    """(host, bad, n): labelled outcomes per host. A page belongs to the
    document whose number is the last path part of its address; it is bad when
    that document is labelled toxic or of low quality. Partial sums are taken
    before the shuffle by host."""
    url = F.col(url_col).cast("string")
    number = F.regexp_extract(path_of(url), r"/([0-9]{1,18})(?:\.[a-z]+)?/?$", 1)
    named = pages.select(host_of(url).alias("host"), F.when(number != "", number).cast("bigint").alias("doc")).where(
        F.col("doc").isNotNull() & F.col("host").isNotNull())
    marked = labels.select(F.col("doc_id").cast("bigint").alias("doc"),
                           F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0).alias("bad"))
    marked = marked.where(F.col("doc").isNotNull()).groupBy("doc").agg(F.max("bad").alias("bad"))
    return named.join(marked, "doc").groupBy("host").agg(F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("n"))
