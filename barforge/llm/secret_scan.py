"""Secrets: three rules, and a battery of randomness tests for the other
character strings that could be keys. Column functions and windows only.

Every generator is one regular expression; splitting a text at its matches gives
the offsets, and matches become narrow rows, so texts are never shuffled. Spans
of the rules (assign, access, hex) always stay. The other candidates are runs of
16 or more characters of an encoding's alphabet with a letter and a digit. For
the encoding inferred from its characters (hexadecimal, base32, base36, base62,
base64) a candidate takes three tests of uniform randomness:

* chi-squared of the character counts against the whole alphabet;
* runs: the number of changes between lower case, upper case and digits;
* serial correlation of neighbouring characters' places in the alphabet.

A string that fails one of them (Bonferroni) is structured and no secret. Short
strings pass easily, so passing is not enough: for what passes, the probability
that an ordinary string of the same length does so well - so few equal
characters, so many changes of case and digits - is bounded (Chernoff bound for
the changes, normal tail for the equal pairs, Fisher's combination), and the
Benjamini-Hochberg rule over all candidates of a length class keeps the expected
share of ordinary strings among the added spans below ``rate``. Its counts are a
table of length classes times probability steps, whatever the corpus's size.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.llm.common import written

#: Rules in the order of their spans, then the method's kind.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "random")
_ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
_ANY = "[A-Za-z0-9+/_-]"
#: kind -> (expression, cheap test that a text can match). The runs of access
#: and hex start where a run starts, so a least length in the expression leaves
#: the matches as they are. assign's least length is tested on its matches.
GENERATORS = {
    "assign": (_ASSIGN, r"[:=]"),
    "access": (r"AKIA[A-Z0-9]{16,}+", "AKIA"),
    "hex": (r"(?<![0-9a-f])[0-9a-f]{24,}+", r"(?<![0-9a-f])[0-9a-f]{24}"),
    "random": (rf"(?<!{_ANY})(?=[A-Za-z+/_-]*+[0-9]){_ANY}{{16,}}+={{0,2}}+", rf"{_ANY}{{16}}"),
}
#: encoding -> (what its strings look like, its alphabet), the narrowest first.
#: A string is of an encoding if it holds letters and digits (fixed values).
_DIGITS, _LOW = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = {
    "hex": ("^(?:[0-9a-f]+|[0-9A-F]+)$", _DIGITS + "abcdef"),
    "base32": ("^[A-Z2-7]+$", _LOW + "234567"),
    "base36": ("^(?:[0-9a-z]+|[0-9A-Z]+)$", _DIGITS + _LOW),
    "base62": ("^[0-9A-Za-z]+$", _DIGITS + _LOW.upper() + _LOW),
    "base64": ("^[0-9A-Za-z+/]+$", _LOW.upper() + _LOW + _DIGITS + "+/"),
}
#: Characters of two cases count as one in encodings of one case.
_ONE_CASE = ("hex", "base32", "base36")
LENGTHS = (16, 20, 24, 32, 48, 64)
#: Ordinary strings: the chance that two characters are equal (that of English
#: letters, and its ratio to a uniform alphabet's), the third moment over the
#: square of it, and how often the kind of character changes (fixed values).
EQUAL_PAIR, EQUAL_RATIO, THIRD, CHANGES = 0.0667, 1.73, 1.19, 0.15
ALPHA = 0.01
RATE = 0.01
#: Steps of log10 of the probabilities that the counts are kept by, and how many.
STEPS, MAX_STEP = 4, 160
#: Characters whose neighbours are compared at once.
BLOCK = 1024


def _upper_tail(z: Column) -> Column:
    """P(Z >= z) of a standard normal, within a few percent at any z."""
    a = F.abs(z)
    q = F.exp(-a * a / 2) * 2 / (math.sqrt(2 * math.pi) * (a + F.sqrt(a * a + 8 / math.pi)))
    return F.when(z >= 0, q).otherwise(1 - q)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, kind, start, end, found) for every match, offsets in
    code points, end exclusive. doc_id and text_hash identify a row; repeated
    rows count once. Matches that fail their rule are left out."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("t"), F.xxhash64(text, F.lit(1)).alias("text_hash"))
    none = F.array().cast("array<string>")
    rows = rows.withColumns({f"m_{k}": F.when(F.col("t").rlike(test), F.regexp_extract_all("t", F.lit(p), F.lit(0))).otherwise(none)
                             for k, (p, test) in GENERATORS.items()})
    rows = rows.where(reduce(lambda a, k: a | (F.size(f"m_{k}") > 0), KINDS, F.lit(False)))
    rows = rows.withColumns({f"g_{k}": F.when(F.size(f"m_{k}") > 0, F.split("t", p, -1)).otherwise(none) for k, (p, _) in GENERATORS.items()})
    parts = [F.transform(F.arrays_zip(F.col(f"m_{k}").alias("m"), F.col(f"g_{k}").alias("g")),
                         lambda x, i: F.struct(i.alias("nth"), x["m"].alias("found"), F.length(x["g"]).alias("gap"))) for k in KINDS]
    lists = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), p.alias("list")) for k, p in zip(KINDS, parts)))).alias("k")
    found = rows.select("doc_id", "text_hash", lists).where(F.size("k.list") > 0)
    found = found.select("doc_id", "text_hash", "k.kind", F.explode("k.list").alias("m")).select("doc_id", "text_hash", "kind", "m.*")
    found = found.where("found is not null").dropDuplicates(["doc_id", "text_hash", "kind", "nth"])
    so_far = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("end", F.sum(F.col("gap") + F.length("found")).over(so_far))
    valid = (F.when(F.col("kind") == "assign", F.length(F.regexp_extract("found", _ASSIGN, 2)) >= 6)
             .when(F.col("kind") == "random", F.col("found").rlike("[A-Za-z]")).otherwise(True))
    return found.where(valid).select("doc_id", "text_hash", "kind", (F.col("end") - F.length("found")).alias("start"), "end", "found")


def tested(found: DataFrame) -> DataFrame:
    """Candidates (column ``found``) with the encoding, the three probabilities
    under uniform randomness (p_chi, p_runs, p_serial), whether they pass the
    battery, the length class and ``ordinary``, a bound of the probability that
    an ordinary string does as well."""
    plain = F.translate(F.regexp_replace("found", "=+$", ""), "-_", "+/")
    rows = found.withColumn("s", plain)
    kind = F.lit("base64")
    for name, (pattern, _) in reversed(ENCODINGS.items()):
        kind = F.when(F.col("s").rlike(pattern), name).otherwise(kind)
    rows = rows.withColumn("encoding", kind)
    one_case = F.col("encoding").isin(*_ONE_CASE)
    pick = lambda of: reduce(lambda a, e: F.when(F.col("encoding") == e, of(e)).otherwise(a), ENCODINGS, F.lit(None))
    alphabet = pick(lambda e: F.lit(ENCODINGS[e][1]))
    size = pick(lambda e: F.lit(float(len(ENCODINGS[e][1]))))
    rows = rows.withColumns({"s": F.when(one_case, F.lower("s")).otherwise(F.col("s")), "alphabet": alphabet, "a": size})
    length = F.length("s").cast("double")
    # how often each of its characters occurs: squares summed over the alphabet
    squares = F.aggregate(F.transform(F.split("alphabet", ""), lambda c: F.when(
        c == "", F.lit(0.0)).otherwise((F.length("s") - F.length(F.replace("s", c, F.lit("")))).cast("double"))), F.lit(0.0), lambda t, o: t + o * o)
    kinds = reduce(lambda c, p: F.regexp_replace(c, *p), (("[+/]+", ""), ("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "0")), F.col("s"))
    letters = F.col("s").cast("string")
    # neighbours' distances from the alphabet's middle, multiplied
    middle = (F.col("a") + 1) / 2
    places = lambda b: F.transform(F.filter(F.split(b, ""), lambda c: c != ""), lambda c: F.position(c, F.col("alphabet")) - F.col("middle"))
    products = lambda v: F.aggregate(F.zip_with(F.slice(v, 1, F.greatest(F.size(v) - 1, F.lit(0))), F.slice(v, 2, F.greatest(F.size(v) - 1, F.lit(0))),
                                                lambda x, y: x * y), F.lit(0.0), lambda t, x: t + x)
    rows = rows.withColumns({"n": length, "squares": squares, "changes": (F.length(kinds) - 1).cast("double"), "middle": middle,
                             "letters_only": F.length(F.regexp_replace(letters, "[+/]", "")).cast("double")})
    rows = rows.withColumn("blocks", F.regexp_extract_all("s", F.lit(f".{{1,{BLOCK}}}"), F.lit(0)))
    rows = rows.withColumn("serial", F.aggregate(F.transform("blocks", lambda b: products(places(b))), F.lit(0.0), lambda t, x: t + x))
    n, a = F.col("n"), F.col("a")
    # characters of a kind: its share of the alphabet gives the changes expected
    switch = pick(lambda e: F.lit(_switch(ENCODINGS[e][1])))
    steps = F.greatest(F.col("letters_only") - 1, F.lit(1.0))
    chi = a / n * F.col("squares") - n
    z_chi = (chi - (a - 1)) / F.sqrt(2 * (a - 1) * (n - 1) / n)
    rows = rows.withColumns({"switch": switch, "steps": steps, "z_chi": z_chi})
    z_runs = (F.col("changes") - F.col("steps") * F.col("switch")) / F.sqrt(F.col("steps") * F.col("switch") * (1 - F.col("switch")))
    z_serial = F.col("serial") / ((a * a - 1) / 12 * F.sqrt(n - F.size("blocks")))
    rows = rows.withColumns({"p_chi": _upper_tail(F.col("z_chi")), "p_runs": F.least(F.lit(1.0), 2 * _upper_tail(F.abs(z_runs))),
                             "p_serial": F.least(F.lit(1.0), 2 * _upper_tail(F.abs(z_serial)))})
    # an ordinary string's equal pairs and changes
    equal = F.greatest(F.lit(EQUAL_PAIR), EQUAL_RATIO / a)
    pairs = n * (n - 1) / 2
    spread = pairs * equal * (1 - equal) + n * (n - 1) * (n - 2) * (THIRD - 1) * equal * equal
    low = 1 - _upper_tail(((F.col("squares") - n) / 2 + 0.5 - pairs * equal) / F.sqrt(spread))
    share = F.least(F.col("changes") / F.col("steps"), F.lit(1.0))
    part = lambda x, p: F.when(x > 0, x * F.log(x / p)).otherwise(0.0)
    many = F.when(share > CHANGES, F.col("steps") * (part(share, CHANGES) + part(1 - share, 1 - CHANGES))).otherwise(0.0)
    rows = rows.withColumn("evidence", many - F.log(F.greatest(low, F.lit(1e-300))))
    rows = rows.withColumn("ordinary", F.exp(-F.col("evidence")) * (1 + F.col("evidence")))
    passes = F.least("p_chi", "p_runs", "p_serial") >= ALPHA / 3
    length_class = reduce(lambda x, at: F.when(n >= at, at).otherwise(x), LENGTHS, F.lit(0))
    return rows.select(*found.columns, "encoding", "p_chi", "p_runs", "p_serial", passes.alias("passes"),
                       length_class.alias("length_class"), "ordinary")


def _switch(alphabet: str) -> float:
    """The chance that two random characters of the alphabet are of different
    kinds; + and / are left out, letters of one case are one kind."""
    kinds = [sum(c.isdigit() for c in alphabet), sum(c.islower() for c in alphabet), sum(c.isupper() for c in alphabet)]
    return 1 - sum(k * k for k in kinds) / sum(kinds) ** 2


def thresholds(scored: DataFrame, rate: float = RATE) -> DataFrame:
    """(length_class, least_step): the Benjamini-Hochberg cut over the candidates
    of each length class, on steps of the probability's logarithm."""
    step = F.least(F.floor(-F.log10(F.greatest("ordinary", F.lit(1e-300))) * STEPS), F.lit(MAX_STEP)).cast("int")
    counts = scored.withColumn("step", step).groupBy("length_class", "step").agg(
        F.count("*").alias("n"), F.sum(F.col("passes").cast("long")).alias("passing"))
    down = Window.partitionBy("length_class").orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, 0)
    counts = counts.withColumns({"m": F.sum("n").over(Window.partitionBy("length_class")), "hits": F.sum("passing").over(down)})
    return counts.where(F.col("m") * F.pow(F.lit(10.0), -F.col("step") / STEPS) <= rate * F.col("hits")).groupBy("length_class").agg(
        F.min("step").alias("least_step"))


def find_spans(docs: DataFrame, rate: float = RATE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, kind, start, end, base): the rules' spans and the
    strings that the battery adds. Strings that overlap a rule's span are not
    tested."""
    found = candidates(docs, id_col, text_col)
    place = Window.partitionBy("doc_id", "text_hash").orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    # from the end: a frame that reaches to the partition's end would take time in the square of its rows
    behind = Window.partitionBy("doc_id", "text_hash").orderBy(F.desc("start"), F.desc("end"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    rule = F.col("kind") != "random"
    back = F.max(F.when(rule, F.col("end"))).over(place)
    ahead = F.min(F.when(rule, F.col("start"))).over(behind)
    inside = F.coalesce(back > F.col("start"), F.lit(False)) | F.coalesce(ahead < F.col("end"), F.lit(False))
    found = written(found.withColumn("inside", inside).where(rule | ~F.col("inside")).drop("inside"), "secret-candidates")
    scored = written(tested(found.where(~rule)).drop("found"), "secret-tests")
    step = F.least(F.floor(-F.log10(F.greatest("ordinary", F.lit(1e-300))) * STEPS), F.lit(MAX_STEP)).cast("int")
    added = scored.where("passes").join(F.broadcast(thresholds(scored, rate)), "length_class").where(step >= F.col("least_step"))
    keys = ["doc_id", "text_hash", "kind", "start", "end"]
    return found.where(rule).select(*keys, F.lit(True).alias("base")).unionByName(added.select(*keys, F.lit(False).alias("base")))


def document_spans(docs: DataFrame, rate: float = RATE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_assign, n_access, n_hex
    (rules' spans), base and spans (arrays of start, rank, end, kind in the order
    of their starts, then kinds). Null text has no spans; null ids and repeated
    rows stay; an empty table gives an empty result; other columns are ignored."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text, F.lit(1)).alias("text_hash"))
    order = reduce(lambda a, k: F.when(F.col("kind") == k, KINDS.index(k)).otherwise(a), KINDS, F.lit(-1))
    span = F.struct(F.col("start"), order.alias("rank"), F.col("end"), F.col("kind"))
    listed = find_spans(docs, rate, id_col, text_col).groupBy(F.col("doc_id").alias("d"), F.col("text_hash").alias("h")).agg(
        *(F.sum(F.when(F.col("base") & (F.col("kind") == k), 1).otherwise(0)).alias(f"n_{k}") for k in BASE),
        F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("base"), F.sort_array(F.collect_list(span)).alias("spans"))
    out = rows.join(listed, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    return out.select("doc_id", "text_hash", *(F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in BASE),
                      F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))


def span_text(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
