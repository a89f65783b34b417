"""Personal data: high-recall span generators, rules for four base kinds, and
gradient-boosted trees over format and context for the rest. Column functions,
windows and Spark's own tree learner only.

Every generator is one regular expression; splitting a text at its matches
gives the offsets. Matches become narrow rows (offsets, a few characters of
context), so texts are never shuffled. Base spans follow their rules alone and
always stay. The other candidates - secrets in assignments, loosely written
numbers and addresses - are scored by boosted trees. Their positives are
confirmed spans rewritten so that the confirming rule no longer holds (phones
without their plus or country code, hex secrets in base64 or cut short,
addresses spelled out), in the context they stand in; negatives are candidates
with a sign against them (numbers without a word that leads to a phone, values
spelled in words, names that end in no domain). Candidates without either are
in neither class: the trees decide them. Feature values are small codes, so all
candidates of the corpus reduce to a bounded table of feature patterns with
weights; trees are fitted and evaluated on it. Per kind, the threshold is the
lowest score whose precision on held-out documents reaches the target.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barforge.llm.common import written

#: Base kinds in the order of their spans.
BASE = ("email", "ip", "card", "phone")
_LOCAL, _NAME = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: kind -> (expression, cheap test that a text can match). Runs are possessive
#: and start where the run starts (or where the last match ended), which leaves
#: the matches as they are and the time linear in the text.
GENERATORS = {
    "email": (rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_NAME}++(?:\.{_NAME}++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", "[0-9][0-9 -]"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
    "secret": (r"(?i)(?:key|token|secret|passw(?:or)?d|pwd)[\"']?[\x20\t]{0,3}[:=][\x20\t]{0,3}[\"']?[A-Za-z0-9+/_=-]{8,}+",
               "(?i)(?:key|token|secret|passw|pwd)"),
    "number": (r"(?<![0-9])[0-9](?:[\x20()./-]{0,2}+[0-9]){6,}+", "[0-9]"),
    "address": (r"(?i)[A-Za-z0-9._%+-]{2,64}+\x20?[(\[{]\x20?at\x20?[)\]}]\x20?[A-Za-z0-9-]{2,64}+"
                r"(?:\x20?(?:\.|[(\[{]\x20?dot\x20?[)\]}])\x20?[A-Za-z0-9-]{2,24}+){1,4}+", r"(?i)[(\[{]\x20?at\x20?[)\]}]"),
}
KINDS = tuple(GENERATORS)
CONTEXT = 24
CONTACT_CUE = "(?i)(?:phone|tel|call|fax|mobile|contact|mail|card|account|ssn|passport|iban|addr)"
SECRET_CUE = "(?i)(?:key|token|secret|passw|pwd)"
#: What leads to a phone number, right before it.
LEADS = r"(?i)\b(?:phone|tel|telephone|call|fax|mobile|cell|contact|reach|dial)\b[^0-9]{0,12}$"
DATE = r"^(?:(?:19|20)[0-9]{2}([./-])[0-9]{1,2}\1[0-9]{1,2}|[0-9]{1,2}([./-])[0-9]{1,2}\2(?:19|20)[0-9]{2})(?:\x20.*)?$"
#: Values made of words and numbers, e.g. primary_key2 or camelCase names.
SPELLED = "^(?:[A-Z]?[a-z]{2,}+|[A-Z]{2,}+|[0-9]++(?![a-z])|[_/+=-]++)++$"
DOMAIN_END = r"[\x20.)\]}](?!(?:txt|html?|pdf|docx?|xlsx?|csv|json|xml|php|js|py|java|jpe?g|png|gif|zip|md)$)[a-z]{2,24}$"
PRECISION = 0.99
TREES, DEPTH = 10, 4
FEATURES = ("kind_code", "length_code", "digits", "separators", "luhn", "octets", "hex", "before", "behind", "cue", "mix", "runs")


def _octets(m: Column) -> Column:
    part = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
    return m.rlike(rf"^{part}(?:\.{part}){{3}}$")


def _luhn(digits: Column) -> Column:
    """The Luhn check of a string of digits (of 19 at most; longer ones fail)."""
    ok = F.length(digits).between(2, 19)
    back = F.reverse(digits)
    values = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.when(
        i % 2 == 1, back.substr(i, F.lit(1)).cast("int")).otherwise(
        F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), back.substr(i, F.lit(1)).cast("int") + 1)))
    return F.when(ok, F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0).otherwise(False)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, kind, start, end, found, prior, next, valid) for every
    match of every generator, offsets in code points, end exclusive; valid marks
    base spans. doc_id and text_hash identify a row; repeated rows count once."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("t"), F.xxhash64(text, F.lit(1)).alias("text_hash"))
    none = F.array().cast("array<string>")
    matches, gaps = {}, {}
    for kind, (pattern, test) in GENERATORS.items():
        may = F.col("t").contains(test) if test == "@" else F.col("t").rlike(test)
        matches[f"m_{kind}"] = F.when(may, F.regexp_extract_all("t", F.lit(pattern), F.lit(0))).otherwise(none)
        gaps[f"g_{kind}"] = F.when(may, F.split("t", pattern, -1)).otherwise(none)
    rows = rows.withColumns(matches)
    rows = rows.withColumns({k: F.when(F.size(f"m_{k[2:]}") > 0, g).otherwise(none) for k, g in gaps.items()})
    parts = [F.transform(
        F.arrays_zip(F.col(f"m_{kind}").alias("m"), F.col(f"g_{kind}").alias("g"),
                     F.slice(f"g_{kind}", 2, F.greatest(F.size(f"g_{kind}"), F.lit(1))).alias("n")),
        lambda x, i: F.struct(i.alias("nth"), x["m"].alias("found"), F.length(x["g"]).alias("gap"),
                              F.right(x["g"], F.lit(CONTEXT)).alias("prior"), F.left(x["n"], F.lit(CONTEXT)).alias("next")))
        for kind in KINDS]
    kinds = F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), p.alias("list")) for k, p in zip(KINDS, parts)))).alias("k")
    found = rows.select("doc_id", "text_hash", kinds).where(F.size("k.list") > 0)
    found = found.select("doc_id", "text_hash", "k.kind", F.explode("k.list").alias("m")).select("doc_id", "text_hash", "kind", "m.*")
    found = found.where(F.col("found").isNotNull())
    found = found.dropDuplicates(["doc_id", "text_hash", "kind", "nth"])
    so_far = Window.partitionBy("doc_id", "text_hash", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    found = found.withColumn("end", F.sum(F.col("gap") + F.length("found")).over(so_far))
    # a secret's span is the value behind the sign
    value = F.regexp_extract("found", "[:=][ \\t]{0,3}[\"']?([A-Za-z0-9+/_=-]{8,})$", 1)
    found = found.withColumns({"found": F.when((F.col("kind") == "secret") & (value != ""), value).otherwise(F.col("found")),
                               "whole": F.col("found")})
    digits = F.regexp_replace("found", "[^0-9]", "")
    valid = (F.when(F.col("kind") == "email", True).when(F.col("kind") == "ip", _octets(F.col("found")))
             .when(F.col("kind") == "card", F.length(digits).between(12, 19) & _luhn(digits))
             .when(F.col("kind") == "phone", F.length(digits).between(9, 15)).otherwise(False))
    prior = F.when(F.col("kind") == "secret", F.concat("prior", F.expr("left(whole, length(whole) - length(found))"))).otherwise(F.col("prior"))
    return found.select("doc_id", "text_hash", "kind", (F.col("end") - F.length("found")).alias("start"), "end", "found",
                        F.right(prior, F.lit(CONTEXT)).alias("prior"), "next", valid.alias("valid"))


def _class(c: Column) -> Column:
    """0 edge or white space, 1 letter, 2 digit, 3 quote or bracket, 4 other."""
    return (F.when((c == "") | c.rlike(r"^\s"), 0).when(c.rlike(r"^\p{L}"), 1).when(c.rlike("^[0-9]"), 2)
            .when(c.rlike("^[\"'()\\[\\]<>{}]"), 3).otherwise(4))


def _coded(rows: DataFrame) -> DataFrame:
    """Rows of kind, found, prior, next with their feature codes. The cue is left
    to the base kinds: for numbers it is what the labels rest on."""
    m, digits = F.col("found"), F.regexp_replace("found", "[^0-9]", "")
    cue = F.when(F.col("prior").rlike(CONTACT_CUE), 1).otherwise(0) + F.when(F.col("prior").rlike(SECRET_CUE), 2).otherwise(0)
    has = lambda c, w: F.when(m.rlike(c), w).otherwise(0)
    turns = "(?<=[a-z])(?![a-z])|(?<=[A-Z])(?![A-Z])|(?<=[0-9])(?![0-9])"
    return rows.withColumns({
        "kind_code": reduce(lambda a, k: F.when(F.col("kind") == k, KINDS.index(k)).otherwise(a), KINDS, F.lit(-1)),
        "length_code": F.least(F.floor(F.log2(F.length(m))), F.lit(7)).cast("int"), "digits": F.least(F.length(digits), F.lit(20)),
        "separators": F.least(F.length(F.regexp_replace(m, r"[^\x20()./-]", "")), F.lit(5)),
        "luhn": (F.length(digits).between(12, 19) & _luhn(digits)).cast("int"), "octets": _octets(m).cast("int"),
        "hex": m.rlike("^(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]{16,}$").cast("int"),
        "before": _class(F.right("prior", F.lit(1))), "behind": _class(F.left("next", F.lit(1))),
        "cue": F.when(F.col("kind").isin(*BASE), cue).otherwise(0), "mix": has("[a-z]", 1) + has("[A-Z]", 2) + has("[0-9]", 4),
        "runs": F.least(F.size(F.regexp_extract_all(F.left(m, F.lit(64)), F.lit(turns), F.lit(0))), F.lit(7))})


def _rewritten(sure: DataFrame) -> DataFrame:
    """Confirmed phones, secrets and addresses in forms their rules do not
    confirm, as rows of kind, found, prior, next, held_out and weight. The forms
    of a span weigh 1 together. Only forms that the kind's generator finds."""
    m = F.col("found")
    at, name = F.regexp_extract(m, "^(.*)@", 1), F.regexp_extract(m, "@(.*)$", 1)
    form = lambda kind, found, lead="": F.struct(
        F.lit(kind).alias("kind"), found.alias("found"), F.concat("prior", lead if isinstance(lead, Column) else F.lit(lead)).alias("prior"))
    country = r"^\+([0-9]{1,3}[\x20().-]+)([0-9].*)$"
    code = F.base64(F.unhex(F.left(m, F.floor(F.length(m) / 2).cast("int") * 2)))
    code = F.regexp_replace(code, r"\s", "")
    forms = (F.when(F.col("kind") == "phone", F.array(
        form("number", F.expr("substr(found, 2)")), form("number", F.regexp_extract(m, country, 2), F.regexp_extract(m, country, 1))))
        .when(F.col("kind") == "secret", F.array(
            form("secret", code), form("secret", F.left(code, F.lit(20))), form("secret", F.left(m, F.lit(24))), form("secret", F.left(m, F.lit(16)))))
        .when(F.col("kind") == "email", F.array(*(
            form("address", F.concat(at, F.lit(a), F.regexp_replace(name, r"\.", d)))
            for a, d in ((" [at] ", " [dot] "), (" (at) ", " (dot) "), (" (at) ", "."), ("[at]", "[dot]"), (" [at] ", "."))))))
    whole = {"number": f"^(?:{GENERATORS['number'][0]})$", "secret": "^[A-Za-z0-9+/_=-]{8,}$", "address": f"^(?:{GENERATORS['address'][0]})$"}
    forms = F.filter(forms, lambda x: reduce(lambda a, k: a | ((x["kind"] == k) & x["found"].rlike(whole[k])), whole, F.lit(False)))
    rows = sure.select("next", "held_out", (1.0 / F.size(forms)).alias("weight"), F.explode(forms).alias("x"))
    return rows.select("x.*", "next", "held_out", "weight")


def featured(found: DataFrame) -> DataFrame:
    """Candidates with their feature codes, the weak label (1: a rule confirms
    the span, 0: a sign is against it, null: undecided), whether a confirmed
    span overlaps it or it cannot be of its kind, and the fold of their document."""
    m, n = F.col("found"), F.length(F.regexp_replace("found", "[^0-9]", ""))
    by_place = Window.partitionBy("doc_id", "text_hash").orderBy("start", "end", "kind")
    # rule-confirmed secrets: 32 hex digits or more behind a secret's name
    seed = (F.col("kind") == "secret") & m.rlike("^[0-9A-Fa-f]{32,}$")
    sure = found.withColumn("sure", F.col("valid") | seed)
    back = F.max(F.when(F.col("sure"), F.col("end"))).over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    # from the end: a frame that reaches to the partition's end would take time in the square of its rows
    from_end = Window.partitionBy("doc_id", "text_hash").orderBy(F.desc("start"), F.desc("end"), F.desc("kind"))
    ahead = F.min(F.when(F.col("sure"), F.col("start"))).over(from_end.rowsBetween(Window.unboundedPreceding, -1))
    overlaps = F.coalesce(back > F.col("start"), F.lit(False)) | F.coalesce(ahead < F.col("end"), F.lit(False))
    # no phone number has 16 digits; four parts of digits are an address or a version
    refuted = (F.when(F.col("kind") == "number", (n > 15) | m.rlike(r"^[0-9]+(?:\.[0-9]+){3}$") | m.rlike(DATE))
               .when(F.col("kind") == "secret", m.rlike(SPELLED)).when(F.col("kind") == "address", ~m.rlike(DOMAIN_END)).otherwise(False))
    against = F.col("kind").isin(*BASE) | F.col("refuted") | ((F.col("kind") == "number") & ~F.col("prior").rlike(LEADS))
    rows = sure.withColumns({"inside": overlaps, "refuted": ~F.col("sure") & refuted,
                             "held_out": F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(5)) == 0})
    return _coded(rows.withColumn("label", F.when(F.col("sure"), 1.0).when(~F.col("inside") & against, 0.0)))


def selected_patterns(candidates_featured: DataFrame, precision: float = PRECISION) -> DataFrame | None:
    """The feature patterns whose candidates are redacted, with their score:
    boosted trees on the patterns' weights outside the held-out fold, both
    classes of each kind balanced, the threshold of each kind from the held-out
    fold (precision with one hit and one miss added, so that a few lucky
    candidates select nothing). For secrets, numbers and addresses the positives
    are rewritten spans alone. None without both classes.

    The pattern table is bounded by the features' codes, not by the corpus."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    weight = lambda c: F.sum(F.when(c, F.col("weight")).otherwise(0.0))
    own = candidates_featured.select(*FEATURES, "held_out", F.when(F.col("kind").isin(*BASE) | (F.col("label") == 0), F.col("label")).alias("label"),
                                     F.lit(1.0).alias("weight"))
    forms = _coded(_rewritten(candidates_featured.where("sure"))).select(*FEATURES, "held_out", F.lit(1.0).alias("label"), "weight")
    patterns = own.unionByName(forms).groupBy(*FEATURES).agg(
        weight(~F.col("held_out") & (F.col("label") == 1)).alias("fit_1"), weight(~F.col("held_out") & (F.col("label") == 0)).alias("fit_0"),
        weight(F.col("held_out") & (F.col("label") == 1)).alias("held_1"), weight(F.col("held_out") & (F.col("label") == 0)).alias("held_0"))
    patterns = written(patterns.coalesce(1).sortWithinPartitions(*FEATURES), "pii-patterns")
    sums = patterns.agg(F.sum("fit_1").alias("a"), F.sum("fit_0").alias("b")).first()
    if not sums["a"] or not sums["b"]:
        return None
    # a rare kind counts as much as a frequent one
    kind = Window.partitionBy("kind_code")
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(patterns).withColumns(
        {c: F.coalesce(F.try_divide(F.lit(1000.0) * F.col(c), F.sum(c).over(kind)), F.lit(0.0)) for c in ("fit_1", "fit_0")})
    fit = vector.select("features", F.lit(1.0).alias("label"), F.col("fit_1").alias("w")).union(
        vector.select("features", F.lit(0.0).alias("label"), F.col("fit_0").alias("w"))).where("w > 0").coalesce(1).cache()
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, weightCol="w", seed=7).fit(fit)
    fit.unpersist()
    scored = model.transform(vector).select(*FEATURES, "held_1", "held_0", vector_to_array("probability")[1].alias("score"))
    down = Window.partitionBy("kind_code").orderBy(F.col("score").desc())
    scored = scored.withColumns({"good": F.sum("held_1").over(down), "all": F.sum(F.col("held_1") + F.col("held_0")).over(down)})
    least = F.min(F.when(F.col("good") + 1 >= precision * (F.col("all") + 2), F.col("score"))).over(Window.partitionBy("kind_code"))
    return written(scored.withColumn("least", least).where(F.col("score") >= F.col("least")).select(*FEATURES, "score"), "pii-selected")


def find_spans(docs: DataFrame, precision: float = PRECISION, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, kind, start, end, base): the base spans, secrets a
    rule confirms, and the other candidates the calibrated trees select.
    Candidates of a base kind that fail its rule are not added, nor candidates
    of the trees that cannot be of their kind or overlap a confirmed span."""
    found = written(featured(candidates(docs, id_col, text_col)), "pii-candidates")
    base = found.where("valid").select("doc_id", "text_hash", "kind", "start", "end", F.lit(True).alias("base"))
    chosen = selected_patterns(found, precision)
    more = found.where(~F.col("valid") & ~F.col("kind").isin(*BASE))
    added = more.where("sure")
    if chosen is not None:
        added = added.unionByName(more.where("not sure and not inside and not refuted").join(chosen, list(FEATURES), "left_semi"))
    return base.union(added.select("doc_id", "text_hash", "kind", "start", "end", F.lit(False)))


def _listed(spans: DataFrame) -> DataFrame:
    """Spans gathered per document: counts of the base kinds and sorted lists."""
    order = reduce(lambda a, k: F.when(F.col("kind") == k, KINDS.index(k)).otherwise(a), KINDS, F.lit(-1))
    span = F.struct(F.col("start"), order.alias("rank"), F.col("end"), F.col("kind"))
    return spans.groupBy("doc_id", "text_hash").agg(
        *(F.sum(F.when(F.col("base") & (F.col("kind") == k), 1).otherwise(0)).alias(f"n_{k}") for k in BASE),
        F.sort_array(F.collect_list(F.when(F.col("base"), span))).alias("base"), F.sort_array(F.collect_list(span)).alias("spans"))


def document_spans(docs: DataFrame, precision: float = PRECISION, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, text_hash, n_email, n_ip, n_card,
    n_phone (base spans), base and spans (arrays of start, rank, end, kind in
    the order of their starts, then kinds). Null text has no spans; null ids
    and repeated rows stay; an empty table gives an empty result; other columns
    are ignored."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text, F.lit(1)).alias("text_hash"))
    listed = _listed(find_spans(docs, precision, id_col, text_col)).withColumnsRenamed({"doc_id": "d", "text_hash": "h"})
    out = rows.join(listed, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    return out.select("doc_id", "text_hash", *(F.coalesce(f"n_{k}", F.lit(0)).cast("bigint").alias(f"n_{k}") for k in BASE),
                      F.coalesce("base", none).alias("base"), F.coalesce("spans", none).alias("spans"))


def span_text(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, precision: float = PRECISION, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, e.g. [EMAIL];
    overlapping spans are replaced together, under the first one's kind. All
    other columns are as they were; null text stays null."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    spans = _listed(find_spans(docs, precision, id_col, text_col)).select(
        F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), F.col("spans").alias("_spans"))
    spans = written(spans, "pii-spans")
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")  # kept apart from the names used here
    rows = docs.select(row, F.col(id_col).cast("bigint").alias("_id"), F.xxhash64(text, F.lit(1)).alias("_hash"))
    # one plan at every size: each row is shuffled once, with its text once; a
    # broadcast that turns into this once the spans outgrow it gains nothing
    rows = rows.join(spans.hint("merge"), F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_hash") == F.col("_h")), "left")
    text = F.coalesce(F.col(f"row.`{text_col}`").cast("string"), F.lit(""))
    start = F.struct(F.lit("").alias("text"), F.lit(0).cast("bigint").alias("at"))
    done = F.aggregate("_spans", start, lambda a, s: F.when(s["start"] < a["at"], F.struct(
        a["text"].alias("text"), F.greatest(a["at"], s["end"]).alias("at"))).otherwise(F.struct(
            F.concat(a["text"], text.substr((a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")),
                     F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("text"), s["end"].alias("at"))))
    rows = rows.withColumn("_done", F.when(F.col("_spans").isNotNull(), done))
    rest = F.concat("_done.text", text.substr((F.col("_done.at") + 1).cast("int"), F.length(text)))
    clean = F.when(F.col("_done").isNotNull(), rest)
    return rows.select(*((F.coalesce(clean, F.col(f"row.`{c}`")) if c == text_col else F.col(f"row.`{c}`")).alias(c)
                         for c in docs.columns))
