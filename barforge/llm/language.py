"""Language identification by Bayesian evidence fusion.

Four sources of evidence meet in one posterior per document:

* text likelihood: byte-trigram multinomials per language, fitted on a bounded
  sample of labelled documents, plus a flat background model ("und") for text
  of none of them;
* the language the markup declares, through a confusion table;
* the address suffix and the host, as priors smoothed hierarchically: corpus ->
  suffix -> registered domain -> host, each level shrunk towards the one above.

The confusion table and the priors are grouped counts over all documents whose
text alone is decisive. Texts are read once; everything after that works on
narrow rows of scores.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barforge.llm.common import small_batches, with_fields, written
from barforge.llm.url_filter import host_of, registered_domain, suffix_of

UNKNOWN = "und"
#: Hash buckets of byte trigrams.
BUCKETS = 1 << 16
#: The labelled documents a language's text model is fitted on, at most.
SAMPLE_PER_LANGUAGE = 2000
#: Trigrams overlap and repeat: a text counts as at most this many independent ones.
MOST_EVIDENCE = 40.0
#: Share of a text's trigrams taken as independent below that.
INDEPENDENT = 0.25
PRIOR_STRENGTH = 20.0
DECLARED_STRENGTH = 5.0
#: Text-only posterior from which a document enters the grouped counts.
DECISIVE = 0.9
ACCEPT = 0.5


def trigram_buckets(text: bytes, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of the byte trigrams of a text, A-Z folded, digits and ASCII
    punctuation taken as white space, runs of it as one blank."""
    b = _CLASS[np.frombuffer(text, np.uint8)]
    keep = np.ones(len(b), bool)
    keep[1:] = (b[1:] != 32) | (b[:-1] != 32)
    b = b[keep].astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64)
    h = (b[:-2] << 16 | b[1:-1] << 8 | b[2:]) * np.uint32(0x9E3779B1)
    return (h >> np.uint32(32 - (buckets.bit_length() - 1))).astype(np.int64)


_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[:128] = 32
_CLASS[0x61:0x7B] = np.arange(0x61, 0x7B)
_CLASS[0x41:0x5B] = np.arange(0x61, 0x7B)


def fit_text_models(docs: DataFrame, label_col: str, text_col: str = "text", id_col: str = "doc_id",
                    per_language: int = SAMPLE_PER_LANGUAGE, buckets: int = BUCKETS) -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities [language, bucket]) from at most
    ``per_language`` labelled documents of each language (smallest hash of the
    id, so the sample does not depend on order or partitions), whole texts."""
    by_hash = Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = docs.select(F.col(label_col).cast("string").alias("label"), F.col(id_col).cast("bigint").alias("doc_id"))
    ids = ids.where((F.trim("label") != "") & F.col("doc_id").isNotNull() & F.col("label").rlike("^[a-z]{2,3}$")).distinct()
    ids = ids.withColumn("n", F.row_number().over(by_hash)).where(F.col("n") <= per_language).select("label", "doc_id")
    sample = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"),
                         F.col(label_col).cast("string").alias("label"))
    # languages times per_language rows: small by construction
    sample = sample.join(F.broadcast(written(ids, "lang-sample")), ["label", "doc_id"], "left_semi").select("label", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for b in batches:
            for label, text in zip(b.column("label").to_pylist(), b.column("text").to_pylist()):
                own = counts.setdefault(label, np.zeros(buckets, np.int64))
                own += np.bincount(trigram_buckets(text or b"", buckets), minlength=buckets)
        for label, own in counts.items():
            met = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(met), pa.string()), pa.array(met), pa.array(own[met])],
                                             ["label", "bucket", "n"])

    rows = sample.mapInArrow(count, "label string, bucket bigint, n bigint").groupBy("label", "bucket").agg(F.sum("n").alias("n")).toArrow()
    label = np.array(rows.column("label").to_pylist(), dtype=object)
    languages = sorted(set(label))
    total = np.zeros((len(languages), buckets))
    for i, name in enumerate(languages):
        total[i, rows.column("bucket").to_numpy()[label == name]] = rows.column("n").to_numpy()[label == name]
    smoothed = total + 0.05
    return languages, np.log(smoothed / smoothed.sum(axis=1, keepdims=True))


def text_scores(docs: DataFrame, languages: list[str], models: np.ndarray, *keep: Column, text_col: str = "text") -> DataFrame:
    """The columns ``keep`` and scores: log likelihood per language and, last,
    of the flat background, tempered to independent trigrams. All zero for a
    text without a trigram of letters."""
    buckets = models.shape[1]
    flat = math.log(8.0 / buckets)
    table = np.ascontiguousarray(models.T)
    small_batches(docs.sparkSession)
    rows = docs.select(*keep, F.col(text_col).cast("string").cast("binary").alias("_text"))
    names = [c for c in rows.columns if c != "_text"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text in b.column("_text"):
                text, total, n = text.as_py() or b"", np.zeros(len(languages)), 0
                for at in range(0, max(1, len(text)), 1 << 20):  # long texts in parts
                    own = trigram_buckets(text[max(0, at - 2):at + (1 << 20)], buckets)
                    total += table[own].sum(axis=0)
                    n += len(own)
                weight = min(MOST_EVIDENCE, INDEPENDENT * n) / n if n else 0.0
                out.append([*(total * weight).tolist(), flat * n * weight])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(out, pa.list_(pa.float64()))],
                                             [*names, "scores"])

    schema = T.StructType([f for f in rows.schema.fields if f.name != "_text"])
    return rows.mapInArrow(score, with_fields(schema, ("scores", T.ArrayType(T.DoubleType()))))


def _softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    grown = F.transform(scores, lambda s: F.exp(s - top))
    total = F.aggregate(grown, F.lit(0.0), lambda a, x: a + x)
    return F.transform(grown, lambda s: s / total)


def _counts(rows: DataFrame, k: int, *keys: str) -> DataFrame:
    """(keys, c): how often each language (by index) is the decisive one."""
    per = [F.sum(F.when(F.col("best") == i, 1).otherwise(0)).cast("double") for i in range(k)]
    return rows.groupBy(*keys).agg(F.array(*per).alias("c"))


def _shrink(counts: Column, parent: Column, strength: float) -> Column:
    """(count + strength * parent) / (total + strength), per language."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return F.zip_with(counts, parent, lambda c, p: (c + strength * p) / (total + strength))


def identify(docs: DataFrame, languages: list[str], models: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
             declared_col: str | None = None, url_col: str | None = None, host_col: str | None = None,
             evidence: DataFrame | None = None, accept: float = ACCEPT) -> DataFrame:
    """(doc_id, lang, probability, text_lang, kept) per row of ``docs``.
    ``declared_col`` holds the markup's language tag, ``url_col`` an address,
    ``host_col`` a host name for rows without one; each may be missing or null,
    which leaves that evidence out. ``evidence(doc_id, declared, url)``, at most
    one row per id, supplies them from another table: it meets the scores, never
    the texts. lang is the most probable language or "und";
    kept: a language is at least ``accept`` probable and the text has letters.
    Ties go to the alphabetically first language. Null text has no letters and
    is not kept; null ids and repeated rows stay; an empty table gives an empty
    result; other columns are ignored."""
    names = [*languages, UNKNOWN]
    k = len(names)
    of = lambda c: F.col(c).cast("string") if c else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("_t"),
                       of(declared_col).alias("declared"), of(url_col).alias("url"), of(host_col).alias("named_host"))
    scored = written(text_scores(rows, languages, models, *map(F.col, ("doc_id", "declared", "url", "named_host")),
                                 text_col="_t"), "lang-scores")
    if evidence is not None:
        more = evidence.select("doc_id", F.col("declared").alias("declared2"), F.col("url").alias("url2"))
        scored = scored.join(more, "doc_id", "left").withColumns({
            "declared": F.coalesce("declared", "declared2"), "url": F.coalesce("url", "url2")})
    tag = F.lower(F.regexp_extract(F.trim("declared"), "^[A-Za-z]{2,3}", 0))
    host = F.coalesce(F.when(host_of(F.col("url")) != "", host_of(F.col("url"))), F.col("named_host"), F.lit(""))
    scored = written(scored.select(
        "doc_id", "scores", F.when(tag.isin(*languages), tag).when(tag != "", F.lit(UNKNOWN)).alias("declared"),
        host.alias("host"), _softmax(F.col("scores")).alias("alone")), "lang-evidence")
    scored = scored.withColumn("best", F.when(F.array_max("alone") >= DECISIVE, F.array_position("alone", F.array_max("alone")) - 1))
    # decisive documents that have a letter trigram at all; a text without one scores 0 everywhere
    scored = scored.withColumn("best", F.when(F.exists("scores", lambda s: s != 0), F.col("best")))

    # grouped counts: hosts first, upper levels from the host counts
    hosts = _counts(scored.where("best is not null"), k, "host")
    hosts = scored.select("host").distinct().join(hosts, "host", "left").select(
        "host", registered_domain(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"),
        F.coalesce("c", F.array(*[F.lit(0.0)] * k)).alias("c"))
    hosts = written(hosts, "lang-hosts")
    add = lambda *keys: hosts.groupBy(*keys).agg(F.array(*(F.sum(F.col("c")[i]) for i in range(k))).alias("c"))
    corpus = add().first()["c"]
    corpus = [((c or 0.0) + 1.0) / (sum(x or 0.0 for x in corpus) + k) for c in corpus]
    suffixes = add("suffix").select("suffix", _shrink(F.col("c"), F.array(*map(F.lit, corpus)), PRIOR_STRENGTH).alias("up"))
    domains = add("suffix", "domain").join(suffixes, "suffix").select(
        "domain", _shrink(F.col("c"), F.col("up"), PRIOR_STRENGTH).alias("up"))
    priors = hosts.join(domains, "domain").select("host", _shrink(F.col("c"), F.col("up"), PRIOR_STRENGTH).alias("prior"))

    # P(declared | language): languages + 1 values either way
    told = {r["declared"]: r["c"] for r in _counts(scored.where("best is not null and declared is not null"), k, "declared").collect()}
    seen = [sum(c[i] for c in told.values()) for i in range(k)]
    says = {d: [math.log((told.get(d, [0.0] * k)[i] + DECLARED_STRENGTH * (0.8 if d == names[i] else 0.2 / (k - 1)))
                         / (seen[i] + DECLARED_STRENGTH)) for i in range(k)] for d in names} if k > 1 else {UNKNOWN: [0.0]}
    evidence = F.coalesce(*(F.when(F.col("declared") == d, F.array(*map(F.lit, says[d]))) for d in says),
                          F.array(*[F.lit(0.0)] * k))
    fused = scored.join(priors, "host").withColumn("p", _softmax(F.zip_with(F.zip_with(
        F.col("scores"), F.transform("prior", lambda p: F.log(p)), lambda a, b: a + b), evidence, lambda a, b: a + b)))
    label = F.array(*map(F.lit, names))
    top, letters = F.array_max("p"), F.exists("scores", lambda s: s != 0)
    lang = F.when(letters, F.get(label, (F.array_position("p", top) - 1).cast("int"))).otherwise(UNKNOWN)
    fused = fused.select("doc_id", lang.alias("lang"), top.alias("probability"),
                         F.when(letters, F.get(label, (F.array_position("alone", F.array_max("alone")) - 1).cast("int")))
                         .otherwise(UNKNOWN).alias("text_lang"))
    return fused.withColumn("kept", (F.col("lang") != UNKNOWN) & (F.col("probability") >= accept))


def page_evidence(pages: DataFrame) -> DataFrame:
    """(doc_id, declared, url): the markup language and address of the pages of
    each document (those whose address ends in the document's number). The
    address is that of the smallest page_id, the language that of the smallest
    page_id whose markup declares one, wherever in the page it stands; "" if
    none does."""
    number = F.regexp_extract("url", r"/([0-9]{1,18})(?:\.[a-z]+)?/?(?:[?#].*)?$", 1)
    tag = F.regexp_extract("html", r"(?i)<html(?=\s)[^>]*?\slang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    page = pages.select(F.when(number != "", number).cast("bigint").alias("doc_id"), "page_id", "url", tag.alias("declared"))
    says = F.col("declared") != ""
    return page.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.coalesce(F.min_by("declared", F.when(says, F.col("page_id"))), F.lit("")).alias("declared"),
        F.min_by("url", "page_id").alias("url"))
