"""Registered queries of the training-data operators: production parameters,
whole tables. Each derives the contract's columns from its operator's output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLE[name] = oracle
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op7_simhash_near_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barforge.llm.simhash import hex_fingerprint, near_duplicates
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", hex_fingerprint("fp").alias("fingerprint"), "component_id")


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from barforge.llm.packing import pack, token_pieces
    return pack(token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), keep_ids=False))


@query("op9_warc_chunked_records", oracle="""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NOT NULL AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS NOT NULL AND first <> page_id THEN first END AS refers_to
FROM f
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barforge.llm.warc import read_archive, records, write_archive
    path = write_archive(table(spark, sf_dir, "pages"))
    return records(read_archive(spark, path))


@query("op3_substring_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barforge.llm.substring import EMPTY, remove_repeats
    summary, changed = remove_repeats(table(spark, sf_dir, "documents"))
    kept = changed.select(F.col("doc_id").alias("id"), F.col("digest").alias("of"), F.sha2("kept", 256).alias("rest"))
    out = summary.join(kept, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("of")), "left")
    return out.select("doc_id", "n_words", "n_removed",
                      F.when(F.col("state") == "copy", F.lit(EMPTY)).otherwise(F.coalesce("rest", "digest")).alias("kept_sha256"))


#: The contract's rules (fixed values).
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]

_OP1_SHARE = """greatest(0.001, least(0.9, coalesce(CASE WHEN sum(n) FILTER (n > 0) > count(*) FILTER (n > 0) THEN
  (sum((bad * 1.0::DOUBLE / n - up) * (bad * 1.0::DOUBLE / n - up) * n / (up * (1 - up))) FILTER (n > 0) - count(*) FILTER (n > 0))
  / (sum(n) FILTER (n > 0) - count(*) FILTER (n > 0)) END, 0.001)))::DOUBLE"""


@query("op1_url_host_reputation", oracle=rf"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
marked AS (
  SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id),
counts AS (
  SELECT host, sum(bad) AS bad, count(*) AS n
  FROM p JOIN marked ON marked.doc_id = try_cast(nullif(regexp_extract(path, '/([0-9]{{1,18}})(?:\.[a-z]+)?/?$', 1), '') AS BIGINT)
  GROUP BY host),
hosts AS (
  SELECT host, CASE WHEN host ~ '^[0-9.]+$' OR regexp_extract(host, '[^.]+\.[^.]+$') = '' OR host ~ '^(?:ac|co|com|edu|gov|net|org)\.[a-z][a-z]$' THEN host
      WHEN regexp_extract(host, '[^.]+\.(?:ac|co|com|edu|gov|net|org)\.[a-z][a-z]$') <> '' THEN regexp_extract(host, '[^.]+\.(?:ac|co|com|edu|gov|net|org)\.[a-z][a-z]$')
      ELSE regexp_extract(host, '[^.]+\.[^.]+$') END AS domain
  FROM (SELECT DISTINCT host FROM p)),
base AS (
  SELECT h.host, domain, CASE WHEN regexp_extract(domain, '^[^.]*\.(.+)$', 1) = '' OR h.host ~ '^[0-9.]+$' THEN domain
      ELSE regexp_extract(domain, '^[^.]*\.(.+)$', 1) END AS suffix, coalesce(bad, 0) AS bad, coalesce(n, 0) AS n
  FROM hosts h LEFT JOIN counts c ON c.host = h.host),
d0 AS (SELECT suffix, domain, sum(bad) AS bad, sum(n) AS n FROM base GROUP BY ALL),
s0 AS (SELECT suffix, sum(bad) AS bad, sum(n) AS n, (SELECT (sum(bad) + 1.0::DOUBLE) / (sum(n) + 2) FROM base) AS up FROM d0 GROUP BY suffix),
s1 AS (SELECT 1 / {_OP1_SHARE} - 1 AS k FROM s0),
d1 AS (SELECT d0.*, (s0.bad + k * up) / (s0.n + k) AS up FROM d0 JOIN s0 USING (suffix), s1),
d2 AS (SELECT 1 / {_OP1_SHARE} - 1 AS k FROM d1),
h1 AS (SELECT host, base.bad, base.n, (d1.bad + k * up) / (d1.n + k) AS up FROM base JOIN d1 USING (domain), d2),
h2 AS (SELECT 1 / {_OP1_SHARE} - 1 AS k FROM h1),
post AS (SELECT host, bad + k * up AS a, n - bad + k * (1 - up) AS b FROM h1, h2),
j AS (
  SELECT page_id, host, path, a / (a + b) - 1.645 * sqrt(a * b / (pow(a + b, 2) * (a + b + 1))) AS low,
    CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
      WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
      WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
      WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM p LEFT JOIN post USING (host))
SELECT page_id, host, path, rule,
  CASE rule WHEN 'com/' THEN 'allow' WHEN 'www.example.com/en/' THEN 'allow' WHEN 'example.com/en/' THEN 'block'
    WHEN 'net/es/' THEN 'block' WHEN 'net/fr/' THEN 'block' ELSE CASE WHEN low > 0.5 THEN 'block' ELSE 'allow' END END AS verdict
FROM j
""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barforge.llm.url_filter import judge, page_outcomes
    pages = table(spark, sf_dir, "pages")
    judged = judge(pages, page_outcomes(pages, table(spark, sf_dir, "labels")), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op8_quality_ngram_ratio")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barforge.llm.quality import judge
    labels = table(spark, sf_dir, "labels")
    trusted = labels.where((F.col("quality") == 1) & (F.col("toxic") == 0))
    return judge(table(spark, sf_dir, "documents"), trusted).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def languages_of(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language decisions for ``docs`` (columns of documents): text, markup
    language and address of the document's page, and its source as the host of
    documents without a page."""
    from barforge.llm.language import fit_text_models, identify, page_evidence
    languages, models = fit_text_models(docs, "lang")
    return identify(docs, languages, models, host_col="source", evidence=page_evidence(table(spark, sf_dir, "pages")))


@query("op6_language_evidence")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = languages_of(spark, table(spark, sf_dir, "documents"), sf_dir)
    return found.select("doc_id", "lang", "kept", "text_lang", F.round("probability", 6).alias("probability"))


@query("op2_benchmark_decontamination")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barforge.llm.decontaminate import contaminated
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_pii_boosted_candidates")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barforge.llm.pii import BASE, document_spans, span_text
    found = document_spans(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *(f"n_{k}" for k in BASE), F.sha2(span_text("base"), 256).alias("base_sha256"),
                        span_text("spans").alias("spans"))


@query("op4_licence_paragraphs")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barforge.llm.licences import scan
    found = scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_paragraphs", "n_licence", F.array_join("families", ",").alias("families"),
                        F.round("probability", 6).alias("probability"))


@query("op12_phrase_collocations", oracle=r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
  FROM documents WHERE text IS NOT NULL),
p AS (SELECT lang, unnest(list_transform(pieces, lambda x: regexp_extract_all(x, '[^\x20\x09]+'))) AS w FROM d),
q AS (SELECT lang, w FROM p WHERE len(w) > 0),
s AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM q),
g AS (SELECT lang, w[i:i + k - 1] AS g, count(*) AS f FROM s, (VALUES (1), (2), (3), (4)) v(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE len(g) = 1 GROUP BY lang),
c AS (SELECT lang, g, f FROM g WHERE f >= 30 AND len(g) > 1),
cover AS (
  SELECT lang, g[b:e] AS g, max(f) AS longer
  FROM (SELECT lang, g, f, unnest(range(1, len(g))) AS b FROM c WHERE len(g) > 2), (VALUES (2), (3), (4)) v(e)
  WHERE e > b AND e <= len(g) AND e - b + 1 < len(g) GROUP BY ALL),
kept AS (
  SELECT c.lang, c.g, c.f FROM c LEFT JOIN cover ON cover.lang = c.lang AND cover.g = c.g
  WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * f),
cuts AS (
  SELECT kept.lang, kept.g, kept.f, k, l.f AS l, r.f AS r, (2000000::HUGEINT * kept.f // (l.f::HUGEINT + r.f))::BIGINT AS score
  FROM kept, (VALUES (1), (2), (3)) v(k), g l, g r
  WHERE k < len(kept.g) AND l.lang = kept.lang AND r.lang = kept.lang AND l.g = kept.g[:k] AND r.g = kept.g[k + 1:]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
ranked AS (
  SELECT lang, list_aggregate(g, 'string_agg', ' ') AS phrase, f AS a, l, r, score FROM best),
top AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM ranked)
SELECT lang, rank, phrase, a, l, r, n, score FROM top JOIN n USING (lang) WHERE rank <= 2000
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barforge.llm.collocations import collocations
    return collocations(table(spark, sf_dir, "documents"))


@query("op11_hard_negatives", oracle="""
WITH v AS (
  SELECT row_number() OVER () AS row, vec_id AS id,
    CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.row AS anchor, a.id AS anchor_id, b.row, b.id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM v a, v b WHERE a.id % 50 = 0 AND a.row <> b.row),
p AS (
  SELECT anchor, anchor_id, id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id, row) AS k
  FROM s WHERE same QUALIFY k <= 5)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor, k ORDER BY score DESC, id, row)::INTEGER AS rank, id AS negative_id,
  positive_score, score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barforge.llm.hard_negatives import mine
    rows, label = table(spark, sf_dir, "embeddings"), F.col("label").cast("bigint")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return mine(rows, F.col("vec_id") % 50 == 0)


@query("op13_secret_randomness_tests")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barforge.llm.secret_scan import BASE, document_spans, span_text
    found = document_spans(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *(f"n_{k}" for k in BASE), F.sha2(span_text("base"), 256).alias("base_sha256"),
                        span_text("spans").alias("spans"))
