"""Quality rules: hashed n-gram log-likelihood ratio between a trusted target and
the raw corpus, plus the base measures of every text.

Words and word pairs are hashed into a fixed number of buckets. One pass counts
the buckets over all documents and, at the same time, over the trusted ones;
the target is fitted on a bounded sample of these, whose ids every task holds,
so no text is shuffled. Each task sends one row per bucket it met: what is
shuffled for the counts and what reaches the driver is bounded by the number
of buckets. A second pass
scores every document: the sum of log(p_target / p_raw) over its n-grams,
divided by their number plus a pseudo-length, against a fixed threshold.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import mix, slices, texts_only, window_hashes, word_hashes, written

BUCKETS = 1 << 18
#: Trusted documents the target is fitted on, at most (those with the smallest hash of the id).
TRUSTED_SAMPLE = 30_000
#: Target n-grams added to every bucket, and raw ones in proportion.
PRIOR_COUNT = 4.0
#: n-grams of neutral evidence added to every document; short texts are not judged on a few words.
PSEUDO_LENGTH = 16
THRESHOLD = -0.25
SYMBOLS = b"#*$%&|<>"
GAPS = b" \t\n\v\f\r"
REPEAT_WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20


def ngram_buckets(words: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of a text's words and word pairs."""
    grams = np.concatenate([mix(words ^ np.uint64(1)), window_hashes(words, 2, seed=2)])
    return (grams % np.uint64(buckets)).astype(np.int64)


def bucket_counts(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, id_col: str = "doc_id",
                  text_col: str = "text", trusted_sample: int = TRUSTED_SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """(raw, target) n-gram counts per bucket over all documents and over those
    whose id is among the ``trusted_sample`` chosen from ``trusted(doc_id)``."""
    ids = trusted.select(F.col("doc_id").cast("bigint").alias("doc_id")).where("doc_id is not null").distinct()
    ids = written(ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(trusted_sample), "quality-trusted")
    # at most trusted_sample ids: small by construction
    marked = texts_only(docs, id_col, text_col).join(F.broadcast(ids.withColumn("trusted", F.lit(True))), "doc_id", "left")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for b in batches:
            texts, good = b.column("text").to_pylist(), b.column("trusted").to_pylist()
            for a, z in slices(texts):
                words, _, _, before = word_hashes([t or b"" for t in texts[a:z]], fold=True)
                for i in range(z - a):
                    own = ngram_buckets(words[before[i]:before[i + 1]], buckets)
                    np.add.at(raw, own, 1)
                    if good[a + i]:
                        np.add.at(target, own, 1)
        met = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(raw[met]), pa.array(target[met])], ["bucket", "raw", "target"])

    rows = marked.select("text", "trusted").mapInArrow(count, "bucket bigint, raw bigint, target bigint")
    raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    total = rows.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    at = total.column("bucket").to_numpy()
    raw[at], target[at] = total.column("raw").to_numpy(), total.column("target").to_numpy()
    return raw, target


def log_ratio(raw: np.ndarray, target: np.ndarray, prior_count: float = PRIOR_COUNT) -> np.ndarray:
    """log(p_target / p_raw) per bucket, both multinomials smoothed by pseudo
    counts in proportion to their sizes: a bucket seen often pulls hard, one
    hardly seen stays near 0 whichever corpus it came from, so that texts are
    not judged for being new. Without trusted text every ratio is 0."""
    if not target.sum():
        return np.zeros(len(raw))
    share = target.sum() / raw.sum()
    return np.log((target + prior_count) / (share * raw + prior_count))


def repeated_words(words: list[bytes], hashes: np.ndarray, window: int = REPEAT_WINDOW) -> int:
    """Words covered by a window of ``window`` words that occurs twice or more
    in the text. Window hashes only nominate; equality is decided on the words."""
    grams = window_hashes(hashes, window)
    if not len(grams):
        return 0
    _, where, count = np.unique(grams, return_inverse=True, return_counts=True)
    maybe = np.flatnonzero(count[where] > 1)
    if not len(maybe):
        return 0
    exact = [tuple(words[i:i + window]) for i in maybe.tolist()]
    times = Counter(exact)
    edge = np.zeros(len(words) + 1, np.int64)
    for i, key in zip(maybe.tolist(), exact):
        if times[key] > 1:
            edge[i] += 1
            edge[i + window] -= 1
    return int((np.cumsum(edge[:-1]) > 0).sum())


def base_measures(text: bytes, hashes: np.ndarray) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a UTF-8
    text; word_chars counts code points."""
    words = text.split()
    in_words = text.translate(None, GAPS)
    lines = [line for line in text.split(b"\n") if line.strip(GAPS)]
    return (len(words), len(in_words.decode("utf-8", "replace")),
            len(text) - len(text.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words, hashes))


def judge(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, threshold: float = THRESHOLD,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, score, kept) per row of ``docs``. base_failed: under 10 words,
    or over 20 % of them in repeated 5-word windows. kept: not base_failed and
    score at least ``threshold``. Null text has no words and fails; null ids
    and repeated rows stay; an empty table gives an empty result; without
    trusted documents every score is 0; other columns are ignored."""
    ratio = log_ratio(*bucket_counts(docs, trusted, buckets, id_col, text_col))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [t or b"" for t in b.column("text").to_pylist()]
            rows = []
            for a, z in slices(texts):
                words, _, _, before = word_hashes(texts[a:z], fold=False)
                folded = word_hashes(texts[a:z], fold=True)[0]
                for i in range(z - a):
                    own = slice(before[i], before[i + 1])
                    grams = ngram_buckets(folded[own], buckets)
                    rows.append((*base_measures(texts[a + i], words[own]),
                                 float(ratio[grams].sum()) / (len(grams) + PSEUDO_LENGTH)))
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = [pa.int64()] * 5 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"])

    out = texts_only(docs, id_col, text_col).mapInArrow(
        score, "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
               "n_repeat_words bigint, score double")
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED_PERCENT)
    out = out.withColumn("base_failed", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
