"""Helpers shared by the training-data operators: scratch tables in the shared
checkpoint folder, and vectorised word hashing for Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barforge.session import checkpoint_dir

#: ASCII white space that separates words in every operator's contract.
WORD_SQL = r"[^\x20\x09-\x0D]+"
GAP_SQL = r"[\x20\x09-\x0D]+"

#: Texts handed to one numpy pass, in bytes; bounds a task's working memory.
SLICE_BYTES = 1 << 21


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, so
    a lost executor costs one task of the reader, not the whole computation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def column_or_null(df: DataFrame, name: str, kind: str):
    """The column cast to ``kind``, or a typed null when the table lacks it."""
    return (F.col(name) if name in df.columns else F.lit(None)).cast(kind)


#: Rows of text that a Python worker is handed at once, at most.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of texts: Spark's 10,000 rows can be hundreds of
    megabytes in each worker. A smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def texts_only(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) alone, the text as UTF-8 bytes: other columns, whatever
    their names, never reach the operator."""
    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.col(text_col).cast("string").cast("binary").alias("text"))


def with_fields(schema: T.StructType, *fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(n, t, True) for n, t in fields)])


def slices(texts: Iterable[bytes | None], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(first, end) row ranges of about ``limit`` bytes of text, one row at least."""
    first, size, i = 0, 0, -1
    for i, text in enumerate(texts):
        n = len(text or b"")
        if size and size + n > limit:
            yield first, i
            first, size = i, 0
        size += n + 1
    if i >= first:
        yield first, i + 1


# ---------------------------------------------------------------------------
# Word hashes of a slice, without a Python object per word.
# ---------------------------------------------------------------------------
_U = np.uint64
_MIX1, _MIX2, _STEP = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB), _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix); wraps modulo 2^64."""
    x = (x ^ (x >> _U(30))) * _MIX1
    x = (x ^ (x >> _U(27))) * _MIX2
    return x ^ (x >> _U(31))


#: Masks that keep the first n bytes of a little-endian 8-byte load.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_IS_GAP = np.zeros(256, bool)
_IS_GAP[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20


def word_hashes(texts: list[bytes], fold: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hashes of all words of ``texts``: (hash, first byte, end byte of
    each word in the joined buffer, words before each text). ``fold``
    lower-cases A-Z first. A word's hash depends on its bytes alone."""
    buffer = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    gap = _IS_GAP[buffer]
    edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1 if len(buffer) else np.zeros(0, np.int64)
    if len(buffer) and not gap[0]:
        edge = np.concatenate([[0], edge])
    first, end = edge[::2], edge[1::2]
    ends = np.cumsum([len(t) + 1 for t in texts]) if texts else np.zeros(0, np.int64)
    before = np.concatenate([[0], np.searchsorted(first, ends)]).astype(np.int64)
    if not len(first):
        return np.zeros(0, np.uint64), first, end, before
    length = end - first
    if fold:
        buffer = _FOLD[buffer]
    padded = np.concatenate([buffer, np.zeros(8, np.uint8)])
    # the eight bytes that start at every byte of the buffer, without a copy
    eight = np.ndarray((len(buffer) + 1,), "<u8", padded.data, strides=(1,))
    out = length.astype(np.uint64) * _STEP
    live, at, n = slice(None), first, length
    while True:
        h = (out[live] ^ (eight[at] & _FIRST[np.minimum(n, 8)])) * _MIX1
        out[live] = h ^ (h >> _U(32))
        more = n > 8
        if not more.any():
            return mix(out), first, end, before
        live = np.flatnonzero(more) if isinstance(live, slice) else live[more]
        at, n = at[more] + 8, n[more] - 8


def window_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words (polynomial in the word
    hashes, then finalised). Empty when there are fewer words."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, seed, np.uint64)
    step = _U(0xD6E8FEB86659FD93)
    for i in range(size):
        out = (out + words[i:i + n]) * step
        out ^= out >> _U(29)
    return mix(out)
