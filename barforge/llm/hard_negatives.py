"""Hard negatives of every anchor vector by a vertical (column-wise) scan with
branch-and-bound on the dimensions.

Vectors are stored as blocks of columns: a row of the block table holds, for a
few thousand vectors, one packed column per dimension and each column's least
and greatest value. An anchor reads a block's columns in descending order of its
own components' size. After every few columns the partial scores plus the least
and greatest contribution that the unread columns can still make bound each
candidate's score, and candidates that no longer matter leave the bitmap:

* for positives, those whose upper bound is below the fifth best score so far;
* for negatives, those whose bounds miss every window of the anchor, or lie
  below the third best score that a window is sure to hold.

What remains after the last column has exact scores. Anchors are a stated query
set: they meet the block table in blocks of bounded size, each task keeps its
best rows per anchor over all its blocks, and a window per anchor merges the
tasks' best. Scores are integers; ties go to the smaller id.

Rows with a null id, label or vector, or a null, infinite or NaN component take
no part. Vectors of unequal length are compared over the shorter one's length
(missing components are zero). Every other row counts on its own, repeated rows
and ids too: another row under the anchor's id can be its positive. Anchors
without positives, and positives without a row in their window (negative
scores have an empty one), give no rows; an empty table gives an empty result.
Scores beyond 64 bits are compared exactly and returned as the nearest long.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barforge.llm.common import scratch_path, written

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: A negative's score lies between these percentages of the positive's score.
WINDOW = (50, 95)
#: Values in one block of columns, and in one block of anchors: they bound what
#: a task holds and what is broadcast (32 MB).
BLOCK_VALUES = 1 << 18
ANCHOR_VALUES = 1 << 22
#: Columns read between two looks at the bounds.
STEP = 16
#: Blocks that a Python worker is handed at once.
BLOCKS_AT_ONCE = 8
_LONG = (-(1 << 63), (1 << 63) - 1)

BLOCKS = "rows binary, ids binary, labels binary, anchors binary, columns array<binary>, width int, low array<long>, high array<long>"


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Bound the rows of an Arrow batch while a job runs; the session's own
    setting is restored."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


# ---------------------------------------------------------------------------
# The block table.
# ---------------------------------------------------------------------------
def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """Vectors as columns (dimensions x rows), short ones filled up with zeros."""
    offsets = vectors.offsets.to_numpy()
    values = vectors.values.to_numpy(zero_copy_only=False)
    size = np.diff(offsets)
    wide = int(size.max(initial=0))
    out = np.zeros((len(size), wide), np.int64)
    out[np.arange(wide) < size[:, None]] = values[offsets[0]:offsets[-1]]
    return out.T


def _pack(matrix: np.ndarray) -> tuple[list[bytes], int]:
    """Columns in the narrowest integers that hold them."""
    top = max(int(matrix.max(initial=0)), -int(matrix.min(initial=0)) - 1)
    width = 2 if top < 1 << 15 else 4 if top < 1 << 31 else 8
    return [c.astype(f"<i{width}").tobytes() for c in matrix], width


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        step = max(64, BLOCK_VALUES // max(1, len(batch["v"].values) // max(1, batch.num_rows)))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            matrix = _matrix(part["v"])
            columns, width = _pack(matrix)
            n = part.num_rows
            yield pa.RecordBatch.from_arrays([
                pa.array([np.arange(row, row + n).tobytes()]), pa.array([part["id"].to_numpy().tobytes()]),
                pa.array([part["label"].to_numpy().tobytes()]),
                pa.array([part["anchor"].to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()]),
                pa.array([columns], pa.list_(pa.binary())), pa.array([width], pa.int32()),
                pa.array([matrix.min(1).tolist()], pa.list_(pa.int64())), pa.array([matrix.max(1).tolist()], pa.list_(pa.int64()))],
                ["rows", "ids", "labels", "anchors", "columns", "width", "low", "high"])
            row += n


def column_blocks(df: DataFrame, anchor: Column, id_col: str = "vec_id", label_col: str = "label",
                  vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The block table of ``df``: rows that take part, components floor(scale * x)."""
    spark = df.sparkSession
    x = F.col(vector_col).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & ~bad).select(
        F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("bigint")).alias("v"))
    with arrow_rows(spark, BLOCK_VALUES // 64):
        return written(rows.sortWithinPartitions("label").mapInArrow(_to_blocks, BLOCKS), "negatives-blocks")


def _anchors_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            chosen = np.flatnonzero(np.frombuffer(row["anchors"], np.uint8))
            columns = np.array([np.frombuffer(c, f"<i{row['width']}")[chosen] for c in row["columns"]], np.int64).reshape(len(row["columns"]), -1)
            take = lambda c: pa.array(np.frombuffer(row[c], np.int64)[chosen])  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([take("rows"), take("ids"), take("labels"), pa.array(columns.T.tolist(), pa.list_(pa.int64()))],
                                             ["row", "id", "label", "v"])


# ---------------------------------------------------------------------------
# The scan.
# ---------------------------------------------------------------------------
@dataclass
class Block:
    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    columns: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def read(cls, row: dict) -> Block:
        long = lambda c: np.frombuffer(row[c], np.int64)
        columns = np.array([np.frombuffer(c, f"<i{row['width']}") for c in row["columns"]]).reshape(len(row["columns"]), -1)
        return cls(long("rows"), long("ids"), long("labels"), columns, np.array(row["low"], np.int64), np.array(row["high"], np.int64))

    def suited_to(self, anchors: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Columns and bounds in numbers in which every partial score with
        components up to ``anchors`` is exact: doubles, else Python integers."""
        top = max([1, *map(abs, map(int, self.low)), *map(abs, map(int, self.high))])
        kind = np.float64 if 2 * anchors * top * max(1, len(self.columns)) < 1 << 53 else object
        return self.columns.astype(kind), self.low.astype(kind), self.high.astype(kind)


def scan(anchor: np.ndarray, columns: np.ndarray, low: np.ndarray, high: np.ndarray, alive: np.ndarray,
         matter: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray, int]:
    """Exact scores of the candidates ``alive`` that matter: (their places, their
    scores, values read). ``matter`` gets the candidates' lower and upper bounds
    and tells which stay."""
    size = min(len(anchor), len(columns))
    order = np.argsort(-np.abs(anchor[:size]), kind="stable")
    weight = anchor[order]
    ends = np.stack([weight * low[order], weight * high[order]])
    # what the columns from the k-th on can still add, at least and at most
    least = np.append(np.cumsum(ends.min(0)[::-1])[::-1], 0)
    most = np.append(np.cumsum(ends.max(0)[::-1])[::-1], 0)
    score, read = np.zeros(len(alive), columns.dtype), 0
    for k in range(0, size + 1, STEP):
        if k:
            dims = order[k - STEP:k]
            score = score + weight[k - STEP:k] @ columns[dims[:, None], alive]
            read += len(dims) * len(alive)
        keep = matter(score + least[k], score + most[k])
        if not keep.all():
            alive, score = alive[keep], score[keep]
        if not len(alive):
            return alive, score, read
    if size % STEP:
        k = size - size % STEP
        score = score + weight[k:] @ columns[order[k:][:, None], alive]
        read += (size - k) * len(alive)
        keep = matter(score, score)
        alive, score = alive[keep], score[keep]
    return alive, score, read


def _best(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, top: int) -> list[tuple[int, int, int]]:
    """The first ``top`` (score, id, row), by descending score, then id."""
    order = np.lexsort((rows, ids, -score))[:top] if score.dtype != object else sorted(
        range(len(score)), key=lambda i: (-score[i], ids[i], rows[i]))[:top]
    return [(int(score[i]), int(ids[i]), int(rows[i])) for i in order]


def _merge(held: list[tuple[int, int, int]], more: list[tuple[int, int, int]], top: int) -> list[tuple[int, int, int]]:
    return sorted([*held, *more], key=lambda x: (-x[0], x[1], x[2]))[:top]


@dataclass
class Anchors:
    """A block of anchors; ``windows`` are (positive, least, greatest score)."""

    rows: np.ndarray
    labels: np.ndarray
    vectors: list[np.ndarray]
    windows: list[list[tuple[int, int, int]]] | None = None

    def top(self) -> int:
        return max([1, *(max(abs(int(v.min())), abs(int(v.max()))) for v in self.vectors if len(v))])


def _suited(anchors: Anchors, kind) -> list[np.ndarray]:
    return [v.astype(kind) for v in anchors.vectors]


def _nearest(batches, anchors: Anchors, top: int) -> Iterator[pa.RecordBatch]:
    """The task's best rows of each anchor's label, the anchor itself aside."""
    best: list[list[tuple[int, int, int]]] = [[] for _ in anchors.rows]
    for batch in batches:
        for row in batch.to_pylist():
            block = Block.read(row)
            columns, low, high = block.suited_to(anchors.top())
            vectors = _suited(anchors, columns.dtype)
            of_label = {int(x): np.flatnonzero(block.labels == x) for x in np.unique(block.labels)}
            for i, (own, label) in enumerate(zip(anchors.rows, anchors.labels.tolist())):
                alive = of_label.get(label)
                if alive is None:
                    continue
                alive = alive[block.rows[alive] != own]
                held = best[i][-1][0] if len(best[i]) == top else None

                def matter(least, most, held=held):
                    bar = held
                    if len(least) > top:
                        here = np.partition(least, -top)[-top]
                        bar = here if bar is None else max(bar, here)
                    return np.ones(len(least), bool) if bar is None else (most >= bar).astype(bool)

                alive, score, _ = scan(vectors[i], columns, low, high, alive, matter)
                if len(alive):
                    best[i] = _merge(best[i], _best(score, block.ids[alive], block.rows[alive], top), top)
    yield _rows_out(anchors, [(i, 0, *x) for i, found in enumerate(best) for x in found])


def _in_windows(batches, anchors: Anchors, top: int) -> Iterator[pa.RecordBatch]:
    """The task's best rows of other labels in each window of each anchor."""
    best: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            block = Block.read(row)
            columns, low, high = block.suited_to(anchors.top())
            vectors = _suited(anchors, columns.dtype)
            others = {int(x): np.flatnonzero(block.labels != x) for x in np.unique(block.labels)}
            everything = np.arange(len(block.labels))
            for i, (label, windows) in enumerate(zip(anchors.labels.tolist(), anchors.windows)):
                if not windows:
                    continue

                def matter(least, most, i=i, windows=windows):
                    keep = np.zeros(len(least), bool)
                    for p, a, b in windows:
                        held = best.get((i, p), ())
                        bar = max(a, held[-1][0]) if len(held) == top else a
                        sure = least[((least >= a) & (most <= b)).astype(bool)]
                        if len(sure) > top:
                            bar = max(bar, np.partition(sure, -top)[-top])
                        keep |= ((most >= bar) & (least <= b)).astype(bool)
                    return keep

                alive, score, _ = scan(vectors[i], columns, low, high, others.get(label, everything), matter)
                for p, a, b in windows if len(alive) else ():
                    fits = ((score >= a) & (score <= b)).astype(bool)
                    if fits.any():
                        found = _best(score[fits], block.ids[alive[fits]], block.rows[alive[fits]], top)
                        best[i, p] = _merge(best.get((i, p), []), found, top)
    yield _rows_out(anchors, [(i, p, *x) for (i, p), found in best.items() for x in found])


FOUND = "anchor long, place int, score long, id long, row long"


def _rows_out(anchors: Anchors, found: list[tuple]) -> pa.RecordBatch:
    i, place, score, ids, rows = zip(*found) if found else ((),) * 5
    clipped = [min(max(s, _LONG[0]), _LONG[1]) for s in score]
    return pa.RecordBatch.from_arrays([pa.array(anchors.rows[list(i)], pa.int64()), pa.array(place, pa.int32()), pa.array(clipped, pa.int64()),
                                       pa.array(ids, pa.int64()), pa.array(rows, pa.int64())], ["anchor", "place", "score", "id", "row"])


def _pass(blocks: DataFrame, anchors: Anchors, fn, top: int, name: str) -> DataFrame:
    """The first ``top`` rows of each (anchor, place) over all tasks, ranked."""
    shared = blocks.sparkSession.sparkContext.broadcast(anchors)
    found = blocks.mapInArrow(lambda batches: fn(batches, shared.value, top), FOUND)
    order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "id", "row")
    with arrow_rows(blocks.sparkSession, BLOCKS_AT_ONCE):
        out = written(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top), name)
    shared.unpersist()
    return out


def mine(df: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW,
         id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """For each row of ``df`` for which ``anchor`` holds and each of its first
    ``positives`` rows of the same label, the first ``negatives`` rows of other
    labels whose score is within ``window`` percent of the positive's: anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score."""
    spark = df.sparkSession
    blocks = column_blocks(df, anchor, id_col, label_col, vector_col, scale)
    n_blocks = blocks.count()
    blocks = blocks.repartition(max(1, min(n_blocks, 2 * spark.sparkContext.defaultParallelism)))
    anchors = blocks.mapInArrow(_anchors_of, "row long, id long, label long, v array<long>")
    with arrow_rows(spark, BLOCKS_AT_ONCE):
        anchors = written(anchors, "negatives-anchors")
    n, wide = anchors.agg(F.count("*"), F.max(F.size("v"))).first()
    bins = max(1, -(-2 * n * max(1, wide or 1) // ANCHOR_VALUES))
    path = scratch_path(spark, "negatives-anchor-blocks")
    # row keys are unique, so a hash fills the bins evenly, whatever the data
    anchors.withColumn("bin", F.pmod(F.xxhash64("row"), F.lit(bins))).repartition("bin").write.partitionBy("bin").parquet(path)
    out = None
    for part in range(bins if n else 0):
        held = spark.read.schema(anchors.schema.add("bin", "long")).parquet(path).where(F.col("bin") == part).drop("bin").toArrow()
        if not held.num_rows:
            continue
        vectors = held["v"].combine_chunks()
        offsets, values = vectors.offsets.to_numpy(), vectors.values.to_numpy(zero_copy_only=False)
        group = Anchors(held["row"].to_numpy(), held["label"].to_numpy(), [values[a:b] for a, b in zip(offsets[:-1], offsets[1:])])
        near = _pass(blocks, group, _nearest, positives, "negatives-near")
        place = {row: i for i, row in enumerate(group.rows.tolist())}
        group.windows = [[] for _ in place]
        for r in near.select("anchor", "rank", "score").toLocalIterator():
            least, most = -(-window[0] * r["score"] // 100), window[1] * r["score"] // 100
            if least <= most:
                group.windows[place[r["anchor"]]].append((r["rank"], least, most))
        hard = _pass(blocks, group, _in_windows, negatives, "negatives-hard")
        ids = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
        pairs = hard.select("anchor", F.col("place").alias("rank_of"), F.col("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        pairs = pairs.join(near.select("anchor", F.col("rank").alias("rank_of"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")),
                           ["anchor", "rank_of"]).join(ids, "anchor")
        pairs = pairs.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
        out = pairs if out is None else out.unionByName(pairs)
    if out is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return out
