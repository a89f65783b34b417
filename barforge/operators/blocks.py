"""Correlations of any number of series by blocked products.

Aligned values become matrices: the series are dealt into blocks by hash, the
timestamps into chunks, and a matrix row holds one (block, chunk). Blocks meet
pairwise within a chunk (an equi-join on the chunk), each pair of matrices gives
one small product, and the products of a pair are summed over the chunks. Data
is replicated once per other block, never once per other series, and a task
holds two matrices, however many series or timestamps there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.session import stored_table

#: Series in a block and timestamps in a chunk: a matrix of 2 MB.
BLOCK, CHUNK = 256, 1024


def standardised(df: DataFrame, value: str, series_col: str, on: str) -> DataFrame:
    """(series, at, z): values less their series' mean, scaled so that the
    product of two series sums to their correlation; null for constant series."""
    w = Window.partitionBy(series_col)
    centred = df.select(F.col(series_col).alias("series"), F.col(on).alias("at"),
                        (F.col(value) - F.avg(value).over(w)).alias("c"))
    size = F.sqrt(F.sum(F.col("c") * F.col("c")).over(Window.partitionBy("series")))
    return centred.select("series", "at", F.try_divide("c", size).alias("z"))


def _matrix(rows):
    """One (block, chunk): its series in order, a matrix of timestamps x series."""
    import pandas as pd
    wide = rows.pivot(index="at", columns="series", values="z").sort_index()
    if wide.size != len(rows):
        raise ValueError("series are not aligned: some have no value at some timestamps")
    return pd.DataFrame({"block": [rows["block"].iloc[0]], "chunk": [rows["chunk"].iloc[0]],
                         "series": [list(wide.columns)], "z": [wide.to_numpy(np.float64).tobytes()]})


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The products of two matrices, one row per pair of series."""
    for batch in batches:
        for i in range(batch.num_rows):
            names, others = batch["series"][i].values, batch["series2"][i].values
            left = np.frombuffer(batch["z"][i].as_py()).reshape(-1, len(names))
            right = np.frombuffer(batch["z2"][i].as_py()).reshape(-1, len(others))
            if len(left) != len(right):
                raise ValueError("series are not aligned: blocks differ in their timestamps")
            at, to = np.divmod(np.arange(len(names) * len(others)), len(others))
            keep = np.flatnonzero(at <= to) if batch["block"][i] == batch["block2"][i] else np.arange(len(at))
            sums = (left.T @ right).ravel()[keep]
            yield pa.RecordBatch.from_arrays([names.take(pa.array(at[keep])), others.take(pa.array(to[keep])), pa.array(sums)], ["x", "y", "part"])


def correlations(df: DataFrame, value: str = "ret", series_col: str = "ticker", on: str = "ts",
                 pairs: DataFrame | None = None, top: int | None = None,
                 block: int = BLOCK, chunk: int = CHUNK) -> DataFrame:
    """Pearson correlations of aligned series (every series has a value at
    every ``on``; see ``align_long``): a, b, corr.

    With ``pairs`` (a, b) the requested pairs alone, and only the blocks that
    hold them are multiplied; with ``top`` each series ``a`` with its ``top``
    most correlated others (ties by name) and their ``rank``; else all pairs
    a <= b. The correlation with a constant series is null."""
    if pairs is not None and top is not None:
        raise ValueError("pairs or top, not both")
    z = stored_table(standardised(df.where(F.col(value).isNotNull()), value, series_col, on), "standardised")
    n_series, n_at = z.agg(F.count_distinct("series"), F.count_distinct("at")).first()
    blocks, chunks = max(1, -(-n_series // block)), max(1, -(-n_at // chunk))
    block_of = lambda c: F.pmod(F.xxhash64(c), F.lit(blocks))
    dealt = z.withColumns({"block": block_of(F.col("series")), "chunk": F.pmod(F.xxhash64("at"), F.lit(chunks))})
    matrices = stored_table(dealt.groupBy("block", "chunk").applyInPandas(
        _matrix, f"block long, chunk long, series array<{z.schema['series'].dataType.simpleString()}>, z binary"), "series-blocks")
    others = matrices.select("chunk", F.col("block").alias("block2"), F.col("series").alias("series2"), F.col("z").alias("z2"))
    met = matrices.join(others, "chunk").where("block <= block2")
    if pairs is not None:
        asked = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        ends = [block_of(F.col(c)) for c in ("a", "b")]
        need = asked.select(F.least(*ends).alias("block"), F.greatest(*ends).alias("block2")).distinct()
        met = met.join(need, ["block", "block2"], "left_semi")
    name = z.schema["series"].dataType.simpleString()
    found = met.mapInArrow(_products, f"x {name}, y {name}, part double").groupBy("x", "y").agg(F.sum("part").alias("corr"))
    found = found.withColumn("corr", F.when(~F.isnan("corr"), F.col("corr")))
    if top is None:
        found = found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "corr")
        return found if pairs is None else found.join(asked, ["a", "b"], "left_semi")
    both = found.where("x != y and corr is not null").select(F.explode(F.array(
        F.struct(F.col("x").alias("a"), F.col("y").alias("b"), "corr"), F.struct(F.col("y").alias("a"), F.col("x").alias("b"), "corr"))).alias("p")).select("p.*")
    order = Window.partitionBy("a").orderBy(F.desc("corr"), "b")
    return both.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
