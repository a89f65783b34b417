"""SimHash near-duplicates by multi-index hashing over fingerprint segments.

A fingerprint of 64 bits is cut into two segments of 32. Two fingerprints at
most ``max_bits`` apart are found through tables keyed by a segment's value:
each fingerprint is filed under every value in a small Hamming ball around its
own segment, next to its other segment(s). Filing both sides under balls of
half the radius makes the tables symmetric: if x and y differ in 2 bits, one of
the two bits can be flipped in x's segment and the other in y's, whichever
segments they lie in, so the two meet under a common key; with 1 or 0 bits x's
own value does. All fingerprints of a key lie within half the radius of it, so
a key holds at most 65 distinct fingerprints at radius 1 - no table bucket can
grow with a group of copies, and nothing needs a cap. Complete distances are
verified before a link counts. Components come from large-star / small-star
rounds whose edges are written to the shared folder each time.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barforge.llm.common import texts_only, written

SEED = 42
_BLOCK = 1 << 14


def text_fingerprint(text: bytes | None, shingle: int) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text: majority over the XXH64 hashes
    of its word shingles (repeats count); no word: 0."""
    import xxhash
    words = (text or b"").lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        grams, n = iter([b" ".join(words)]), 1
    else:
        grams, n = map(b" ".join, zip(*(words[i:] for i in range(shingle)))), len(words) - shingle + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, itertools.repeat(SEED)), np.uint64, n)
    bits = hashes.astype(">u8").view(np.uint8).reshape(n, 8)
    count = np.zeros(64, np.int64)
    for i in range(0, n, _BLOCK):
        count += np.unpackbits(bits[i:i + _BLOCK], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): one row per input row, fp the fingerprint as a signed
    BIGINT with the same bits. Null text counts as empty; nulls in the id stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([text_fingerprint(t.as_py(), shingle) for t in b.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps.view(np.int64))], ["doc_id", "fp"])
    return texts_only(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, fp bigint")


def ball_masks(radius: int, segments: int = 2, bits: int = 64) -> list[int]:
    """XOR masks of the Hamming ball, enumerated segment by segment: every way
    to spend ``radius`` flips over the segments' own small balls. Signed."""
    width = bits // segments
    out = []
    for spent in itertools.product(range(radius + 1), repeat=segments):
        if sum(spent) > radius:
            continue
        parts = [[sum(1 << (s * width + i) for i in flips) for flips in itertools.combinations(range(width), k)]
                 for s, k in enumerate(spent)]
        out += [sum(p) for p in itertools.product(*parts)]
    return sorted(m - (1 << bits) if m >> (bits - 1) else m for m in out)


def links(fps: DataFrame, max_bits: int = 2, segments: int = 2) -> DataFrame:
    """Verified links (src > dst as signed values) between distinct
    fingerprints ``fps(fp)``: under each table key every member links to one
    hub of the key, so a key of n members yields n - 1 links, never n^2.
    Connectivity equals that of all pairs within ``max_bits``."""
    table, probe = max_bits // 2, max_bits - max_bits // 2
    masks = ball_masks(probe, segments)
    near = set(ball_masks(table, segments))
    entries = fps.select("fp", F.explode(F.array(*(
        F.struct(F.lit(m).cast("bigint").alias("mask"), F.lit(m not in near).alias("probe")) for m in masks))).alias("m"))
    entries = entries.select("fp", F.col("fp").bitwiseXOR(F.col("m.mask")).alias("key"), F.col("m.probe").alias("probe"))
    # a table entry comes first under its key and becomes the hub
    by_key = Window.partitionBy("key").orderBy("probe", "fp")
    met = entries.select("fp", F.first("fp").over(by_key).alias("hub"), F.first("probe").over(by_key).alias("no_hub"))
    met = met.where((F.col("fp") != F.col("hub")) & ~F.col("no_hub")
                    & (F.bit_count(F.col("fp").bitwiseXOR(F.col("hub"))) <= max_bits))
    return met.select(F.greatest("fp", "hub").alias("src"), F.least("fp", "hub").alias("dst")).distinct()


def _fingerprint_of(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"),
                    F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``edges(src, dst)``, root the component's
    smallest node. Large-star / small-star rounds until the edge set is
    stable; each round's edges are a written table and only their count and
    checksum reach the driver."""
    edges = written(edges, "cc-edges")
    seen = _fingerprint_of(edges)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        both = edges.union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
        large = both.join(low, "src").where(F.col("dst") > F.col("src")).select(
            F.col("dst").alias("src"), F.col("m").alias("dst")).distinct()
        low = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = large.join(low, "src")
        small = (small.where(F.col("dst") != F.col("m")).select(F.col("dst").alias("src"), F.col("m").alias("dst"))
                 .union(low.select("src", F.col("m").alias("dst"))).distinct())
        edges = written(small, "cc-edges")
        now = _fingerprint_of(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("src").alias("node"), F.col("dst").alias("root")).union(
        edges.select(F.col("dst").alias("node"), F.col("dst").alias("root"))).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, segments: int = 2,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id): one row per input row; documents link when
    their fingerprints differ in at most ``max_bits`` bits, and component_id is
    the smallest doc_id reachable over links (itself included). Rows with equal
    fingerprints form one node, so copies are never expanded into pairs. Null
    or empty text has fingerprint 0 and links like any other; a null doc_id
    keeps its row and never becomes a component_id (null when the component
    has no other); repeated rows repeat in the result; an empty table gives an
    empty result; other columns are ignored."""
    fps = written(fingerprints(docs, shingle, id_col, text_col), "simhash-fp")
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("doc"))
    roots = components(links(nodes.select("fp"), max_bits, segments))
    member = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "doc", F.coalesce("root", "fp").alias("root"))
    member = written(member, "simhash-member")
    lowest = member.groupBy("root").agg(F.min("doc").alias("component_id"))
    named = member.join(lowest, "root").select("fp", "component_id")
    return fps.join(named, "fp", "left").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp="fp"):
    """The BIGINT's 64 bits as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
