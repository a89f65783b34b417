"""Benchmark decontamination by SimHash over item-sized windows.

A window has as many words as a benchmark item. Its SimHash (majority bits of
its word-shingle hashes) is looked up among the items' fingerprints of that
size through multi-index Hamming tables: the 64 bits are cut into blocks, and
by the pigeonhole principle a fingerprint within ``radius`` bits lies within
radius // blocks bits of the item's in the first block or within one bit less
in another, so the tables return every item within the radius. Each candidate
is then verified by its whole Hamming distance and by the exact weighted
shingle similarity (shingles with their multiplicities).

Only windows that hold at least one shingle of an item of their size can reach
a positive similarity; these are the windows that are fingerprinted. Benchmark
items are taken in blocks of bounded size, one scan of the documents per block;
each block's tables go to the tasks. Nothing of the documents is shuffled.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import slices, texts_only, window_hashes, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 24
BLOCKS = 8
#: A block of benchmark items holds at most so many items, and texts of so many characters.
BLOCK_ITEMS = 4096
BLOCK_CHARS = 8_000_000
MATCHES = ("doc_id bigint, item_id bigint, first_word bigint, n_words int, hamming int, similarity double")

#: A-Z folded; ASCII punctuation and control characters separate words.
_PLAIN = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def plain_words(text: bytes) -> bytes:
    """The text with words as runs of letters and digits, lower case."""
    return text.translate(_PLAIN)


def _simhash(shingles: np.ndarray, size: int) -> np.ndarray:
    """SimHash of every run of ``size`` consecutive shingle hashes."""
    bits = np.unpackbits(shingles.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    total = np.zeros((len(shingles) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=total[1:])
    major = 2 * (total[size:] - total[:-size]) > size
    return np.packbits(major, axis=1).view(">u8").reshape(-1).astype(np.uint64)


class SizeClass:
    """The items of one size in words: shingle counts and Hamming block tables."""

    def __init__(self, n_words: int, items: list[tuple], radius: int, blocks: int, shingle: int):
        self.n_words, self.k = n_words, min(shingle, n_words)
        self.size = n_words - self.k + 1
        self.ids = [i for i, _ in items]
        hashes = [window_hashes(words, self.k, seed=self.k) for _, words in items]
        self.fingerprint = np.array([_simhash(h, self.size)[0] for h in hashes], np.uint64)
        self.counts = [Counter(h.tolist()) for h in hashes]
        self.shingles = np.unique(np.concatenate(hashes))
        width = 64 // blocks
        values = np.arange(1 << width, dtype=np.uint64)
        self.shifts = np.arange(blocks, dtype=np.uint64) * np.uint64(width)
        self.low = np.uint64((1 << width) - 1)
        # table[b, v, i]: may item i be within the radius of a window whose block b is v
        self.table = np.empty((blocks, 1 << width, len(items)), bool)
        for b in range(blocks):
            within = radius // blocks - (b > radius % blocks)
            part = (self.fingerprint >> self.shifts[b]) & self.low
            self.table[b] = np.bitwise_count(values[:, None] ^ part[None, :]).astype(int) <= within

    def near(self, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of all pairs within ``radius`` bits."""
        met = np.zeros((len(fps), len(self.ids)), bool)
        for b, shift in enumerate(self.shifts):
            met |= self.table[b][((fps >> shift) & self.low).astype(np.int64)]
        window, item = np.nonzero(met)
        far = np.bitwise_count(fps[window] ^ self.fingerprint[item]).astype(np.int64)
        return window[far <= radius], item[far <= radius], far[far <= radius]

    def similarity(self, shingles: np.ndarray, item: int) -> float:
        """Weighted overlap of a window's shingles with the item's: the sum of
        the smaller counts over the larger total."""
        own = self.counts[item]
        shared = sum(min(c, own[s]) for s, c in Counter(shingles.tolist()).items() if s in own)
        return shared / max(len(shingles), self.size)


class Benchmark:
    """A block of items, by size."""

    def __init__(self, items: list[tuple[int | None, str]], shingle: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS):
        self.radius, by_size = radius, {}
        for item, text in items:
            words = word_hashes([plain_words(text.lower().encode())])[0]
            if len(words):
                by_size.setdefault(len(words), []).append((item, words))
        self.classes = [SizeClass(n, own, radius, blocks, shingle) for n, own in sorted(by_size.items())]
        # all shingles of one length in one sorted list, each with the size classes that hold it
        self.lookup = {}
        for k in {c.k for c in self.classes}:
            pairs = sorted((s, i) for i, c in enumerate(self.classes) if c.k == k for s in c.shingles.tolist())
            key, owner = np.array([p[0] for p in pairs], np.uint64), np.array([p[1] for p in pairs], np.int64)
            maybe = np.zeros(1 << 20, bool)
            maybe[key >> np.uint64(44)] = True
            self.lookup[k] = key, owner, maybe

    def anchors(self, words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(k, shingle hashes, places of shingles some item holds) per length k."""
        for k, (key, _, maybe) in self.lookup.items():
            hashes = window_hashes(words, k, seed=k)
            at = np.flatnonzero(maybe[hashes >> np.uint64(44)])
            if len(at):
                row = np.minimum(np.searchsorted(key, hashes[at]), len(key) - 1)
                at = at[key[row] == hashes[at]]
            yield k, hashes, at

    def matches(self, k: int, shingles: np.ndarray, places: np.ndarray, threshold: float) -> Iterator[tuple]:
        """(item, first word, n_words, distance, similarity): the best window of
        each item found in one document (highest similarity, then the first)."""
        key, owner, _ = self.lookup[k]
        lo, hi = (np.searchsorted(key, shingles[places], side) for side in ("left", "right"))
        held: dict[int, list[int]] = {}
        for place, a, z in zip(places.tolist(), lo.tolist(), hi.tolist()):
            for i in owner[a:z].tolist():
                held.setdefault(i, []).append(place)
        for i, at in held.items():
            c = self.classes[i]
            size = min(c.size, len(shingles))
            best: dict[int, tuple] = {}
            for first, end in _runs(at, size, len(shingles) - size):
                fps = _simhash(shingles[first:end + size], size)
                for w, item, far in zip(*c.near(fps, self.radius)):
                    start = first + int(w)
                    same = c.similarity(shingles[start:start + size], int(item))
                    if same >= threshold and (int(item) not in best or same > best[int(item)][-1]):
                        best[int(item)] = (start, size + k - 1, int(far), same)
            for item, found in best.items():
                yield c.ids[item], *found


def _runs(places: list[int], size: int, last: int) -> list[tuple[int, int]]:
    """Merged [first, end) ranges of window starts that cover a place."""
    out: list[list[int]] = []
    for p in places:
        a, z = max(0, min(p - size + 1, last)), min(p, last) + 1
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], z)
        else:
            out.append([a, z])
    return [tuple(r) for r in out]


def _scan(docs: DataFrame, bench: Benchmark, threshold: float) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column("doc_id").to_pylist(), [plain_words(t or b"") for t in b.column("text").to_pylist()]
            rows = []
            for a, z in slices(texts):
                words, _, _, before = word_hashes(texts[a:z])
                for k, shingles, places in bench.anchors(words):
                    doc = np.searchsorted(before, places, "right") - 1
                    inside = places + k <= before[doc + 1]
                    places, doc = places[inside], doc[inside]
                    for d, own in itertools.groupby(zip(doc.tolist(), places.tolist()), key=lambda x: x[0]):
                        first, end = int(before[d]), int(before[d + 1]) - k + 1
                        at = np.array([p for _, p in own]) - first
                        rows += [(ids[a + d], *m) for m in bench.matches(k, shingles[first:end], at, threshold)]
            columns = list(zip(*rows)) if rows else [()] * 6
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                             [c.split()[0] for c in MATCHES.split(", ")])
    return docs.mapInArrow(run, MATCHES)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = SIMILARITY, radius: int = RADIUS,
                 blocks: int = BLOCKS, shingle: int = SHINGLE, block_items: int = BLOCK_ITEMS,
                 block_chars: int = BLOCK_CHARS, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id,
    first_word and n_words of the best window (the first of equally good ones),
    hamming, similarity. Documents without a match have no row. Words are
    lower-case runs of letters and digits. Null texts have no words and match
    nothing, items without a word likewise; an item under ``shingle`` words is
    compared as one shingle; a document shorter than an item is one window;
    null ids stay; repeated documents repeat, repeated items count once; empty
    tables give an empty result; other columns are ignored."""
    items = benchmark.select(F.col(item_col).cast("bigint").alias("item"), F.col(item_text_col).cast("string").alias("body"))
    items = items.where(F.trim("body") != "").distinct()
    size = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("body")).alias("c")).first()
    parts = max(1, math.ceil(size["n"] / block_items), math.ceil((size["c"] or 0) / block_chars))
    texts = texts_only(docs.withColumn(text_col, F.lower(F.col(text_col).cast("string"))), id_col, text_col)
    found = None
    for part in range(parts):
        own = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(parts)) == part).collect()
        one = _scan(texts, Benchmark([(r["item"], r["body"]) for r in own], shingle, radius, blocks), threshold)
        found = one if found is None else found.union(one)
    return found
