"""Best-fit packing of tokenised documents into fixed-length sequences by bin
completion branch-and-bound.

Sequences hold at most ``capacity`` tokens, so the whole corpus is described
for packing purposes by a histogram of piece lengths with at most ``capacity``
entries, however many documents there are. The plan is made on that histogram:
each step takes the longest remaining length, enumerates undominated fillings
around it and applies the chosen filling to as many copies as the counts
allow; the last few sequences are solved by branch-and-bound proper, with a
best-fit-decreasing solution as the incumbent and waste bounds for pruning.
The pieces themselves stay distributed: a piece's rank among the pieces of its
length (partition offsets plus its place inside the partition) selects its
sequence and offset from the plan.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barforge.llm.common import texts_only, written

CAPACITY = 4096
END_ID = 1

PIECE_SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("part", T.IntegerType()),
    T.StructField("nth", T.LongType()), T.StructField("ids", T.BinaryType())])

# ---------------------------------------------------------------------------
# Tokenising: the ids of a text are those of its white-space separated chunks,
# so a worker keeps the chunks it has met.
# ---------------------------------------------------------------------------
#: Chunks kept by a Python worker before it starts afresh (bounds its memory).
CACHE_CHUNKS = 200_000
_SIMPLE = re.compile("[!-~¡-ÿ]+")


class ChunkTokenizer:
    """ids of whole texts with a per-chunk memory. A chunk of plain Latin
    characters is lower-cased and cut by the tokenizer's own split pattern, and
    its model is asked for each cut; any other chunk goes through the
    tokenizer as it is."""

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.whole = Tokenizer.from_file(path)
        self.special = [a["content"] for a in spec["added_tokens"]]
        steps = spec["normalizer"].get("normalizers", []) if spec["normalizer"] else []
        splits = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
        # the shortcut needs: lower-casing, one split pattern, byte-level letters
        self.quick = ([s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
                      and [s["type"] for s in splits] == ["Split", "ByteLevel"])
        if self.quick:
            self.cut = regex.compile(splits[0]["pattern"]["Regex"]).findall
            printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
            others = [b for b in range(256) if b not in printable]
            self.letter = {b: chr(256 + i) for i, b in enumerate(others)}  # the printable stand for themselves
            self.tokenize = self.whole.model.tokenize
        self.chunks: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            if len(self.parts) >= CACHE_CHUNKS:
                self.parts.clear()
            letters = part if part.isascii() else part.encode("utf-8").decode("latin-1").translate(self.letter)
            ids = self.parts[part] = array("I", [t.id for t in self.tokenize(letters)]).tobytes()
        return ids

    def _chunk(self, chunk: bytes) -> bytes:
        if self.quick:
            text = chunk.decode("utf-8", "replace")
            if _SIMPLE.fullmatch(text):
                low = text.lower()
                if low.isalpha():
                    return self._part(low)
                if low[-1] in ",." and low[:-1].isalpha():
                    return self._part(low[:-1]) + self._part(low[-1])
                if not any(s in text for s in self.special):
                    return b"".join(map(self._part, self.cut(low)))
        return array("I", self.whole.encode(chunk.decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes()

    def __call__(self, text: bytes | None) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        known, chunks = self.chunks, (text or b"").split()
        out = list(map(known.get, chunks))
        if None in out:
            if len(known) >= CACHE_CHUNKS:
                known.clear()
            for i in [i for i, ids in enumerate(out) if ids is None]:
                chunk = chunks[i]
                ids = known.get(chunk)
                if ids is None:
                    ids = known[chunk] = self._chunk(chunk)
                out[i] = ids
        ids = b"".join(out)
        return ids if sys.byteorder == "little" else np.frombuffer(ids, ">u4").astype("<u4").tobytes()


_LOADED: dict[str, ChunkTokenizer] = {}


def tokenizer_at(path: str) -> ChunkTokenizer:
    """One tokenizer per Python worker and file."""
    if path not in _LOADED:
        _LOADED[path] = ChunkTokenizer(path)
    return _LOADED[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = True) -> DataFrame:
    """Token pieces of every document, written to the shared folder: doc_id,
    piece, start, length, ids_crc32 (of the ids as little-endian unsigned 32-bit
    integers), the place of the piece (part, nth among that part's pieces of its
    length), and with ``keep_ids`` the ids themselves. A document's ids end with
    ``end_id``; only those longer than ``capacity`` are cut. Null text counts as
    empty, a null doc_id stays."""
    schema = PIECE_SCHEMA if keep_ids else T.StructType(PIECE_SCHEMA.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, nth, tokenize = TaskContext.get().partitionId(), Counter(), tokenizer_at(tokenizer_path)
        end, step = np.array([end_id], "<u4").tobytes(), 4 * capacity
        for b in batches:
            rows, size = [], 0
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                ids = tokenize(text.as_py()) + end
                for piece, at in enumerate(range(0, len(ids), step)):
                    cut = ids[at:at + step]
                    n = len(cut) // 4
                    rows.append((doc, piece, at // 4, n, crc32(cut), part, nth[n], *([cut] if keep_ids else [])))
                    nth[n] += 1
                size += len(ids)
                if size > 4_000_000:
                    yield _frame(rows, schema)
                    rows, size = [], 0
            yield _frame(rows, schema)
    return written(texts_only(docs, id_col, text_col).mapInArrow(run, schema), "pack-pieces")


def _frame(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()][:len(schema)]
    columns = zip(*rows) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], schema.names)


# ---------------------------------------------------------------------------
# Bin completion on the histogram of lengths.
# ---------------------------------------------------------------------------
def lower_bound(lengths: Counter, capacity: int) -> int:
    """At least this many sequences: total length, and for thresholds k the
    long pieces that exclude each other (Martello and Toth's second bound)."""
    if not lengths:
        return 0
    size = np.zeros(capacity + 1, np.int64)
    for n, c in lengths.items():
        size[n] = c
    at = np.arange(capacity + 1)
    count, total = np.cumsum(size), np.cumsum(size * at)
    best = -(-int(total[-1]) // capacity)
    half = capacity // 2
    for k in [n for n in lengths if n <= half] or [0]:
        huge = int(count[-1] - count[capacity - k])
        large, large_sum = int(count[capacity - k] - count[half]), int(total[capacity - k] - total[half])
        small_sum = int(total[half] - (total[k - 1] if k else 0))
        best = max(best, huge + large + max(0, -(-(small_sum - (large * capacity - large_sum)) // capacity)))
    return best


class Lengths:
    """Counts by length, with two bit sets (forward and mirrored) so that "which
    pairs of lengths add up to this" is one AND of two integers."""

    def __init__(self, counts: Counter, capacity: int):
        self.capacity, self.count = capacity, Counter()
        self.has = self.mirror = 0
        for n, c in counts.items():
            self.add(n, c)

    def add(self, n: int, c: int) -> None:
        self.count[n] += c
        if self.count[n]:
            self.has |= 1 << n
            self.mirror |= 1 << (self.capacity - n)
        else:
            self.has &= ~(1 << n)
            self.mirror &= ~(1 << (self.capacity - n))

    def up_to(self, room: int) -> int:
        """The lengths of at most ``room``, as a bit set."""
        return self.has & ((1 << (room + 1)) - 1)

    def longest(self, room: int | None = None) -> int:
        return (self.has if room is None else self.up_to(room)).bit_length() - 1

    def pairs(self, fill: int, most: int, top: int | None = None) -> list[tuple[int, int]]:
        """Pairs a >= b with a + b = fill (a at most ``top``), longest a first."""
        if fill < 2:
            return []
        both = self.has & (self.mirror >> (self.capacity - fill)) & ((1 << fill) - 1)
        both >>= (fill + 1) // 2
        if not fill % 2 and both & 1 and self.count[fill // 2] < 2:
            both &= ~1
        if top is not None:
            both &= (1 << max(0, top + 1 - (fill + 1) // 2)) - 1
        out = []
        while both and len(out) < most:
            a = both.bit_length() - 1
            both ^= 1 << a
            out.append((a + (fill + 1) // 2, fill - a - (fill + 1) // 2))
        return out


def _descending(bits: int, most: int) -> Iterator[int]:
    while bits and most:
        n = bits.bit_length() - 1
        bits ^= 1 << n
        most -= 1
        yield n


def _exact(left: Lengths, fill: int, most: int, depth: int = 6, top: int | None = None) -> list[tuple[int, ...]]:
    """Sets of pieces (longest first, none above ``top``) that add up to
    ``fill``: one piece, pairs, triples; failing these, more pieces behind the
    longest that fit."""
    if fill == 0:
        return [()]
    if (top is None or fill <= top) and left.has >> fill & 1:
        return [(fill,)]
    out: list[tuple[int, ...]] = list(left.pairs(fill, most, top))
    reach = left.up_to(min(fill, top if top is not None else fill))
    if len(out) < most:
        for a in _descending(reach, 64):
            if 3 * a < fill:
                break
            left.add(a, -1)
            out += [(a, *p) for p in left.pairs(fill - a, 1, a)]
            left.add(a, 1)
            if len(out) >= most:
                break
    if not out and depth:
        for a in _descending(reach, 3 if depth > 4 else 1):
            k = max(1, min(left.count[a], fill // a) if depth < 4 else 1)
            left.add(a, -k)
            out = [(a,) * k + f for f in _exact(left, fill - a * k, 1, depth - 1, a)]
            left.add(a, k)
            if out:
                break
    return out


def fillings(left: Lengths, room: int, most: int = 8) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room``, least waste first, longer pieces before
    shorter: one piece that fills the room dominates every other filling. At
    least one maximal filling is returned (empty if nothing fits)."""
    if not left.up_to(room):
        return [()]
    for waste in range(min(room, 32)):
        out = _exact(left, room - waste, most)
        if out:
            return sorted(set(out), key=lambda f: (len(f), [-x for x in f]))[:most]
    out, rest = [], Counter()
    while left.up_to(room):  # nothing comes close: longest first
        a = left.longest(room)
        k = min(left.count[a], room // a)
        left.add(a, -k)
        rest[a] += k
        room -= a * k
        out += [a] * k
    for a, k in rest.items():
        left.add(a, k)
    return [tuple(out)]


def best_fit(lengths: Counter, capacity: int) -> list[Counter]:
    """Best-fit decreasing, one sequence at a time: the incumbent."""
    rooms: list[list] = []
    for n in sorted(lengths.elements(), reverse=True):
        fit = min((r for r in rooms if r[0] >= n), key=lambda r: r[0], default=None)
        if fit is None:
            rooms.append(fit := [capacity, Counter()])
        fit[0] -= n
        fit[1][n] += 1
    return [r[1] for r in rooms]


def branch_and_bound(lengths: Counter, capacity: int, nodes: int = 3000) -> list[Counter]:
    """Bin completion for few pieces: depth-first over the fillings around the
    longest piece, pruned when the waste so far leaves no room to beat the
    incumbent (best-fit decreasing at first). Exact over the fillings listed
    unless ``nodes`` run out; then the best solution found is returned."""
    best = best_fit(lengths, capacity)
    bound, total = lower_bound(lengths, capacity), sum(n * c for n, c in lengths.items())
    left, visits = Lengths(lengths, capacity), 0

    def descend(done: list[Counter], waste: int) -> bool:
        """True to stop: proven best, or out of nodes."""
        nonlocal best, visits
        if not left.has:
            if len(done) < len(best):
                best = done
            return len(best) <= bound
        visits += 1
        if visits > nodes:
            return True
        # beating the incumbent leaves it one sequence less, so this much waste
        if waste > (len(best) - 1) * capacity - total or len(done) + 1 >= len(best):
            return False
        a = left.longest()
        left.add(a, -1)
        stop = False
        for f in fillings(left, capacity - a):
            for x in f:
                left.add(x, -1)
            stop = descend([*done, Counter((a, *f))], waste + capacity - a - sum(f))
            for x in f:
                left.add(x, 1)
            if stop:
                break
        left.add(a, 1)
        return stop

    if len(best) > bound:
        descend([], 0)
    return best


def plan(lengths: Counter, capacity: int = CAPACITY, tail_pieces: int = 300) -> list[tuple[Counter, int]]:
    """(contents, copies) of all sequences for a histogram of lengths. Work
    follows the number of different lengths, not of pieces: each step uses a
    filling for as many sequences as its scarcest length allows. The last
    ``tail_pieces`` pieces go to branch_and_bound."""
    if any(not 0 < n <= capacity for n in lengths):
        raise ValueError(f"a piece's length lies outside 1 to {capacity}")
    left = Lengths(lengths, capacity)
    out: list[tuple[Counter, int]] = []
    pieces = sum(lengths.values())
    while pieces > tail_pieces:
        a = left.longest()
        left.add(a, -1)
        contents = Counter((a, *fillings(left, capacity - a, 1)[0]))
        left.add(a, 1)
        copies = min(left.count[n] // k for n, k in contents.items())
        for n, k in contents.items():
            left.add(n, -k * copies)
            pieces -= k * copies
        out.append((contents, copies))
    rest = Counter({n: c for n, c in left.count.items() if c})
    if rest:
        alike = Counter(tuple(sorted(c.elements(), reverse=True)) for c in branch_and_bound(rest, capacity))
        out += [(Counter(c), k) for c, k in alike.items()]
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (length, part, nth and any columns besides) with sequence_id
    and offset instead of part and nth. Only the histogram of lengths (at most
    ``capacity`` rows) reaches the driver."""
    held = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("held"))
    histogram = held.groupBy("length").agg(F.sum("held").alias("n")).collect()
    steps = plan(Counter({r["length"]: r["n"] for r in histogram}), capacity)
    # plan rows by (length, first rank): the first sequence, pieces per sequence, offset
    rows, used, sequence = [], Counter(), 0
    for contents, copies in steps:
        offset = 0
        for n, k in sorted(contents.items(), reverse=True):
            rows.append((n, used[n], sequence, k, offset))
            used[n] += k * copies
            offset += n * k
        sequence += copies
    rows.sort()
    table = np.array(rows or [(0, 0, 0, 1, 0)], np.int64)
    key = (table[:, 0] << 48) | table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, rank = (b.column(c).to_numpy() for c in ("length", "_rank"))
            row = table[np.searchsorted(key, (n << 48) | rank, "right") - 1]
            nth = rank - row[:, 1]
            sequence, offset = row[:, 2] + nth // row[:, 3], row[:, 4] + nth % row[:, 3] * n
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in kept), pa.array(sequence), pa.array(offset)], [*kept, "sequence_id", "offset"])

    by_length = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = held.select("part", "length", F.coalesce(F.sum("held").over(by_length), F.lit(0)).alias("_first"))
    ranked = pieces.join(first, ["part", "length"])
    kept = [c for c in pieces.columns if c not in ("part", "nth")]
    ranked = ranked.select(*kept, (F.col("_first") + F.col("nth")).cast("bigint").alias("_rank"))
    schema = T.StructType([*(f for f in ranked.schema.fields if f.name != "_rank"),
                           T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(place, schema)
