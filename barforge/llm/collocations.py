"""Phrase collocations of every language: counts of all word sequences of up to
four words, from depth-truncated suffix subtrees that are built independently.

The method is the vertical partitioning of disk-based suffix trees:

1. *Word counts* by language, over all texts. Words are known by a 64-bit hash;
   occurrences are compared with the word they are counted for, and a hash that
   two words share starts the count again under another seed.
2. *Prefixes* of words, of variable length: a prefix that starts more suffixes
   than the memory budget is extended by one word, and its extensions are
   counted, until none is over the budget or the full depth is reached.
   Consecutive prefixes (in hash order) form groups within the budget.
3. *Subtrees*: every position starts a suffix of up to four words, cut at the
   piece's end and before a word too rare to be in a reported phrase (told by a
   bit table of fixed size; its false hits cost time only). Equal suffixes of a
   slice of text are one row entry with a count, packed per group. Each group is
   sorted into its subtree in one task, and a node's count is its leaves' total.

The counts of a node's left parts are its ancestors'; those of its right parts
come from a join of nodes. Only nodes that reach the least count leave a task.

Null languages are ``und``; null and empty texts have no words; repeated rows
count each time; an empty table gives no phrases; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barforge.llm.common import _FIRST, _MIX1, _STEP, mix, small_batches, written

DEPTH = 4
LEAST = 30
TOP = 2000
#: A candidate inside a longer one with this share (in percent) of its count is dropped.
COVERED = 80
SCALE = 2_000_000
#: Suffixes in one group, the memory of a task that builds a subtree.
BUDGET = 2_000_000
#: At most so many extended prefixes reach the driver; beyond, the budget grows.
MAX_EXTENDED = 1_000_000
#: Bits of the table of frequent words that every task holds (4 MB).
TABLE_BITS = 25
#: Prefix hashes are summed in so many bins to lay out the groups.
BIN_BITS = 16
#: A long text is cut at the piece's end behind so many bytes; so many bytes of
#: text are held, by language, before they are tokenised.
SLICE = 4 << 20
HELD = 12 << 20

_U = np.uint64
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_END = re.compile(rb"[.,;:!?\x0A-\x0D]")
_STEP2 = _U(0xD6E8FEB86659FD93)


class HashClash(Exception):
    """Two words, or two prefixes over the budget, share a hash under this seed."""


@dataclass
class Layout:
    """What every task knows: the seed, the bit table of frequent words, for
    each level the extended prefixes (sorted hashes, counts and words), and the
    first bin of each group. All of bounded size."""

    seed: int
    table: np.ndarray | None = None
    extended: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    starts: np.ndarray | None = None
    least: int = LEAST

    def frequent(self, words: np.ndarray) -> np.ndarray:
        at = words & _U((1 << TABLE_BITS) - 1)
        return (self.table[at >> _U(6)] >> (at & _U(63))) & _U(1) == 1

    def count_of(self, words: np.ndarray, ids: np.ndarray, level: int) -> np.ndarray:
        """Counts of those extended prefixes of ``level`` words that the suffixes
        start with, 0 for others. The words are compared, not their hash alone."""
        if level > len(self.extended) or not len(self.extended[level - 1][0]):
            return np.zeros(ids.shape[1], np.int64)
        keys, counts, spelled = self.extended[level - 1]
        prefix = prefix_hash(words, ids, level)
        at = np.minimum(np.searchsorted(keys, prefix), len(keys) - 1)
        known = np.concatenate([np.zeros(1, np.uint64), words])
        same = keys[at] == prefix
        for d in range(level):
            same &= spelled[d, at] == known[ids[d]]
        return np.where(same, counts[at], 0)

    def group_of(self, prefix: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, (prefix >> _U(64 - BIN_BITS)).astype(np.int64), "right") - 1


def _spans(raw: np.ndarray, first: np.ndarray, end: np.ndarray) -> Iterator[tuple]:
    """The words' bytes, eight at a time: (which words, their next bytes)."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(raw) + 1,), "<u8", padded.data, strides=(1,))
    live, at, n = np.arange(len(first)), first, end - first
    while len(live):
        yield live, eight[at] & _FIRST[np.minimum(n, 8)]
        more = n > 8
        live, at, n = live[more], at[more] + 8, n[more] - 8


def tokens(data: bytes, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of a lower-cased text: (bytes, hash, first byte, end byte, piece)."""
    raw = np.frombuffer(data, np.uint8)
    kind = _KIND[raw]
    edge = np.flatnonzero(np.diff(kind == 0, prepend=False, append=False))
    first, end = edge[::2], edge[1::2]
    piece = np.cumsum(kind == 2, dtype=np.int32)[first] if len(first) else np.zeros(0, np.int32)
    out = (end - first).astype(np.uint64) * _STEP ^ _U(seed)
    for live, part in _spans(raw, first, end):
        h = (out[live] ^ part) * _MIX1
        out[live] = h ^ (h >> _U(32))
    return raw, mix(out), first, end, piece


def _differ(raw: np.ndarray, first: np.ndarray, end: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether each word differs from the word number ``of`` it is counted for."""
    out = (end - first) != (end - first)[of]
    same = np.flatnonzero(~out & (of != np.arange(len(of))))
    ours, theirs = _spans(raw, first[same], end[same]), _spans(raw, first[of[same]], end[of[same]])
    for (live, a), (_, b) in zip(ours, theirs):
        out[same[live[a != b]]] = True
    return out


def _text_slices(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[tuple[str, int, bytes]]:
    """(lang, seed of the language, lower-cased text) of bounded size: whole
    texts, or parts of a long one that end at a piece's end and go out as they
    are cut. Texts are held up to a bound, then the language with most of them
    goes out."""
    import xxhash
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}

    def flush(lang):
        del sizes[lang]
        return lang, xxhash.xxh64_intdigest(lang.encode(), seed), b"\n".join(held.pop(lang)).lower()

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
            text = text.as_py() or b""
            at = 0
            while at < len(text):
                cut = _END.search(text, at + SLICE) if len(text) - at > SLICE else None
                end = cut.end() if cut else len(text)
                held.setdefault(lang, []).append(text[at:end])
                sizes[lang], at = sizes.get(lang, 0) + end - at, end
                if cut or sum(sizes.values()) >= HELD:
                    yield flush(lang if cut else max(sizes, key=sizes.get))
    for lang in list(held):
        yield flush(lang)


def _count_words(batches, layout: Layout) -> Iterator[pa.RecordBatch]:
    for lang, seed, data in _text_slices(batches, layout.seed):
        raw, words, first, end, _ = tokens(data, seed)
        if not len(words):
            continue
        unique, at, back, n = np.unique(words, return_index=True, return_inverse=True, return_counts=True)
        # words counted for another word of the same hash go out on their own
        other = np.flatnonzero(_differ(raw, first, end, at[back]))
        n = n - np.bincount(back[other], minlength=len(unique))
        at, n, h = np.concatenate([at, other]), np.concatenate([n, np.ones(len(other), np.int64)]), np.concatenate([unique, words[other]])
        texts = [data[a:b] for a, b in zip(first[at].tolist(), end[at].tolist())]
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(texts, pa.binary()),
                                          pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "word", "h", "n"])


@dataclass
class Suffixes:
    """Distinct suffixes of a slice: ``ids`` (depth x m, 0: none) into ``words``
    (sorted hashes, from 1), how often each occurs, and its prefix hashes."""

    words: np.ndarray
    ids: np.ndarray
    n: np.ndarray

    def prefix(self, level: int) -> np.ndarray:
        return prefix_hash(self.words, self.ids, level)


def prefix_hash(words: np.ndarray, ids: np.ndarray, level: int) -> np.ndarray:
    """Hash of the first ``level`` words (of suffixes that have so many)."""
    known = np.concatenate([np.zeros(1, np.uint64), words])
    out = known[ids[0]]
    for row in ids[1:level]:
        out = mix(out * _STEP2 + known[row])
    return out


def _sorted_order(ids: np.ndarray) -> np.ndarray:
    wide = ids.astype(np.uint64)
    keys = [wide[i] << _U(32) | (wide[i + 1] if i + 1 < len(wide) else _U(0)) for i in range(0, len(wide), 2)]
    return np.lexsort(keys[::-1])


def _new(ids: np.ndarray, level: int) -> np.ndarray:
    """Whether each (sorted) suffix differs from the one before in its first
    ``level`` words."""
    out = np.ones(ids.shape[1], bool)
    if ids.shape[1] > 1:
        out[1:] = (ids[:level, 1:] != ids[:level, :-1]).any(0)
    return out


def suffixes(words: np.ndarray, piece: np.ndarray, frequent: np.ndarray, depth: int) -> Suffixes:
    """Distinct suffixes of up to ``depth`` frequent words within a piece."""
    unique, back = np.unique(words, return_inverse=True)
    n = len(words)
    ids = np.zeros((depth, n), np.int32)
    live = frequent
    ids[0] = np.where(live, back + 1, 0)
    for d in range(1, min(depth, n)):
        live = live[:n - d] & frequent[d:] & (piece[:n - d] == piece[d:])
        ids[d, :n - d] = np.where(live, back[d:] + 1, 0)
    ids = ids[:, ids[0] > 0]
    ids = ids[:, _sorted_order(ids)]
    at = np.flatnonzero(_new(ids, depth))
    return Suffixes(unique, ids[:, at], np.diff(np.append(at, ids.shape[1])))


def _count_prefixes(batches, layout: Layout, level: int) -> Iterator[pa.RecordBatch]:
    """Counts of the extensions, to ``level`` words, of prefixes over the budget."""
    for lang, seed, data in _text_slices(batches, layout.seed):
        _, words, _, _, piece = tokens(data, seed)
        found = suffixes(words, piece, layout.frequent(words), level)
        keep = (layout.count_of(found.words, found.ids, level - 1) > 0) & (found.ids[level - 1] > 0)
        found = Suffixes(found.words, found.ids[:, keep], found.n[keep])
        known = np.concatenate([np.zeros(1, np.uint64), found.words])
        columns = [pa.array([lang] * len(found.n), pa.string())]
        columns += [pa.array(known[found.ids[d]].view(np.int64) if d < level else np.zeros(len(found.n), np.int64)) for d in range(DEPTH - 1)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(found.prefix(level).view(np.int64)), pa.array(found.n.astype(np.int64))],
                                         ["lang", "w1", "w2", "w3", "h", "n"])


def _packed(values: np.ndarray) -> bytes:
    """32-bit values as compressed byte planes."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return pa.Codec("zstd").compress(planes.tobytes(), asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.Codec("zstd").decompress(data, 4 * n, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(4, n).T).view("<u4").ravel().astype(np.int64)


def _deal_suffixes(batches, layout: Layout) -> Iterator[pa.RecordBatch]:
    """The distinct suffixes of each slice, a packed row per group."""
    for lang, seed, data in _text_slices(batches, layout.seed):
        _, words, _, _, piece = tokens(data, seed)
        if not len(words):
            continue
        found = suffixes(words, piece, layout.frequent(words), DEPTH)
        deal = found.prefix(1)
        over = layout.count_of(found.words, found.ids, 1) > 0
        for level in range(2, DEPTH + 1):
            # the prefix is over the budget: its group follows from one word
            # more. Without one, the prefix's own count is known already.
            keep = ~over | (found.ids[level - 1] > 0)
            found, deal, over = Suffixes(found.words, found.ids[:, keep], found.n[keep]), deal[keep], over[keep]
            longer = found.prefix(level)
            deal = np.where(over, longer, deal)
            over = over & (layout.count_of(found.words, found.ids, level) > 0)
        if not len(found.n):
            continue
        group = layout.group_of(deal)
        order = np.argsort(group, kind="stable")
        group, ids, n = group[order], found.ids[:, order], found.n[order]
        at = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group))
        rows: list[tuple] = []
        for a, b in zip(at[:-1], at[1:]):
            used = np.zeros(len(found.words) + 1, bool)
            used[ids[:, a:b]] = True
            used[0] = False
            number = np.cumsum(used)
            number[0] = 0
            own = np.where(ids[:, a:b] > 0, number[ids[:, a:b]], 0)
            rows.append((int(group[a]), lang, b - a, found.words[used[1:]].tobytes(), _packed(np.concatenate([own.ravel(), n[a:b]]))))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), (
            pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary()))], ["grp", "lang", "m", "words", "tree"])


NODES = "lang string, w1 long, w2 long, w3 long, w4 long, size int, a long, l1 long, l2 long, l3 long"


def _subtree(rows, layout: Layout):
    """The subtree of one group of prefixes: its inner nodes of two words or
    more with at least the least count, and the counts of their ancestors."""
    import pandas as pd
    trees = []
    words = np.unique(np.concatenate([np.frombuffer(w, np.uint64) for w in rows["words"]]))
    for own, tree, m in zip(rows["words"], rows["tree"], rows["m"]):
        values = _unpacked(tree, m * (DEPTH + 1)).reshape(DEPTH + 1, m)
        number = np.concatenate([[0], np.searchsorted(words, np.frombuffer(own, np.uint64)) + 1])
        values[:DEPTH] = number[values[:DEPTH]]
        trees.append(values)
    everything = np.concatenate(trees, 1)
    del trees
    order = _sorted_order(everything[:DEPTH])
    ids, n = everything[:DEPTH, order].astype(np.int32), everything[DEPTH, order]
    known = np.concatenate([np.zeros(1, np.uint64), words]).view(np.int64)
    out, above = [], []
    for level in range(1, DEPTH + 1):
        at = np.flatnonzero(_new(ids, level))
        total = np.add.reduceat(n, at)
        whole = ids[level - 1, at] > 0
        over = np.where(whole, layout.count_of(words, ids[:, at], level), 0)
        total = np.where(over > 0, over, total)
        if level > 1:
            # a node over the budget is spread over groups; its count is known
            keep = np.flatnonzero(whole & (over == 0) & (total >= layout.least))
            place = at[keep]
            columns = {f"w{d + 1}": known[ids[d, place]] if d < level else np.zeros(len(place), np.int64) for d in range(DEPTH)}
            columns |= {"size": np.full(len(place), level, np.int32), "a": total[keep]}
            columns |= {f"l{d}": above[d - 1][place] if d < level else np.zeros(len(place), np.int64) for d in range(1, DEPTH)}
            out.append(pd.DataFrame(columns))
        above.append(np.repeat(total, np.diff(np.append(at, ids.shape[1]))))
    nodes = pd.concat(out, ignore_index=True)
    nodes.insert(0, "lang", rows["lang"].iloc[0])
    return nodes


def _read(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                       F.col(text_col).cast("string").cast("binary").alias("text"))


def _mapped(texts: DataFrame, fn, layout: Layout, schema: str, *args) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(layout)
    return texts.mapInArrow(lambda batches: fn(batches, shared.value, *args), schema)


def word_counts(texts: DataFrame, seed: int) -> DataFrame:
    """(lang, word, h, f) of every word; raises HashClash if two words share h."""
    rows = _mapped(texts, _count_words, Layout(seed), "lang string, word binary, h long, n long")
    counts = rows.groupBy("lang", F.col("word").cast("string").alias("word"), "h").agg(F.sum("n").alias("f"))
    counts = written(counts, "phrase-words")
    if not counts.groupBy("h").count().where("count > 1").isEmpty():
        raise HashClash
    return counts


def _bit_table(words: DataFrame) -> np.ndarray:
    """Bits of the frequent words' hashes; 2^TABLE_BITS / 64 numbers at most."""
    at = F.col("h").bitwiseAND((1 << TABLE_BITS) - 1)
    bits = words.groupBy(F.shiftright(at, 6).alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(h & 63 as int))")).alias("bits")).toArrow()
    table = np.zeros(1 << TABLE_BITS - 6, np.uint64)
    table[bits["at"].to_numpy()] = bits["bits"].to_numpy().view(np.uint64)
    return table


def _vertical_partition(texts: DataFrame, words: DataFrame, layout: Layout, budget: int) -> DataFrame | None:
    """Fill ``layout`` with the extended prefixes and the groups; the nodes over
    the budget (of two words or more) with their counts, if there are any."""
    bins = F.shiftrightunsigned("h", 64 - BIN_BITS).alias("bin")
    light, over = [words.where(F.col("f") <= budget).groupBy(bins).agg(F.sum("f").alias("f"))], []
    prefixes = words
    for level in range(1, DEPTH):
        spelled = [F.col("h").alias("w1")] if level == 1 else [F.col(f"w{d}") for d in range(1, level + 1)]
        heavy = prefixes.where(F.col("f") > budget).select("h", "f", *spelled).toArrow()
        order = np.argsort(heavy["h"].to_numpy().view(np.uint64))
        keys, counts, *spelled = (heavy[c].to_numpy().astype(np.int64)[order] for c in heavy.column_names)
        keys = keys.view(np.uint64)
        if len(np.unique(keys)) < len(keys):
            raise HashClash
        layout.extended.append((keys, counts, np.stack(spelled).view(np.uint64)))
        if not len(keys):
            break
        if level > 1:
            over.append(prefixes.where(F.col("f") > budget))
        rows = _mapped(texts, _count_prefixes, layout, "lang string, w1 long, w2 long, w3 long, h long, n long", level + 1) \
            if level + 1 < DEPTH else None
        if rows is None:  # full depth: each leaf is its own group's entry
            continue
        prefixes = written(rows.groupBy("lang", "w1", "w2", "w3", "h").agg(F.sum("n").alias("f")), "phrase-prefixes")
        light.append(prefixes.where(F.col("f") <= budget).groupBy(bins).agg(F.sum("f").alias("f")))
    sums = np.zeros(1 << BIN_BITS, np.int64)
    for part in light:
        got = part.toArrow()
        np.add.at(sums, got["bin"].to_numpy(), got["f"].to_numpy().astype(np.int64))
    starts, held = [0], 0
    for i, size in enumerate(sums.tolist()):
        if held and held + size > budget:
            starts.append(i)
            held = 0
        held += size
    layout.starts = np.array(starts, np.int64)
    if not over:
        return None
    nodes = over[0] if len(over) == 1 else over[0].unionByName(over[1])
    shared = texts.sparkSession.sparkContext.broadcast(layout)

    def ancestors(batches):
        for batch in batches:
            known = [batch[f"w{d}"].to_numpy(zero_copy_only=False).view(np.uint64) for d in range(1, DEPTH)]
            words, back = np.unique(np.concatenate(known), return_inverse=True)
            ids = back.reshape(DEPTH - 1, -1) + 1
            size = 1 + (known[1] != 0).astype(np.int32) + (known[2] != 0)
            left = [shared.value.count_of(words, ids, 1), np.where(size > 2, shared.value.count_of(words, ids, 2), 0)]
            zero = pa.array(np.zeros(len(size), np.int64))
            yield pa.RecordBatch.from_arrays([batch["lang"], batch["w1"], batch["w2"], batch["w3"], zero, pa.array(size.astype(np.int32)),
                                              batch["f"], pa.array(left[0]), pa.array(left[1].astype(np.int64)), zero],
                                             [c.split()[0] for c in NODES.split(", ")])
    return nodes.mapInArrow(ancestors, NODES)


def phrase_nodes(docs: DataFrame, least: int = LEAST, budget: int = BUDGET, text_col: str = "text",
                 lang_col: str = "lang") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, words, totals): every phrase of two to four words with at least
    ``least`` occurrences in its language (hashes of its words, 0 for none, the
    count and its left parts' counts), the frequent words (lang, word, h, f) and
    the number of word occurrences of each language (lang, n)."""
    texts = _read(docs, text_col, lang_col)
    for seed in range(8):
        try:
            counts = word_counts(texts, seed)
            words = counts.where(F.col("f") >= least)
            layout = Layout(seed, _bit_table(words), least=least)
            budget = max(budget, (words.agg(F.sum("f")).first()[0] or 0) // MAX_EXTENDED)
            over = _vertical_partition(texts, words, layout, budget)
            break
        except HashClash:
            continue
    else:
        raise HashClash("no seed tells all words apart")
    totals = written(counts.groupBy("lang").agg(F.sum("f").alias("n")), "phrase-totals")
    shared = texts.sparkSession.sparkContext.broadcast(layout)
    dealt = _mapped(texts, _deal_suffixes, layout, "grp long, lang string, m long, words binary, tree binary")
    nodes = dealt.groupBy("grp", "lang").applyInPandas(lambda rows: _subtree(rows, shared.value), NODES)
    if over is not None:
        nodes = nodes.unionByName(over)
    return written(nodes, "phrase-nodes"), words, totals


def _exact(name: str, times: int = 1) -> str:
    return f"cast({name} as decimal(20,0))" + (f" * cast({times} as decimal(8,0))" if times > 1 else "")


def _not_covered(nodes: DataFrame, covered: int) -> DataFrame:
    """Nodes that no longer node contains at ``covered`` percent of their count."""
    w = [F.col(f"w{d}") for d in range(1, DEPTH + 1)]
    zero = F.lit(0).cast("bigint")
    inner = [(size, at, part) for size in range(3, DEPTH + 1) for part in range(2, size) for at in range(size - part + 1)]
    parts = F.explode(F.filter(F.array(*(F.when(F.col("size") == size, F.struct(
        *((w[at + i] if i < part else zero).alias(f"i{i + 1}") for i in range(DEPTH)))) for size, at, part in inner)), lambda x: x.isNotNull()))
    inside = nodes.where("size > 2").select("lang", "a", parts.alias("x")).groupBy(
        F.col("lang").alias("of"), *(F.col(f"x.i{d}").alias(f"i{d}") for d in range(1, DEPTH + 1))).agg(F.max("a").alias("longer"))
    match = (F.col("lang") == F.col("of")) & (F.col("w1") == F.col("i1")) & (F.col("w2") == F.col("i2")) & (F.col("w3") == F.col("i3"))
    match &= (F.col("w4") == F.col("i4")) & F.expr(f"{_exact('longer', 100)} >= {_exact('a', covered)}")
    return nodes.join(inside, match, "left_anti")


def _scored(kept: DataFrame, nodes: DataFrame, words: DataFrame) -> DataFrame:
    """``kept`` with l, r and score of the lowest-scoring cut."""
    w = [F.col(f"w{d}") for d in range(1, DEPTH + 1)]
    zero = F.lit(0).cast("bigint")
    cuts = F.explode(F.filter(F.array(*(F.when(F.col("size") == size, F.struct(
        F.lit(cut).alias("cut"), F.col(f"l{cut}").alias("l"), *((w[cut + i] if cut + i < size else zero).alias(f"p{i + 1}") for i in range(DEPTH - 1))))
        for size in range(2, DEPTH + 1) for cut in range(1, size))), lambda x: x.isNotNull()))
    rows = kept.select("lang", "size", *w, "a", cuts.alias("x")).select("lang", "size", *w, "a", "x.*")
    parts = words.select(F.col("lang").alias("of"), F.col("h").alias("q1"), zero.alias("q2"), zero.alias("q3"), F.col("f").alias("r"))
    parts = parts.unionByName(nodes.where(F.col("size") < DEPTH).select(
        F.col("lang").alias("of"), F.col("w1").alias("q1"), F.col("w2").alias("q2"), F.col("w3").alias("q3"), F.col("a").alias("r")))
    rows = rows.join(parts, (F.col("lang") == F.col("of")) & (F.col("p1") == F.col("q1")) & (F.col("p2") == F.col("q2")) & (F.col("p3") == F.col("q3")))
    score = F.expr(f"({_exact('a', SCALE)}) div ({_exact('l')} + {_exact('r')})")
    best = rows.withColumn("score", score).groupBy("lang", "size", *w, "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("b"))
    return best.select("lang", "size", *w, "a", "b.l", "b.r", "b.score")


def _first(rows: DataFrame, top: int, salts: int = 256, *ties: str) -> DataFrame:
    """The rows of each language ranked up to ``top`` (equal ranks included
    unless ``ties`` settle them), in two steps so that no task sorts a language."""
    order = [F.desc("score"), F.desc("a"), *ties]
    place = F.row_number() if ties else F.rank()
    salt = F.pmod(F.xxhash64("w1", "w2", "w3", "w4"), F.lit(salts))
    rows = rows.withColumn("rank", place.over(Window.partitionBy("lang", salt).orderBy(*order))).where(F.col("rank") <= top)
    return rows.withColumn("rank", place.over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED, budget: int = BUDGET,
                 text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a (occurrences), l and
    r (of the parts at the lowest-scoring cut), n (word occurrences), score."""
    nodes, words, totals = phrase_nodes(docs, least, budget, text_col, lang_col)
    best = written(_first(_scored(_not_covered(nodes, covered), nodes, words), top).drop("rank"), "phrase-best")
    ids = [f"w{d}" for d in range(1, DEPTH + 1)]
    parts = best.select("lang", *ids, F.posexplode(F.array(*ids)).alias("at", "id")).where("id != 0")
    spelled = parts.join(words.select(F.col("lang").alias("of"), "h", "word"), (F.col("lang") == F.col("of")) & (F.col("id") == F.col("h")))
    spelled = spelled.groupBy("lang", *ids).agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("x"))
    spelled = spelled.select("lang", *ids, F.array_join("x.word", " ").alias("phrase"))
    ranked = _first(best.join(spelled, ["lang", *ids]), top, 256, "phrase")
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
