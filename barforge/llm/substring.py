"""Removal of repeated word passages: prefix-partitioned suffix trees.

Of all windows of ``window`` consecutive words, those whose words also start
earlier - in a document with a smaller id, or earlier in the same document -
are repeats, and every word they cover goes.

1. Sparse suffixes. Only suffixes that start at a window's minimizer (the
   smallest hash among its ``prefix``-word grams) are compared first, about one
   word in nine. Equal windows have equal minimizers at equal places, so a gram
   that occurs once in the corpus rules out every window that chose it; whole
   copies of a text count as one occurrence. This leaves the windows that can
   repeat at all.
2. Prefix groups. The remaining suffixes are split by a variable-length prefix:
   by their gram alone where the corpus holds few suffixes of it, by the whole
   window where it holds many, so that a common phrase never gathers in one
   group. Before the shuffle a task already resolves what repeats within its
   own slice of documents, so a passage shared by any number of documents sends
   at most one suffix per slice.
3. Subtrees. Each group, sorted, is the array form of a suffix tree: neighbours
   that share a whole window hang below one internal node of at least that
   depth. A node's first leaf in document order stays; its other leaves are
   repeats. Runs of repeated windows make the maximal repeats.

Words are compared through 64-bit hashes, suffixes through two independent
ones (gram and window). Documents that are whole copies are settled by their
SHA-256, without their windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barforge.llm.common import scratch_path, slices, small_batches, window_hashes, word_hashes, written

WINDOW = 20
PREFIX = 5
#: Suffixes of one gram that still form a single group.
GROUP_SUFFIXES = 100_000
#: Words handled at once; a longer document is taken in overlapping parts.
PART_WORDS = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)
#: Stands for a null id in keys: rows without an id come after all others.
NO_ID = (1 << 63) - 1
EMPTY = hashlib.sha256(b"").hexdigest()


def minimizers(words: np.ndarray, before: np.ndarray, window: int, prefix: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window start, minimizer place, gram hash at that place) of every window
    inside one text; ``before`` holds the words before each text."""
    grams = window_hashes(words, prefix, seed=1)
    n = len(words) - window + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, np.uint64),)
    # the place in the low bits makes equal hashes differ: the leftmost wins
    low = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    span, width = window - prefix + 1, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
    starts = np.arange(n)
    text = np.searchsorted(before, starts, "right") - 1
    starts = starts[starts + window <= before[text + 1]]
    place = (low[starts] & _PLACE).astype(np.int64)
    return starts, place, grams[place]


def _parts(text: bytes, words: np.ndarray, window: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first word, hashes) of overlapping parts of one long text."""
    for at in range(0, max(1, len(words) - window + 1), PART_WORDS - window + 1):
        yield at, words[at:at + PART_WORDS]


def _by_text(texts: list[bytes], window: int, prefix: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(row, starts, places, grams, words) with word positions inside the text."""
    words, _, _, before = word_hashes(texts)
    if len(words) <= PART_WORDS:
        starts, place, gram = minimizers(words, before, window, prefix)
        cut = np.searchsorted(starts, before)
        for i in range(len(texts)):
            a, b = cut[i], cut[i + 1]
            yield i, starts[a:b] - before[i], place[a:b] - before[i], gram[a:b], words[before[i]:before[i + 1]]
        return
    for i, text in enumerate(texts):
        own = words[before[i]:before[i + 1]]
        found = [(s + at, p + at, g) for at, part in _parts(text, own, window)
                 for s, p, g in [minimizers(part, np.array([0, len(part)]), window, prefix)]]
        yield (i, *(np.concatenate(x) for x in zip(*found)), own)


def _word_digest(text: bytes) -> tuple[int, str]:
    words = text.split()
    return len(words), hashlib.sha256(b" ".join(words)).hexdigest()


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("doc"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))


def sparse_suffixes(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX) -> DataFrame:
    """(doc, n_words, digest, grams, places): digest is the SHA-256 of the words
    joined by one space; grams and places are the text's minimizers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text").to_pylist()
            counts, digests, grams, places = [], [], [], []
            for a, z in slices(texts):
                for i, _, place, gram, _ in _by_text(texts[a:z], window, prefix):
                    n, digest = _word_digest(texts[a + i])
                    new = np.concatenate([[True], place[1:] != place[:-1]]) if len(place) else np.zeros(0, bool)
                    counts.append(n)
                    digests.append(digest)
                    grams.append(gram[new].view(np.int64))
                    places.append(place[new])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
                 pa.array(grams, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))],
                ["doc", "n_words", "digest", "grams", "places"])
    return docs.mapInArrow(run, "doc bigint, n_words bigint, digest string, grams array<bigint>, places array<int>")


def open_suffixes(candidates: DataFrame, window: int = WINDOW, prefix: int = PREFIX) -> DataFrame:
    """(doc, digest, settled, keys, nodes, starts) per document of
    ``candidates`` (doc, digest, text, places, wide): settled are the window
    starts that repeat an earlier window of the same slice of documents; the
    others stay open as suffixes with their group key and window hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            order = np.lexsort((b.column("digest").to_numpy(zero_copy_only=False).astype(str), b.column("doc").to_numpy()))
            rows = b.take(pa.array(order)).to_pylist()
            for a, z in slices([r["text"] for r in rows]):
                yield _open_slice(rows[a:z], window, prefix)
    return candidates.mapInArrow(run, "doc bigint, digest string, settled array<int>, keys array<bigint>, "
                                      "nodes array<bigint>, starts array<int>")


def _open_slice(rows: list[dict], window: int, prefix: int) -> pa.RecordBatch:
    seen, docs = set(), []
    for r in rows:  # a repeated row is the same document once
        if (r["doc"], r["digest"]) not in seen and _word_digest(r["text"])[1] == r["digest"]:
            seen.add((r["doc"], r["digest"]))
            docs.append(r)
    found = []
    for i, starts, place, gram, words in _by_text([r["text"] for r in docs], window, prefix):
        flagged = np.array(docs[i]["places"], np.int64)
        wide = np.array(docs[i]["wide"], bool)
        by_place = np.argsort(flagged)
        flagged, wide = flagged[by_place], wide[by_place]
        at = np.minimum(np.searchsorted(flagged, place), max(0, len(flagged) - 1))
        can = flagged[at] == place if len(flagged) else np.zeros(len(place), bool)
        node = window_hashes(words, window)[starts[can]]
        key = np.where(wide[at[can]], node, gram[can])
        found.append((np.full(len(node), i), starts[can], key, node))
    text, start, key, node = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 4
    first = np.zeros(len(node), bool)
    first[np.unique(node, return_index=True)[1]] = True  # rows are in document order
    cut = np.searchsorted(text, np.arange(len(docs) + 1))
    out = [[], [], [], []]
    for i in range(len(docs)):
        s = slice(cut[i], cut[i + 1])
        is_first = first[s]
        out[0].append(start[s][~is_first])
        out[1].append(key[s][is_first].astype(np.uint64).view(np.int64))
        out[2].append(node[s][is_first].astype(np.uint64).view(np.int64))
        out[3].append(start[s][is_first])
    return pa.RecordBatch.from_arrays(
        [pa.array([r["doc"] for r in docs], pa.int64()), pa.array([r["digest"] for r in docs], pa.string()),
         *(pa.array(x, pa.list_(t)) for x, t in zip(out, (pa.int32(), pa.int64(), pa.int64(), pa.int32())))],
        ["doc", "digest", "settled", "keys", "nodes", "starts"])


def later_leaves(suffixes: DataFrame) -> DataFrame:
    """(doc, d, start) of every leaf but the first below each internal node, for
    ``suffixes(key, node, doc, d, start)``: one subtree per prefix group, read
    as a sorted run, so a task holds one batch at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, last, first = ["key", "node", "doc", "d", "start"], None, None
        for b in batches:
            if not b.num_rows:
                continue
            c = [b.column(n).to_numpy() for n in names]
            path = np.empty(b.num_rows, bool)  # starts a new node
            path[1:] = (c[0][1:] != c[0][:-1]) | (c[1][1:] != c[1][:-1])
            path[0] = last != (c[0][0], c[1][0])
            head = np.maximum.accumulate(np.where(path, np.arange(b.num_rows), -1))
            later = np.zeros(b.num_rows, bool)
            for x, f in zip(c[2:], first or (0, 0, 0)):
                later |= x != np.where(head >= 0, x[head], f)
            last, h = (c[0][-1], c[1][-1]), head[-1]
            first = tuple(x[h] for x in c[2:]) if h >= 0 else first
            yield pa.RecordBatch.from_arrays([pa.array(x[later]) for x in c[2:]], names[2:])

    groups = suffixes.repartition("key").sortWithinPartitions("key", "node", "doc", "d", "start")
    return groups.mapInArrow(run, "doc bigint, d bigint, start int")


def without_windows(candidates: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc, digest, n_removed, kept, spans) for ``candidates`` with their
    repeated window ``starts``: kept is the remaining text (words joined by one
    space), spans the maximal runs of removed words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, size = [], 0
            for r in b.to_pylist():
                words = r["text"].split()
                if hashlib.sha256(b" ".join(words)).hexdigest() != r["digest"]:
                    continue  # another row with the same id
                edge = np.zeros(len(words) + 1, np.int64)
                starts = np.unique(np.array(r["starts"], np.int64))
                edge[starts] += 1
                np.subtract.at(edge, starts + window, 1)
                gone = np.cumsum(edge[:-1]) > 0
                turn = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                rows.append((r["doc"], r["digest"], int(gone.sum()),
                             b" ".join([w for w, g in zip(words, gone.tolist()) if not g]),
                             [{"first": int(x), "end": int(y)} for x, y in turn.reshape(-1, 2)]))
                size += len(r["text"])
                if size > 8 << 20:
                    yield _kept_batch(rows)
                    rows, size = [], 0
            yield _kept_batch(rows)
    return candidates.mapInArrow(run, "doc bigint, digest string, n_removed bigint, kept binary, "
                                      "spans array<struct<first:int,end:int>>")


def _kept_batch(rows: list[tuple]) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.binary(), span)
    columns = zip(*rows) if rows else [()] * 5
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)],
                                      ["doc", "digest", "n_removed", "kept", "spans"])


def _let_go(spark: SparkSession) -> None:
    """Let Spark drop shuffle files of finished steps: their results are written
    tables by now, and the cleaner acts when the driver collects its garbage."""
    spark._jvm.System.gc()


def remove_repeats(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group_suffixes: int = GROUP_SUFFIXES,
                   id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(summary, changed). summary has a row per input row: doc_id, digest,
    n_words, n_removed, state ('whole': nothing goes; 'copy': a whole copy of a
    smaller id, everything goes; 'part'). changed has the remaining text of the
    'part' documents: doc_id, digest, n_removed, kept (UTF-8), spans.

    Null text has no words; texts below ``window`` words stay; a null id sorts
    after all others (the largest BIGINT is reserved for it); rows that repeat
    id and text are one document and repeat in summary; different texts under
    one id are ordered by hash; an empty table gives empty results; other
    columns are ignored."""
    spark = docs.sparkSession
    texts = _keyed(docs, id_col, text_col)
    base = written(sparse_suffixes(texts, window, prefix), "substr-base")
    copies = base.where(F.col("n_words") >= window).groupBy("digest").agg(
        F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
    copies = written(copies.where("first_doc <> last_doc").drop("last_doc"), "substr-copies")

    # 1. grams that occur at two different places, copies counting once: a place
    # is a text (by its hash) and a position, whatever documents hold the text
    d = F.xxhash64("digest").alias("d")
    places = base.select(d, F.explode(F.arrays_zip("grams", "places")).alias("g"))
    places = places.select("d", F.col("g.grams").alias("gram"), F.col("g.places").alias("place"))
    v = F.xxhash64("d", "place")
    repeated = places.groupBy("gram").agg(F.min(v).alias("a"), F.max(v).alias("b"), F.count(F.lit(1)).alias("n"))
    repeated = repeated.where("a <> b").select("gram", (F.col("n") > group_suffixes).alias("wide"))
    flagged = places.join(repeated, "gram").groupBy("d").agg(F.collect_set(F.struct("place", "wide")).alias("p"))
    # of whole copies only the first one's windows are looked at
    firsts = base.join(copies, "digest", "left").where(F.coalesce(F.col("first_doc"), F.col("doc")) == F.col("doc"))
    flagged = flagged.join(firsts.select("doc", d, "digest").distinct(), "d")
    flagged = written(flagged.select("doc", "digest", F.col("p.place").alias("places"), F.col("p.wide").alias("wide")), "substr-flagged")
    _let_go(spark)

    # the texts that can change, kept bucketed by id: shuffled once, joined twice
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "substr-candidates")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    (texts.repartition(buckets, "doc").join(flagged, "doc").write.bucketBy(buckets, "doc")
     .option("path", path).option("compression", "zstd").format("parquet").saveAsTable(name))
    candidates = spark.table(name)
    _let_go(spark)

    # 2. and 3. suffixes by prefix group, later leaves of each subtree
    opened = written(open_suffixes(candidates, window, prefix), "substr-open")
    suffixes = opened.select("doc", F.xxhash64("digest").alias("d"), F.explode(F.arrays_zip("keys", "nodes", "starts")).alias("s"))
    later = later_leaves(suffixes.select(F.col("s.keys").alias("key"), F.col("s.nodes").alias("node"), "doc", "d",
                                         F.col("s.starts").alias("start")))
    starts = later.groupBy("doc", "d").agg(F.collect_list("start").alias("starts")).union(
        opened.where(F.size("settled") > 0).select("doc", F.xxhash64("digest").alias("d"), "settled"))
    starts = starts.groupBy("doc", "d").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    starts = written(starts, "substr-starts")
    _let_go(spark)

    hit = candidates.join(starts, "doc").where(F.xxhash64("digest") == F.col("d"))
    changed = without_windows(hit.select("doc", "digest", "text", "starts"), window)
    changed = written(changed, "substr-changed").dropDuplicates(["doc", "digest"])
    summary = base.drop("grams", "places").join(copies, "digest", "left").join(
        changed.select("doc", "digest", "n_removed"), ["doc", "digest"], "left")
    is_copy = F.coalesce(F.col("first_doc") != F.col("doc"), F.lit(False))
    doc_id = F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id")
    summary = summary.select(
        doc_id, "digest", "n_words",
        F.when(is_copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(is_copy, "copy").when(F.col("n_removed") > 0, "part").otherwise("whole").alias("state"))
    return summary, changed.select(doc_id, "digest", "n_removed", "kept", "spans")
