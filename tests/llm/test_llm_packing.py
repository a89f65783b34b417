"""Packing: ids against the tokenizer, gapless layout, few sequences."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from llm_fixtures import edges, nothing  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barforge.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")


def reference_pieces(rows, capacity):
    t = Tokenizer.from_file(PATH)
    out = []
    for d, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        out += [(d, i, a, len(ids[a:a + capacity]), zlib.crc32(np.array(ids[a:a + capacity], "<u4").tobytes()))
                for i, a in enumerate(range(0, len(ids), capacity))]
    return sorted(out, key=str)


def check_layout(rows, capacity):
    held = defaultdict(list)
    for r in rows:
        held[r.sequence_id].append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_pieces_and_layout(spark, edges, nothing):
    for capacity in (4096, 50):
        pieces = P.token_pieces(edges, PATH, capacity).select(
            "doc_id", "piece", "start", "length", F.crc32("ids").alias("c"), "part", "nth")
        got = P.pack(pieces, capacity).collect()
        rows = [(r.doc_id, r.text) for r in edges.collect()]
        assert sorted(((r.doc_id, r.piece, r.start, r.length, r.c) for r in got), key=str) == reference_pieces(rows, capacity)
        assert check_layout(got, capacity) == P.lower_bound(Counter(r.length for r in got), capacity)
    assert P.pack(P.token_pieces(nothing, PATH)).collect() == []


def test_tokenizer_agrees_on_odd_text():
    t, own = Tokenizer.from_file(PATH), P.ChunkTokenizer(PATH)
    rnd = random.Random(4)
    letters = "abcXYZ'’.,-019 \t\n\u00a0\x85\x1c\u2003éÉßſİıªº½²µÿĀſ́中😀<|endoftext|>"
    for _ in range(3000):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(0, 14)))
        assert np.frombuffer(own(text.encode()), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)
    for text in ("it's DON'T we'LL", "<|startoftext|>x <|endoftext|>", "x" * 5000, "e\u0301 é"):
        assert np.frombuffer(own(text.encode()), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def test_memory_of_chunks_is_bounded(monkeypatch):
    monkeypatch.setattr(P, "CACHE_CHUNKS", 5)
    own, t = P.ChunkTokenizer(PATH), Tokenizer.from_file(PATH)
    for i in range(40):
        text = f"word{i} hello, w{i}"
        assert np.frombuffer(own(text.encode()), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids
        assert len(own.chunks) <= 8 and len(own.parts) <= 5


def exact_bins(lengths, capacity):
    """Fewest sequences by exhaustive search over small inputs."""
    best = [len(lengths)]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms) if r >= lengths[i]}.values():
            rooms[j] -= lengths[i]
            place(i + 1, rooms)
            rooms[j] += lengths[i]
        place(i + 1, rooms + [capacity - lengths[i]])
    lengths = sorted(lengths, reverse=True)
    place(0, [])
    return best[0]


def test_branch_and_bound_is_exact_on_small_inputs():
    rnd = random.Random(8)
    for _ in range(60):
        lengths = [rnd.randrange(1, 60) for _ in range(rnd.randrange(1, 10))]
        got = P.branch_and_bound(Counter(lengths), 60)
        assert sum(got, Counter()) == Counter(lengths) and all(sum(c.elements()) <= 60 for c in got)
        assert len(got) == exact_bins(lengths, 60)


def test_plan_reaches_the_bound_and_uses_every_piece():
    rnd = random.Random(1)
    for n in (10, 1000, 40_000):
        lengths = Counter(min(4096, int(rnd.lognormvariate(6.3, 1.3)) + 1) for _ in range(n))
        steps = P.plan(lengths)
        total = Counter()
        for contents, copies in steps:
            assert copies > 0 and sum(x * k for x, k in contents.items()) <= 4096
            for x, k in contents.items():
                total[x] += k * copies
        assert total == lengths
        assert sum(c for _, c in steps) == P.lower_bound(lengths, 4096)
