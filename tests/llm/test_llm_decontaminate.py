"""Decontamination against every item-sized window."""

import random
import re
from collections import Counter

import numpy as np
from llm_fixtures import documents, edges, nothing  # noqa: F401

from barforge.llm import decontaminate as D


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def grams(w, k):
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def plain(rows, items, least=0.8):
    out = []
    for d, t in rows:
        w = words(t)
        for item, body in {(i, b) for i, b in items}:
            iw = words(body)
            if not iw:
                continue
            k, own = min(5, len(iw)), grams(iw, min(5, len(iw)))
            size, best = len(iw), 0.0
            for s in range(max(1, len(w) - size + 1)):
                g = grams(w[s:s + size], k)
                best = max(best, sum((g & own).values()) / max(sum(own.values()), sum(g.values())))
            if best >= least:
                out.append((d, item, round(best, 9)))
    return sorted(out, key=str)


def make(spark, items):
    return spark.createDataFrame([(i, b, "x") for i, b in items], "item_id long, text string, doc_id string")


def corpus(seed=3):
    rnd = random.Random(seed)
    vocab = [f"q{i}" for i in range(200)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.choice((3, 5, 12, 30, 45))))) for i in range(12)]
    rows = []
    for d in range(160):
        w = [rnd.choice(vocab) for _ in range(rnd.randrange(0, 90))]
        if d % 2:
            leak = rnd.choice(items)[1].split()
            for _ in range(rnd.choice((0, 0, 1, 2, 6))):
                leak[rnd.randrange(len(leak))] = "edit"
            if d % 5 == 0:
                leak = leak[:len(leak) * 3 // 4]
            at = rnd.randrange(len(w) + 1)
            text = " ".join(w[:at] + leak + w[at:])
            rows.append((d, text.upper().replace(" ", ", ") if d % 3 == 0 else text))
        else:
            rows.append((d, " ".join(w)))
    return rows, items + [items[4], (99, None), (100, " . ")]


def result(df, bench, **kw):
    return sorted(((r.doc_id, r.item_id, round(r.similarity, 9)) for r in D.contaminated(df, bench, **kw).collect()), key=str)


def test_against_all_windows(spark):
    rows, items = corpus()
    exp = plain(rows, [(i, b) for i, b in items if b])
    assert len(exp) > 20
    assert result(documents(spark, rows).repartition(4), make(spark, items)) == exp
    # the same in blocks of three items
    assert result(documents(spark, rows), make(spark, items), block_items=3) == exp


def test_edges(spark, edges, nothing):
    items = [(1, "one two"), (2, "no id at all here"), (3, D.plain_words(b"w1x1 w2x2 w3x3 w4x4 w5x5 w6x6 w7x7").decode())]
    assert result(edges, make(spark, items)) == plain([(r.doc_id, r.text) for r in edges.collect()], items)
    assert D.contaminated(nothing, make(spark, items)).collect() == []
    assert D.contaminated(edges, make(spark, [])).collect() == []


def test_tables_return_every_fingerprint_in_the_radius():
    rnd = random.Random(4)
    texts = [" ".join(f"z{rnd.randrange(60)}" for _ in range(20)) for _ in range(30)]
    for radius, blocks in ((24, 8), (5, 4), (10, 16), (0, 8)):
        own = D.Benchmark(list(enumerate(texts)), radius=radius, blocks=blocks).classes[0]
        near = np.array([int(f) ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(0, 30))) for f in own.fingerprint], np.uint64)
        got = {(int(w), int(i)) for w, i, _ in zip(*own.near(near, radius))}
        exp = {(w, i) for w, f in enumerate(near) for i, g in enumerate(own.fingerprint) if (int(f) ^ int(g)).bit_count() <= radius}
        assert got == exp
