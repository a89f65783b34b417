"""SimHash near-duplicates against brute force over all pairs."""

import random

import xxhash
from llm_fixtures import documents, edges, nothing  # noqa: F401

from barforge.llm import simhash as S

GAPS = " \t\n\x0b\x0c\r"


def words(text):
    for g in GAPS:
        text = text.replace(g, " ")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).split(" ")


def plain(text, k=3):
    w = [x for x in words(text or "") if x]
    if not w:
        return 0
    grams = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(rows, most=2):
    fps = sorted({plain(t) for _, t in rows})
    root = {f: f for f in fps}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= most:
                root[find(a)] = find(b)
    low = {}
    for d, t in rows:
        if d is not None:
            low[find(plain(t))] = min(d, low.get(find(plain(t)), d))
    return sorted(((d, f"{plain(t):016x}", low.get(find(plain(t)))) for d, t in rows), key=str)


def result(df):
    out = S.near_duplicates(df).select("doc_id", S.hex_fingerprint("fp").alias("f"), "component_id")
    return sorted(map(tuple, out.collect()), key=str)


def near_copies(n):
    rnd = random.Random(5)
    base = [f"t{rnd.randrange(500)}" for _ in range(300)]
    rows = []
    for i in range(n):
        w = list(base) if i % 3 else [f"u{rnd.randrange(500)}" for _ in range(40)]
        if i % 3 and i % 2:
            w[rnd.randrange(300)] = f"edit{i}"
        rows.append((i * 3 % 1009 + 20, " ".join(w)))
    return rows


def test_edges(spark, edges, nothing):
    assert result(edges) == components([(r.doc_id, r.text) for r in edges.collect()])
    assert S.near_duplicates(nothing).collect() == []


def test_near_copies_link(spark):
    rows = near_copies(150)
    got = result(documents(spark, rows).repartition(5))
    assert got == components(rows)
    assert len({c for _, _, c in got}) < len(rows) * 2 // 3


def test_every_link_within_radius_is_found(spark):
    rnd = random.Random(2)
    fps = set()
    for _ in range(25):
        f = rnd.getrandbits(64)
        fps |= {f, f ^ 1 << rnd.randrange(64), f ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64),
                f ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    for most in (2, 3):
        edges = S.links(df, most).collect()
        assert all(((r.src ^ r.dst) & (1 << 64) - 1).bit_count() <= most for r in edges)
        got = {r.node: r.root for r in S.components(S.links(df, most)).collect()}
        for a in signed:
            for b in signed:
                if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= most:
                    assert got[a] == got[b]


def test_long_chain_is_one_component(spark):
    chain = spark.range(1, 400).selectExpr("id AS src", "id - 1 AS dst")
    got = S.components(chain).collect()
    assert len(got) == 400 and {r.root for r in got} == {0}
