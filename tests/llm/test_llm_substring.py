"""Substring dedup against a dictionary of all windows."""

import hashlib
import random

import numpy as np
from llm_fixtures import documents, edges, nothing  # noqa: F401

from barforge.llm import substring as S


def plain(rows, window=20):
    """(doc_id, n_words, n_removed, sha256) in document order; a repeated row is the same document."""
    docs = sorted({(d is None, d or 0, hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest(), t or "") for d, t in rows},
                  key=lambda x: x[:2])
    seen, out = set(), {}
    for no_id, d, h, t in docs:
        w, gone = t.encode().split(), set()
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            if key in seen:
                gone.update(range(i, i + window))
            seen.add(key)
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[None if no_id else d, h] = len(w), len(gone), hashlib.sha256(kept).hexdigest()
    return sorted(((d, *out[d, hashlib.sha256(b" ".join((t or "").encode().split())).hexdigest()]) for d, t in rows), key=str)


def result(df, **kw):
    summary, changed = S.remove_repeats(df, **kw)
    kept = {(r.doc_id, r.digest): r for r in changed.collect()}
    out = []
    for r in summary.collect():
        c = kept.get((r.doc_id, r.digest))
        sha = S.EMPTY if r.state == "copy" else hashlib.sha256(c.kept).hexdigest() if c else r.digest
        out.append((r.doc_id, r.n_words, r.n_removed, sha))
        if c:
            assert sum(s.end - s.first for s in c.spans) == r.n_removed
    return sorted(out, key=str)


def corpus(n, seed=3):
    rnd = random.Random(seed)
    vocab = [f"v{i}" for i in range(400)]
    passages = [[rnd.choice(vocab) for _ in range(rnd.choice((19, 20, 21, 35, 80)))] for _ in range(6)]
    rows = []
    for i in range(n):
        w = []
        for _ in range(rnd.randrange(1, 5)):
            w += [rnd.choice(vocab) for _ in range(rnd.randrange(0, 60))]
            if rnd.random() < 0.6:
                w += rnd.choice(passages)
        if rnd.random() < 0.2:
            w += ["again"] * rnd.randrange(15, 70)
        rows.append((i, " ".join(w)))
    rows += [(n + i, rows[i % 7][1].replace(" ", "\n")) for i in range(12)]
    rnd.shuffle(rows)
    return rows


def test_edges(edges, nothing):
    # two texts share id 8; both are short, so their order does not matter
    assert result(edges) == plain([(r.doc_id, r.text) for r in edges.collect()])
    summary, changed = S.remove_repeats(nothing)
    assert summary.collect() == [] and changed.collect() == []


def test_against_all_windows(spark):
    rows = corpus(120)
    assert result(documents(spark, rows).repartition(6)) == plain(rows)


def test_wide_prefix_groups_give_the_same(spark):
    rows = corpus(60, seed=9)
    assert result(documents(spark, rows).repartition(4), group_suffixes=2) == plain(rows)


def test_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(S, "PART_WORDS", 64)
    rnd = random.Random(1)
    text = " ".join(f"p{rnd.randrange(50)}" for _ in range(500)).encode()
    (_, starts, places, grams, words), = S._by_text([text], 20, 5)
    assert sorted(set(starts.tolist())) == list(range(481))
    monkeypatch.setattr(S, "PART_WORDS", 1 << 20)
    (_, s2, p2, g2, _), = S._by_text([text], 20, 5)
    whole = dict(zip(s2.tolist(), zip(p2.tolist(), g2.tolist())))
    assert all(whole[s] == (p, g) for s, p, g in zip(starts.tolist(), places.tolist(), grams.tolist()))
    assert np.all(p2 >= s2) and np.all(p2 <= s2 + 15)
