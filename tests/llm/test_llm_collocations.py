"""Phrase collocations against a plain count of all word sequences."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from barforge.llm import collocations as C


def brute(rows, least, top, covered=80):
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i:i + k])] += 1
    candidates = {g: f for g, f in counts.items() if f >= least and len(g[1]) > 1}
    dropped = set()
    for (lang, g), f in candidates.items():
        for k in range(2, len(g)):
            for i in range(len(g) - k + 1):
                if 100 * f >= covered * candidates[lang, g[i:i + k]]:
                    dropped.add((lang, g[i:i + k]))
    found = {}
    for (lang, g), a in candidates.items():
        if (lang, g) in dropped:
            continue
        cuts = []
        for k in range(1, len(g)):
            l, r = counts[lang, g[:k]], counts[lang, g[k:]]
            cuts.append((2000000 * a // (l + r), k, l, r))
        score, _, l, r = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), l, r))
    return sorted((lang, i + 1, p.decode(), -a, l, r, total[lang], -s)
                  for lang, rows in found.items() for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top]))


def rows_of(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed=3, n=400):
    rng = random.Random(seed)
    words = ["the", "of", "To", "ärger", "naïve", "x", "longer-than-eight-bytes", "longer-than-eight-bytez", " ", "quick brown", "日本 語"]
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "de", None, "und", ""])
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".\n", " ! "]) for _ in range(rng.randint(0, 60)))
        rows.append((text, lang))
    # one passage in a third of all rows
    rows += [("One same passage of the text. Of the", "en")] * (n // 2)
    return rows + [(None, "en"), ("", None), (" \t.,", "fr"), ("a b " * 3000, "en"), ("y", "en")]


@pytest.mark.parametrize("budget,least,top", [(C.BUDGET, 5, 2000), (50, 3, 2000), (400, 8, 7)])
def test_equals_brute_force(spark, budget, least, top, monkeypatch):
    monkeypatch.setattr(C, "MAX_EXTENDED", 1 << 40)
    rows = corpus(n=400 if budget > 50 else 120)
    docs = spark.createDataFrame([(t, l, 1, "x", i) for i, (t, l) in enumerate(rows)], "text string, lang string, a int, h string, n int").repartition(5)
    got = rows_of(C.collocations(docs, least=least, top=top, budget=budget))
    assert got == brute(rows, least, top) and got


def test_prefixes_over_the_budget_are_extended(spark):
    """A budget far below the counts lays the suffixes out in many groups, by
    prefixes of several words."""
    rows = [("u v w x y. " * 300, "en")] * 4
    texts = C._read(spark.createDataFrame(rows, "text string, lang string"), "text", "lang")
    counts = C.word_counts(texts, 0)
    layout = C.Layout(0, C._bit_table(counts), least=3)
    over = C._vertical_partition(texts, counts, layout, 100)
    assert [len(keys) for keys, _, _ in layout.extended] == [5, 4, 3]
    assert sorted((r["size"], r["a"], r["l1"], r["l2"]) for r in over.collect()) == [(2, 1200, 1200, 0)] * 4 + [(3, 1200, 1200, 1200)] * 3
    layout = C.Layout(0, C._bit_table(counts), least=3)
    assert C._vertical_partition(texts, counts, layout, 1200) is None and len(layout.starts) > 1


def test_words_that_share_a_hash_start_again(spark, monkeypatch):
    plain = C.tokens

    def clashing(data, seed):
        raw, words, first, end, piece = plain(data, seed)
        return raw, (words & np.uint64(7) if seed % 2 == 0 else words), first, end, piece

    raw, words, first, end, _ = clashing(b"alpha beta alpha gamma delta epsilon zeta eta theta iota", 0)
    _, at, back = np.unique(words, return_index=True, return_inverse=True)
    wrong = C._differ(raw, first, end, at[back])
    spelled = [bytes(raw[a:b]) for a, b in zip(first, end)]
    assert [spelled[i] != spelled[at[back[i]]] for i in range(len(spelled))] == wrong.tolist() and wrong.any()
    batch = __import__("pyarrow").RecordBatch.from_pylist([{"lang": "en", "text": b"a b c d e f g h i j k l m a b"}])
    monkeypatch.setattr(C, "tokens", lambda data, seed: (lambda t: (t[0], t[1] & np.uint64(3), *t[2:]))(plain(data, seed)))
    rows = [r for b in C._count_words(iter([batch]), C.Layout(0)) for r in b.to_pylist()]
    counted = Counter()
    for r in rows:
        counted[r["word"]] += r["n"]
    assert counted == Counter(b"a b c d e f g h i j k l m a b".split())
    assert len({r["h"] for r in rows}) < len(counted)


def test_long_texts_are_cut_at_pieces(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(C, "SLICE", 64)
    text = b". ".join(b"w%d v%d" % (i, i) for i in range(200)) + b" " + b"long" * 100
    parts = [data for _, _, data in C._text_slices(iter([pa.RecordBatch.from_pylist([{"lang": "en", "text": text}])]), 0)]
    assert len(parts) > 10 and b"".join(parts).replace(b"\n", b"") == text


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert C.collocations(docs).collect() == []


def test_large_counts_are_exact(spark):
    """Products of counts and the scale pass 64 bits."""
    big = 9_000_000_000_000
    nodes = spark.createDataFrame([("en", 1, 2, 0, 0, 2, big, big + 1, 0, 0)], C.NODES)
    words = spark.createDataFrame([("en", "u", 1, big + 1), ("en", "v", 2, big + 3)], "lang string, word string, h long, f long")
    row = C._scored(C._not_covered(nodes, 80), nodes, words).first()
    assert row["score"] == 2000000 * big // (2 * big + 4)
