"""Hard negatives against a plain search over all pairs."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barforge.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, row string, score int, anchor string, columns int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, y, "x", 1, "y", 2) for i, v, y in rows], SCHEMA)


def brute(rows, every, positives=5, negatives=3):
    live = [(i, [math.floor(256 * float(np.float32(x))) for x in v], y) for i, v, y in rows
            if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (anchor, v, y) in enumerate(live):
        if anchor % every:
            continue
        score = [(-sum(p * q for p, q in zip(v, w)), i, label, b) for b, (i, w, label) in enumerate(live)]
        near = sorted(s for s in score if s[2] == y and s[3] != a)[:positives]
        for p, i, *_ in near:
            p = -p
            fit = sorted(s for s in score if s[2] != y and 50 * p <= -100 * s[0] <= 95 * p)[:negatives]
            out += [(anchor, i, k + 1, s[1], p, -s[0]) for k, s in enumerate(fit)]
    return sorted(out)


def found(spark, rows, every=5, **more):
    return sorted(tuple(r) for r in H.mine(table(spark, rows).repartition(3), F.col("vec_id") % every == 0, **more).collect())


def vectors(n, seed, wide=12, labels=4, spread=0.3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(wide)] for _ in range(labels)]
    rows = []
    for i in range(n):
        y = rng.randrange(labels)
        rows.append((i, [c * rng.random() + rng.gauss(0, spread) for c in centres[y if rng.random() < 0.7 else rng.randrange(labels)]], y))
    return rows


def test_equals_brute_force(spark):
    rows = vectors(300, 1)
    assert found(spark, rows) == brute(rows, 5) != []


def test_small_blocks_and_many_anchor_blocks(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK_VALUES", 64 * 12)
    monkeypatch.setattr(H, "ANCHOR_VALUES", 12 * 20)
    rows = vectors(400, 2, spread=1.0)
    assert found(spark, rows) == brute(rows, 5) != []


def test_ties_and_repeated_rows(spark):
    rows = [(i % 30, [1.0, 0.5 * (i % 3), 0.25], i % 2) for i in range(90)] + [(-5, [1.0, 0.9, 0.25], 0), (10, [0.7, 0.9, 0.25], 3)]
    assert found(spark, rows) == brute(rows, 5) != []


def test_edges(spark):
    rows = [(0, [1.0, 1.0], 0), (5, [0.9, 1.0], 0), (1, [0.6, 0.7], 1), (2, None, 0), (3, [1.0, None], 1), (4, [1.0, float("nan")], 1),
            (6, [float("inf"), 1.0], 1), (7, [0.9, 0.6], None), (None, [0.9, 0.6], 1), (10, [1.0, 1.0, 5.0], 0), (11, [0.8], 1), (12, [], 1),
            (15, [], 2), (20, [-1.0, -1.0], 5), (21, [1.0, 1.0], 5), (25, [1e6, 1e6], 7), (26, [1e6, 9e5], 7), (27, [5e5, 9e5], 8)]
    assert found(spark, rows) == brute(rows, 5) != []
    assert found(spark, []) == [] and found(spark, [(1, [1.0], 1)]) == []


def test_components_beyond_exact_doubles(spark):
    rows = [(0, [3e6, 1.0], 0), (1, [3e6, 2.0], 0), (2, [2e6, 7.0], 1), (3, [2e6, 6.0], 1)]
    assert found(spark, rows) == [r for r in brute(rows, 5)] != []
    huge = [(0, [3e30, 1.0], 0), (1, [3e30, 2.0], 0), (2, [2e9, 7.0], 1)]
    assert found(spark, huge) == []          # clipped scores, no crash


@pytest.mark.parametrize("wide", [5, 8, 64])
def test_bounds_prune_and_stay_exact(wide):
    """Columns in the order of the anchor's components; few values are read
    where the first columns decide, and no candidate that matters is lost."""
    rng = np.random.default_rng(wide)
    columns = np.floor(rng.normal(0, 40, (wide, 2000)))
    columns[1] *= 20
    anchor = np.floor(rng.normal(0, 40, wide))
    anchor[1] = 900
    true = anchor @ columns
    bar = np.sort(true)[-5]
    seen = []

    def matter(low, high):
        seen.append((low.copy(), high.copy()))
        return high >= bar

    alive, score, read = H.scan(anchor, columns, columns.min(1), columns.max(1), np.arange(2000), matter)
    assert set(alive) == set(np.flatnonzero(true >= bar)) and (score == true[alive]).all()
    low, high = seen[0]
    assert (low <= true).all() and (high >= true).all()
    if wide > H.STEP:
        assert read < 0.5 * columns.size


def test_session_setting_is_restored(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    found(spark, vectors(20, 3))
    assert spark.conf.get(key) == before
