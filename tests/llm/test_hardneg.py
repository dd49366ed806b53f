from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import hardneg

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, vector int, `_n` int"


def slow(rows, anchor, positives=5, negatives=3):
    """Every anchor against every row."""
    best = {}
    for i, v, g, *_ in rows:
        if i is None or g is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in v]
        best[i] = min(best.get(i, (g, q)), (g, q))
    out = []
    for a, (label, va) in best.items():
        if not anchor(a):
            continue
        score = {i: sum(x * y for x, y in zip(va, v)) for i, (_, v) in best.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if best[i][0] == label][:positives]:
            inside = [i for i in order if best[i][0] != label and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out += [(a, p, r, i, score[p], score[i]) for r, i in enumerate(inside[:negatives], 1)]
    return sorted(out)


def run(spark, rows, every=5, **kw):
    df = spark.createDataFrame([(i, v, g, "x", 1, 2) for i, v, g in rows], SCHEMA)
    got = hardneg.hard_negatives(df, F.col("id") % every == 0, **kw)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


def vectors(seed, n, width, labels, copies=0):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(0, 0.3, width).astype(np.float32).tolist(), int(rng.integers(labels))) for i in range(n)]
    return rows + [(n + i, rows[0][1], int(rng.integers(labels))) for i in range(copies)]


@pytest.mark.parametrize("chunk,block,groups", [(8, 4, 1), (16, 100, 3), (8192, 16384, 12)])
def test_matches_brute_force(spark, monkeypatch, chunk, block, groups):
    """Few rows a chunk, many blocks, ties from copies of one vector (a third of all rows)."""
    monkeypatch.setattr(hardneg, "CHUNK", chunk)
    monkeypatch.setattr(hardneg, "BLOCK", block)
    monkeypatch.setattr(hardneg, "GROUPS", groups)
    rows = vectors(chunk, 80, 6, 3, copies=40)
    assert run(spark, rows) == slow(rows, lambda i: i % 5 == 0) != []


def test_edge_rows(spark):
    """Nulls anywhere, non-finite components, unequal widths, empty and zero vectors, repeated rows and ids."""
    rows = vectors(1, 40, 4, 2)
    rows += [(None, [0.1] * 4, 1), (100, None, 1), (105, [0.1, None, 0.2, 0.3], 1), (110, [float("nan")] * 4, 0)]
    rows += [(115, [float("inf"), 0.0, 0.0, 0.0], 0), (120, [0.2] * 4, None), (125, [], 1), (130, [0.0] * 4, 1)]
    rows += [(135, [0.5, -0.5], 0), (140, [0.4] * 7, 1), rows[3], rows[3], (5, [0.9] * 4, 0), (145, [0.1] * 4, 7)]
    assert run(spark, rows) == slow(rows, lambda i: i % 5 == 0)


def test_counts_are_parameters(spark):
    rows = vectors(2, 60, 5, 2)
    assert run(spark, rows, positives=2, negatives=7) == slow(rows, lambda i: i % 5 == 0, 2, 7)


def test_empty_and_without_anchors(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [0.1], 1), (2, [0.1], 2)]) == []


def test_inexact_scores_are_refused():
    big = np.full((2, 3), 2.0**30)
    with pytest.raises(ValueError, match="too large"):
        hardneg._check_exact(big, hardneg.Chunk(np.arange(2), np.zeros(2, np.int64), big))


def test_walk_stops_early_and_threshold_bounds_unseen_rows():
    """With one dominant dimension only a part of the chunk is scored."""
    rng = np.random.default_rng(0)
    matrix = np.c_[rng.integers(-1000, 1000, 2000), rng.integers(-3, 3, (2000, 3))].astype(float)
    chunk = hardneg.Chunk(np.arange(2000), np.zeros(2000, np.int64), matrix)
    anchor = np.array([50.0, 1.0, 0.0, -1.0])
    limits, seen = chunk.thresholds(anchor[None])[0], set()
    for rows, limit in chunk.walk(anchor, limits, 0):
        seen |= set(rows.tolist())
        rest = [i for i in range(2000) if i not in seen]
        assert not rest or (matrix[rest] @ anchor).max() <= limit
    state = hardneg._Positives(3, np.array([-1]), np.array([0]), anchor[None], [None])
    scored = []
    product, chunk.product = chunk.product, lambda a, r: scored.extend(r.tolist()) or product(a, r)
    state.see(chunk)
    assert len(scored) < 200 and state.best[0][0].tolist() == sorted((matrix @ anchor).astype(int), reverse=True)[:3]
