"""Hard negatives against all pairs."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tripcohorts.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, key string, leaf string, part long, score double"


def _frame(spark, rows):
    return spark.createDataFrame([(*row, "x", "y", 1, 0.5) for row in rows], SCHEMA)


def brute(rows, every=100):
    """The contract, row by row."""
    kept = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        ints = [math.floor(256 * float(np.float32(x))) for x in vector]
        kept.append((vec_id, ints, (label + 1) % 10 if vec_id % 7 == 0 else label))
    result = []
    for at, (anchor, vector, label) in enumerate(kept):
        if anchor % every:
            continue
        scored = [(-sum(a * b for a, b in zip(vector, v)), i, other) for place, (i, v, other) in enumerate(kept) if place != at]
        scored.sort(key=lambda s: s[:2])
        for positive, positive_id, _ in [s for s in scored if s[2] == label][:5]:
            positive = -positive
            inside = [s for s in scored if s[2] != label and 30 * positive <= -100 * s[0] <= 90 * positive]
            for rank, (score, i, _) in enumerate(inside[:10], 1):
                result.append((anchor, positive_id, rank, i, positive, -score))
    return sorted(result)


def _clustered(count: int, seed: int, width: int = 6):
    random.seed(seed)
    centres = [[random.gauss(0, 0.5) for _ in range(width)] for _ in range(12)]
    return [
        (i, [float(np.float32(c + random.gauss(0, 0.1))) for c in random.choice(centres)], random.randrange(10))
        for i in range(count)
    ]


@pytest.fixture(params=["one leaf", "many leaves and parts"])
def sizes(request, monkeypatch):
    if request.param != "one leaf":
        for name, value in {"FAN_OUT": 4, "LEAF_SAMPLE": 10, "ROWS_TOGETHER": 20, "ANCHORS_TOGETHER": 2, "FIRST_LEAVES": 2, "AT_A_TIME": 3}.items():
            monkeypatch.setattr(negatives, name, value)


def _found(frame, **options):
    return sorted(map(tuple, negatives.mine(frame, **options).collect()))


def test_clusters(spark, sizes):
    rows = _clustered(700, 1)
    wanted = brute(rows, 50)
    assert wanted and _found(_frame(spark, rows), every=50) == wanted


def test_odd_rows(spark, sizes):
    same = [0.5, 0.25, -0.125]
    rows = [
        (0, same, 6), (0, same, 6), (100, None, 1), (200, same, None), (None, same, 1), (300, [0.1, None, 0.2], 3),
        (400, [0.1, float("nan"), 0.2], 3), (500, [0.1, float("inf"), 0.2], 3), (600, [], 3), (700, [0.5], 3),
        (-100, [-0.5, 0.0, 0.0], 3), (800, [0.0, 0.0, 0.0], 3),
    ]
    rows += [(1000 + i, same, i % 4) for i in range(60)]
    rows += [(2000 + i, [0.25, 0.125, 0.0], i % 4) for i in range(60)]
    rows += [(5, same, 3)] * 12
    wanted = brute(rows)
    assert wanted and _found(_frame(spark, rows)) == wanted


def test_no_rows(spark):
    assert _found(_frame(spark, [])) == []
    assert _found(_frame(spark, [(100, None, 1)])) == []
    assert _found(_frame(spark, [(1, [0.5], 1), (2, [0.5], 2)])) == []
    assert _found(_frame(spark, [(100, [], 1), (2, [], 1), (3, [], 2)])) == [(100, 2, 1, 3, 0, 0)]


def test_large_components_are_exact(spark):
    rows = [(i, [1000.0 * (i % 13) + i, 30_000.0 - i, 5.0 * i], i % 3) for i in range(120)]
    assert _found(_frame(spark, rows)) == brute(rows)


def test_scores_beyond_doubles_are_exact():
    a, b = np.array([[(1 << 30) + 1, 3]]), np.array([[(1 << 30) + 3, 5], [1, -1]])
    assert negatives._scores(a, b).tolist() == [[((1 << 30) + 1) * ((1 << 30) + 3) + 15, (1 << 30) - 2]]


def test_whole_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert _found(frame) == brute([tuple(r) for r in frame.select("vec_id", "embedding", "label").collect()])


def test_ranges_leave_subtrees_out():
    rows = np.array([[int(256 * x) for x in v] for _, v, _ in _clustered(2000, 3, 4)])
    square = int((rows**2).sum(1).max())
    tree = negatives.Tree(rows, square)
    ranges = {}

    def visit(node, child, distances):
        for point, d in enumerate(distances.T):
            low, high = ranges.get((node, point, child), (np.inf, -np.inf))
            ranges[node, point, child] = min(low, d.min()), max(high, d.max())

    leaf = tree.place(rows.astype(float), visit)
    tree.set_ranges([(*at, *r) for at, r in ranges.items()])
    anchors = rows[:50].astype(float)
    score = rows[:50] @ rows.T
    high = np.sort(score, axis=1)[:, -5:-4]
    low = np.sort(score, axis=1)[:, -15:-14]
    meets, _ = tree.reach(anchors, low, high)
    for a in range(50):
        inside = (score[a] >= low[a]) & (score[a] <= high[a])
        assert meets[a, leaf[inside]].all()
    assert tree.leaves > 20 and meets.mean() < 0.5
