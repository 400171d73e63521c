"""Maximal segments one by one, and in time that grows with the text."""

from __future__ import annotations

import time

import numpy as np
import pytest

from tripcohorts.llm import toxicity


def _plain(line: list[int], a: int, b: int) -> list[tuple[int, int, int]]:
    """The best segment of line[a:b], the shortest and then first one of equal ones; then left and right of it."""
    best = max(((sum(line[i : j + 1]), i - j, -i, j) for i in range(a, b) for j in range(i, b)), default=(0, 0, 0, 0))
    if best[0] <= 0:
        return []
    i, j = -best[2], best[3]
    return [*_plain(line, a, i), (best[0], i, j), *_plain(line, j + 1, b)]


def test_every_segment_is_that_of_the_definition():
    chance = np.random.default_rng(0)
    for _ in range(400):
        # sums of different powers leave no ties
        scores = np.where(chance.random(12) < 0.5, 2.0 ** -np.arange(12) + chance.integers(1, 4, 12), 0)
        places = np.flatnonzero(scores)
        drift = -1.0 - 2.0**-20
        line = np.where(scores > 0, scores, drift).tolist()
        found = toxicity.maximal_segments(places, scores[places], drift)
        wanted = _plain(line, 0, 12)
        assert [(a, b) for _, a, b in found] == [(a, b) for _, a, b in wanted]
        assert [s for s, _, _ in found] == pytest.approx([s for s, _, _ in wanted])


@pytest.mark.parametrize("gap", [1, 2, 50, 1000])
def test_a_million_hits_end_soon(gap):
    places = np.arange(1_000_000) * gap
    start = time.perf_counter()
    found = toxicity.maximal_segments(places, np.full(len(places), 1.0), -0.05)
    assert time.perf_counter() - start < 6
    assert sum(s for s, _, _ in found) > 0
