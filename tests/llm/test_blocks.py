"""Links within a block against all pairs, and large groups of near copies."""

from __future__ import annotations

import time

import numpy as np
import pandas as pd
import pytest

from tripcohorts.llm import neardup


def _table(sets) -> pd.DataFrame:
    return pd.DataFrame({"id": np.arange(len(sets)) * 3 + 5, "shingles": [np.array(sorted(s), np.uint64).tobytes() for s in sets]})


def _components(sets, percent) -> list[int]:
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [find(x) * 3 + 5 for x in range(len(sets))]


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_links_of_a_block(percent):
    chance = np.random.default_rng(percent)
    for size in (1, 2, 5, 7, 20, 60):
        base = chance.integers(0, 1 << 62, (4, size))
        sets = []
        for _ in range(70):
            one = base[chance.integers(0, 4)].copy()
            for place in range(size):
                if chance.random() < chance.choice([0.0, 0.05, 0.15]):
                    one[place] = chance.integers(0, 200)
            sets.append(set(one[: chance.integers(max(1, size - 3), size + 1)].tolist()))
        found = neardup._block_links(_table(sets), percent)
        assert found["a"].tolist() == [x * 3 + 5 for x in range(len(sets))]
        assert found["b"].tolist() == _components(sets, percent)


@pytest.mark.parametrize("edits", [3, 10])
def test_a_large_group_of_near_copies_ends_soon(edits):
    """As many sets of 300 shingles as a block holds; before, the time grew with the square."""
    chance = np.random.default_rng(1)
    base = chance.integers(0, 1 << 62, 300, dtype=np.int64)
    rows = []
    for _ in range(14_000):
        one = base.copy()
        one[chance.integers(0, 300, edits)] = chance.integers(0, 1 << 62, edits)
        rows.append(np.unique(one.astype(np.uint64)).tobytes())
    start = time.perf_counter()
    found = neardup._block_links(pd.DataFrame({"id": np.arange(len(rows)), "shingles": rows}), 85)
    assert time.perf_counter() - start < 20
    assert (found["b"] == 0).all()


def test_no_sets():
    assert len(neardup._block_links(_table([]), 85)) == 0
