"""Likeness of texts that repeat themselves."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tripcohorts.llm import fingerprints


def _noise(chance: random.Random, size: int) -> str:
    return "".join(chance.choice("abcdefghijklmnop ") for _ in range(size))


def test_repeats_count_each_time():
    chance = random.Random(6)
    passage = _noise(chance, 500)
    text = passage * 100
    changed = fingerprints.edited(text, _noise(chance, len(text)))
    once, many, edit = fingerprints.anchors([passage.encode(), text.encode(), changed.encode()])
    assert fingerprints.likeness(many, edit) == pytest.approx(0.75, abs=0.03)
    assert fingerprints.likeness(once, many) < 0.05


@pytest.mark.parametrize("pairs", [0, 10**9])
def test_longest_common_against_the_table(monkeypatch, pairs):
    monkeypatch.setattr(fingerprints, "PAIRS_OF_ANCHOR", pairs)
    chance = np.random.default_rng(3)
    for _ in range(200):
        a, b = (chance.integers(0, 6, chance.integers(0, 30)) for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert fingerprints.longest_common(a, b) == table[-1, -1]
