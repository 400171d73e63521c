"""Ids of slices against the tokenizers library."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripcohorts.llm import wordids

FILES = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "word_bpe_49k.json")]
RULES = {file: Tokenizer.from_file(file) for file in FILES}
COMMON = st.text("abelrstvdm AT'’  \n\t\r019.,-_é«ÀŸİ€§×<|", max_size=40)


def _check(file: str, texts: list[str]) -> None:
    ids, bounds = wordids.word_ids(file).encode(pa.array(texts, pa.string()))
    assert len(bounds) == len(texts) + 1 and bounds[-1] == len(ids)
    for place, text in enumerate(texts):
        assert ids[bounds[place] : bounds[place + 1]].tolist() == RULES[file].encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("file", FILES)
@settings(max_examples=500, deadline=None)
@given(texts=st.lists(st.one_of(COMMON, st.text(max_size=20)), min_size=1, max_size=6))
def test_slices_are_exact(file, texts):
    _check(file, texts)


@pytest.mark.parametrize("file", FILES)
def test_borders(file):
    _check(file, ["", "it's 'll'll''s  x", "'", " 's", "s", "\n's\n", "a  \n", "  ", " ", "\n\n a", "'r", "e've", "12 3", "", "<|endoftext|> a", "A<", "| b"])


@pytest.mark.parametrize("file", FILES)
def test_a_full_memory_forgets_what_is_not_met_again(file, monkeypatch):
    monkeypatch.setattr(wordids, "REMEMBERED_WORDS", 3)
    coder = wordids.WordIds(file)
    for text in ("one two three four five", "six seven eight one", "one two", "nine ten six five four", "one six"):
        ids, _ = coder.encode(pa.array([text]))
        assert np.array_equal(ids, RULES[file].encode(text, add_special_tokens=False).ids)
    assert len(coder.known) == len(coder.count) == len(coder.first) == len(coder.met) < 12
