"""BPE and packing against the tokenizers library."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tripcohorts.llm import bpe, packing

WORDS, BYTES = (public_tokenizers.path(name) for name in ("word_bpe_49k.json", "byte_bpe_50k.json"))
WORD_RULES, BYTE_RULES = Tokenizer.from_file(WORDS), Tokenizer.from_file(BYTES)


def _expected(text: str | None) -> tuple[bytes, str]:
    ids = WORD_RULES.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), WORD_RULES.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.text("aabtheinr '</w>_!éßÀ1", max_size=40)), min_size=1, max_size=5))
def test_bpe_is_exact(texts):
    for text, (ids, decoded) in zip(texts, bpe.coder(WORDS).encode(texts), strict=True):
        assert (ids, decoded.decode()) == _expected(text)


def test_words_that_fail_the_check_are_merged():
    merges = bpe.coder(WORDS).merges
    words = [b"thththin", b"aaaaaaa", b"ererer", "éàü".encode()]
    proposed, _ = merges.encode_words(words)
    assert len(proposed)
    for word in words:
        tokens, ends = merges.encode_words([word])
        assert tokens.tolist() == WORD_RULES.encode(word.decode(), add_special_tokens=False).ids


def test_digests_of_documents(documents, odd_documents, no_documents):
    for frame in (documents, odd_documents):
        found = sorted(map(tuple, bpe.encode_digests(frame, WORDS).collect()), key=str)
        wanted = []
        for row in frame.collect():
            ids, decoded = _expected(row["text"])
            wanted.append((row["doc_id"], len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
        assert found == sorted(wanted, key=str)
    assert bpe.encode_digests(no_documents, WORDS).count() == 0


def test_encoded_documents_carry_ids_and_text(documents):
    rows = bpe.encode_documents(documents.limit(20), WORDS).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    for row in rows:
        assert (bytes(row["ids"]), row["decoded"]) == _expected(texts[row["doc_id"]])


def _check_packing(frame) -> float:
    pieces = packing.pack_documents(frame, BYTES).collect()
    ids = Counter()
    for row in frame.collect():
        coded = np.array([*BYTE_RULES.encode(row["text"] or "", add_special_tokens=False).ids, 1], "<u4")
        for start in range(0, len(coded), packing.CAPACITY):
            piece = coded[start : start + packing.CAPACITY]
            ids[row["doc_id"], start, len(piece), zlib.crc32(piece.tobytes()), len(coded)] += 1
    assert ids == Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in pieces)
    used: dict[int, list[tuple[int, int]]] = {}
    for r in pieces:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
    return 1 - sum(r["length"] for r in pieces) / packing.CAPACITY / len(used)


def test_packing(documents, odd_documents, no_documents):
    assert _check_packing(documents) < 0.02
    _check_packing(odd_documents)
    assert packing.pack_documents(no_documents, BYTES).count() == 0


@pytest.mark.parametrize("groups", [1, 7])
def test_ranks_are_complete(spark, groups):
    pieces = spark.range(500).selectExpr("id div 2 doc_id", "0L start", "id % 3 length")
    ranks: dict[int, list[int]] = {}
    for row in packing.ranked(pieces, groups).collect():
        ranks.setdefault(row["length"], []).append(row["rank"])
    assert all(sorted(r) == list(range(len(r))) for r in ranks.values())


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=20))
def test_patterns_hold_the_histogram(histogram):
    patterns = packing.shortest_pack_first(histogram, 64)
    held = Counter()
    for pattern in patterns:
        assert pattern.free == 64 - sum(length * n for length, n in pattern.runs) >= 0
        for length, n in pattern.runs:
            held[length] += n * pattern.count
    assert held == histogram
