"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None, size: int) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def components(texts: dict[int, str | None], size: int, percent: int) -> dict[int, int]:
    """Smallest id that links reach, over all pairs."""
    sets = {i: shingles(t, size) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: find(i) for i in texts}


def repeats(texts: list[str | None], length: int) -> list[tuple[int, int, str]]:
    """Removed bytes, runs, and hash of the rest, window by window."""
    coded = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for data in coded:
        for at in range(len(data) - length + 1):
            window = data[at : at + length]
            seen[window] = seen.get(window, 0) + 1
    result = []
    for data in coded:
        gone = [False] * len(data)
        for at in range(len(data) - length + 1):
            if seen[data[at : at + length]] > 1:
                gone[at : at + length] = [True] * length
        rest = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        result.append((sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return result


def quality_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    seen: set[str] = set()
    duplicates = 0
    for line in text.split("\n"):
        if WORD.search(line):
            duplicates += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), duplicates, len(covered)


def base_spans(text: str | None) -> str:
    text = text or ""
    assign = r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    spans = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in re.finditer(assign, text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(s for _, _, s in sorted(spans))
