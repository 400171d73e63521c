"""BPE encoding and decoding by speculation and verification.

A greedy longest match proposes the tokens of each distinct word. A proposal equals the result
of the merges exactly if every two neighbours are compatible, that is, if the merges keep the
border between them when they run over just these two tokens. All neighbours of a batch are
tested together with numpy; only words with a failing pair are merged step by step.

Edge cases: a null or empty text has no tokens and decodes to an empty text. Strings of special
tokens inside a text become these tokens, as in the tokenizers library. Repeated rows give
repeated results; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcohorts.llm.common import map_texts, text_of

#: Words that a worker remembers; past it the memory starts anew.
REMEMBERED_WORDS = 250_000

#: Texts of these characters only are lower-cased and split with `re`; others by the tokenizer's own rules.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
_UNUSUAL = re.compile(f"[^\\t\\n\\r\\x20-\\x7e{_LETTERS}«»–—‘’“”…€°§©®·]")
_WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\s{_LETTERS}0-9]+")

#: Symbols of the trie: bytes, and the end of a word.
END, SYMBOLS = 256, 257


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(others)) for b in range(256)]


class Merges:
    """A vocabulary with ranked merges; ids, parts and ranks as arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        size = max(vocab.values()) + 1
        self.special = {token["content"]: token["id"] for token in content["added_tokens"]}
        self.strings = [""] * max(size, *(i + 1 for i in self.special.values()))
        for string, token in [*vocab.items(), *self.special.items()]:
            self.strings[token] = string
        self.rank = np.full(size, -1, np.int64)
        self.left = np.zeros(size, np.int64)
        self.right = np.zeros(size, np.int64)
        self.pair_rank: dict[tuple[int, int], int] = {}
        self.pair_token: dict[tuple[int, int], int] = {}
        spelled: dict[int, tuple[int, ...]] = {}
        for value, char in enumerate(byte_characters()):
            if char in vocab:
                spelled[vocab[char]] = (value,)
            if self.suffix and char + self.suffix in vocab:
                spelled[vocab[char + self.suffix]] = (value, END)
        self.base = np.zeros((2, 256), np.int64)
        for token, (value, *end) in spelled.items():
            self.base[len(end), value] = token
        for rank, (a, b) in enumerate(model["merges"]):
            x, y, token = vocab[a], vocab[b], vocab[a + b]
            self.pair_rank[x, y], self.pair_token[x, y] = rank, token
            if self.rank[token] < 0:
                self.rank[token], self.left[token], self.right[token] = rank, x, y
                spelled[token] = spelled[x] + spelled[y]
        self.size = size
        keys = np.array([x * size + y for x, y in self.pair_rank], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.fromiter(self.pair_rank.values(), np.int64, len(keys))[order]
        self.made = np.fromiter(self.pair_token.values(), np.int64, len(keys))[order]
        self._grow(spelled)

    def _grow(self, spelled: dict[int, tuple[int, ...]]) -> None:
        """A trie of all spellings as sorted (node, symbol) keys."""
        children: dict[int, int] = {}
        token_at = {}
        for token, symbols in spelled.items():
            node = 0
            for symbol in symbols:
                node = children.setdefault(node * SYMBOLS + symbol, len(children) + 1)
            token_at[node] = token
        edges = np.fromiter(children.keys(), np.int64, len(children))
        order = np.argsort(edges)
        self.edges, self.child = edges[order], np.fromiter(children.values(), np.int64, len(children))[order]
        self.token_at = np.full(len(children) + 1, -1, np.int64)
        self.token_at[list(token_at)] = list(token_at.values())

    def propose(self, symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match from the left in all words at once: (word, token), word by word."""
        words, tokens = [], []
        active, at = np.arange(len(starts)), starts.copy()
        while len(active):
            node, place, stop = np.zeros(len(active), np.int64), at[active], ends[active]
            found, reached = np.full(len(active), -1), place.copy()
            alive = np.arange(len(active))
            while len(alive):
                edge = node[alive] * SYMBOLS + symbols[place[alive]]
                index = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
                hit = self.edges[index] == edge
                alive = alive[hit]
                node[alive] = self.child[index[hit]]
                place[alive] += 1
                token = self.token_at[node[alive]]
                # the last character and the end of the word belong together
                whole = (token >= 0) & (place[alive] != stop[alive] - 1) if self.suffix else token >= 0
                found[alive[whole]], reached[alive[whole]] = token[whole], place[alive[whole]]
                alive = alive[place[alive] < stop[alive]]
            words.append(active)
            tokens.append(found)
            at[active] = reached
            active = active[reached < stop]
        word, token = np.concatenate(words), np.concatenate(tokens)
        order = np.argsort(word, kind="stable")
        return word[order], token[order]

    def compatible(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether the merges keep the border between two tokens.

        Goes back in time: the part at the border that was made last is taken apart, and at each
        step a merge across the border must not come before the one that used up either part.
        """
        never = np.iinfo(np.int64).max
        good = np.ones(len(first), bool)
        rows = np.arange(len(first))
        x, y = first.astype(np.int64), second.astype(np.int64)
        until_x, until_y = np.full(len(x), never), np.full(len(x), never)
        while len(rows):
            key = x * self.size + y
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(self.keys[at] == key, self.ranks[at], never)
            # at equal rank the merge further left comes first
            crossed = (rank < until_x) & (rank <= until_y) & (rank < never)
            good[rows[crossed]] = False
            rank_x, rank_y = self.rank[x], self.rank[y]
            on = ~crossed & ((rank_x >= 0) | (rank_y >= 0))
            apart_x = rank_x > rank_y
            until_x = np.where(apart_x, rank_x, until_x)[on]
            until_y = np.where(apart_x, until_y, rank_y)[on]
            x, y = np.where(apart_x, self.right[x], x)[on], np.where(apart_x, y, self.left[y])[on]
            rows = rows[on]
        return good

    def merge(self, word: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The merges one by one in each word, lowest rank first, from the left; from single characters."""
        done = []
        while len(word):
            key = token[:-1] * self.size + token[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = (self.keys[at] == key) & (word[:-1] == word[1:])
            rank = np.append(np.where(known, self.ranks[at], len(self.keys)), len(self.keys))
            first = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            sizes = np.diff(np.append(first, len(word)))
            lowest = np.repeat(np.minimum.reduceat(rank, first), sizes)
            over = lowest == len(self.keys)
            done.append((word[over], token[over]))
            best = np.flatnonzero((rank == lowest) & ~over)
            best = best[np.append(True, word[best][1:] != word[best][:-1])] if len(best) else best
            token[best] = self.made[at[best]]
            over[best + 1] = True
            word, token = word[~over], token[~over]
        word, token = (np.concatenate(parts) for parts in zip(*done, strict=True))
        order = np.argsort(word, kind="stable")
        return word[order], token[order]

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words, one after the other, and where each word's tokens end.

        Proposed together, verified together, merged where that fails.
        """
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + bool(self.suffix)
        ends = np.cumsum(sizes)
        symbols = np.full(ends[-1], END, np.int64)
        last = np.zeros(ends[-1], bool)
        last[ends - 1] = bool(self.suffix)
        symbols[~last] = np.frombuffer(b"".join(words), np.uint8)
        word, token = self.propose(symbols, ends - sizes, ends)
        inside = np.flatnonzero(word[1:] == word[:-1])
        pairs, which = np.unique(token[inside] * self.size + token[inside + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)[which]
        failed = np.zeros(len(words), bool)
        failed[word[inside[~good]]] = True
        if failed.any():
            of = np.repeat(np.arange(len(words)), sizes)
            here = failed[of] & ~last
            closing = np.append(last[1:], False)
            again = self.merge(of[here], self.base[closing.astype(int)[here], symbols[here]])
            kept = ~failed[word]
            word, token = np.concatenate([word[kept], again[0]]), np.concatenate([token[kept], again[1]])
            order = np.argsort(word, kind="stable")
            word, token = word[order], token[order]
        return token, np.cumsum(np.bincount(word, minlength=len(words)))


class Coder:
    """Encodes and decodes whole texts as the tokenizers library does with the same file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.merges = Merges(path)
        rules = Tokenizer.from_file(path)
        self.normalizer, self.splitter = rules.normalizer, rules.pre_tokenizer
        self.special = re.compile("(" + "|".join(map(re.escape, self.merges.special)) + ")")
        self.byte_of = {char: value for value, char in enumerate(byte_characters())}
        self.ids: dict[str, bytes] = {}
        self.decoded: dict[str, bytes] = {}
        self.strings = [string.encode() for string in self.merges.strings]

    def words(self, text: str) -> list[str]:
        if not _UNUSUAL.search(text):
            return _WORDS.findall(text.lower())
        pieces = self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))
        return [bytes(self.byte_of[c] for c in piece).decode("utf-8") for piece, _ in pieces]

    def learn(self, words: set[str]) -> None:
        if len(self.ids) > REMEMBERED_WORDS:
            self.ids.clear()
            self.decoded.clear()
        new = list(words - self.ids.keys())
        tokens, ends = self.merges.encode_words([word.encode() for word in new])
        flat = tokens.astype("<u4").tobytes()
        strings = list(map(self.strings.__getitem__, tokens.tolist()))
        start = 0
        for word, end in zip(new, ends.tolist(), strict=True):
            self.ids[word] = flat[4 * start : 4 * end]
            self.decoded[word] = b" ".join(strings[start:end])
            start = end

    def encode(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Ids as little-endian unsigned 32-bit integers, and the text decoded from them in UTF-8."""
        #: each text as a list of word lists, and strings of special tokens at odd places
        split = []
        for text in texts:
            parts = self.special.split(text) if "<|" in text else [text]
            split.append([part if place % 2 else self.words(part) for place, part in enumerate(parts)])
        self.learn({word for parts in split for part in parts[::2] for word in part})
        return [self._coded(parts) for parts in split]

    def _coded(self, parts: list) -> tuple[bytes, bytes]:
        ids, decoded = [], []
        for place, part in enumerate(parts):
            if place % 2:
                ids.append(self.merges.special[part].to_bytes(4, "little"))
                decoded.append(part.encode())
            elif part:
                ids.append(b"".join(map(self.ids.__getitem__, part)))
                decoded.append(b" ".join(map(self.decoded.__getitem__, part)))
        return b"".join(ids), b" ".join(decoded)


_CODERS: dict[str, Coder] = {}


def coder(path: str) -> Coder:
    """One coder for each worker process and vocabulary."""
    if path not in _CODERS:
        _CODERS[path] = Coder(path)
    return _CODERS[path]


def encode_documents(documents: DataFrame, vocabulary: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its id, `ids` (bytes, little-endian unsigned 32-bit), `decoded` text."""
    kind = documents.schema[id_column].dataType.simpleString()

    def work(part: pa.RecordBatch) -> dict:
        coded = coder(vocabulary).encode(part.column("text").to_pylist())
        return {"id": part.column("id"), "ids": [c[0] for c in coded], "decoded": [c[1].decode() for c in coded]}

    rows = documents.select(F.col(id_column).alias("id"), text_of(text).alias("text"))
    return map_texts(rows, work, f"id {kind}, ids binary, decoded string").withColumnRenamed("id", id_column)


def encode_digests(documents: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document.

    Hashed where the text is encoded, so neither ids nor decoded texts leave the task.
    """

    def work(part: pa.RecordBatch) -> dict:
        sizes, ids_hash, text_hash = [], [], []
        for ids, decoded in coder(vocabulary).encode(part.column("text").to_pylist()):
            sizes.append(len(ids) // 4)
            ids_hash.append(hashlib.sha256(ids).hexdigest())
            text_hash.append(hashlib.sha256(decoded).hexdigest())
        return {"doc_id": part.column("doc_id"), "n_tokens": sizes, "ids_sha256": ids_hash, "decoded_sha256": text_hash}

    rows = documents.select("doc_id", text_of().alias("text"))
    return map_texts(rows, work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
