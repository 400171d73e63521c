"""Token ids of whole slices of texts: every distinct word is encoded once, the rest is gathered.

Both tokenizer files split a text into words before they merge, and encode each word by itself.
Here the words of all texts of a slice are found at once by the classes of their bytes, told
apart by Arrow's dictionary encoding, and only those that the worker does not know yet go to the
tokenizers library. The ids of the slice are then one gather from the table of known words.

Texts with characters beyond the common ones, or with the beginning of a special token, are
encoded whole by the library. An empty text has no ids.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tripcohorts.llm.words import text_bytes

#: Words that a worker remembers, some 40 bytes each; past it those not met since the last time are forgotten.
REMEMBERED_WORDS = 400_000

#: New words that the library encodes as one text.
JOINED_WORDS = 256

#: Bytes of text in a slice: looking words up costs something for each word known, too.
SLICE_BYTES = 4 << 20

OTHER, LETTER, DIGIT, SPACE, LINE = range(5)

#: Class of each byte; bytes that go on in a character get that of its first byte.
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[[*range(65, 91), *range(97, 123), 0xC3, 0xC4, 0xC5]] = LETTER
_CLASS[48:58] = DIGIT
_CLASS[32] = SPACE
_CLASS[[9, 10, 13]] = LINE

#: The common characters beyond ASCII, and the endings that an apostrophe starts.
_COMMON = [*range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x130), *range(0x131, 0x180), *map(ord, "«»–—‘’“”…€°§©®·")]
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")

_PLAIN = np.zeros(256, bool)
_PLAIN[[9, 10, 13, *range(32, 127)]] = True
_TWO = np.array(sorted(int.from_bytes(chr(c).encode(), "big") for c in _COMMON if c < 0x800))
_THREE = np.array(sorted(int.from_bytes(chr(c).encode(), "big") for c in _COMMON if c >= 0x800))


def _unusual(data: np.ndarray) -> np.ndarray:
    """Positions of bytes that no common character explains, and of the beginnings of special tokens."""
    high = np.flatnonzero(~_PLAIN[data])
    bytes_ = np.append(data, np.zeros(3, np.uint8)).astype(np.int64)
    first = bytes_[high]
    two = first << 8 | bytes_[high + 1]
    lead = np.isin(two, _TWO)
    triple = (first >= 0xE0) & np.isin(two << 8 | bytes_[high + 2], _THREE)
    goes_on = (first >= 0x80) & (first < 0xC0)  # its first byte is looked at instead
    special = np.flatnonzero((data == 60) & (bytes_[1 : len(data) + 1] == 124))
    return np.append(high[~(lead | triple | goes_on)], special)


def _classes(data: np.ndarray) -> np.ndarray:
    """The class of each byte's character."""
    found = _CLASS[data]
    goes_on = np.flatnonzero((data >= 0x80) & (data < 0xC0))
    for _ in range(2):  # two bytes may follow the first
        found[goes_on] = found[goes_on - 1]
    return found


class WordIds:
    """Ids by a word-splitting tokenizer file; one object for each worker process."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel work
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: whether a word keeps the space before it, and case; otherwise white space has no ids
        self.spaced = bool(self._library([" "])[0])
        #: ids that stand between words or end them, in texts made of many words
        self.newline = self._library(["\n"])[0][0] if self.spaced else None
        self.ending = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.ending[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith("</w>")]] = True
        #: word by word: spelling, number of ids, place of the first in `table`, whether met of late
        self.known = pa.array([], pa.large_binary())
        self.count, self.first, self.met = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
        self.table = np.zeros(0, np.uint32)

    def _forget(self) -> None:
        """Keeps only the words met since the last time."""
        kept = np.flatnonzero(self.met)
        self.table, ends = self._gather(kept)
        self.known, self.count = self.known.take(pa.array(kept)), self.count[kept]
        self.first, self.met = ends - self.count, np.zeros(len(kept), bool)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [c.ids for c in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _borders(self, data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Where words begin, white space included; `begins` holds the beginnings of texts and the end."""
        start, last = begins[:-1], begins[1:]
        kind = _classes(data)
        white = kind >= SPACE
        before = np.where(start, np.uint8(255), np.append(np.uint8(255), kind[:-1]))
        goes_on = (before == SPACE) | (before == LINE)  # white space before it
        if self.spaced:
            followed = ~last & ~np.append(white[1:], True)  # by a word, which takes a space along
            borders = np.where(white, ~goes_on | followed, (kind != before) & (before != SPACE))
        else:
            borders = np.where(white, ~goes_on, (kind != before) | (kind == DIGIT))
        marks = np.flatnonzero((data == 39) & borders)
        padded = np.append(data, np.zeros(3, np.uint8))
        ends_text = np.append(last, [True] * 3)
        for ending in _ENDINGS:
            here = marks
            for place, char in enumerate(ending.encode(), 1):
                here = here[(padded[here + place] == char) & ~ends_text[here + place - 1]]
            borders[here + 1] = False
            after = here + len(ending) + 1
            borders[after[after < len(data)]] = True
        return borders

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a column of texts after each other, and where those of each text start (and end)."""
        data, bounds = text_bytes(column)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(bounds), np.int64)
        if len(self.known) > REMEMBERED_WORDS:
            self._forget()
        begins = np.zeros(len(data) + 1, bool)
        begins[bounds] = True
        odd = np.unique(np.searchsorted(bounds, _unusual(data), side="right") - 1)
        texts = [column[int(i)].as_py() for i in odd]
        data = data.copy()
        for i in odd:
            data[bounds[i] : bounds[i + 1]] = 32
        if not self.spaced:
            data = np.frombuffer(data.tobytes().decode().lower().encode(), np.uint8)
        borders = self._borders(data, begins)
        for i in odd:
            borders[bounds[i] + 1 : bounds[i + 1]] = False
        starts = np.flatnonzero(borders)
        offsets = pa.py_buffer(np.append(starts, len(data)).astype(np.int64))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, offsets, pa.py_buffer(data)])
        whole = np.searchsorted(starts, bounds[odd])  # words that are texts
        which = self._places(words, whole)
        which[whole] = self._added(*self._texts(texts))
        self.met[which] = True
        ids, ends = self._gather(which)
        self._drop(len(odd))
        return ids, np.append(0, ends)[np.searchsorted(starts, bounds)]

    def _places(self, words: pa.Array, whole: np.ndarray) -> np.ndarray:
        """Where the ids of each word are; those of `whole` are not looked up."""
        found = pc.index_in(words, value_set=self.known)
        new = found.is_null().to_numpy(zero_copy_only=False)
        new[whole] = False
        which = found.fill_null(0).to_numpy().astype(np.int64)
        if new.any():
            coded = words.filter(pa.array(new)).dictionary_encode()
            texts = [word.decode() for word in coded.dictionary.to_pylist()]
            white = np.fromiter(map(str.isspace, texts), bool, len(texts))
            order = np.argsort(white, kind="stable")
            plain = len(texts) - int(white.sum())
            texts = [texts[i] for i in order]
            places = np.empty(len(texts), np.int64)
            places[order] = np.append(self._added(*self._words(texts[:plain])), self._added(*self._texts(texts[plain:])))
            self.known = pa.concat_arrays([self.known, coded.dictionary.take(pa.array(order))])
            which[new] = places[coded.indices.to_numpy()]
        return which

    def _texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts after each other, and how many each has."""
        ids = self._library(texts)
        counts = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, counts.sum()), counts

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for words without white space inside, which the library gets in texts of many words."""
        joined = "\n" if self.spaced else " "
        groups = [joined.join(words[i : i + JOINED_WORDS]) for i in range(0, len(words), JOINED_WORDS)]
        end = [self.newline] if self.spaced else []
        ids = np.concatenate([np.zeros(0, np.uint32), *(np.array(each + end, np.uint32) for each in self._library(groups))])
        last = np.flatnonzero(ids == self.newline if self.spaced else self.ending[ids])
        if len(last) != len(words):
            raise ValueError(f"{len(words)} words were encoded as {len(last)}")
        counts = np.diff(np.append(-1, last))
        return (np.delete(ids, last), counts - 1) if self.spaced else (ids, counts)

    def _added(self, flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Places of new rows with these ids."""
        place = len(self.count) + np.arange(len(counts))
        self.first = np.append(self.first, len(self.table) + np.cumsum(counts) - counts)
        self.count = np.append(self.count, counts)
        self.met = np.append(self.met, np.ones(len(counts), bool))
        self.table = np.append(self.table, flat)
        return place

    def _drop(self, rows: int) -> None:
        """Without the last rows, those of whole texts."""
        if rows:
            self.table = self.table[: self.first[-rows]]
            self.count, self.first, self.met = self.count[:-rows], self.first[:-rows], self.met[:-rows]

    def _gather(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count = self.count[which]
        ends = np.cumsum(count)
        places = np.repeat(self.first[which] - (ends - count), count)
        places += np.arange(len(places))
        return self.table[places], ends


_KNOWN: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """One table of words for each worker process and tokenizer file."""
    if path not in _KNOWN:
        _KNOWN[path] = WordIds(path)
    return _KNOWN[path]
