"""Packing token sequences: shortest pack first over the histogram of piece lengths.

Documents are cut at multiples of the capacity, so only lengths count from then on. Lengths are
placed longest first, each into the emptiest packs that it fits into, on counts of packs with
equal content (patterns) instead of single packs. Pieces get their rank among those of their
length, and ranks are mapped to packs of the patterns.

Edge cases: a null or empty text has only its end token and is one piece; a text of a multiple
of the capacity has no shorter last piece; repeated rows are packed as often as they occur; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripcohorts.llm.common import map_texts, text_of, written
from tripcohorts.llm.wordids import SLICE_BYTES, word_ids

CAPACITY = 2048
END_TOKEN = 1

#: Pieces of one length that are ranked in one group.
RANKED_TOGETHER = 20_000

def pieces_of(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of each piece of at most `capacity` ids."""

    def work(part: pa.RecordBatch) -> dict:
        flat, bounds = word_ids(vocabulary).encode(part.column("text"))
        flat, bounds = flat.astype("<u4", copy=False), bounds.tolist()
        rows, starts, lengths, checks, totals = [], [], [], [], []
        for row, (begin, end) in enumerate(zip(bounds, bounds[1:])):
            ids = flat[begin:end].tobytes() + END_TOKEN.to_bytes(4, "little")
            total = len(ids) // 4
            for start in range(0, total, capacity):
                piece = ids[4 * start : 4 * (start + capacity)]
                rows.append(row)
                starts.append(start)
                lengths.append(len(piece) // 4)
                checks.append(zlib.crc32(piece))
                totals.append(total)
        return {
            "doc_id": part.column("doc_id").take(pa.array(rows, pa.int64())),
            "start": starts,
            "length": lengths,
            "ids_crc32": checks,
            "doc_tokens": totals,
        }

    rows = documents.select("doc_id", text_of().alias("text"))
    return map_texts(rows, work, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long", limit=SLICE_BYTES)


@dataclass
class Pattern:
    """`count` packs with the same content: runs of (length, how many)."""

    count: int
    free: int
    runs: list[tuple[int, int]] = field(default_factory=list)

    def with_one(self, length: int, count: int) -> Pattern:
        runs = list(self.runs)
        if runs and runs[-1][0] == length:
            runs[-1] = (length, runs[-1][1] + 1)
        else:
            runs.append((length, 1))
        return Pattern(count, self.free - length, runs)


def shortest_pack_first(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that hold every piece of a histogram {length: count}, counts as they come out.

    Its work depends on the number of different lengths, which the capacity bounds, and not on
    the number of pieces.
    """
    by_free: list[list[Pattern]] = [[] for _ in range(capacity + 1)]
    emptiest = 0
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while emptiest and not by_free[emptiest]:
                emptiest -= 1
            if emptiest >= length:
                pattern = by_free[emptiest].pop()
                placed = min(left, pattern.count)
                if placed < pattern.count:
                    by_free[emptiest].append(Pattern(pattern.count - placed, pattern.free, pattern.runs))
                made = pattern.with_one(length, placed)
                left -= placed
                by_free[made.free].append(made)
            else:
                # no open pack takes it: new ones, filled one after the other
                each = capacity // length
                for count, held in ((left // each, each), (1, left % each)):
                    if count and held:
                        made = Pattern(count, capacity - held * length, [(length, held)])
                        by_free[made.free].append(made)
                        emptiest = max(emptiest, made.free)
                left = 0
    return [pattern for patterns in by_free for pattern in patterns]


def slots(patterns: list[Pattern]) -> dict[int, np.ndarray]:
    """By length: first rank, first sequence, packs, pieces in each pack, offset of the first.

    Ordered by first rank. At most one pattern is split for each length and no pattern has more
    than 63 different lengths at a capacity of 2048, so this table is small whatever the input.
    """
    used: dict[int, int] = {}
    found: dict[int, list[tuple[int, ...]]] = {}
    first_sequence = 0
    for pattern in patterns:
        offset = 0
        for length, held in pattern.runs:
            rank = used.get(length, 0)
            found.setdefault(length, []).append((rank, first_sequence, pattern.count, held, offset))
            used[length] = rank + held * pattern.count
            offset += held * length
        first_sequence += pattern.count
    return {length: np.array(rows, np.int64) for length, rows in found.items()}


def ranked(pieces: DataFrame, groups: int) -> DataFrame:
    """`rank` of each piece among those of its length, from 0; a length is split into groups."""
    key = F.pmod(F.xxhash64("doc_id", "start"), F.lit(groups)).alias("part")
    split = pieces.select("*", key)
    sizes = split.groupBy("length", "part").agg(F.count("*").alias("size"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "start"))
    numbered = split.withColumn("place", place)
    return numbered.join(firsts, ["length", "part"]).withColumn("rank", F.col("first") + F.col("place") - 1)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces (doc_id, start, length, ...) with sequence_id and offset."""
    kept = written(pieces, "pieces")
    histogram = {row[0]: row[1] for row in kept.groupBy("length").count().collect()}  # `capacity` rows at most
    table = slots(shortest_pack_first(histogram, capacity))
    groups = -(-sum(histogram.values()) // RANKED_TOGETHER) or 1
    columns = [f.name for f in pieces.schema]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)

    def work(part: pa.RecordBatch) -> dict:
        length = part.column("length").to_numpy()
        rank = part.column("rank").to_numpy()
        sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        for each in np.unique(length):
            here = length == each
            rows = table[int(each)]
            first, base, _, held, start = rows[np.searchsorted(rows[:, 0], rank[here], side="right") - 1].T
            place = rank[here] - first
            sequence[here], offset[here] = base + place // held, start + place % held * each
        out = {name: part.column(name) for name in columns}
        return out | {"sequence_id": sequence, "offset": offset}

    return map_texts(ranked(kept, groups), work, f"{schema}, sequence_id long, offset long", column=None)


def pack_documents(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return pack(pieces_of(documents, vocabulary, capacity), capacity)
