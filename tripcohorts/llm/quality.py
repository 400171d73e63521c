"""Quality rules, the main one by the frequency of lines across the documents of a host.

Lines are compared by their lower-cased words. A line that more documents of a host hold than the
limits allow is taken out of all of them; a document that keeps too few of its words is rejected.
Exact copies of a text count as one document of their host.

Edge cases: a null or empty text has no words and fails the base rules. A null host is a host of
its own. Repeated rows each get their row. An empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcohorts.llm.common import map_texts, text_of, written
from tripcohorts.llm.words import LOWER, PART_BYTES, Rolling, mixed, split_words, text_bytes, window_hashes

#: Fixed values of the base rules.
LEAST_WORDS, MOST_REPEATED_PERCENT, WINDOW = 20, 30, 8
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

#: A line is over the limits in more than this percentage of its host's documents. The limit is at least LEAST_LIMIT
#: documents, so that a few pages of a small host prove nothing, and never above MOST_LIMIT: what that many hold is
#: repeated however large the host is.
MOST_PERCENT, LEAST_LIMIT, MOST_LIMIT = 2, 20, 1000

#: The share of its words that a document must keep.
LEAST_KEPT_SHARE = 0.3

_MEASURES = """row long, doc_id long, host string, content long, n_words long, word_chars long, n_symbols long,
    n_dup_lines long, n_repeat_words long, lines array<long>, line_words array<int>"""


def _measure(part: pa.RecordBatch) -> dict:
    data, bounds = text_bytes(part.column("text"))
    texts = len(bounds) - 1
    exact, lower = Rolling(data), Rolling(LOWER[data])
    words = split_words(data, bounds, rolling=exact)

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags)])
        return total[bounds[1:]] - total[bounds[:-1]]

    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, words.starts, 1)
    np.subtract.at(inside, words.ends, 1)
    characters = (np.cumsum(inside[:-1]) > 0) & ((data & 0xC0) != 0x80)

    # words in windows that their text holds twice
    at, window = window_hashes(words, WINDOW)
    of = words.text[at]
    order = np.lexsort((window, of))
    same = (window[order][1:] == window[order][:-1]) & (of[order][1:] == of[order][:-1])
    twice = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
    covered = np.zeros(len(words.starts) + 1, np.int64)
    np.add.at(covered, at[twice], 1)
    np.subtract.at(covered, at[twice] + WINDOW, 1)
    repeated = np.bincount(words.text[np.cumsum(covered[:-1]) > 0], minlength=texts)

    # lines with a word
    breaks = np.flatnonzero(data == 10)
    before = np.searchsorted(breaks, words.starts)
    line = before + words.text
    first = np.flatnonzero(np.append(True, line[1:] != line[:-1])) if len(line) else np.zeros(0, np.int64)
    owner, count = words.text[first], np.diff(np.append(first, len(line)))
    edges = np.concatenate([[-1], breaks, [len(data)]])
    starts = np.maximum(edges[before[first]] + 1, bounds[owner])
    ends = np.minimum(edges[before[first] + 1], bounds[owner + 1])
    raw = exact.of(starts, ends)
    order = np.lexsort((np.arange(len(raw)), raw, owner))
    again = (raw[order][1:] == raw[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    duplicates = np.bincount(owner[order][1:][again], minlength=texts)
    if len(first):
        spelled = lower.of(words.starts, words.ends)
        place = (np.arange(len(line)) - np.repeat(first, count)).astype(np.uint64)
        line_hash = np.add.reduceat(mixed(spelled + place * np.uint64(0x9E3779B97F4A7C15)), first).view(np.int64)
    else:
        line_hash = np.zeros(0, np.int64)
    offsets = pa.array(np.searchsorted(owner, np.arange(texts + 1)), pa.int32())
    return {
        "row": part.column("row"),
        "doc_id": part.column("doc_id"),
        "host": part.column("host"),
        "content": exact.of(bounds[:-1], bounds[1:]).view(np.int64),
        "n_words": words.counts,
        "word_chars": per_text(characters),
        "n_symbols": per_text(SYMBOLS[data]),
        "n_dup_lines": duplicates,
        "n_repeat_words": repeated,
        "lines": pa.ListArray.from_arrays(offsets, pa.array(line_hash)),
        "line_words": pa.ListArray.from_arrays(offsets, pa.array(count.astype(np.int32))),
    }


def measure(documents: DataFrame, host: str = "source") -> DataFrame:
    """Counts of every text, and the hash and word count of each of its lines."""
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        F.coalesce(F.col(host), F.lit("\0")).alias("host"),
        text_of().alias("text"),
    )
    return map_texts(rows, _measure, _MEASURES, limit=PART_BYTES)


def frequent_lines(measured: DataFrame) -> DataFrame:
    """host, line of lines in more documents of the host than the limits allow."""
    distinct = measured.groupBy("host", "content").agg(F.min("row").alias("row"))
    # in hundredths of a document
    least, most = F.lit(100 * LEAST_LIMIT), F.lit(100 * MOST_LIMIT)
    limits = distinct.groupBy("host").agg(F.least(F.greatest(MOST_PERCENT * F.count("*"), least), most).alias("limit"))
    once = measured.select("row", F.explode(F.array_distinct("lines")).alias("line"), "host").join(
        distinct.select("row"), "row", "left_semi"
    )
    counts = once.groupBy("host", "line").agg(F.count("*").alias("documents")).filter(F.col("documents") > LEAST_LIMIT)
    return counts.join(limits, "host").filter(100 * F.col("documents") > F.col("limit")).select("host", "line")


def apply_rules(documents: DataFrame, host: str = "source") -> DataFrame:
    """Every document with its counts, `removed_words` in frequent lines, base_failed and kept."""
    measured = written(measure(documents, host), "quality")
    lines = measured.select("row", "host", F.explode(F.arrays_zip("lines", "line_words")).alias("at")).select(
        "row", "host", F.col("at.lines").alias("line"), F.col("at.line_words").alias("words")
    )
    removed = (
        lines.join(frequent_lines(measured), ["host", "line"])
        .groupBy("row")
        .agg(F.sum("words").alias("removed_words"))
    )
    left = F.col("n_words") - F.col("removed_words")
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    depleted = (F.col("removed_words") > 0) & (left < LEAST_KEPT_SHARE * F.col("n_words"))
    return (
        measured.drop("lines", "line_words", "host", "content")
        .join(removed, "row", "left")
        .withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & ~depleted)
        .drop("row")
    )
