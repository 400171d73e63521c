"""Fingerprints of documents by closed syncmers.

A stretch of `K` bytes is an anchor if the lowest hash among its inner stretches of `S` bytes
stands at its beginning or end. Whether it is depends on its own bytes alone, so an edit moves no
anchor outside of the stretches it touches, and equal texts have equal fingerprints. A fingerprint
holds the hash of each anchor and the distance from the one before. Two fingerprints are alike to the
share of their anchors that match in the same order.

Edge cases: a null or empty text has an empty fingerprint, equal to another empty one (likeness 1)
and unlike any other (0). A text shorter than `K` has one anchor, the whole text. Documents of equal
id follow each other by text; a null id comes first. The only document is its own next one. An
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcohorts.llm.common import arrow_schema, slices, text_of, total_bytes
from tripcohorts.llm.words import PART_BYTES, Rolling

K, S = 36, 6

#: Text in one range of ids, but for the largest inputs, and ranges at most.
RANGE_BYTES, MOST_RANGES = 4 << 20, 1 << 16

#: Pairs of equal anchors, for each anchor, up to which two fingerprints are compared pair by pair.
PAIRS_OF_ANCHOR = 16

_FIRST = -(2**63)


def anchors(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Positions and 32-bit hashes of the anchors of each text."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(text) for text in texts])
    starts = ends - [len(text) for text in texts]
    rolling = Rolling(data)
    found = np.zeros(0, np.int64)
    if len(data) >= K:
        places = np.arange(len(data) - S + 1)
        inner = rolling.of(places, places + S)
        span, wanted, lowest = 1, K - S + 1, inner
        while span < wanted:
            step = min(span, wanted - span)
            lowest = np.minimum(lowest[:-step], lowest[step:])
            span += step
        count = len(data) - K + 1
        edge = (inner[:count] == lowest) | (inner[K - S : K - S + count] == lowest)
        found = np.flatnonzero(edge)
        owner = np.searchsorted(ends, found, side="right")
        found = found[found + K <= ends[owner]]
    hashes = rolling.of(found, found + K).astype(np.uint32)
    cuts = np.searchsorted(found, np.append(starts, len(data)))
    whole = rolling.of(starts, ends).astype(np.uint32)
    result = []
    for row, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        if 0 < len(texts[row]) < K:
            result.append((np.zeros(1, np.int64), whole[row : row + 1]))
        else:
            result.append((found[a:b] - starts[row], hashes[a:b]))
    return result


def spelled(anchor: tuple[np.ndarray, np.ndarray]) -> str:
    """Distances and hashes, four bytes each, as base64."""
    places, hashes = anchor
    gaps = np.diff(places, prepend=0).astype("<u4")
    return base64.b64encode(gaps.tobytes() + hashes.astype("<u4").tobytes()).decode()


def longest_common(one: np.ndarray, other: np.ndarray) -> int:
    """Length of the longest run of values that both hold in the same order, repeats counted each time."""
    size = min(len(one), len(other))
    differ = np.flatnonzero(one[:size] != other[:size])
    begin = int(differ[0]) if len(differ) else size
    one, other, size = one[begin:], other[begin:], size - begin
    differ = np.flatnonzero(one[len(one) - size :][::-1] != other[len(other) - size :][::-1])
    end = int(differ[0]) if len(differ) else size
    one, other = one[: len(one) - end], other[: len(other) - end]
    one, other = one[np.isin(one, other)], other[np.isin(other, one)]
    if not len(one):
        return begin + end
    values, kind = np.unique(other, return_inverse=True)
    of = np.searchsorted(values, one)
    order = np.argsort(kind, kind="stable")
    counts = np.bincount(kind)
    where = np.split(order, np.cumsum(counts)[:-1])
    if counts[of].sum() <= PAIRS_OF_ANCHOR * (len(one) + len(other)):
        # rising places of equal values; the later ones of a value first, so that it counts once
        tails: list[int] = []
        for number in of.tolist():
            for place in where[number][::-1].tolist():
                at_tail = bisect_left(tails, place)
                tails[at_tail : at_tail + 1] = [place]
        return begin + end + len(tails)
    # many repeats: a row of the table of common lengths at once, a zero bit where it rises
    bits = []
    for places in where:
        flags = np.zeros(len(other), np.uint8)
        flags[places] = 1
        bits.append(int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little"))
    full = (1 << len(other)) - 1
    row = full
    for number in of.tolist():
        met = row & bits[number]
        row = (row + met | row - met) & full
    return begin + end + len(other) - row.bit_count()


def likeness(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> float:
    """Twice the longest run of anchors that both hold in the same order, by their number."""
    total = len(one[1]) + len(other[1])
    return 2.0 * longest_common(one[1], other[1]) / total if total else 1.0


def edited(text: str, following: str) -> str:
    """The last quarter replaced by as much of the beginning of the next text."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _with_next(rows: DataFrame) -> DataFrame:
    """Rows (span, tail, place, doc_id, text) in ranges of ids; a range ends with the next one's first row.

    Texts are dealt out once. Only ids of range limits and of first rows reach the driver.
    """
    total = total_bytes(rows)
    count = min(MOST_RANGES, max(1, -(-total // RANGE_BYTES)))
    wanted = [i / count for i in range(1, count)]
    limits = np.array(rows.agg(F.percentile_approx("place", wanted, 20 * count)).first()[0] if wanted else [], np.int64)

    def spans_of(places: np.ndarray) -> np.ndarray:
        return np.searchsorted(limits, places, side="left")

    def only_span(batches):
        for batch in batches:
            place = batch.column("place").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(spans_of(place)), pa.array(place)], names=["span", "place"])

    ids = rows.select("place").mapInArrow(only_span, "span long, place long")
    firsts = sorted(map(tuple, ids.groupBy("span").agg(F.min("place")).collect()))
    before = {place: firsts[i - 1][0] for i, (_, place) in enumerate(firsts)}
    known = np.array(sorted(before), np.int64)
    known_span = np.array([before[place] for place in sorted(before)], np.int64)
    schema = "span long, tail boolean, place long, doc_id long, text string"
    types = arrow_schema(rows.sparkSession, schema)

    def deal(batches):
        for batch in batches:
            place = batch.column("place").to_numpy()
            if not len(place):
                continue
            at = np.minimum(np.searchsorted(known, place), len(known) - 1)
            also = np.flatnonzero(known[at] == place)
            rest = [batch.column(name) for name in ("place", "doc_id", "text")]
            for chosen, span, tail in (
                (None, spans_of(place), False),
                (also, known_span[at[also]], True),
            ):
                columns = rest if chosen is None else [c.take(pa.array(chosen)) for c in rest]
                flags = pa.array(np.full(len(span), tail))
                yield pa.RecordBatch.from_arrays([pa.array(span), flags, *columns], schema=types)

    dealt = rows.select("place", "doc_id", "text").mapInArrow(deal, schema)
    return dealt.repartition("span").sortWithinPartitions("span", "tail", "place", "text")


_RESULT = """doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,
    near_edited double, near_next double"""


def fingerprint_documents(documents: DataFrame) -> DataFrame:
    """Fingerprints of every document and its edited text, and likenesses to that and the next one.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    """
    rows = documents.select(
        F.coalesce("doc_id", F.lit(_FIRST)).alias("place"), "doc_id", text_of().alias("text")
    )
    types = arrow_schema(documents.sparkSession, _RESULT)

    def result(ids: list, texts: list[str]) -> pa.RecordBatch:
        """Of all but the last text, which is only the next one."""
        changed = [edited(text, after) for text, after in zip(texts, texts[1:], strict=False)]
        coded = [text.encode() for text in changed]
        own, other = anchors([text.encode() for text in texts]), anchors(coded)
        columns = [
            ids,
            [len(text) for text in texts[:-1]],
            [hashlib.sha256(text).hexdigest() for text in coded],
            [spelled(a) for a in own[:-1]],
            [spelled(a) for a in other],
            [likeness(a, b) for a, b in zip(own, other, strict=False)],
            [likeness(a, b) for a, b in zip(own, own[1:], strict=False)],
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, types, strict=True)], schema=types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        current, closed, held = None, False, 0
        for batch in slices(batches, "text", PART_BYTES):
            for span, tail, doc_id, text in zip(
                *(batch.column(name).to_pylist() for name in ("span", "tail", "doc_id", "text")), strict=True
            ):
                if span != current:
                    ids, texts, current, closed, held = [], [], span, False, 0
                if closed:
                    continue
                texts.append(text)
                held += len(text)
                if not tail:
                    ids.append(doc_id)
                if tail or held > PART_BYTES and len(texts) > 1:
                    done = ids if tail else ids[:-1]
                    yield result(done, texts)
                    ids, texts, closed, held = ids[-1:], texts[-1:], tail, len(text)

    return _with_next(rows).mapInArrow(run, _RESULT)
