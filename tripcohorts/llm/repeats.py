"""Removal of long byte strings that occur more than once, with a family of sparse suffix arrays.

A suffix array of every position costs more than the text is worth, so the arrays hold the suffixes
at anchors only: in each window of `length` bytes the place whose next bytes hash lowest. Equal
windows have equal anchors, so no repeat is missed. The arrays are split into shards by the hash at
the anchor. In a shard each batch that arrives gets its sorted array; levels of equal size merge,
and every merge scans neighbours for matches, so an entry is merged a logarithmic number of times.

An anchor's stretch is all windows that it stands for. A stretch that occurs elsewhere is repeated
as a whole. Where suffixes at an anchor agree in part only, the windows themselves are compared:
one stretch of each kind sends the hashes of its windows to a second round of shards, by these
hashes, so that a string in very many documents spreads over the tasks.

Edge cases: a null or empty text, and one shorter than `length`, has nothing to remove. Repeated rows
are repeats of each other. Null ids are kept. An empty table gives no rows. A text is held whole by
one task, with about a hundred bytes for each of its own; one of 256 MB is refused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripcohorts.llm.common import arrow_schema, map_texts, text_of, total_bytes, written
from tripcohorts.llm.words import Rolling, text_bytes

LENGTH = 200

#: Bytes at an anchor by which windows choose it.
ANCHOR_BYTES = 40

#: Bytes of text whose anchors share a shard.
SHARD_TEXT = 24 << 20

#: Windows of the second round that share a shard.
SHARD_WINDOWS = 2 << 20

#: Bytes of text in one part: of stretches, at some 70 bytes each; of windows, at some 130, since each byte can begin one.
STRETCH_PART, WINDOW_PART = 1 << 20, 512 << 10

_POSITION_BITS = np.uint64(28)
_POSITION = (np.uint64(1) << _POSITION_BITS) - np.uint64(1)

_COLUMNS = {"h": "<u8", "ctx": "<u8", "doc": "<i8", "tag": "<i4", "at": "<i4", "off": "u1", "n": "u1"}

#: What a stretch is: repeated as a whole; to be compared window by window.
WHOLE, OPEN = 1, 2


def stretches(data: np.ndarray, bounds: np.ndarray, rolling: Rolling, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, first window and number of windows of each stretch, in order."""
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 3
    if len(data) > int(_POSITION):
        raise ValueError(f"a text has more than {int(_POSITION)} bytes")
    change = np.zeros(len(data) + 1, np.int8)
    long = np.diff(bounds) >= length
    np.add.at(change, bounds[:-1][long], 1)
    np.subtract.at(change, bounds[1:][long] - length + 1, 1)
    windows = np.flatnonzero(np.cumsum(change[:-1], dtype=np.int8))
    places = np.arange(len(data) - ANCHOR_BYTES + 1)
    lowest = rolling.of(places, places + ANCHOR_BYTES)
    lowest = (lowest >> _POSITION_BITS << _POSITION_BITS) | places.astype(np.uint64)
    span, wanted = 1, length - ANCHOR_BYTES + 1
    while span < wanted:
        step = min(span, wanted - span)
        lowest = np.minimum(lowest[:-step], lowest[step:])
        span += step
    anchor = (lowest[windows] & _POSITION).astype(np.int64)
    first = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1])) if len(anchor) else np.zeros(0, np.int64)
    return anchor[first], windows[first], np.diff(np.append(first, len(anchor)))


def _by_shard(shard: np.ndarray, columns: dict[str, np.ndarray]) -> dict:
    order = np.argsort(shard, kind="stable")
    shard = shard[order]
    first = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else []
    ends = [*first[1:], len(shard)] if len(shard) else []
    rows = {"shard": shard[first] if len(shard) else []}
    for name, values in columns.items():
        values = values[order]
        rows[name] = [values[a:b].tobytes() for a, b in zip(first, ends, strict=True)]
    return rows


class Family:
    """Sorted arrays of entries in levels; each merge marks entries that match another one."""

    def __init__(self) -> None:
        self.levels: list[dict[str, np.ndarray]] = []

    @staticmethod
    def _scanned(entries: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """In order of what stands at the anchor; marks `same` stretch and `mixed` stretches."""
        order = np.lexsort((entries["ctx"], entries["h"]))
        entries = {name: values[order] for name, values in entries.items()}
        h, ctx = entries["h"], entries["ctx"]
        new = np.append(True, h[1:] != h[:-1])
        kind = new | np.append(True, ctx[1:] != ctx[:-1])
        first = np.flatnonzero(new)
        kinds = np.add.reduceat(kind.astype(np.int64), first) > 1
        entries["mixed"] |= np.repeat(kinds, np.diff(np.append(first, len(h))))
        alone = kind & np.append(kind[1:], True)
        entries["same"] |= ~alone
        entries["first"] = kind
        return entries

    def add(self, entries: dict[str, np.ndarray]) -> None:
        if not len(entries["h"]):
            return
        flags = {name: np.zeros(len(entries["h"]), bool) for name in ("same", "mixed", "first")}
        self.levels.append(self._scanned(entries | flags))
        while len(self.levels) > 1 and 2 * len(self.levels[-1]["h"]) > len(self.levels[-2]["h"]):
            self._merge()

    def _merge(self) -> None:
        last = self.levels.pop()
        before = self.levels.pop()
        self.levels.append(self._scanned({name: np.concatenate([before[name], last[name]]) for name in last}))

    def matches(self) -> dict[str, np.ndarray] | None:
        """Entries that match another one, with what they are."""
        while len(self.levels) > 1:
            self._merge()
        if not self.levels:
            return None
        found = self.levels.pop()
        what = WHOLE * found["same"] + OPEN * (found["mixed"] & (found["first"] | ~found["same"]))
        kept = what > 0
        return {name: values[kept] for name, values in found.items()} | {"what": what[kept]}


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Single rows with their shard."""
    for batch in batches:
        for row, shard in enumerate(batch.column("shard").to_pylist()):
            yield shard, batch.slice(row, 1)


def _column(row: pa.RecordBatch, name: str, kind: str) -> np.ndarray:
    return np.frombuffer(row.column(name)[0].as_buffer(), kind)


def _in_shards(rows: DataFrame, shards: int, start, add, end, schema: str) -> DataFrame:
    """Every shard by itself: `start` makes its state, `add` takes each row, `end` gives its result.

    A shard is a partition, so tasks stay as large as a shard however many texts there are.
    """
    types = arrow_schema(rows.sparkSession, schema)

    def run(batches):
        current = state = None
        for shard, row in _shards(batches):
            if shard != current:
                if state is not None and (out := end(state)) is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in types], schema=types)
                current, state = shard, start()
            add(state, row)
        if state is not None and (out := end(state)) is not None:
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in types], schema=types)

    return rows.repartitionById(shards, "shard").mapInArrow(run, schema)


def anchor_rows(texts: DataFrame, shards: int, length: int) -> DataFrame:
    """Packed entries of all stretches, by shard."""

    def work(part: pa.RecordBatch) -> dict:
        data, bounds = text_bytes(part.column("text"))
        rolling = Rolling(data)
        anchor, first, count = stretches(data, bounds, rolling, length)
        owner = np.searchsorted(bounds, first, side="right") - 1
        h = rolling.of(anchor, anchor + ANCHOR_BYTES)
        whole = rolling.of(first, first + count - 1 + length) + (anchor - first).astype(np.uint64)
        columns = {
            "h": h,
            "ctx": whole,
            "doc": part.column("doc").to_numpy()[owner],
            "tag": part.column("tag").to_numpy()[owner],
            "at": (first - bounds[owner]).astype(np.int32),
            "off": (anchor - first).astype(np.uint8),
            "n": count.astype(np.uint8),
        }
        return _by_shard((h % np.uint64(shards)).astype(np.int32), columns)

    schema = "shard int, " + ", ".join(f"{name} binary" for name in _COLUMNS)
    return map_texts(texts.select("doc", "tag", "text"), work, schema, limit=STRETCH_PART)


def matching_stretches(rows: DataFrame, shards: int) -> DataFrame:
    """doc, tag, at, off, n, what of the stretches that match another one."""

    def add(family: Family, row: pa.RecordBatch) -> None:
        family.add({name: _column(row, name, kind) for name, kind in _COLUMNS.items()})

    def end(family: Family) -> dict | None:
        return family.matches()

    return _in_shards(rows, shards, Family, add, end, "doc long, tag int, at int, off int, n int, what int")


def window_rows(open_texts: DataFrame, shards: int, length: int) -> DataFrame:
    """Packed window hashes of open stretches, by shard of the window."""

    def work(part: pa.RecordBatch) -> dict:
        data, bounds = text_bytes(part.column("text"))
        rolling = Rolling(data)
        entries, owner = _entries(part, OPEN)
        first, count = entries["at"] + bounds[owner], entries["n"]
        start = np.repeat(first - np.append(0, np.cumsum(count)[:-1]), count) + np.arange(count.sum())
        windows, owner = rolling.of(start, start + length), np.repeat(owner, count)
        columns = {
            "doc": part.column("doc").to_numpy()[owner],
            "tag": part.column("tag").to_numpy()[owner],
            "at": (start - bounds[owner]).astype(np.int32),
            "window": windows,
        }
        return _by_shard((windows % np.uint64(shards)).astype(np.int32), columns)

    schema = "shard int, doc binary, tag binary, at binary, window binary"
    return map_texts(open_texts, work, schema, limit=WINDOW_PART)


def repeated_windows(rows: DataFrame, shards: int) -> DataFrame:
    """doc, tag, at of windows that occur elsewhere."""
    kinds = {"doc": "<i8", "tag": "<i4", "at": "<i4", "window": "<u8"}

    def add(state: list, row: pa.RecordBatch) -> None:
        state.append({name: _column(row, name, kind) for name, kind in kinds.items()})

    def end(state: list) -> dict | None:
        windows = np.concatenate([row["window"] for row in state])
        order = np.argsort(windows, kind="stable")
        windows = windows[order]
        equal = windows[1:] == windows[:-1]
        repeated = order[np.append(equal, False) | np.append(False, equal)]
        if not len(repeated):
            return None
        return {name: np.concatenate([row[name] for row in state])[repeated] for name in ("doc", "tag", "at")}

    return _in_shards(rows, shards, list, add, end, "doc long, tag int, at int")


def _entries(part: pa.RecordBatch, what: int) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Entries of one kind in the `found` lists of a part, and the row each belongs to."""
    found = part.column("found")
    if isinstance(found, pa.ChunkedArray):
        found = found.combine_chunks()
    sizes = np.nan_to_num(np.asarray(pc.list_value_length(found).fill_null(0)))
    owner = np.repeat(np.arange(len(found)), sizes)
    flat = found.flatten()
    names = ("at", "off", "n", "what")
    columns = (flat.field(place).to_numpy(zero_copy_only=False) for place in range(len(names)))
    values = {name: column.astype(np.int64) for name, column in zip(names, columns, strict=True)}
    kept = (values["what"] & what) > 0
    return {name: column[kept] for name, column in values.items()}, owner[kept]


def _removed(size: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Maximal runs (start, end) that the intervals cover."""
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > reach[:-1])
    first = np.flatnonzero(new)
    return np.stack([starts[first], reach[np.append(first[1:], len(starts)) - 1]], axis=1)


def remove_repeats(documents: DataFrame, length: int = LENGTH, texts: bool = False) -> DataFrame:
    """Every document without the bytes that a string of `length` bytes found elsewhere covers.

    Returns doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, end of each removed
    run, in bytes). With `texts` all columns of the documents come first, with the kept bytes as
    `text`, cut further to whole characters where a run ends inside one.
    """
    others = [name for name in documents.columns if name not in ("text", "doc_id")]
    rows = documents.select(
        "doc_id",
        F.coalesce("doc_id", F.lit(-(2**63))).alias("doc"),
        F.hash(text_of()).alias("tag"),
        text_of().alias("text"),
        *([F.struct(*others).alias("others")] if texts and others else []),
    )
    shards = max(12, -(-total_bytes(documents) // SHARD_TEXT))
    found = matching_stretches(anchor_rows(rows, shards, length), shards)
    listed = found.groupBy("doc", "tag").agg(F.collect_list(F.struct("at", "off", "n", "what")).alias("found"))
    marked = written(rows.join(listed.hint("shuffle_hash"), ["doc", "tag"], "left"), "marked")
    is_open = F.exists("found", lambda entry: entry["what"] >= OPEN)
    open_windows = F.transform("found", lambda entry: F.when(entry["what"] >= OPEN, entry["n"]).otherwise(0))
    count = marked.agg(F.sum(F.aggregate(open_windows, F.lit(0).cast("long"), lambda a, b: a + b))).first()[0] or 0
    shards = max(12, -(-count // SHARD_WINDOWS))
    windows = window_rows(marked.filter(is_open).select("doc", "tag", "text", "found"), shards, length)
    one = F.struct("at", F.lit(0).alias("off"), F.lit(1).alias("n"), F.lit(WHOLE).alias("what"))
    runs = repeated_windows(windows, shards).groupBy("doc", "tag").agg(F.collect_list(one).alias("more"))
    closed = marked.filter(~F.coalesce(is_open, F.lit(False)))
    opened = marked.filter(is_open).join(runs.hint("shuffle_hash"), ["doc", "tag"], "left")
    more = F.concat(F.col("found"), F.coalesce("more", F.array().cast(opened.schema["more"].dataType)))
    both = closed.unionByName(opened.withColumn("found", more).drop("more"))

    def work(part: pa.RecordBatch) -> dict:
        entries, owner = _entries(part, WHOLE)
        bounds = np.searchsorted(owner, np.arange(part.num_rows + 1))
        sizes, removed, counts, hashes, spans, kept_texts = [], [], [], [], [], []
        for row, text in enumerate(part.column("text")):
            data = text.as_buffer().to_pybytes()
            mine = slice(bounds[row], bounds[row + 1])
            at = entries["at"][mine]
            cut = _removed(len(data), at, at + entries["n"][mine] - 1 + length)
            kept = [data[a:b] for a, b in zip([0, *cut[:, 1]], [*cut[:, 0], len(data)], strict=True)]
            joined = b"".join(kept)
            sizes.append(len(data))
            removed.append(len(data) - len(joined))
            counts.append(len(cut))
            hashes.append(hashlib.sha256(joined).hexdigest())
            spans.append([{"start": int(a), "end": int(b)} for a, b in cut])
            if texts:
                kept_texts.append("".join(piece.decode("utf-8", "ignore") for piece in kept))
        out = {"n_bytes": sizes, "n_removed": removed, "n_spans": counts, "kept_sha256": hashes, "spans": spans}
        return out | {name: part.column(name) for name in names} | ({"text": kept_texts} if texts else {})

    names = ["doc_id", *(["others"] if texts and others else [])]
    kinds = [f"{name} {both.schema[name].dataType.simpleString()}" for name in names]
    schema = ", ".join([*kinds, *(["text string"] if texts else []), _RESULT])
    result = map_texts(both, work, schema, limit=WINDOW_PART)
    if not texts:
        return result
    named = [F.col("others")[name].alias(name) if name in others else F.col(name) for name in documents.columns]
    return result.select(*named, "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")


_RESULT = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>"
