"""Token ids in ORC files: integer run lengths, row indexes, and Bloom filters on document ids.

Documents are dealt out by ranges of their id, sorted, encoded in that order and written, one file
for each range. ORC keeps ids as run-length coded integers in stripes; each stripe has an index with
the least and greatest document id of every ROWS_AN_ENTRY rows and a Bloom filter of them. So a
reader splits a file between stripes, and a look-up by id skips files, stripes and entries by their
metadata alone. A document's place in the whole sequence is its place in its file plus what all
files before hold, which is one number a file.

Edge cases: a null or empty text has its end token only. A null id comes first. Rows with the same id
follow each other in the order of a hash of their text, so a repeated id may spread over files; repeated
rows are written as often as they occur. A folder written from an empty table has no rows.
Further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripcohorts.llm.common import arrow_schema, map_texts, slices, text_of, total_bytes, written
from tripcohorts.llm.wordids import SLICE_BYTES, word_ids

END_TOKEN = 2

#: Bytes of text for each file; a file's documents are sorted and encoded by one task as a stream.
FILE_BYTES = 32 << 20

#: Files whose totals are broadcast, some 20 bytes each.
BROADCAST_FILES = 1_000_000

#: Rows of an index entry, and bytes of a stripe while it is written.
ROWS_AN_ENTRY, STRIPE_BYTES = 1000, 16 << 20

ORC_OPTIONS = {
    "orc.create.index": "true",
    "orc.row.index.stride": str(ROWS_AN_ENTRY),
    "orc.stripe.size": str(STRIPE_BYTES),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "compression": "zstd",
}

#: part: the file's number in ascending order; before: ids of the file ahead of this document.
TOKEN_SCHEMA = "doc_id long, part int, before long, n_tokens long, ids array<int>"


def in_order(documents: DataFrame) -> DataFrame:
    """doc_id and text by ascending ranges of ids, sorted; equal rows may lie in several ranges."""
    rows = documents.select("doc_id", text_of().alias("text"))
    files = -(-total_bytes(rows) // FILE_BYTES) or 1
    # the last key only deals out rows that are equal otherwise
    keyed = rows.select("*", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    keys = [F.asc_nulls_first("doc_id"), F.col("hash"), F.col("row")]
    return keyed.repartitionByRange(files, *keys).sortWithinPartitions(*keys).select("doc_id", "text")


def write_tokens(documents: DataFrame, path: str, vocabulary: str) -> None:
    """Ids of every whole text and an end token, as ORC files in ascending order of doc_id."""
    types = arrow_schema(documents.sparkSession, TOKEN_SCHEMA)
    end = np.uint32(END_TOKEN)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for rows in slices(batches, "text", SLICE_BYTES):
            flat, bounds = word_ids(vocabulary).encode(rows.column("text"))
            ids = np.insert(flat, bounds[1:], end).astype(np.int32)
            bounds = bounds + np.arange(len(bounds))
            columns = {
                "doc_id": rows.column("doc_id"),
                "part": pa.array(np.full(rows.num_rows, part, np.int32)),
                "before": pa.array(before + bounds[:-1]),
                "n_tokens": pa.array(np.diff(bounds)),
                "ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids)),
            }
            before += int(bounds[-1])
            yield pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) for f in types], schema=types)

    in_order(documents).mapInArrow(run, TOKEN_SCHEMA).write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str, doc_ids: Sequence[int] | None = None) -> DataFrame:
    """Rows of TOKEN_SCHEMA; with `doc_ids`, what their index entries and Bloom filters let through."""
    rows = spark.read.schema(TOKEN_SCHEMA).orc(path)
    return rows if doc_ids is None else rows.filter(F.col("doc_id").isin(*doc_ids))


def with_starts(tokens: DataFrame) -> DataFrame:
    """The rows with `start`: the ids of all documents before, in the order they were written.

    Totals of the files are broadcast up to BROADCAST_FILES of them; beyond, Spark chooses how they meet the rows.
    """
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    totals = tokens.groupBy("part").agg(F.sum("n_tokens").alias("held"))
    firsts = written(totals.select("part", F.coalesce(F.sum("held").over(ahead), F.lit(0)).alias("first")), "files")
    known = F.broadcast(firsts) if firsts.count() <= BROADCAST_FILES else firsts
    return tokens.join(known, "part").withColumn("start", F.col("first") + F.col("before"))


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of rows with ids, from what the files hold."""

    def work(part: pa.RecordBatch) -> dict:
        ids = part.column("ids")
        flat = memoryview(np.ascontiguousarray(ids.values.to_numpy(), "<i4")).cast("B")
        bounds = ids.offsets.to_numpy().tolist()
        return {
            "doc_id": part.column("doc_id"),
            "start": part.column("start"),
            "n_tokens": np.diff(ids.offsets.to_numpy()).astype(np.int64),
            "ids_crc32": [zlib.crc32(flat[4 * begin : 4 * end]) for begin, end in zip(bounds, bounds[1:])],
        }

    rows = with_starts(tokens).select("doc_id", "start", "ids")
    return map_texts(rows, work, "doc_id long, start long, n_tokens long, ids_crc32 long", column=None)
