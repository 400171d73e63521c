"""Helpers that the operators of this package share."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task holds in Python at once, but for single longer texts.
SLICE_BYTES = 4 << 20


def work_folder(spark: SparkSession) -> str:
    """The shared folder of the session, below the warehouse where none is set."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return shared or f"{spark.conf.get('spark.sql.warehouse.dir')}/checkpoints"


def written(frame: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder and read again.

    Cuts the lineage: a lost executor does not bring the work before this point back. The files
    go when the application ends.
    """
    spark = frame.sparkSession
    path = new_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used; what is there goes when the application ends."""
    path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def text_of(column: str | Column = "text") -> Column:
    """A text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in parts whose texts take about `limit` bytes; one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for row, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += int(size) + 1
        yield batch.slice(start)


def map_texts(
    frame: DataFrame,
    work: Callable[[pa.RecordBatch], dict],
    schema: str,
    column: str | None = "text",
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """`work` on parts of `frame`; it returns columns by name, in the order of `schema`.

    Parts are cut by the size of `column`, or are Spark's own batches without one.
    """
    types = arrow_schema(frame.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, column, limit) if column else batches:
            columns = work(part)
            yield pa.RecordBatch.from_arrays(
                [_array(columns[field.name], field.type) for field in types], schema=types
            )

    return frame.mapInArrow(run, schema)


def _array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values.cast(kind)
    return pa.array(values, kind)


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    """The Arrow schema of a DDL string."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def total_bytes(frame: DataFrame, column: str = "text") -> int:
    """Bytes of a text column over all rows."""
    return frame.agg(F.sum(F.octet_length(column))).first()[0] or 0
