"""Memory in MB that a task needs for a batch of many texts."""

from __future__ import annotations

import random
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripcohorts.llm import repeats


class _Frame:
    """A frame whose batches are worked on here, where they can be measured."""

    def __init__(self, frame):
        self.sparkSession, self.frame = frame.sparkSession, frame

    def select(self, *names):
        return _Frame(self.frame.select(*names))

    def mapInArrow(self, run, schema):
        batches = self.frame.toArrow().combine_chunks().to_batches()
        next(run(iter([batches[0].slice(0, 1)])), None)  # tables that the worker keeps
        tracemalloc.start()
        try:
            rows = sum(batch.num_rows for batch in run(iter(batches)))
            return rows, tracemalloc.get_traced_memory()[1] / (1 << 20)
        finally:
            tracemalloc.stop()


@pytest.mark.parametrize("step", ["anchors", "windows"])
def test_a_batch_of_many_texts_takes_little_memory(spark, step):
    chance = random.Random(5)
    text = "".join(chance.choice("abcdefgh ") for _ in range(64 << 10))
    rows = spark.range(64).select(F.col("id").alias("doc"), F.lit(1).alias("tag"), F.concat(F.lit(text), F.col("id").cast("string")).alias("text"))
    if step == "anchors":
        rows_out, most = repeats.anchor_rows(_Frame(rows), 12, 200)
    else:
        entry = "transform(sequence(0, 600), i -> named_struct('at', cast(i * 100 as int), 'off', 0, 'n', 100, 'what', 2)) found"
        rows_out, most = repeats.window_rows(_Frame(rows.selectExpr("*", entry)), 12, 200)
    assert rows_out >= 12
    assert most < 90
