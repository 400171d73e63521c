"""Stretches at an anchor that very many documents hold."""

from __future__ import annotations

import random

import numpy as np
import pytest
from brute import repeats as plain
from pyspark.sql import functions as F

from tripcohorts.llm import repeats


def _texts(spark):
    """Documents with one string, of which some also agree in part around it."""
    chance = random.Random(8)

    def noise(size: int) -> str:
        return "".join(chance.choice("abcdefghijklmnop") for _ in range(size))

    hot, around = noise(40), noise(170)
    rows = [(i, noise(230) + hot + noise(230)) for i in range(60)]
    rows += [(60 + i, noise(60) + around + hot + noise(60)) for i in range(20)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def _rows(frame):
    return frame.select(F.col("doc_id").alias("doc"), F.hash("text").alias("tag"), "text")


def test_stretches_are_told_by_their_whole_hash(spark):
    rows = repeats.anchor_rows(_rows(_texts(spark)), 12, 200).collect()
    ctx = np.concatenate([np.frombuffer(r["ctx"], repeats._COLUMNS["ctx"]) for r in rows])
    assert len(ctx) == sum(len(r["n"]) for r in rows)
    assert (ctx.astype(np.uint64) >> np.uint64(40)).max() > 0


def test_windows_of_a_hot_anchor_spread_over_shards(spark):
    frame = _rows(_texts(spark))
    entry = "array(named_struct('at', 0, 'off', 0, 'n', 100, 'what', 2)) found"
    hot = frame.filter("doc >= 60").selectExpr("*", entry)
    hot = hot.withColumn("text", F.concat(F.lit("the string of this anchor is forty bytes."), "text"))
    shards = {r["shard"] for r in repeats.window_rows(hot, 64, 200).collect()}
    assert len(shards) > 32


def test_partly_equal_stretches_of_a_hot_anchor(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_WINDOWS", 100)
    frame = _texts(spark)
    rows = frame.orderBy("doc_id").collect()
    wanted = plain([r["text"] for r in rows], 200)
    found = repeats.remove_repeats(frame, 200).orderBy("doc_id").collect()
    assert [(r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found] == wanted
    assert sum(n > 0 for n, _, _ in wanted) >= 20


def test_every_shard_is_a_partition(spark):
    rows = repeats.anchor_rows(_rows(_texts(spark)), 37, 200)
    found = repeats.matching_stretches(rows, 37)
    assert found.rdd.getNumPartitions() == 37
    assert found.select(F.spark_partition_id().alias("task")).distinct().count() > 1


def test_a_text_beyond_the_positions_is_refused(monkeypatch):
    monkeypatch.setattr(repeats, "_POSITION", np.uint64(500))
    data, bounds = np.zeros(600, np.uint8), np.array([0, 600])
    with pytest.raises(ValueError, match="more than 500 bytes"):
        repeats.stretches(data, bounds, repeats.Rolling(data), 200)
