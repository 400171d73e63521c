"""Links between the clusters of several pivots of a group in parts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tripcohorts.llm import neardup


def test_clusters_of_two_pivots_meet_across_parts(spark, monkeypatch):
    monkeypatch.setattr(neardup, "PIVOTS", 2)
    parts = {r["id"]: r["part"] for r in spark.range(40).select("id", F.pmod(F.xxhash64("id"), F.lit(2)).alias("part")).collect()}
    even, odd = ([i for i, part in parts.items() if part == side] for side in (0, 1))
    # a chain of sets of which only neighbours are linked; its ends are the pivots
    chain = [even[0], even[1], odd[0], odd[1]]
    rows = [
        (one, 7, 9 if one in (chain[0], chain[-1]) else 1, np.arange(8 * at, 8 * at + 100).astype(np.uint64).tobytes())
        for at, one in enumerate(chain)
    ]
    sets = spark.createDataFrame(rows, "id long, component long, degree long, shingles binary")
    groups = spark.createDataFrame([(7, 2)], "component long, parts int")
    links = neardup.written(neardup.confirmed_links(sets, groups, 85), "links")
    found = neardup.components(links).collect()
    assert {r["id"]: r["component"] for r in found} == dict.fromkeys(chain, min(chain))
