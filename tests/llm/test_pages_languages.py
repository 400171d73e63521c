"""Languages of pages: a row for each page, whatever its id."""

from __future__ import annotations

import numpy as np

from tripcohorts.llm import fingerprints, queries


def test_repeated_and_missing_ids_keep_their_rows(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    plain = spark.read.parquet(f"{folder}/pages.parquet").limit(20)
    names = plain.columns
    rows = [tuple(r) for r in plain.collect()]
    place = names.index("page_id")
    odd = [(*r[:place], None, *r[place + 1 :]) for r in rows[:2]] + rows[:3]
    odd += [tuple({"page_id": 99, "url": None, "html": None}.get(n) for n in names), tuple({"page_id": 98, "html": "<HTML lang='fr'>"}.get(n) for n in names)]
    spark.createDataFrame(rows + odd, plain.schema).write.parquet(str(tmp_path / "pages.parquet"))
    spark.read.parquet(f"{folder}/documents.parquet").write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.language_of_pages(spark, str(tmp_path)).collect()
    assert len(found) == len(rows) + len(odd)
    assert sum(r["page_id"] is None for r in found) == 2
    assert all(0 <= r["posterior"] <= 1 and r["language"] for r in found)
    assert {r["language"] for r in found if r["page_id"] == 98} == {"fr"}


def test_anchors_are_those_of_the_definition():
    """k-mers whose least inner substring, by hash, lies at an edge, one by one."""
    chance = np.random.default_rng(3)
    texts = [bytes(chance.choice([97, 98, 99, 195, 32], size)) for size in (0, 5, 35, 36, 37, 200, 3000)] + [b"a" * 200, b"ab" * 100]
    for text, (places, hashes) in zip(texts, fingerprints.anchors(texts), strict=True):
        if 0 < len(text) < fingerprints.K:
            assert places.tolist() == [0] and len(hashes) == 1
            continue
        rolling = fingerprints.Rolling(np.frombuffer(text, np.uint8))

        def hashed(start: int, size: int) -> int:
            return int(rolling.of(np.array([start]), np.array([start + size]))[0])

        wanted = []
        for start in range(len(text) - fingerprints.K + 1):
            inner = [hashed(start + i, fingerprints.S) for i in range(fingerprints.K - fingerprints.S + 1)]
            if min(inner) in (inner[0], inner[-1]):
                wanted.append((start, hashed(start, fingerprints.K) & 0xFFFFFFFF))
        assert list(zip(places.tolist(), hashes.tolist())) == wanted


def test_long_gaps_are_kept():
    one = fingerprints.spelled((np.array([0, 70_000, 200_000]), np.array([1, 2, 3], np.uint32)))
    other = fingerprints.spelled((np.array([0, 80_000, 200_000]), np.array([1, 2, 3], np.uint32)))
    assert one != other
