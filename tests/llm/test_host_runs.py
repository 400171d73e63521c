"""Runs of words that pages of a host share, on hosts of any size."""

from __future__ import annotations

import random

import pytest

from tripcohorts.llm import pages


@pytest.mark.parametrize("size", [200, 10**6])
def test_shared_runs_do_not_depend_on_the_size_of_the_host(spark, monkeypatch, size):
    monkeypatch.setattr(pages, "PART_WORDS", size)
    notice = "this notice stands on five pages of the whole host and nowhere else"
    chance = random.Random(1)
    own = [" ".join(f"w{chance.randrange(10**6)}" for _ in range(20)) for _ in range(100)]
    rows = [(i, f"http://h.example/{i}", f"<body><div>{notice}</div><p>{own[i]}</p></body>" if i % 20 == 0 else f"<body><p>{own[i]}</p></body>") for i in range(100)]
    # copies of one text are one page
    rows += [(200 + i, f"http://h.example/copy/{i}", "<body><p>one text on two pages that is no notice of its host at all</p></body>") for i in range(2)]
    rows += [(300, "http://h.example/300", "<body></body>"), (301, "http://h.example/301", "<body><p>few words</p></body>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in pages.main_text(frame).collect()}
    assert all(found[i] == own[i] for i in range(100))
    assert found[200] == found[201] == "one text on two pages that is no notice of its host at all"
    assert found[300] == "" and found[301] == "few words"
