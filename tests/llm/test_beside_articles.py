"""Text beside a marked article that no markup settles."""

from __future__ import annotations

import pytest

from tripcohorts.llm import pages


@pytest.mark.parametrize("size", [20, 10**6])
def test_the_host_decides_about_text_beside_an_article(spark, monkeypatch, size):
    monkeypatch.setattr(pages, "PART_WORDS", size)
    notice = "all words of this site belong to its owners and to nobody else"

    def page(own: str, beside: str, after: str = "") -> str:
        return f"<body><nav>{notice} in a menu</nav><div>{beside}</div><article><h1>{own}</h1><p>{notice}</p></article><div>{after}</div></body>"

    rows = [
        (1, "http://a.example/1", page("One", notice)),
        (2, "http://a.example/2", page("Two", f"told by nobody but page two {notice} and by page two", "the end of two")),
        (3, "http://a.example/3", page("Three", "", notice)),
        # its only evidence is a marked menu of other pages
        (4, "http://a.example/4", f"<body><div>{notice} in a menu</div><p>Four</p></body>"),
        (5, "http://b.example/5", page("Five", "of its own", "and after")),
        (5, "http://b.example/5", None),
        (None, None, "<main>Six<header>of it</header><br>goes on</main>beside"),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = sorted(((r["page_id"] or 0, r["text"], r["n_chars"]) for r in pages.main_text(frame).collect()))
    wanted = [
        (0, "Six\nof it\ngoes on\nbeside"),
        (1, f"One\n{notice}"),
        (2, f"told by nobody but page two and by page two\nTwo\n{notice}\nthe end of two"),
        (3, f"Three\n{notice}"),
        (4, "Four"),
        (5, ""),
        (5, f"of its own\nFive\n{notice}\nand after"),
    ]
    assert found == [(number, text, len(text)) for number, text in wanted]


def test_every_host_has_its_suffix_array(spark, monkeypatch):
    """Also where every page marks its article and nothing else is open."""
    built = []
    monkeypatch.setattr(pages, "written", lambda frame, name: built.append((name, frame)) or frame.localCheckpoint())
    rows = [(i, f"http://h{i % 5}.example/{i}", f"<nav>menu</nav><article>Text {i}</article>") for i in range(20)]
    found = pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r["page_id"], r["text"]) for r in found) == [(i, f"Text {i}") for i in range(20)]
    assert dict(built)["hosts"].count() == 5 and "runs" in dict(built)
