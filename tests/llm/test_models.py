"""Toxicity, language and page text: held-out accuracy, plain versions, odd rows."""

from __future__ import annotations

import numpy as np
import pytest

from tripcohorts.llm import language, pages, toxicity

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def fitted(spark):
    documents, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    return documents, labels, toxicity.fit(documents, labels)


def test_toxicity_of_texts_without_learned_labels(fitted):
    documents, labels, model = fitted
    scored = toxicity.score_documents(documents, model).withColumn("held", toxicity.held_out())
    rows = scored.join(labels, "doc_id").filter("held").collect()
    right = [(r["score"] >= 0.5) == (r["toxic"] == 1) for r in rows]
    assert np.mean(right) > 0.93
    toxic = [r["score"] for r in rows if r["toxic"] == 1]
    other = [r["score"] for r in rows if r["toxic"] == 0]
    assert np.mean([a > b for a in toxic for b in other]) > 0.85


def test_held_out_labels_are_not_learned(fitted):
    documents, labels, model = fitted
    changed = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(), 1 - labels["toxic"]).otherwise(labels["toxic"]))
    again = toxicity.fit(documents, changed)
    assert (again.words == model.words).all() and np.allclose(again.weights, model.weights)


def test_maximal_segments_against_all_segments():
    chance = np.random.default_rng(0)
    for _ in range(200):
        scores = np.where(chance.random(14) < 0.4, chance.integers(1, 5, 14), 0)
        places = np.flatnonzero(scores)
        found = toxicity.maximal_segments(places, scores[places].astype(float), -1.0)
        line = np.where(scores > 0, scores, -1)

        def split(a: int, b: int) -> list[tuple[float, int, int]]:
            """Best segment, longest first of equal ones; then left and right of it."""
            best = max(((line[i : j + 1].sum(), i - j, -i, j) for i in range(a, b) for j in range(i, b)), default=(0, 0, 0, 0))
            if best[0] <= 0:
                return []
            i, j = -best[2], best[3]
            return [*split(a, i), (best[0], i, j), *split(j + 1, b)]

        assert sum(s for s, _, _ in found) == pytest.approx(sum(s for s, _, _ in split(0, 14)))
        assert max((s for s, _, _ in found), default=0) == pytest.approx(max((s for s, _, _ in split(0, 14)), default=0))


def test_toxicity_of_odd_rows(fitted, odd_documents, no_documents, spark):
    documents, labels, model = fitted
    rows = toxicity.score_documents(odd_documents, model).collect()
    assert len(rows) == odd_documents.count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.score_documents(no_documents, model).count() == 0
    empty = toxicity.fit(documents, labels.limit(0))
    assert {r["score"] for r in toxicity.score_documents(odd_documents, empty).collect()} == {0.0}


def test_language_from_text_alone(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    half = documents.filter("doc_id % 2 = 0")
    model = language.fit(half)
    found = language.identify(documents.filter("doc_id % 2 = 1 and n_chars > 100"), model, host="source")
    rows = found.join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["language"] == r["lang"] for r in rows]) > 0.98


def test_evidence_is_fused(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(documents)
    english = documents.filter("lang = 'en' and n_chars > 500").first()["text"]
    rows = [
        (0, english, "de", "http://a.example.de/x", "a"),
        (1, None, "fr", "http://b.example.com/", "b"),
        (2, "", None, "http://c.example.de/", "c"),
        (3, "", None, None, None),
        (4, "12345 67890 +++", None, None, None),
        (5, "Ωμέγα και άλφα είναι γράμματα " * 30, None, None, None),
        *((10 + i, english, None, None, "english host") for i in range(30)),
        (40, "", None, None, "english host"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, url string, source string")
    found = {r["doc_id"]: r for r in language.identify(frame, model, declared="lang", address="url", host="source").collect()}
    # a long text outweighs wrong declarations; without text they decide, then hosts and addresses
    assert found[0]["language"] == "en" and found[1]["language"] == "fr"
    assert found[2]["posterior"] < found[1]["posterior"]
    assert found[40]["language"] == "en" and found[40]["posterior"] > found[3]["posterior"]
    assert found[5]["language"] == language.UNKNOWN and not found[5]["kept"]
    assert all(not r["kept"] or r["posterior"] >= language.LEAST_POSTERIOR for r in found.values())


def test_language_of_odd_rows(odd_documents, no_documents):
    found = language.identify_documents(odd_documents).collect()
    assert len(found) == odd_documents.count()
    assert language.identify_documents(no_documents).count() == 0
    unlabelled = language.identify(odd_documents, language.fit(no_documents)).collect()
    assert {r["language"] for r in unlabelled} == {language.UNKNOWN}


def _texts(spark, rows: list[tuple]) -> dict:
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["page_id"]: (r["text"], r["n_chars"]) for r in pages.main_text(frame).collect()}


def test_marked_articles_are_kept_whole(spark):
    page = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="<p>no</p>";</script></head>
    <body><nav><ul><li>Home</ul></nav><!-- <p>no</p> --><div class="top ad">buy</div><article><h1>A &amp; B&nbsp;C</h1>
    <p><b>bold  text<br>goes
    on<p title="a > b">second &lt;p&gt;</p><form><input value=x>send</form><section class="comments"><p>me too</p></section>
    <p></p><ul><li>one<li>two</ul></article><aside>more</aside><footer>&copy; x</footer></body></html>"""
    shared = "<article><p>the same words on every page of this host are its article</p></article>"
    rows = [(1, "http://a.example/1", page), (2, "http://b.example/1", shared), (3, "http://b.example/2", shared)]
    rows += [(4, None, None), (5, "x", ""), (6, "http://c.example", "<nav>menu<article><p>in it"), (6, "http://c.example", "plain &eacute; text")]
    found = _texts(spark, rows[:6])
    text = "A & B C\nbold text goes on\nsecond <p>\none\ntwo"
    assert found[1] == (text, len(text))
    assert found[2][0] == found[3][0] == "the same words on every page of this host are its article"
    assert found[4] == found[5] == ("", 0) and found[6][0] == "in it"


def test_unmarked_boilerplate_is_found_by_the_host(spark, monkeypatch):
    monkeypatch.setattr(pages, "PART_WORDS", 200)
    menu = "Home News Sport Weather Travel Video Music Contact About"
    rows = [
        (i, f"http://h.example/{i}", f"<html><body><div>{menu}</div><div>body{i} has words{i} of its own number{i}</div><p>All rights are reserved by the owners of h</p></body></html>")
        for i in range(40)
    ]
    rows.append((99, "http://other.example/", f"<body><div>{menu}</div><div>alone</div></body>"))
    found = _texts(spark, rows)
    assert all(found[i][0] == f"body{i} has words{i} of its own number{i}" for i in range(40))
    assert found[99][0] == f"{menu}\nalone"


def test_shared_words_against_all_windows():
    chance = np.random.default_rng(7)
    for _ in range(60):
        streams = [[f"w{x}" for x in chance.integers(0, 3, chance.integers(0, 40))] for _ in range(4)]
        size = pages.LEAST_SHARED
        where: dict[tuple, set[int]] = {}
        for number, words in enumerate(streams):
            for at in range(len(words) - size + 1):
                where.setdefault(tuple(words[at : at + size]), set()).add(number)
        wanted = []
        for words in streams:
            mark = [False] * len(words)
            for at in range(len(words) - size + 1):
                if len(where[tuple(words[at : at + size])]) > 1:
                    mark[at : at + size] = [True] * size
            wanted.append(mark)
        assert [list(map(bool, c)) for c in pages.shared_words(streams)] == wanted


def test_no_pages(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert pages.main_text(none).count() == 0
