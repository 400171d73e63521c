"""Tags of pages: marks within an article, articles of readers, and long broken pages."""

from __future__ import annotations

import time

import pytest

from tripcohorts.llm.pages import blocks_of


def article(page: str) -> list[str]:
    return blocks_of(page)[0]


def test_marks_within_an_article_say_nothing_about_headings_and_paragraphs():
    page = '<article><h1 class="article-header">Title</h1><p>Body</p><p class="related-work">More</p><div class="share">Share</div><p hidden>x</p></article>'
    assert article(page) == ["Title", "Body", "More"]


def test_an_article_of_a_reader_is_none_of_the_page():
    page = '<article class="post has-sidebar">Own</article><article class="comment odd">A reader<p>writes</p></article><article>Second</article>'
    assert article(page) == ["Own", "Second"]
    assert article('<article>Own<article id="comment-7">A reader</article> and more</article>') == ["Own", "and more"]


def test_quotes_hold_angles_and_broken_ones_do_not_swallow_the_page():
    assert article('<article title="a > b" data-x=\'<p>\'>One<p>Two</article>') == ["One", "Two"]
    assert article("<article>One<p title=\"a>Two</p><p>Three</article>") == ["One", "Two", "Three"]
    assert article("<article>1 < 2 <3 & 4 > 3 <!DOCTYPE x><!-- a <p> --> 5</article>") == ["1 < 2 <3 & 4 > 3 5"]
    assert article("<article>One<!-- never closed <p>Two") == ["One"]


@pytest.mark.parametrize(
    "page",
    ["<" * 1_000_000, "<a" * 500_000, "<a " * 333_333 + ">", "<a '" * 250_000, "<a \"'" * 200_000 + ">", "<p>" * 300_000, "<a>'\"" * 160_000, "<!--" * 250_000, "<![a" * 250_000, "<script>" * 125_000, "<a b='" * 170_000 + ">" * 1000, "<a=" * 1000 + "<b>\"" * 200_000],
    ids=range(12),
)
def test_long_broken_pages_end_soon(page):
    start = time.perf_counter()
    blocks_of(page)
    assert time.perf_counter() - start < 4
