"""Every label is a language, and labels and declarations are whole tags."""

from __future__ import annotations

from tripcohorts.llm import language


def _frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_every_label_is_modelled(spark):
    # the 70 languages differ in their letters; the last ones have fewest texts
    rows = []
    for number in range(70):
        word = f"{chr(97 + number % 26)}{chr(97 + number // 26)}qx"
        rows += [(1000 * number + i, f"{word} {word}{word} " * 40, f"x{number:02d}", f"s{number}") for i in range(2 if number >= 64 else 3)]
    model = language.fit(_frame(spark, rows))
    assert len(model.languages) == 70
    found = language.identify(_frame(spark, rows), model, declared="lang", host="source").collect()
    wanted = {r[0]: r[2] for r in rows}
    assert all(r["language"] == wanted[r["doc_id"]] and r["kept"] for r in found)


def test_tags_are_whole(spark):
    rows = [(i, "the same words of a text " * 3, tag, None) for i, tag in enumerate(["ceb", "fi", "pt-BR", "pt_br", "PT-br"])]
    model = language.fit(_frame(spark, rows))
    assert model.languages == ["ceb", "fi", "pt-br"]
    told = [(0, "", "ceb", None), (1, "", "PT_BR", None), (2, "", "fi-FI", None), (3, "", "fil", None), (4, "", None, None)]
    found = {r["doc_id"]: r for r in language.identify(_frame(spark, told), model, declared="lang").collect()}
    assert [found[i]["language"] for i in range(3)] == ["ceb", "pt-br", "fi"]
    # what no label names says nothing
    assert found[3]["posterior"] == found[4]["posterior"] < found[2]["posterior"]
