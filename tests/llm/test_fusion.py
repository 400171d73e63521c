"""Fused evidence against a plain version that goes from text to text."""

from __future__ import annotations

import math
import random

import pyarrow as pa

from tripcohorts.llm import language

SF = "/root/testdata/sf0.001"


def _plain(rows: list[dict], model) -> dict:
    """key -> language, posterior of rows with text, declared, suffix and host."""
    classes = [*model.languages, language.UNKNOWN]
    size = len(classes)
    found = model.likelihoods(pa.array([r["text"] or "" for r in rows], pa.string()))
    own = []
    for weights in found:
        shares = [math.exp(w) for w in weights]
        own.append([s / sum(shares) for s in shares])

    def total(keep) -> list[float]:
        return [sum(o[c] for r, o in zip(rows, own, strict=True) if keep(r, o)) for c in range(size)]

    def smooth(shares, above, weight):
        return [(n + weight * p) / (sum(shares) + weight) for n, p in zip(shares, above, strict=True)]

    everything = total(lambda r, o: True)
    overall = [(everything[c] + 1) / (sum(everything) + size) for c in range(size - 1)] + [language.UNKNOWN_SHARE]
    seen = total(lambda r, o: r["declared"] and max(o) >= language.SURE)
    wrong = (1 - language.DECLARED_RIGHT) / max(1, size - 1)
    result = {}
    for row, weights in zip(rows, found, strict=True):
        first = overall
        pointed = language.SUFFIX_LANGUAGE.get(row["suffix"])
        if pointed in model.languages:
            right, missed = language.SUFFIX_RIGHT, (1 - language.SUFFIX_RIGHT) / (size - 1)
            first = [p * (right if name == pointed else missed) for p, name in zip(overall, classes, strict=True)]
            first = [p / sum(first) for p in first]
        above = smooth(total(lambda r, o: r["suffix"] == row["suffix"]), first, language.ALL_WEIGHT)
        prior = smooth(
            total(lambda r, o: (r["suffix"], r["host"]) == (row["suffix"], row["host"])), above, language.SUFFIX_WEIGHT
        )
        score = [w + math.log(p + 1e-12) for w, p in zip(weights, prior, strict=True)]
        if row["declared"]:
            told = total(lambda r, o: r["declared"] == row["declared"] and max(o) >= language.SURE)
            for c, name in enumerate(classes):
                before = language.DECLARED_RIGHT if row["declared"] == name else wrong
                weight = language.DECLARED_WEIGHT
                learned = (told[c] + weight * before) / (seen[c] + weight)
                score[c] += math.log(before if name == language.UNKNOWN else learned)
        top = max(score)
        parts = [math.exp(s - top) for s in score]
        best = max(range(size), key=lambda c: (parts[c], -c))
        result[row["doc_id"]] = (classes[best], parts[best] / sum(parts))
    return result


def test_fusion_against_a_plain_version(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(documents)
    chance = random.Random(5)
    rows = []
    for r in documents.orderBy("doc_id").collect():
        text = r["text"]
        text = chance.choice([text, text, (text or "")[:12], "", None])
        suffix, host = chance.choice([("de", "a"), ("de", "b"), ("com", "c"), (None, "a"), (None, None)])
        declared = chance.choice([r["lang"], r["lang"], *model.languages, "zz", None])
        rows.append({"doc_id": r["doc_id"], "text": text, "declared": declared, "suffix": suffix, "host": host})
    frame = spark.createDataFrame(
        [(r["doc_id"], r["text"], r["declared"], f"http://x.{r['suffix']}/p" if r["suffix"] else None, r["host"]) for r in rows],
        "doc_id long, text string, declared string, url string, host string",
    )
    # what names no label says nothing
    known = [r | {"declared": r["declared"] if r["declared"] in model.languages else None} for r in rows]
    wanted = _plain(known, model)
    found = language.identify(frame, model, declared="declared", address="url", host="host").collect()
    assert len(found) == len(rows)
    for r in found:
        name, posterior = wanted[r["doc_id"]]
        assert abs(r["posterior"] - posterior) < 1e-9
        assert r["language"] == name
        assert r["kept"] == (name != language.UNKNOWN and posterior >= language.LEAST_POSTERIOR)


def test_declarations_count_as_far_as_texts_bear_them_out(spark):
    # texts tell "en" and "de" apart; on these pages "fr" is declared for what is German
    german, english = "der die das und nicht ist ein eine mit von ", "the and of to in is that it was for "
    french = "le la les et des une dans pour que qui "
    labelled = [(i, text * 20, lang, None) for i, (text, lang) in enumerate([(german, "de"), (english, "en"), (french, "fr")] * 5)]
    schema = "doc_id long, text string, lang string, source string"
    model = language.fit(spark.createDataFrame(labelled, schema))
    rows = [(i, german * 20, "fr", None) for i in range(400)] + [(1000 + i, english * 20, "en", None) for i in range(400)]
    rows += [(2000 + i, french * 20, None, None) for i in range(400)]
    rows += [(3000, "", "fr", None), (3001, "", "en", None)]
    found = {r["doc_id"]: r for r in language.identify(spark.createDataFrame(rows, schema), model, declared="lang").collect()}
    assert found[3000]["language"] == "de"
    assert found[3001]["language"] == "en"
