"""Toxicity of texts by maximum-scoring segments over the log-odds of their tokens.

Log-odds of each word and of each beginning of a word between toxic and other labelled texts have an informative Dirichlet prior
(the words of both), and only their lower confidence bound counts; a word scores as the best of
itself and its beginnings, so inflected and compound forms count too. A linear scan over a text finds
all maximal segments: passages that score higher than any part of them and cannot be extended
with gain. Scores of segments are set against what texts of the same length without the label reach
by chance (an extreme-value distribution), and a logistic curve turns the excess of the best
segment, of all significant ones together and their share of the text into a probability.

Edge cases: a null or empty text has no segments and gets the score of an inconspicuous text.
Repeated rows each get their row. Without any labelled row, or with only one kind of label, all
scores are 0. An empty table gives no rows; further columns are ignored, and neither ids nor sources
nor languages enter a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcohorts.llm.common import map_texts, text_of, written
from tripcohorts.llm.words import LOWER, PART_BYTES, Rolling, Words, mixed, split_words, text_bytes

#: Labelled rows that the model is fitted on at most: those whose ids hash lowest.
TRAINING_ROWS = 20_000

#: Strength of the prior, in words, besides half an occurrence of each word; standard deviations of the
#: lower bound; share of the different toxic texts that must hold a word (a group of near copies does not).
PRIOR_WORDS, DEVIATIONS, LEAST_SHARE = 500.0, 3.0, 0.02

#: Letters, digits and bytes of other scripts make words.
_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


#: Bytes of the beginnings of words that are counted beside whole words.
BEGINNINGS = (4, 5, 6, 7, 8)

#: Score of a word without a score of its own.
DRIFT = -0.05


def held_out(doc_id: str = "doc_id") -> Column:
    """The fifth of the ids that no label is learned from."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0


def training_rows(documents: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """text, label (0 or 1) of at most TRAINING_ROWS labelled texts."""
    known = labels.filter(F.col(label).isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
    chosen = known.filter(~held_out()).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(TRAINING_ROWS)
    return documents.select("doc_id", text_of().alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "label")


def units(words: Words, rolling: Rolling) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words (places) and hashes of the whole words, then of their beginnings of each length."""
    yield np.arange(len(words.starts)), words.hashes
    for size in BEGINNINGS:
        long = np.flatnonzero(words.ends - words.starts >= size)
        start = words.starts[long]
        yield long, mixed(rolling.of(start, start + size), 5)


def word_counts(rows: DataFrame) -> DataFrame:
    """word, and for both labels the number of its occurrences and of different texts with it."""

    def work(part: pa.RecordBatch) -> dict:
        data, bounds = text_bytes(part.column("text"))
        rolling = Rolling(LOWER[data])
        words = split_words(data, bounds, _SEPARATOR, rolling)
        place, hashes = (np.concatenate(parts) for parts in zip(*units(words, rolling), strict=True))
        text = words.text[place]
        label = part.column("label").to_numpy()[text].astype(np.uint64)
        key = mixed(hashes * np.uint64(2) + label)
        order = np.lexsort((text, key))
        key, text = key[order], text[order]
        new = np.append(True, key[1:] != key[:-1])[: len(key)]
        first = np.flatnonzero(new)
        total = np.diff(np.append(first, len(key)))
        fresh = new | np.append(True, text[1:] != text[:-1])[: len(key)]
        texts = np.add.reduceat(fresh.astype(np.int64), first) if len(first) else first
        return {
            "word": hashes[order][first].view(np.int64),
            "label": label[order][first].astype(np.int32),
            "total": total,
            "texts": texts,
        }

    counted = map_texts(rows, work, "word long, label int, total long, texts long", limit=PART_BYTES)

    def of(column: str, label: int) -> Column:
        return F.sum(F.when(F.col("label") == label, F.col(column)).otherwise(0))

    return counted.groupBy("word").agg(
        of("total", 1).alias("toxic"), of("total", 0).alias("other"), of("texts", 1).alias("texts")
    )


def log_odds(counts: DataFrame, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Words with a positive lower bound, sorted, and their scores.

    `texts` is the number of different toxic texts.
    """
    totals = counts.agg(F.sum("toxic"), F.sum("other")).first()
    toxic, other = float(totals[0] or 0), float(totals[1] or 0)
    if not toxic or not other:
        return np.zeros(0, np.uint64), np.zeros(0)
    prior = (F.col("toxic") + F.col("other")) * F.lit(PRIOR_WORDS / (toxic + other)) + 0.5
    a, b = F.col("toxic") + prior, F.col("other") + prior
    delta = F.log(a / (toxic + PRIOR_WORDS - a)) - F.log(b / (other + PRIOR_WORDS - b))
    bound = delta - DEVIATIONS * F.sqrt(1 / a + 1 / b)
    known = (
        counts.select("word", "toxic", "other", "texts", bound.alias("bound"))
        .filter((F.col("bound") > 0) & (F.col("texts") >= max(3, LEAST_SHARE * texts)))
        # each is in a share of the toxic texts: at most 1 / LEAST_SHARE times the words of one text
        .toPandas()
    )
    words = known["word"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    return words[order], known["bound"].to_numpy()[order]


def maximal_segments(places: np.ndarray, scores: np.ndarray, drift: float = DRIFT) -> list[tuple[float, int, int]]:
    """(score, first, last place) of all maximal segments, in time that grows with the places.

    `places` are those with a positive score; all between them score `drift`. Each candidate holds
    the sum before it and at its end; a later one joins with the nearest earlier one that begins
    lower, if that has not yet reached higher. A candidate also holds where that earlier one is, so the search
    jumps from link to link and never looks twice at what a link passes over.
    """
    found: list[tuple[float, float, int, int, int]] = []
    total, at = 0.0, -1
    for place, score in zip(places.tolist(), scores.tolist(), strict=True):
        total += drift * (place - at - 1)
        begin, end, first = total, total + score, place
        total, at = end, place
        lower = len(found) - 1
        while True:
            while lower >= 0 and found[lower][0] >= begin:
                lower = found[lower][4]
            if lower < 0 or found[lower][1] >= end:
                found.append((begin, end, first, place, lower))
                break
            begin, _, first, _, before = found[lower]
            del found[lower:]
            lower = before
    return [(end - begin, first, last) for begin, end, first, last, _ in found]


@dataclass
class Model:
    words: np.ndarray
    scores: np.ndarray
    #: Rate and constant of the extreme-value distribution, and weights of the logistic curve.
    rate: float = 1.0
    constant: float = 1.0
    weights: np.ndarray | None = None

    def segments(self, column: pa.Array) -> tuple[np.ndarray, list[list[tuple[float, int, int]]]]:
        """Number of words and maximal segments of each text."""
        data, bounds = text_bytes(column)
        rolling = Rolling(LOWER[data])
        words = split_words(data, bounds, _SEPARATOR, rolling)
        score = np.zeros(len(words.starts))
        if len(self.words):
            # most words are turned away by a few bits of their hash
            low = np.zeros(1 << 16, bool)
            low[self.words & np.uint64(0xFFFF)] = True
            for place, hashes in units(words, rolling):
                maybe = np.flatnonzero(low[hashes & np.uint64(0xFFFF)])
                place, hashes = place[maybe], hashes[maybe]
                at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
                hit = self.words[at] == hashes
                score[place[hit]] = np.maximum(score[place[hit]], self.scores[at[hit]])
        hits = np.flatnonzero(score)
        cuts = np.searchsorted(words.text[hits], np.arange(len(bounds)))
        found = []
        for row, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            found.append(maximal_segments(hits[a:b] - words.first[row], score[hits[a:b]]) if b > a else [])
        return words.counts, found

    def features(self, counts: np.ndarray, found: list[list[tuple[float, int, int]]]) -> np.ndarray:
        """1, excess of the best segment, of all significant ones, and their score for each word."""
        rows = np.zeros((len(counts), 4))
        rows[:, 0] = 1
        for row, (count, segments) in enumerate(zip(counts, found, strict=True)):
            if segments:
                scores = np.array([s for s, _, _ in segments])
                excess = self.rate * scores - np.log(self.constant * count + 1)
                rows[row, 1] = excess.max()
                rows[row, 2] = np.log1p(np.maximum(excess, 0).sum())
                rows[row, 3] = np.log1p(100 * scores.sum() / count)
        return rows

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(features))
        return 1 / (1 + np.exp(-np.clip(features @ self.weights, -30, 30)))


def calibrated(model: Model, rows: DataFrame) -> Model:
    """Fits the extreme-value distribution and the logistic curve on the segments of labelled texts."""

    def work(part: pa.RecordBatch) -> dict:
        counts, found = model.segments(part.column("text"))
        return {"label": part.column("label"), "count": counts, "scores": [[s for s, _, _ in f] for f in found]}

    # TRAINING_ROWS rows at most
    known = map_texts(rows, work, "label int, count long, scores array<double>", limit=PART_BYTES).toPandas()
    label = known["label"].to_numpy(float)
    counts = known["count"].to_numpy()
    found = [[(s, 0, 0) for s in scores] for scores in known["scores"]]
    best = np.array([max((s for s, _, _ in f), default=0.0) for f in found])
    chance = best[(label == 0) & (counts > 0)]
    if not 0 < label.sum() < len(label):
        return model
    # a Gumbel distribution by its moments; its location grows with the logarithm of the length
    deviation = chance.std() or 1.0
    model.rate = np.pi / (deviation * 6**0.5)
    location = chance.mean() - 0.5772 / model.rate
    model.constant = float(np.exp(model.rate * location) / max(1.0, np.median(counts)))
    x = model.features(counts, found)
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + np.diag([1e-6, 1e-2, 1e-2, 1e-2])
        step = np.linalg.solve(hessian, x.T @ (label - p) - np.array([0, 1e-2, 1e-2, 1e-2]) * weights)
        weights += step
        if abs(step).max() < 1e-6:
            break
    model.weights = weights
    return model


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    rows = written(training_rows(documents, labels, label), "training")
    # exact copies say nothing new about words
    distinct = rows.dropDuplicates(["text"])
    toxic = distinct.filter("label = 1").count()
    model = Model(*log_odds(written(word_counts(distinct), "words"), toxic))
    return calibrated(model, rows)


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, and `passages`: first word, words and score of each significant segment."""

    def work(part: pa.RecordBatch) -> dict:
        counts, found = model.segments(part.column("text"))
        limit = [np.log(model.constant * count + 1) / model.rate for count in counts]
        passages = [
            [{"first": a, "words": b - a + 1, "score": s} for s, a, b in segments if s > least]
            for segments, least in zip(found, limit, strict=True)
        ]
        return {
            "doc_id": part.column("doc_id"),
            "score": model.score(model.features(counts, found)),
            "passages": passages,
        }

    rows = documents.select("doc_id", text_of().alias("text"))
    schema = "doc_id long, score double, passages array<struct<first: long, words: long, score: double>>"
    return map_texts(rows, work, schema, limit=PART_BYTES)
