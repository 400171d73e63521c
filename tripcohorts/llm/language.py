"""Language of texts by Bayesian fusion of what the text, its markup, its address and its host say.

The text gives a likelihood for each language (bytes in fours, naive Bayes, damped since neighbouring
fours overlap). A declared language is observed through a confusion table: how often each language is
declared so, summed over all texts that are sure by themselves. The prior of a language is that of
the host, smoothed towards the address suffix and this towards all texts, from sums of the texts' own
posteriors over the whole table. What a suffix or a declaration is believed to say at first counts for
some texts only, and the sums outweigh it. A class "und" stands for text of no known language, of which
a declaration is never learned; texts whose best class it is, or that have no clear best one, are rejected.

Edge cases: a null or empty text says nothing; without any other evidence it is "und" and rejected,
with a declared language it is as sure as that declaration. Labels and declarations are whole tags, in lower
case and with hyphens; a declaration without a label of its own (en-US) is that of the longest beginning
of whole subtags that has one (en). Null evidence of any kind is left out. Repeated
rows each get their row. Without any labelled row everything is "und". An empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripcohorts.llm.common import map_texts, text_of, written
from tripcohorts.llm.words import LOWER, PART_BYTES, mixed, text_bytes

UNKNOWN = "und"

#: Labelled rows of each language that the model is fitted on at most: those whose text hashes lowest.
ROWS_OF_LANGUAGE = 1_500

#: Counters of byte groups, bytes of a group, weight of all groups together in a table of counters.
COUNTERS, GROUP, SMOOTHING = 1 << 15, 4, 0.5

#: Weight of each group, as neighbouring ones are not independent, and groups that count in full.
DAMPING, FULL_GROUPS = 0.25, 400

#: Log-likelihood of a group in text of no known language, below the mean of the languages.
UNKNOWN_COST = 2.5

#: Share of right declarations before any is seen, the texts of a language that this counts for, and the posterior by
#: its own words that a text needs to be counted.
DECLARED_RIGHT, DECLARED_WEIGHT, SURE = 0.9, 20.0, 0.9

#: Share of right address suffixes before any is seen; weight of the suffix's and of all texts' shares in a prior.
SUFFIX_RIGHT, SUFFIX_WEIGHT, ALL_WEIGHT = 0.6, 20.0, 20.0

#: Prior share of text of no known language; posterior that a kept text needs.
UNKNOWN_SHARE, LEAST_POSTERIOR = 0.01, 0.5

#: Country suffixes of addresses that point to a language at first.
SUFFIX_LANGUAGE = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "ie": "en", "au": "en"}


def _groups(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Counter of each group of bytes, and the text it is in; runs of digits and signs count as spaces."""
    data, bounds = text_bytes(column)
    plain = _PLAIN[data].astype(np.uint64)
    count = len(plain) - GROUP + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    value = np.zeros(count, np.uint64)
    for place in range(GROUP):
        value = value << np.uint64(8) | plain[place : place + count]
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    # at least one letter, and within one text
    whole = np.flatnonzero((owner[:count] == owner[GROUP - 1 :]) & (value != np.uint64(0x20202020)))
    return (mixed(value[whole]) % np.uint64(COUNTERS)).astype(np.int64), owner[whole]


_PLAIN = LOWER.copy()
_PLAIN[[b for b in range(128) if not 97 <= LOWER[b] <= 122]] = 0x20


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # log-likelihood of a group: counters by languages

    def likelihoods(self, column: pa.Array) -> np.ndarray:
        """Damped log-likelihood of each text in each language, and last in no known one."""
        group, owner = _groups(column)
        size = len(self.languages)
        result = np.zeros((len(column), size + 1))
        number = np.bincount(owner, minlength=len(column))
        for place in range(size):
            result[:, place] = np.bincount(owner, self.table[group, place], len(column)) if len(group) else 0
        weight = DAMPING * np.minimum(1, FULL_GROUPS / np.maximum(number, 1))
        best = result[:, :size].max(axis=1, initial=-np.inf) if size else np.zeros(len(column))
        result[:, size] = np.where(number > 0, number * self.floor, 0)
        return (result - np.where(size, best, 0)[:, None]) * weight[:, None]

    floor: float = 0.0


def tag_of(column: str) -> Column:
    """A language tag in lower case with hyphens, null where it is empty."""
    tag = F.lower(F.trim(F.regexp_replace(F.col(column), "_", "-")))
    return F.when(tag != "", tag)


def declared_label(tag: str | None, labels: Collection[str]) -> str | None:
    """The label that a tag or else the longest beginning of its subtags equals."""
    while tag and tag not in labels:
        tag = tag.rpartition("-")[0]
    return tag or None


def fit(labelled: DataFrame, label: str = "lang") -> Model:
    """A model of all languages that label some texts; bounded samples of each."""
    known = labelled.filter(F.length("text") > 0).select("text", tag_of(label).alias("label")).filter("label is not null")
    counts = known.groupBy("label").agg(F.count("*").alias("texts")).collect()
    languages = sorted(r["label"] for r in counts)
    place = {language: index for index, language in enumerate(languages)}
    if not languages:
        return Model([], np.zeros((COUNTERS, 0)))

    def work(part: pa.RecordBatch) -> dict:
        group, owner = _groups(part.column("text"))
        language = np.array([place[name] for name in part.column("label").to_pylist()], np.int64)
        keys, seen = np.unique(language[owner] * COUNTERS + group, return_counts=True)
        return {"language": keys // COUNTERS, "counter": keys % COUNTERS, "seen": seen}

    # texts that hash lowest within each language, by a threshold that takes about the wanted number
    share = {r["label"]: min(1.0, ROWS_OF_LANGUAGE / r["texts"]) for r in counts}
    threshold = F.create_map(*[F.lit(x) for name, part in share.items() for x in (name, int(part * 2**31))])
    rows = known.filter(F.pmod(F.xxhash64("text"), F.lit(2**31)) < threshold[F.col("label")])
    seen = map_texts(rows, work, "language long, counter long, seen long", limit=PART_BYTES)
    seen = seen.groupBy("language", "counter").agg(F.sum("seen").alias("seen"))

    def packed(one: pd.DataFrame) -> pd.DataFrame:
        totals = np.bincount(one["counter"], one["seen"], COUNTERS)
        return pd.DataFrame({"language": one["language"].iloc[:1], "totals": [totals.tobytes()]})

    # one row of COUNTERS numbers for each language
    table = np.full((COUNTERS, len(languages)), SMOOTHING)
    for language, totals in seen.groupBy("language").applyInPandas(packed, "language long, totals binary").toLocalIterator():
        table[:, language] += np.frombuffer(totals)
    table = np.log(table / table.sum(axis=0))
    own = (np.exp(table) * table).sum(axis=0).mean()
    return Model(languages, table, float(own - UNKNOWN_COST))


def _suffix(address: Column) -> Column:
    """Last part of the host name of an address."""
    host = F.lower(F.regexp_extract(address, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return F.substring_index(host, ".", -1)


def _normal(weights: Column) -> Column:
    """Probabilities from log weights."""
    top = F.array_max(weights)
    shifted = F.transform(weights, lambda w: F.exp(w - top))
    total = F.aggregate(shifted, F.lit(0.0), lambda a, b: a + b)
    return F.transform(shifted, lambda w: w / total)


def _sums(rows: DataFrame, size: int, *keys: str) -> DataFrame:
    """Sums of the posteriors for each group, as an array `shares`."""
    each = [F.sum(F.col("own")[place]).alias(f"s{place}") for place in range(size)]
    grouped = rows.groupBy(*keys).agg(*each) if keys else rows.agg(*each)
    return grouped.select(*keys, F.array(*[F.coalesce(f"s{place}", F.lit(0.0)) for place in range(size)]).alias("shares"))


def identify(
    texts: DataFrame,
    model: Model,
    key: str = "doc_id",
    text: str = "text",
    declared: str | None = None,
    address: str | None = None,
    host: str | None = None,
) -> DataFrame:
    """The key, detected language, its posterior, and kept, for every row."""
    classes = [*model.languages, UNKNOWN]
    size = len(classes)
    labels = frozenset(model.languages)
    null = F.lit(None).cast("string")
    kind = texts.schema[key].dataType.simpleString()

    def work(part: pa.RecordBatch) -> dict:
        found = model.likelihoods(part.column("text"))
        own = np.exp(found) / np.exp(found).sum(axis=1, keepdims=True)
        names = ("key", "suffix", "host")
        told = [declared_label(tag, labels) for tag in part.column("declared").to_pylist()]
        return {name: part.column(name) for name in names} | {"declared": told, "found": list(found), "own": list(own)}

    rows = texts.select(
        F.col(key).alias("key"),
        text_of(text).alias("text"),
        (tag_of(declared) if declared else null).alias("declared"),
        (_suffix(F.col(address)) if address else null).alias("suffix"),
        (F.col(host) if host else null).alias("host"),
    )
    schema = f"key {kind}, declared string, suffix string, host string, found array<double>, own array<double>"
    known = written(map_texts(rows, work, schema, limit=PART_BYTES), "language")

    # shares of all texts, of address suffixes and of hosts, each smoothed by the one before
    total = _sums(known, size).first()[0]
    every = sum(total) or 1.0
    base = [UNKNOWN_SHARE if name == UNKNOWN else (total[i] + 1) / (every + size) for i, name in enumerate(classes)]
    overall = F.array(*[F.lit(float(share)) for share in base])

    def smoothed(shares: str, above: Column, weight: float) -> Column:
        number = F.aggregate(shares, F.lit(0.0), lambda a, b: a + b)
        return F.zip_with(shares, above, lambda n, p: (n + weight * p) / (number + weight))

    blank = "\0"
    places = known.select(F.coalesce("suffix", F.lit(blank)).alias("suffix"), F.coalesce("host", F.lit(blank)).alias("host"), "own")
    hosts = written(_sums(places, size, "suffix", "host"), "hosts")
    suffixes = _sums(hosts.withColumnRenamed("shares", "own"), size, "suffix")
    names = F.array(*[F.lit(name) for name in classes])

    def told_by(label: Column, right: float) -> Column:
        """Rate of an observation that names one of the languages for each class, before any is seen."""
        wrong = (1 - right) / max(1, size - 1)
        return F.transform(names, lambda name: F.when(label == name, F.lit(right)).otherwise(F.lit(wrong)))

    pointed = F.coalesce(*[F.when(F.col("suffix") == suffix, F.lit(name)) for suffix, name in SUFFIX_LANGUAGE.items()])
    tilted = F.transform(F.zip_with(overall, told_by(pointed, SUFFIX_RIGHT), lambda p, rate: p * rate), F.ln)
    first = F.when(pointed.isin(*model.languages), _normal(tilted)).otherwise(overall)
    suffixes = suffixes.select("suffix", smoothed("shares", first, ALL_WEIGHT).alias("above"))
    priors = hosts.join(suffixes, "suffix").select("suffix", "host", smoothed("shares", F.col("above"), SUFFIX_WEIGHT).alias("prior"))

    # how often each language is declared so
    sure = known.filter("declared is not null").filter(F.array_max("own") >= SURE)
    told = written(_sums(sure, size, "declared"), "declared")
    seen = F.array(*[F.lit(float(number)) for number in _sums(told.withColumnRenamed("shares", "own"), size).first()[0]])
    nothing = F.transform(names, lambda name: F.lit(0.0))
    believed = told_by(F.col("declared"), DECLARED_RIGHT)
    rates = F.zip_with(F.coalesce("shares", nothing), believed, lambda n, p: n + DECLARED_WEIGHT * p)
    rates = F.zip_with(rates, seen, lambda n, number: n / (number + DECLARED_WEIGHT))
    rates = F.concat(F.slice(rates, 1, size - 1), F.slice(believed, size, 1))
    rates = F.transform(rates, F.ln)

    joined = known.withColumns({"at": F.coalesce("suffix", F.lit(blank)), "of": F.coalesce("host", F.lit(blank))})
    joined = joined.join(priors.toDF("at", "of", "prior"), ["at", "of"], "left").join(told, "declared", "left")
    weights = F.transform(F.coalesce("prior", overall), lambda p: F.log(p + 1e-12))
    for evidence in (F.col("found"), F.when(F.col("declared").isNotNull(), rates).otherwise(nothing)):
        weights = F.zip_with(weights, evidence, lambda a, b: a + b)
    scored = joined.withColumn("posterior", _normal(weights))
    best = F.array_max("posterior")
    language = F.element_at(names, F.array_position("posterior", best).cast("int"))
    result = scored.select(F.col("key").alias(key), language.alias("language"), best.alias("posterior"))
    kept = (F.col("language") != UNKNOWN) & (F.col("posterior") >= LEAST_POSTERIOR)
    return result.withColumn("kept", kept)


def identify_documents(documents: DataFrame) -> DataFrame:
    """doc_id, language, posterior, kept. The source of a document is its host, `lang` its declaration."""
    return identify(documents, fit(documents), declared="lang", host="source")
