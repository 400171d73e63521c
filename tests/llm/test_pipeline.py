"""Stages of the corpus pipeline and the registered queries."""

from __future__ import annotations

import duckdb
import pytest
from brute import components

import __spark_entry__ as entry
import corpus_pipeline

SMALL = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_clean_documents(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, SMALL)
        assert result.dtypes == docs.dtypes, name
        docs = corpus_pipeline.written(result, "test")
    before = {r["doc_id"]: r["text"] for r in documents.collect()}
    after = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(after) == docs.count() > 0.7 * len(before)
    assert sum(before[i] == text for i, text in after.items()) > 0.6 * len(after)
    assert all(len(text) == n for text, n in docs.select("text", "n_chars").collect())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r["doc_id"] for r in pieces} == set(after)


def test_one_document_of_each_group_stays(spark, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    roots = components(texts, 5, 80)
    kept = corpus_pipeline.without_near_duplicates(spark, documents, SMALL).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(roots.values()))


def test_copies_without_an_id_go(spark):
    one, two, three = (" ".join(f"{word}{i}" for i in range(60)) for word in ("a", "b", "c"))
    rows = [(1, one), (None, one), (None, two), (None, two), (None, two + " more"), (None, three), (None, None), (2, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.without_near_duplicates(spark, frame, SMALL).collect()]
    assert (1, one) in kept and (None, one) not in kept
    assert len([text for _, text in kept if text in (two, two + " more")]) == 1
    assert kept.count((None, three)) == 1 and (2, None) in kept and (None, None) in kept
    assert len(kept) == 5


def test_stages_take_odd_and_empty_tables(spark, odd_documents, no_documents):
    for frame in (odd_documents, no_documents):
        docs = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = corpus_pipeline.written(stage(spark, docs, SMALL), "odd")
            assert docs.columns == frame.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).count()
    assert docs.count() == 0


def test_run(spark):
    rows = corpus_pipeline.run(spark, SMALL)
    assert rows.count() > 0 and {"doc_id", "sequence_id", "offset"} <= set(rows.columns)


@pytest.mark.parametrize("number", range(1, 11))
def test_queries_return_every_row(spark, number):
    name = next(n for n in entry.queries() if n.startswith(f"op{number}_"))
    key, table = ("page_id", "pages") if number == 5 else ("doc_id", "documents")
    ids = entry.queries()[name](spark, SMALL).select(key).distinct().count()
    assert ids == spark.read.parquet(f"{SMALL}/{table}.parquet").count()


@pytest.mark.parametrize("name", sorted(entry.llm.oracle_sql()))
def test_same_as_duckdb(spark, name):
    con = duckdb.connect()
    for table in ("documents",):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    expected = con.execute(entry.oracle_sql()[name]).df()
    found = entry.queries()[name](spark, SMALL).toPandas()
    assert sorted(found.columns) == sorted(expected.columns)
    columns = sorted(found.columns)
    found, expected = (f[columns].sort_values("doc_id").reset_index(drop=True) for f in (found, expected))
    assert found.equals(expected.astype(found.dtypes))
