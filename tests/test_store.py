"""Stored tables on uneven input: empty tables, new columns, vectors that come or go."""

import pytest

from profilelake.operators import vectors
from profilelake.plans import ingest
from profilelake.session import fresh_path
from profilelake.sources import documents, fixtures, tables


def test_core_only_ingest(spark, sf_dir):
    store = ingest.Store(spark, fresh_path(spark, "core-only"))
    bronze = fixtures.bronze(spark, sf_dir)
    ingest.ingest(store, bronze.where("upper(source_file) not like 'S%' and profile_index is not null"))
    assert store.read("bgc_profiles").count() == 0 and store.read("profiles").count() > 0
    assert "profile_id" in store.read("bgc_profiles").columns


def test_missing_table_is_named(spark):
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, fresh_path(spark, "none"))


def test_documents_with_and_without_vectors(spark):
    store = ingest.Store(spark, fresh_path(spark, "documents"))
    plain = spark.createDataFrame(
        [("a", "one", "floats"), ("b", "two", "floats")], "id string, document string, collection string")
    documents.upsert_documents(store, plain.limit(0))
    documents.upsert_documents(store, plain)
    with_vectors = plain.selectExpr("*", "array(float(1)) as embedding")
    documents.upsert_documents(store, with_vectors)
    changed = plain.selectExpr("id", "if(id = 'a', 'new', document) as document", "collection")
    rows = {r.id: (r.document, r.embedding) for r in documents.upsert_documents(store, changed).collect()}
    assert rows == {"a": ("new", None), "b": ("two", [1.0])}


def test_approximate_search_with_a_zero_vector(spark):
    corpus = spark.createDataFrame(
        [("a", [1.0, 0.0]), ("b", [1.0, 0.1]), ("z", [0.0, 0.0])], "id string, embedding array<double>")
    query = spark.createDataFrame([(0, [1.0, 0.0])], "query_id int, vector array<double>")
    found = [(r.id, r.distance) for r in vectors.ann_search(corpus, query, 3).orderBy("rank").collect()]
    assert [i for i, _ in found] == ["a", "b", "z"] and found[2][1] is None
