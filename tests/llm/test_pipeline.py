"""The pipeline's stages against the operators and plain Python, on small tables."""

import re

import pytest
from quorumrank.llm import pii, toxicity
from quorumrank.llm.queries import QUERIES

import corpus_pipeline

from .test_pairs import brute


def test_stages_one_by_one(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    labels = spark.read.parquet(f"{data}/labels.parquet")
    model = toxicity.train(docs, labels)
    first = corpus_pipeline.STAGES[0][1](spark, docs, data)
    kept = {r.doc_id for r in first.collect()}
    assert first.columns == docs.columns and kept == {
        r.doc_id for r in toxicity.score(docs, model).where("score < 0.5").collect()
    }
    second = corpus_pipeline.STAGES[1][1](spark, first, data)
    components = brute({r.doc_id: r.text for r in first.collect()})
    assert second.columns == docs.columns and {r.doc_id for r in second.collect()} == {
        k for k, (_, c) in components.items() if k == c
    }
    third = corpus_pipeline.STAGES[2][1](spark, second, data)
    hide = pii.Pseudonymiser(pii.DEMO_KEY)
    before = {r.doc_id: r.text for r in second.collect()}
    assert third.columns == docs.columns and {r.doc_id: r.text for r in third.collect()} == {
        k: hide.text(t)[0] for k, t in before.items()
    }
    assert all(r.n_chars == len(r.text) for r in third.collect() if r.text is not None)
    last = corpus_pipeline.STAGES[3][1](spark, third, data)
    assert {r.doc_id for r in last.collect()} == set(before)
    key = lambda df: sorted(tuple(r) for r in df.select("doc_id", "start", "length", "ids_crc32").collect())
    whole = corpus_pipeline.run(spark, data)
    assert {
        r.doc_id for r in whole.collect()
    } == set(before) and sum(r.length for r in whole.collect()) == sum(r[2] for r in key(last))


def test_stages_on_odd_and_no_rows(spark, data, odd_documents, no_documents):
    from pyspark.sql import functions as F

    for docs in (odd_documents, no_documents):
        docs = docs.select(
            "doc_id", "text", "lang", F.lit(None).cast("string").alias("source"), F.length("text").cast("long").alias("n_chars")
        )
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, data)
            docs = out if "text" in out.columns else docs
            out.count()


def test_a_cluster_without_a_key_gets_one_of_its_own(spark, data, odd_documents, monkeypatch):
    """The third stage does its work there, hides by a key that isn't public, and the application can undo it."""
    docs = odd_documents.withColumn("n_chars", odd_documents.score)
    texts = {r.doc_id: r.text for r in docs.collect()}
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    with pytest.warns(UserWarning, match=pii.KEY_SETTING):
        out = corpus_pipeline.STAGES[2][1](spark, docs, data)
    got = {r.doc_id: r.text for r in out.collect()}
    assert got == {r.doc_id: r.text for r in corpus_pipeline.STAGES[2][1](spark, docs, data).collect()}
    assert got[9] not in (texts[9], pii.Pseudonymiser(pii.DEMO_KEY).text(texts[9])[0])
    assert {r.doc_id: r.text for r in pii.pseudonymise(out, undo=True).collect()} == texts


def test_every_operator_has_a_query():
    assert {re.match(r"op(\d+)_", q)[1] for q in QUERIES} == {str(n) for n in range(1, 11)}
