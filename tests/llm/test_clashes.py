"""Input columns named like helpers and results: nothing crashes, nothing is overwritten."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF
from lexweave.llm import log_templates, ngram_join, poisson_mixing, toxicity

HELPERS = [
    "_id", "_key", "key", "node", "toxicity", "lines_dropped", "places", "mix_copy", "mix_place", "mix_rate", "_mix_key",
    "_mix_id", "_mix_copies", "_mix_steps", "_mix_parts", "_toxic", "_text", "_text_", "_lang", "_rank", "word", "a b",
]


@pytest.fixture(scope="module")
def docs(spark):
    whole = spark.read.parquet(f"{SF}/documents.parquet")
    return whole.select("*", *[F.concat(F.lit(f"{name} "), "doc_id").alias(name) for name in HELPERS])


def kept(result):
    """Every helper column still tells its own name and row."""
    rows = result.select("doc_id", *[F.col(f"`{h}`") for h in HELPERS]).collect()
    assert rows
    assert all(r[h] == f"{h} {r['doc_id']}" for r in rows for h in HELPERS)


def test_operators(spark, docs):
    kept(toxicity.drop_toxic(docs, None))
    kept(log_templates.drop_recurring(docs))
    kept(ngram_join.one_of_each(docs))
    mixed = poisson_mixing.mix(docs)
    kept(mixed)
    assert mixed.columns[-2:] == ["mix_copy_", "mix_place_"]


def test_stages(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, SF)
        if name == "encoding":
            assert result.count() == docs.count()
        else:
            kept(result)
            assert result.columns == docs.columns, name
