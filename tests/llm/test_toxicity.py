"""Toxicity on held-out labels, and the cases without any."""

import math
import re
import zlib

import pytest
from conftest import SF

from lexweave.llm import toxicity
from lexweave.llm.catalogue import QUERIES

BIG = "/root/testdata/sf0.1"


def auc(pairs):
    good = [s for s, y in pairs if y]
    bad = [s for s, y in pairs if not y]
    wins = sum((g > b) + (g == b) / 2 for g in good for b in bad)
    return wins / (len(good) * len(bad))


def test_held_out_labels(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    rows = QUERIES["op3_toxicity"](spark, BIG).collect()
    assert len(rows) == spark.read.parquet(f"{BIG}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    held = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    # 352 toxic rows to learn from; with 1,700 of them the held-out area is above 0.99.
    assert auc(held) > 0.93
    assert sum((s >= 0.5) == bool(y) for s, y in held) / len(held) > 0.93


def test_an_unseen_misspelling_scores_higher():
    toxic = [f"you are a worthless clown number {i}" for i in range(40)]
    clean = [f"we met a friendly farmer number {i}" for i in range(40)]
    model = toxicity.train(toxic + clean, [1] * 40 + [0] * 40, 0.5)
    assert model.score("a worthlesss clownn") > 0.5 > model.score("a friendlyy farmerr")


def test_scores_do_not_depend_on_the_cache(monkeypatch):
    model = toxicity.train(["bad words", "good words"] * 5, [1, 0] * 5, 0.3)
    once = model.score("some good and bad words here")
    monkeypatch.setattr(toxicity, "CACHED_WORDS", 1)
    model.words.clear()
    assert model.score("some good and bad words here") == once


@pytest.mark.parametrize("kinds", [[], [0], [1, None]])
def test_without_labels_of_both_kinds(spark, kinds):
    docs = spark.createDataFrame([(i, "a b", 5) for i in range(4)], "doc_id long, text string, toxicity int")
    labels = spark.createDataFrame([(i, k) for i, k in enumerate(kinds)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert model is None
    assert [r["toxicity"] for r in toxicity.score_texts(docs, model).collect()] == [0.0] * 4
    assert toxicity.drop_toxic(docs, model).columns == docs.columns


def test_nulls_empties_and_repeats(spark):
    model = toxicity.train(["bad", "good"] * 5, [1, 0] * 5, 0.3)
    rows = [(1, None), (None, ""), (2, " \n"), (3, "good"), (3, "good"), (4, "x" * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {}
    for r in toxicity.score_texts(df, model).collect():
        found.setdefault(r["doc_id"], []).append(r["toxicity"])
    assert found[1] == found[None] == found[2] and found[3][0] == found[3][1]
    assert toxicity.score_texts(df.limit(0), model).count() == 0


def test_labels_on_long_texts_only_are_learned(spark):
    """All toxic rows are longer than what training takes of a text; ids repeat."""
    rows = [(i, "vile nasty words " * 4000) for i in range(10)] * 2 + [(100 + i, "kind and calm words here") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 10)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert model.score("vile nasty") > 0.5 > model.score("kind and calm")


def test_scores_against_the_sum_of_all_rows(spark):
    """Cached words against a plain sum over every subword of every word."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    data = docs.select("text").collect() + [(None,), ("",), ("é!? A a A",)]
    for (text,) in data:
        amounts = [
            float(model.rows[zlib.crc32(gram.encode()) % len(model.rows)])
            for word in re.findall(r"[^\x20\x09-\x0D]+", text or "")
            for marked in [f"<{word.lower()}>"]
            for gram in [marked, *[marked[i : i + n] for n in (3, 4, 5) for i in range(len(marked) - n + 1)]]
        ]
        odds = model.bias + (sum(amounts) / len(amounts) if amounts else 0.0)
        assert model.score(text) == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-5)
