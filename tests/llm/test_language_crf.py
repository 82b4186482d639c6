"""Language of words and texts, held out and against all paths of a chain."""

import itertools
import zlib

import numpy as np
from conftest import SF

from lexweave.llm import language_crf as crf
from lexweave.llm.catalogue import QUERIES

BIG = "/root/testdata/sf0.1"


def test_forward_backward_equals_all_paths():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 1, 4])
    emitted, moves, start = rng.normal(size=(8, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    model = crf.LanguageModel(["a", "b", "c"], np.zeros((1, 3)), {}, moves, start)
    found = model.chances(emitted.astype(np.float32), lengths)
    at = 0
    for length in lengths:
        chance = np.zeros((length, 3))
        for path in itertools.product(range(3), repeat=int(length)):
            odds = start[path[0]] + sum(emitted[at + i, k] for i, k in enumerate(path))
            odds += sum(moves[a, b] for a, b in itertools.pairwise(path))
            for i, k in enumerate(path):
                chance[i, k] += np.exp(odds)
        chance /= chance.sum(1, keepdims=True)
        assert np.allclose(found[at : at + length], chance, atol=1e-4)
        at += length


def test_code_switched_words():
    texts = ["the house and the tree " * 30, "das haus und der baum " * 30]
    model = crf.train(texts, ["en", "de"])
    words = "the tree and the house das haus und der baum".split()
    chances = model.chances(model.emissions(words), np.array([len(words)]))
    assert [model.names[i] for i in chances.argmax(1)] == ["en"] * 5 + ["de"] * 5


def test_held_out_documents(spark):
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{BIG}/documents.parquet").collect()}
    rows = QUERIES["op9_language_crf"](spark, BIG).collect()
    assert len(rows) == len(langs)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    held = [r["lang_pred"] == langs[r["doc_id"]] for r in rows if r["held_out"] and langs[r["doc_id"]]]
    assert sum(held) / len(held) > 0.97


def test_nulls_empties_long_lines_and_clashing_names(spark):
    model = crf.train(["the house and the tree " * 9, "das haus und der baum " * 9], ["en", "de"])
    rows = [(1, None, 5), (None, "", 5), (2, "12 34 ²", 5), (3, "das " * 20_000, 5), (4, "The", 5), (4, "The", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, language int")
    out = crf.with_language(df, model)
    assert out.columns == ["doc_id", "text", "language", "language_score"]
    found = {r["doc_id"]: (r["language"], r["language_score"]) for r in out.collect()}
    assert found[1] == found[None] == found[2] == ("und", 0.0)
    assert found[3][0] == "de" and found[4][0] == "en"
    assert crf.with_language(df.limit(0), model).count() == 0


def test_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "a", None), (2, None, "en")], "doc_id long, text string, lang string")
    model = crf.fit(docs)
    assert [r["language"] for r in crf.with_language(docs, model).collect()] == ["und", "und"]


def test_small_caches_change_nothing(monkeypatch):
    model = crf.train(["the house and the tree " * 9, "das haus und der baum " * 9], ["en", "de"])
    text = ["the baum and das haus\nund the tree"]
    once = model.languages(text)
    monkeypatch.setattr(crf, "CACHED_WORDS", 2)
    model.place.clear()
    assert model.languages(text) == once == model.languages(text * 2)[:1]


def test_sample_is_bounded(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert crf.fit(docs, sample=2).names


def test_many_languages_and_long_texts_are_learned(spark):
    """More than 200 languages, one of which has only texts beyond the bound, in repeated rows."""
    rows = [(i, f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}o " * 8, f"l{i:03d}") for i in range(205)]
    rows += [(900 + i, "zzyx wuwu " * 5000, "zz") for i in (0, 1, 1, 1)]
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    model = crf.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.names == sorted({r[2] for r in rows}) and len(model.names) > 150
    assert model.languages(["zzyx wuwu"])[0][0] == "zz"
