"""Notices with edits against the edit distance of every run of words."""

import random
import re

import pytest
from conftest import SF

from lexweave.llm import license_search as ls
from lexweave.llm.catalogue import QUERIES

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
BASE = {phrase: label for phrase, label in ls.BASE_PHRASES}


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def distance(a, b, most):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        if min(row) > most:
            return most + 1
    return row[-1]


def plain_labels(text, notices):
    """Labels of notices that some run of words resembles, without seeds or patterns."""
    words = WORDS.findall(lowered(text))
    found = {}
    for n in notices:
        for i in range(len(words)):
            for j in range(i + 1, len(words) + 1):
                run = " ".join(words[i:j])
                if len(run) > len(n.phrase) + n.edits:
                    break
                if len(run) < len(n.phrase) - n.edits or not run.startswith(n.phrase[: n.kept]):
                    continue
                d = distance(run[n.kept :], n.phrase[n.kept :], n.edits)
                if d <= n.edits:
                    found[n.label] = min(found.get(n.label, 1), d / len(n.phrase))
    return found


def plain_base(text):
    words = WORDS.findall(lowered(text))
    places = []
    for phrase, label in BASE.items():
        parts = phrase.split()
        places += [(i, label) for i in range(len(words)) if words[i : i + len(parts)] == parts]
    return len(words), sorted(places)


def edited(rng, phrase, edits):
    letters = list(phrase)
    for _ in range(edits):
        at = rng.randrange(len(letters))
        kind = rng.randrange(3)
        if kind == 0:
            del letters[at]
        else:
            letters[at : at + (kind == 1)] = [rng.choice("abcxyzé 1")]
    return "".join(letters)


@pytest.fixture(scope="module")
def search():
    return ls.searcher(tuple(ls.NOTICES))


def check(search, text):
    n_words, places = plain_base(text)
    found = search.found(text.encode())
    assert found["n_words"] == n_words
    assert sorted((s["first_word"], s["label"]) for s in found["spans"] if s["base"]) == places, text
    labels = plain_labels(text, ls.NOTICES)
    assert {s["label"] for s in found["spans"]} == set(labels), text
    assert found["score"] == pytest.approx(1 - min(labels.values()) if labels else 0.0)
    for s in found["spans"]:
        words = WORDS.findall(lowered(text))[s["first_word"] : s["last_word"] + 1]
        assert WORDS.findall(lowered(text[s["start"] : s["end"]])) == words
        assert distance(" ".join(words), s["phrase"], s["edits"]) == s["edits"]


def test_random_edits_against_all_runs(search):
    rng = random.Random(11)
    for _ in range(250):
        n = rng.choice(ls.NOTICES)
        text = edited(rng, n.phrase, rng.randint(0, n.edits + 2))
        around = [" ".join(rng.choices(["The", "under", "a", "1é", "mit", "by", "license"], k=rng.randint(0, 4))) for _ in "ab"]
        check(search, f"{around[0]} {text.upper() if rng.random() < 0.2 else text} {around[1]}")


@pytest.mark.parametrize(
    "text",
    ["", "cc", "cc by", "CC-BY", "cc by cc by", "MIT License. mit licence mit\nlicense", "emit license", "mit licenses",
     "GNU General-Public  LICENSE, gnu general public licence", "apache/license apache license", "Kit license",
     "the gnu\x00general public license", "É mit license é", "apachelicense", "gnu genral pblic license " * 40],
)
def test_plain_cases(search, text):
    check(search, text)


def test_exact_notices_beside_each_other(search):
    found = search.found(b"mit license mit license apache license" * 3)
    assert sum(s["base"] for s in found["spans"]) == plain_base("mit license mit license apache license" * 3)[1].__len__()


def test_query(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op11_license_search"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        n_words, places = plain_base(texts[r["doc_id"]])
        assert (r["n_words"], r["n_base"]) == (n_words, len(places))
        at = [i for i, _ in places]
        assert (r["first_word"], r["last_word"]) == ((min(at), max(at)) if at else (None, None))
        assert r["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_nulls_long_texts_repeats_and_clashing_names(spark):
    long = "word " * 300_000 + "under the MIT Lisense " + "word " * 10
    rows = [(1, None, "x"), (1, None, "x"), (None, "", None), (2, long, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, Licenses string")
    found = ls.find_notices(df)
    assert found.columns == ["doc_id", "text", "Licenses", "licenses_"]
    out = sorted(found.collect(), key=lambda r: r["doc_id"] or 0)
    assert [r["Licenses"] for r in out] == [None, "x", "x", "y"]
    assert [r["licenses_"]["n_words"] for r in out] == [0, 0, 0, 300_014]
    span = out[3]["licenses_"]["spans"][0]
    assert (span["label"], span["edits"], span["first_word"], span["last_word"]) == ("mit", 1, 300_002, 300_003)
    assert long[span["start"] : span["end"]] == "MIT Lisense"
    assert ls.find_notices(df.limit(0)).count() == 0
    assert ls.find_notices(df, notices=[]).where("size(licenses_.spans) > 0").count() == 0
