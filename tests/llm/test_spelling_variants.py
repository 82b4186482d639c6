"""Vocabulary, neighbours, forms and roots against plain loops."""

import random
import re
import zlib
from collections import Counter

import pytest
from conftest import SF

from lexweave.llm import spelling_variants as sv
from lexweave.llm.catalogue import QUERIES


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain_words(rows, least=5, dropped=199):
    words = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % dropped == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 6 and n >= least}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows, least=5, dropped=199):
    """(word, form, root, n, n_near, form_n) by comparing all words."""
    n = plain_words(rows, least, dropped)
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    forms, numbers = {}, {}
    for w in n:
        around = [v for k in (-1, 0, 1) for v in by_length.get(len(w) + k, []) if near(w, v)]
        numbers[w] = len(around)
        best = min(around, key=lambda v: (-n[v], v), default=None)
        forms[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while forms[root]:
            root = forms[root]
        out.append((w, forms[w], root, n[w], numbers[w], n[forms[w]] if forms[w] else None))
    return sorted(out, key=repr)


def found(df, **options):
    return sorted((tuple(r) for r in sv.spelling_variants(df, **options).collect()), key=repr)


def mistyped(rng, word):
    at = rng.randrange(len(word) + 1)
    kind = rng.randrange(3)
    letter = rng.choice("abéÿ×")
    return word[:at] + ("" if kind == 0 else letter) + word[at + (kind != 1) :]


def random_rows(seed, docs=200):
    rng = random.Random(seed)
    syllables = ["an", "ber", "ié", "son", "aa", "ton", "ÿl"]
    stems = ["".join(rng.choices(syllables, k=rng.randint(2, 6))) for _ in range(60)] + ["a" * n for n in range(5, 12)]
    stems += ["z" * 80, "q" * 300]
    words = list(stems)
    for _ in range(400):
        words.append(mistyped(rng, rng.choice(words)))
    weights = [1000 / (1 + i) for i in range(len(words))]
    marks = [" ", "-", "日", "\n", "1"]
    return [
        (i, "".join(w.upper() + rng.choice(marks) if rng.random() < 0.1 else w + rng.choice(marks)
                    for w in rng.choices(words, weights, k=300)))
        for i in range(docs)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_random_vocabularies(spark, seed):
    rows = random_rows(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = plain(rows)
    assert sum(r[1] is not None for r in expected) > 50 and any(r[1] and r[1] != r[2] for r in expected)
    assert found(df) == expected


def test_small_indexes_and_parts_change_nothing(spark, monkeypatch):
    rows = random_rows(3, 60)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(sv, "INDEX_WORDS", 3)
    monkeypatch.setattr(sv, "HELD_WORDS", 5)
    assert found(df, dropped=3) == plain(rows, dropped=3)


def test_index_against_all_pairs():
    rng = random.Random(5)
    words = sorted({"".join(rng.choices("abé", k=rng.randint(1, 7))) for _ in range(400)} | {"ab" * 40, "ab" * 40 + "b"})
    raw = [w.encode("latin-1") for w in words]
    index = sv.PositionIndex(raw)
    for length in {len(w) for w in words} | {9, 90}:
        queries = [w for w in words if len(w) == length] or ["a" * length]
        bits = index.one_error([q.encode("latin-1") for q in queries])
        rows, at = sv.places(bits)
        got = {(queries[i], words[j]) for i, j in zip(rows, at, strict=True)}
        assert got == {(q, w) for q in queries for w in words if near(q, w)}


def test_one_hot_key_in_tiles():
    words = [f"{a}{b}{c}xyzuvw".encode() for a in "abcdefghijklmnop" for b in "abcdefghijklmnopq" for c in "abcdefgh"]
    pairs = set(sv.near_pairs(words))
    assert len(pairs) == len(words) * (15 + 16 + 7)


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in QUERIES["op13_spelling_variants"](spark, SF).collect()), key=repr) == plain(rows)


def test_nulls_repeats_long_texts_ties_and_empty_tables(spark):
    # Ties: two neighbours of one number, the smaller word wins.
    text = "colourx " * 5 + "colour " * 30 + "coloury " * 30 + "colours " * 30
    rows = [(1, text * 200), (1, None), (None, text), (None, text), (2, ""), (3, "w" * 70_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, word string")
    assert found(df) == plain(rows)
    assert found(df.limit(0)) == []
    assert found(df.where("text is null")) == []
