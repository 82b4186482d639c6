"""The n-gram join against all pairs."""

import random
import re
from collections import defaultdict

import pytest
from conftest import SF, rows
from pyspark.sql import functions as F

from lexweave.llm import ngram_join
from lexweave.llm.components import components


def grams(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    size = min(width, len(words))
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def plain(docs, width, percent):
    """Size and smallest reachable id of every row."""
    sets = [grams(t, width) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            ids[find(i)].append(doc)
    return sorted(
        ((doc, len(sets[i]), min(ids[find(i)], default=None)) for i, (doc, _) in enumerate(docs)), key=repr
    )


def found(df, width, percent):
    out = ngram_join.near_duplicates(df, width=width, percent=percent)
    return rows(out.select("doc_id", "n_shingles", "component_id"))


def near_copies(seed, copies=60):
    """A group of near copies, chains that link only step by step, and a passage many share."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randint(0, 400))
    base = [word() for _ in range(60)]
    docs = []
    for _ in range(copies):
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(60)] = word()
        docs.append(" ".join(own))
    step = [word() for _ in range(80)]
    for k in range(12):
        step[5 * k] = word()
        docs.append(" ".join(step))
    passage = " ".join(word() for _ in range(30))
    docs += [f"{passage} {word()} {word()} {word()}" for _ in range(20)]
    docs += [" ".join(word() for _ in range(40)) + " " + passage for _ in range(20)]
    docs += [docs[0].upper(), docs[1] + " \n", "one two", "One  two", "one", "", None, " \t"]
    return [(i, t) for i, t in enumerate(rng.sample(docs, len(docs)))]


@pytest.mark.parametrize("width,percent,rounds", [(3, 90, 6), (5, 80, 6), (1, 80, 0)])
def test_near_copies(spark, monkeypatch, width, percent, rounds):
    monkeypatch.setattr(ngram_join, "ROUNDS", rounds)
    docs = near_copies(width)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(df, width, percent) == plain(docs, width, percent)


def test_null_and_shared_ids(spark):
    docs = [(None, "a b c d"), (None, "a b c d"), (5, "x y z"), (5, "x y z"), (5, "q r s"), (4, "q r s"), (None, None)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, key int")
    assert found(df, 3, 90) == plain(docs, 3, 90)
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns
    assert rows(kept) == sorted([(None, "a b c d", 1), (5, "x y z", 1), (4, "q r s", 1), (None, None, 1)], key=repr)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert found(df, 3, 90) == []
    assert ngram_join.one_of_each(df).collect() == []


def test_one_of_each_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    truth = plain([(r["doc_id"], r["text"]) for r in docs.collect()], 5, 80)
    kept = {r["doc_id"] for r in ngram_join.one_of_each(docs).collect()}
    assert kept == {doc for doc, _, first in truth if doc == first}


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 450)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        root[high] = low
    expected = sorted((i, find(i)) for i in root if any(find(j) == find(i) and j != i for j in root))
    df = spark.createDataFrame(links, "a long, b long")
    assert sorted(map(tuple, components(df).select("node", "root").collect())) == expected
    assert components(df.where("a < 0")).count() == 0


def test_prefixes_share_what_they_promise():
    """Two similar sets share as many n-grams of their prefixes as the smaller need."""
    import numpy as np

    rng = np.random.default_rng(2)
    counts = rng.integers(0, 1000, 64)
    for _ in range(300):
        whole = np.unique(rng.integers(0, 2**63, rng.integers(1, 60)).astype(np.uint64))
        other = np.unique(np.concatenate([rng.permutation(whole)[: max(1, int(len(whole) * 0.95))],
                                          rng.integers(0, 2**63, 2).astype(np.uint64)]))
        both = len(np.intersect1d(whole, other))
        if 100 * both >= 80 * (len(whole) + len(other) - both):
            (a, x), (b, y) = (ngram_join.prefix(s, counts, 80) for s in (whole, other))
            assert len(np.intersect1d(a, b)) >= min(x, y)


def test_sketch_of_counts_is_of_fixed_size(spark):
    df = spark.createDataFrame([("a b c d",), (None,)], "text string")
    assert ngram_join.bucket_counts(df, 3).sum() == 2
    assert len(ngram_join.bucket_counts(df.where(F.lit(False)), 3)) == ngram_join.BUCKETS


@pytest.mark.parametrize("width,percent,parts", [(3, 90, (4, 7, 9, 11)), (5, 80, (9, 14, 19, 25))])
def test_blocks_put_in_and_taken_out(spark, width, percent, parts):
    """Groups of two in which one text has a block of rare words that the other lacks."""
    rng = random.Random(percent)
    word = lambda: f"w{rng.randint(0, 10**6)}"
    usual = [f"u{i}" for i in range(40)]
    docs = []
    for part in parts:
        for place in (0.0, 0.5, 1.0):
            for size in (60, 142, 400):
                # Mostly rare words, and some runs that many texts have.
                text = [w for _ in range(size // 10) for w in [*[word() for _ in range(6)], *usual[: rng.randint(3, 7)]]][:size]
                own = max(1, len(text) * part // 100)
                at = int(place * len(text))
                docs += [" ".join(text), " ".join(text[:at] + [word() for _ in range(own)] + text[at:])]
                text = [word() for _ in range(size)]
                at = int(place * (size - own))
                docs += [" ".join(text), " ".join(text[:at] + text[at + own :])]
    # The usual n-grams are also in a large group, so that they are common.
    docs += [" ".join([*usual, word(), word()]) for _ in range(30)]
    docs = list(enumerate(docs))
    truth = plain(docs, width, percent)
    assert sum(doc != first for doc, _, first in truth) > 40
    assert found(spark.createDataFrame(docs, "doc_id long, text string"), width, percent) == truth
