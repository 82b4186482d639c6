"""Exact search against all pairs, with ties and vectors that take no part."""

import math
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from lexweave.llm import top_k


def plain(data, is_query, k):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in data
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in whole:
        if is_query(i):
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != q and len(w) == len(v)]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block,query_block,deeper", [(4096, 1024, 32), (7, 3, 1)])
def test_all_pairs(spark, monkeypatch, block, query_block, deeper):
    for name, value in (("BLOCK", block), ("QUERY_BLOCK", query_block), ("DEEPER", deeper)):
        monkeypatch.setattr(top_k, name, value)
    rng = random.Random(block)
    data = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, rng.random()]) for _ in range(6)]) for i in range(150)]
    data += [(200 + i, [0.5] * 6) for i in range(20)]  # one common vector
    data += [(300, None), (301, [1.0, None, 0.0, 0, 0, 0]), (302, [math.nan] * 6), (303, [math.inf] * 6)]
    data += [(None, [1.0] * 6), (310, []), (320, []), (330, [1.0, 2.0]), (340, [2.0, 1.0])]
    data += [(10, [0.5] * 6), (11, [0.9] * 6), (11, [0.9] * 6), (350, [0.0] * 6), (360, [1e9] * 6)]
    data = [(i, None if v is None else [None if x is None else float(x) for x in v]) for i, v in data]
    df = spark.createDataFrame([(*d, 0) for d in data], "vec_id long, embedding array<double>, rank int")
    found = top_k.top_k(df, F.col("vec_id") % 10 == 0)
    assert rows(found) == plain(data, lambda i: i % 10 == 0, 5)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k.top_k(df, F.col("vec_id") % 10 == 0).collect() == []


def test_the_bound_stops_the_search():
    """Rows far down every list are never scored."""
    size, k = 1000, 3
    data = np.zeros((size, 4))
    data[:, :] = np.arange(size)[::-1, None]
    lists = np.argsort(-data, axis=0, kind="stable").T
    seen = []

    class Watched(np.ndarray):
        def __matmul__(self, other):
            seen.append(self.shape[0] if self.ndim == 2 else 0)
            return np.asarray(self) @ np.asarray(other)

    found, scores = top_k.threshold_search(np.ones(4), -1, np.arange(size), data.view(Watched), lists, k)
    assert found == [0, 1, 2] and scores == [3996, 3992, 3988]
    assert sum(seen) < 100
