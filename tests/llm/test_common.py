"""Shared helpers: batches bounded by bytes."""

import pytest
from pyspark.sql import types as T

from lexweave.llm import common


@pytest.mark.parametrize("size", [1, 50, 10_000])
def test_batches_are_cut_by_bytes(spark, monkeypatch, size):
    monkeypatch.setattr(common, "SLICE", size)
    texts = [None, "", "é" * 40, "a" * 300, None, "b", "", "c" * 49, "d" * 30, "e" * 5_000, None] * 7
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)

    def values(part):
        return {"size": [None if t is None else len(t) for t in part]}

    rows = common.with_text_columns(df, "text", [T.StructField("size", T.LongType())], values).collect()
    assert sorted((r["doc_id"], r["text"]) for r in rows) == list(enumerate(texts))
    assert all(r["size"] == (None if r["text"] is None else len(r["text"])) for r in rows)


def test_slices_hold_their_bytes():
    import pyarrow as pa

    texts = pa.array([None, "", "a" * 30, "b" * 300, "", "c" * 49, "d" * 30, None])
    batch = pa.RecordBatch.from_arrays([texts], ["t"])
    for size in (1, 40, 100, 10_000):
        parts = list(common.text_slices(batch, texts, size))
        assert [t for _, p in parts for t in p.to_pylist()] == texts.to_pylist()
        assert all(part.num_rows == len(p) for part, p in parts)
        for _, p in parts:
            sizes = [len(t or "") for t in p.to_pylist()]
            assert sum(sizes) - max(sizes) <= size
    assert list(common.text_slices(batch.slice(0, 0), texts.slice(0, 0), 10)) == []
