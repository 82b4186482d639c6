"""Encoding and decoding against the sentencepiece library."""

import hashlib
import random

import pytest
from conftest import SF

from lexweave.llm import piece_codec
from lexweave.llm.catalogue import QUERIES, piece_model

HARD = [
    "", " ", "  a", "a  b ", "a\nb\t c", "▁x ▁", "<s> </s> <unk> <0x41>", "ñ\x00x", "日本語🙂 ﬁ Å é",
    " " * 137 + "x" + " " * 1000, "🧑‍🚀 abc", "\x80߿", "a" * 5000, "=" * 777, "no blank" * 300,
]


@pytest.fixture(scope="module")
def codec():
    return piece_codec.codec(piece_model())


def test_hard_and_random_texts(codec):
    random.seed(4)
    parts = ["a", "b", "the", " ", "  ", "▁", "\n", "é", "ß", "日", "🙂", "̀", "ing", "er", "==", "//", "    ", "12"]
    texts = HARD + ["".join(random.choices(parts, k=random.randint(1, 60))) for _ in range(3000)]
    for text in texts:
        ids = codec.model.encode(text, add_eos=True)
        assert codec.encode(text) == ids, text
        assert codec.decode(ids) == codec.model.decode(ids), text


def test_decoding_any_ids(codec):
    random.seed(5)
    for _ in range(3000):
        ids = [random.choice([random.randint(0, 258), random.randint(0, 31999)]) for _ in range(random.randint(0, 12))]
        assert codec.decode(ids) == codec.model.decode(ids), ids


def test_small_caches_change_nothing(codec, monkeypatch):
    monkeypatch.setattr(piece_codec, "CACHED_CUTS", 3)
    monkeypatch.setattr(piece_codec, "CACHED_PAIRS", 3)
    own = piece_codec.PieceCodec(piece_model())
    text = "the quick brown fox jumps over the lazy dog " * 5
    assert own.encode(text) == codec.model.encode(text, add_eos=True)
    assert len(own.cuts) <= 3


def test_merging_is_what_the_backtracking_finds(codec):
    for text in ("▁unbelievable", "▁internationalization", "▁▁▁▁▁", "xxxxxxxx"):
        assert [codec.piece[i] for i in codec.run(text)] == codec.merged(text)


def test_query(spark, codec):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op2_piece_codec"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = codec.model.encode(texts[r["doc_id"]] or "", add_eos=True)
        joined = " ".join(map(str, ids))
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(codec.model.decode(ids).encode()).hexdigest()


def test_nulls_repeats_and_clashing_names(spark):
    rows = [(1, None, "x"), (1, None, "x"), (None, "", "y"), (2, "a b", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    found = piece_codec.encode_texts(df, piece_model())
    assert found.columns == ["doc_id", "text", "ids", "decoded"]
    out = sorted((r["doc_id"] or 0, list(r["ids"]), r["decoded"]) for r in found.collect())
    assert out[0] == (0, [2], "") and out[1:3] == [(1, [2], "")] * 2 and out[3][2] == "a b"
    assert piece_codec.encode_texts(df.limit(0), piece_model()).count() == 0
