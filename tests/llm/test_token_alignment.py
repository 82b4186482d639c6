"""Alignment of two vocabularies against loops over tokens of the libraries themselves."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import sentencepiece
from conftest import SF
from tokenizers import Tokenizer

from lexweave.llm import token_alignment as ta
from lexweave.llm.catalogue import QUERIES, byte_vocabulary, piece_model
from lexweave.llm.common import stored


@pytest.fixture(scope="module")
def sides():
    left = Tokenizer.from_file(byte_vocabulary())
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=piece_model())
    names = {i: bytes([ta.BYTE_OF[c] for c in t]) for t, i in left.get_vocab().items() if t != "<|endoftext|>"}

    def piece(i):
        name = right.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if right.is_byte(i) else name.replace("▁", " ").encode()

    def encode(text):
        """(ids, bytes) of both sides; empty where one of them doesn't give the text back."""
        if not text:
            return [], []
        a = [(i, names[i]) for i in left.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, piece(i)) for i in right.encode(text)]
        whole = (" " + text).encode()
        return (a, b) if all(b"".join(x for _, x in side) == whole for side in (a, b)) else ([], [])

    return encode


def spans(tokens):
    out, at = [], 0
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def plain(sides, texts):
    """Rows (n_a, n_b, n_groups, n_links, n_best, count_sum, groups) by plain loops."""
    each, counts = [], Counter()
    for text in texts:
        a, b = (spans(s) for s in sides(text))
        links, first = [], 0
        for i, s, e in a:
            while first < len(b) and b[first][2] <= s:
                first += 1
            at = first
            while at < len(b) and b[at][1] < e:
                links.append((i, b[at][0]))
                at += 1
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups, low = [], 0
        parts = {e: ([], []) for e in ends}
        for side, tokens in enumerate((a, b)):
            at = 0
            for i, _, e in tokens:
                while e > ends[at]:
                    at += 1
                parts[ends[at]][side].append(str(i))
        groups = ";".join(",".join(x) + "|" + ",".join(y) for x, y in (parts[e] for e in ends))
        each.append((len(a), len(b), len(ends), links, groups))
        counts.update(set(links))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    return [
        (n_a, n_b, n_groups, len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), groups)
        for n_a, n_b, n_groups, links, groups in each
    ]


def digest(groups):
    return hashlib.sha256(groups.encode()).hexdigest() if groups else ""


def test_query(spark, sides):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    expected = dict(zip(texts, plain(sides, texts.values()), strict=True))
    rows = QUERIES["op12_token_alignment"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        *numbers, groups = expected[r["doc_id"]]
        found = [r[c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
        assert found == numbers
        assert r["groups_sha256"] == digest(groups)


HARD = ["", " ", "  a", "a  b ", "a\nb\t c", "▁x", "a▁b", "<s> </s> <unk> <0x41>", "<|endoftext|>", "ñ\x00x", "日本語🙂 ﬁ Å é",
        "it's I'M we'LL", "\x85\xa0 x ​﻿ y", "a" * 3000, "=" * 777, "1234567890 12", "\r\n\r\n  x", "ǅ ᏸ ⅷ"]


def test_both_sides_encode_as_the_libraries(sides):
    rng = random.Random(12)
    parts = ["a", "the", " ", "  ", "▁", "\n", "é", "ß", "日", "🙂", "̀", "ing", "'s", "'ll", "12", "\t", " ", "//", "X", "ŉ"]
    texts = HARD + ["".join(rng.choices(parts, k=rng.randint(1, 50))) for _ in range(3000)]
    left, right = ta.byte_side(byte_vocabulary()), ta.piece_side(piece_model())
    for text in texts:
        known_a, known_b = sides(text)
        if known_a:
            assert left.encode(text) == [i for i, _ in known_a], text
            assert right.encode(text) == [i for i, _ in known_b], text


def aligned(spark, rows, size, sides):
    df = spark.createDataFrame(rows, "k int, text string").repartition(3)
    kept = stored(ta.align_texts(df, byte_vocabulary(), piece_model(), size=size), "aligned")
    found = ta.with_pair_counts(kept)
    numbers = [f"alignment.{c}" for c in ("n_a", "n_b", "n_groups", "n_links")]
    out = found.select("k", *numbers, "n_best", "count_sum", "alignment.groups").collect()
    expected = dict(zip([k for k, _ in rows], plain(sides, [t for _, t in rows]), strict=True))
    assert len(out) == len(rows)
    assert {r["k"]: tuple(r)[1:] for r in out} == expected


@pytest.mark.parametrize("size", [1, 200, 1 << 22])
def test_blocks_of_any_size_count_alike(spark, sides, size):
    rng = random.Random(size)
    words = ["alpha", "über", "naïve", "x", "日本", "the", "\n", "12", "'s"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for i in range(60)]
    rows += [(100 + i, t) for i, t in enumerate(HARD)] + [(200, None), (201, None), (202, "the x"), (203, "the x")]
    aligned(spark, rows, size, sides)


def test_long_text_columns_and_empty_tables(spark, sides):
    long = "something longer é " * 20_000
    df = spark.createDataFrame([(long, 1, "a", 2.0), (None, 2, None, None)], "text string, _block int, Alignment string, n_best double")
    kept = stored(ta.align_texts(df, byte_vocabulary(), piece_model()), "aligned")
    found = ta.with_pair_counts(kept, "alignment_")
    assert found.columns == ["text", "_block", "Alignment", "n_best", "alignment_", "n_best_", "count_sum"]
    out = sorted(found.collect(), key=lambda r: r["_block"])
    assert [(r["_block"], r["Alignment"], r["n_best"]) for r in out] == [(1, "a", 2.0), (2, None, None)]
    (expected,) = plain(sides, [long])
    assert [out[0]["alignment_"]["n_links"], out[0]["n_best_"], out[0]["count_sum"]] == list(expected[3:6])
    assert (out[1]["alignment_"]["n_a"], out[1]["alignment_"]["groups"], out[1]["n_best_"], out[1]["count_sum"]) == (0, "", 0, 0)
    empty = stored(ta.align_texts(df.limit(0), byte_vocabulary(), piece_model()), "aligned")
    assert ta.with_pair_counts(empty, "alignment_").count() == 0


def test_other_vocabularies_are_refused(tmp_path):
    path = tmp_path / "v.json"
    path.write_text('{"normalizer": null, "pre_tokenizer": null, "model": {"vocab": {"a": 0}, "merges": []}}')
    with pytest.raises(ValueError):
        ta.ByteSide(str(path))
