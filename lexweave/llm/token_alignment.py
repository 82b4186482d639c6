"""Tokens of two vocabularies aligned by the bytes they cover.

Side A is a byte-level BPE vocabulary (a tokenizers file), side B a SentencePiece one with
byte fallback. A encodes the text behind a space, B puts that space itself, so both write
the same bytes. A worker takes a few documents at a time and lays their
tokens end to end. ``pandas.merge_asof``, keyed by document, finds for the start of every
token the token of the other side that covers it; both directions together are all
overlaps, since of two overlapping tokens one starts inside the other. Offsets where
tokens of both sides end cut the tokens into groups.

How well a pair of ids goes together is counted over the corpus: the number of rows that
hold it linked. Each block of documents sends every pair once, with the number of its rows
that hold it; the sums come back as one list per block, and only there meet its
documents. So what is shuffled are the distinct pairs of blocks, not links of documents,
and no key gathers more than one row per block after the sums in each task.

Null and empty texts, and texts that one of the sides doesn't give back (unknown
characters, a space mark in the text), have no tokens: zeros, and empty groups. A block
holds one text at least, so a very long text needs memory in proportion to its length.
Equal rows are rows of their own, each counts. Empty tables stay empty. All input columns
pass through; where one has a result's name, underscores are added to that of the result.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.functions.types import quoted
from lexweave.llm.common import TEXT, free_name, stored, text_slices

BLOCK = 2 << 20  # bytes of text that a worker aligns at a time
SPACE = "▁"
# How byte-level vocabularies write bytes: printable ones as themselves, the others from U+0100 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
OTHERS = [b for b in range(256) if b not in PRINTABLE]
BYTE_OF = {chr(b): b for b in PRINTABLE} | {chr(256 + i): b for i, b in enumerate(OTHERS)}
# Fixed value: how byte-level vocabularies of this kind cut a text before merging.
CUTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

ALIGNED = T.StructType([
    T.StructField("n_a", T.LongType()),
    T.StructField("n_b", T.LongType()),
    T.StructField("n_groups", T.LongType()),
    T.StructField("n_links", T.LongType()),
    T.StructField("groups", T.StringType()),
    T.StructField("block", T.LongType()),
    T.StructField("slots", T.ArrayType(T.IntegerType())),
    T.StructField("times", T.ArrayType(T.IntegerType())),
    T.StructField("pairs", T.ArrayType(T.LongType())),
    T.StructField("holders", T.ArrayType(T.LongType())),
])


class ByteSide:
    """A byte-level BPE file: ids of texts, and the bytes of each id."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        model = whole["model"]
        vocab: dict[str, int] = model["vocab"]
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes[i] = bytes([BYTE_OF[c] for c in token])
        # Merging by ids is merging by rank if every merge made the next id. It is the same, and faster.
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        plain = whole["normalizer"] is None and whole["pre_tokenizer"] == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True,
        }
        if not plain or [vocab.get(a + b) for a, b in merges] != list(range(256, 256 + len(merges))):
            raise ValueError("this is no plain byte-level vocabulary whose ids are the ranks of its merges")
        self.sizes = np.array([len(x) for x in self.bytes], np.int64)
        ranks = {token: i for i, token in enumerate(self.bytes) if token}
        self.own = tiktoken.Encoding("aligned", pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        return self.own.encode_ordinary(" " + text)


class PieceSide:
    """A SentencePiece file: ids of texts, and the bytes of each id (None if it shows none)."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.own = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes: list[bytes] = []
        for i in range(self.own.vocab_size()):
            piece = self.own.id_to_piece(i)
            shown = piece.replace(SPACE, " ").encode()
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.own.is_byte(i) else shown)
        self.sizes = np.array([len(x) for x in self.bytes], np.int64)

    def encode(self, text: str) -> list[int]:
        return self.own.encode(text)


@cache
def byte_side(path: str) -> ByteSide:
    return ByteSide(path)


@cache
def piece_side(path: str) -> PieceSide:
    return PieceSide(path)


class Written:
    """Ids as decimal text with each of the separators that may follow them."""

    def __init__(self, ids: int) -> None:
        numbers = [str(i) for i in range(ids)]
        self.ids = ids
        self.words = np.array([n + mark for mark in ",|;" for n in numbers], dtype=object)


@cache
def written(ids: int) -> Written:
    return Written(ids)


class Tokens:
    """Tokens of one side of a block, end to end: ids, documents, byte offsets."""

    def __init__(self, ids: list[np.ndarray], sizes: np.ndarray) -> None:
        self.counts = np.array([len(i) for i in ids], np.int64)
        self.ids = np.concatenate(ids).astype(np.int64)
        self.docs = np.repeat(np.arange(len(ids)), self.counts)
        lengths = sizes[self.ids]
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths

    def frame(self, place: str) -> pd.DataFrame:
        return pd.DataFrame({"doc": self.docs, "at": self.starts, place: np.arange(len(self.ids))})


def overlaps(a: Tokens, b: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Places of all overlapping tokens of both sides.

    The covering token of a start is the other side's last one that starts at it or before,
    since the tokens of a document leave no gaps. Links that both directions find have equal starts.
    """
    left, right = a.frame("a"), b.frame("b")
    from_a = pd.merge_asof(left, right, on="at", by="doc")
    from_b = pd.merge_asof(right, left, on="at", by="doc")
    other = from_b[from_b["at"].to_numpy() != a.starts[from_b["a"].to_numpy()]]
    both = pd.concat([from_a[["a", "b"]], other[["a", "b"]]])
    return both["a"].to_numpy(), both["b"].to_numpy()


def group_texts(a: Tokens, b: Tokens, rows: int) -> tuple[list[str], np.ndarray]:
    """Groups of each document in decimal, and how many it has."""
    ends_a = np.zeros(int(a.ends[-1]) + 1 if len(a.ends) else 1, bool)
    ends_a[a.ends] = True
    closes_b = ends_a[b.ends]
    ends_b = np.zeros_like(ends_a)
    ends_b[b.ends] = True
    closes_a = ends_b[a.ends]
    # The group of a token is the number of groups closed before it, on either side the same.
    group_a = np.cumsum(closes_a) - closes_a
    group_b = np.cumsum(closes_b) - closes_b
    total = int(closes_a.sum())
    in_a = np.cumsum(np.bincount(group_a, minlength=total))
    in_b = np.cumsum(np.bincount(group_b, minlength=total))
    # In writing, A's tokens of a group stand before B's.
    at_a = np.arange(len(a.ids)) + np.concatenate([[0], in_b])[group_a]
    at_b = np.arange(len(b.ids)) + in_a[group_b] if total else np.arange(0)
    words = written(int(max(a.ids.max(initial=0), b.ids.max(initial=0))) // 65536 * 65536 + 65536)
    which = np.empty(len(a.ids) + len(b.ids), np.int64)
    which[at_a] = a.ids + words.ids * closes_a
    which[at_b] = b.ids + 2 * words.ids * closes_b
    tokens = words.words[which].tolist()
    bounds = np.concatenate([[0], np.cumsum(a.counts + b.counts)])
    texts = ["".join(tokens[s:e])[:-1] for s, e in zip(bounds, bounds[1:], strict=False)]
    return texts, np.bincount(a.docs[closes_a], minlength=rows)


def align_block(texts: list[bytes | None], byte_file: str, piece_file: str, block: int) -> list[dict]:
    """One result (see ``ALIGNED``) per text; the first holds the block's pairs."""
    left, right = byte_side(byte_file), piece_side(piece_file)
    none = np.empty(0, np.int32)
    ids: list[tuple[np.ndarray, np.ndarray]] = []
    for text in texts:
        plain = (text or b"").decode(errors="replace")
        both = [side.encode(plain) if plain else [] for side in (left, right)]
        same = plain and all(
            b"".join([side.bytes[i] for i in found]) == b" " + text for side, found in zip((left, right), both, strict=True)
        )
        ids.append(tuple(np.array(found, np.int32) for found in both) if same else (none, none))
    a, b = (Tokens([pair[k] for pair in ids], side.sizes) for k, side in enumerate((left, right)))
    del ids
    rows = len(texts)
    groups, n_groups = group_texts(a, b, rows)
    at_a, at_b = overlaps(a, b)
    pairs, slot = np.unique(a.ids[at_a] << 32 | b.ids[at_b], return_inverse=True)
    docs = a.docs[at_a]
    n_links = np.bincount(docs, minlength=rows)
    held, times = np.unique(docs * max(1, len(pairs)) + slot, return_counts=True)
    held_doc, held_slot = np.divmod(held, max(1, len(pairs)))
    holders = np.bincount(held_slot, minlength=len(pairs))
    bounds = np.searchsorted(held_doc, np.arange(rows + 1))
    return [
        {
            "n_a": int(a.counts[i]), "n_b": int(b.counts[i]), "n_groups": int(n_groups[i]), "n_links": int(n_links[i]),
            "groups": groups[i], "block": block,
            "slots": held_slot[bounds[i] : bounds[i + 1]].astype(np.int32),
            "times": times[bounds[i] : bounds[i + 1]].astype(np.int32),
            "pairs": pairs if i == 0 and len(pairs) else None,
            "holders": holders if i == 0 and len(pairs) else None,
        }
        for i in range(rows)
    ]


def align_texts(
    df: DataFrame, byte_file: str, piece_file: str, text: str = "text", into: str = "alignment", size: int = BLOCK
) -> DataFrame:
    """Add ``into``: token, group and link counts, the groups in decimal, and the links.

    Groups read ``a1,a2|b1;a3|b2``. Links are slots into the pairs (A id << 32 | B id) of
    the block, which its first row lists, each with how many times the row has it. Blocks
    follow the partitions of the scan: store the result before using it twice.
    """
    result = free_name(df, into)
    own = free_name(df, TEXT)
    source = df.select(*[quoted(c) for c in df.columns], F.col(text).cast("string").cast("binary").alias(own))
    kind = pa.struct([
        ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
        ("groups", pa.string()), ("block", pa.int64()), ("slots", pa.list_(pa.int32())),
        ("times", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())), ("holders", pa.list_(pa.int64())),
    ])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part, texts in text_slices(batch, batch.column(batch.num_columns - 1), size):
                found = align_block(texts.to_pylist(), byte_file, piece_file, block)
                columns = [part.column(i) for i in range(part.num_columns - 1)]
                columns.append(pa.array(found, kind))
                yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], result])
                block += 1

    return source.mapInArrow(each, T.StructType([*df.schema.fields, T.StructField(result, ALIGNED)]))


def pair_counts(aligned: DataFrame, alignment: str = "alignment") -> DataFrame:
    """Corpus-wide counts: pair, docs (rows that hold it linked), best (highest of its A id)."""
    block = F.col(alignment)
    listed = aligned.where(block["pairs"].isNotNull()).select(F.arrays_zip(block["pairs"], block["holders"]).alias("p"))
    each = listed.select(F.explode_outer("p").alias("p")).select(F.col("p")["pairs"].alias("pair"), F.col("p")["holders"].alias("n"))
    counts = stored(each.groupBy("pair").agg(F.sum("n").alias("docs")), "pair-counts")
    side = F.shiftright("pair", 32)
    most = counts.groupBy(side.alias("a")).agg(F.max("docs").alias("most"))
    joined = counts.join(most, side == F.col("a"))
    return stored(joined.select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")), "pair-best")


def with_pair_counts(aligned: DataFrame, alignment: str = "alignment", names: tuple[str, str] = ("n_best", "count_sum")) -> DataFrame:
    """Add to stored aligned rows: links whose pair is the best of its A id, and the sum of counts over links.

    The slots and pairs, which only this step reads, are left out of the result.
    """
    n_best, count_sum = (free_name(aligned, n) for n in names)
    spread = F.posexplode(F.col(alignment)["pairs"]).alias("slot", "pair")
    entries = aligned.where(F.col(alignment)["pairs"].isNotNull()).select(F.col(alignment)["block"].alias("block"), spread)
    met = entries.join(pair_counts(aligned, alignment), "pair")
    entry = F.struct("slot", "docs", "best")
    lists = stored(met.groupBy("block").agg(F.array_sort(F.collect_list(entry)).alias("of")), "block-counts")
    blocks = lists.select("block", F.col("of.docs").alias("docs"), F.col("of.best").alias("best"))
    key, slots, times = (free_name(aligned, n) for n in ("_block", "_slots", "_times"))
    link = {key: "block", slots: "slots", times: "times"}
    shown = F.col(alignment).dropFields("block", "slots", "times", "pairs", "holders").alias(alignment)
    left = aligned.select(
        *[F.col(alignment)[field].alias(name) for name, field in link.items()],
        *[shown if c == alignment else quoted(c) for c in aligned.columns],
    )
    added = [T.StructField(n, T.LongType()) for n in (n_best, count_sum)]
    kept = left.schema.fields[len(link) :]
    names_out = [f.name for f in [*kept, *added]]

    def each(docs: pa.Table, counts: pa.Table) -> pa.Table:
        held, often = (docs.column(c).combine_chunks() for c in (1, 2))
        offsets, at = held.offsets.to_numpy(), held.flatten().to_numpy()
        weight = often.flatten().to_numpy().astype(np.int64)
        sums = []
        for name in ("best", "docs"):
            of = counts.column(name).combine_chunks().flatten().to_numpy(zero_copy_only=False)
            until = np.concatenate([[0], np.cumsum(weight * of[at].astype(np.int64))])
            sums.append(until[offsets[1:] - offsets[0]] - until[offsets[:-1] - offsets[0]])
        return pa.table([*docs.columns[len(link) :], *[pa.array(s) for s in sums]], names=names_out)

    grouped = left.groupBy(quoted(key)).cogroup(blocks.groupBy("block"))
    return grouped.applyInArrow(each, T.StructType([*kept, *added]))
