"""Toxicity as a linear softmax over the mean of subword-bag embeddings.

A word's bag is the word itself and its character n-grams with the word's ends
marked, each a row of a hashed embedding table. A text is the mean of all rows of
all its words. Table and softmax are trained together by gradient descent in numpy,
so a misspelling that no training text holds still shares most of its n-grams.

The softmax is linear in the mean: a word adds a fixed amount to the log odds, so
scoring sums cached amounts of words and never builds a text's vector.

Training takes at most ``sample`` labelled rows, the lowest by a hash of the row
key, toxic and other rows in equal parts as far as there are; the bias is set back
to the share of toxic rows among all labelled ones. Of a training text it takes the first
``longest`` characters, and of rows that share an id the least text. Scoring takes whole texts.

Nulls, empty texts and texts without a word get the score of the bias alone.
Repeated rows get equal scores. Without labels of both kinds every score is 0. Very long
texts are scored word by word; empty tables stay empty. An input column named ``toxicity``
is replaced by ``score_texts``; ``drop_toxic`` returns all columns as they came.
"""

from __future__ import annotations

import math
import re
import zlib
from array import array
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.llm.common import WORD, crc_part, free_name, with_text_columns

SAMPLE = 4_000  # labelled rows that training may take
MOST_REPEATS = 4  # of a toxic row in training
LONGEST_SAMPLED = 40_000  # characters of a text that training takes
CACHED_WORDS = 200_000
CACHED_TRAINING = 50_000
WORDS = re.compile(WORD)


def subwords(word: str, buckets: int) -> list[int]:
    """Rows of the table for a word: itself and its n-grams of 3 to 5 characters."""
    text = f"<{word}>"
    size = len(text)
    grams = [text[i : i + n] for n in (3, 4, 5) for i in range(size - n + 1)]
    grams.append(text)
    return [zlib.crc32(g.encode()) % buckets for g in grams]


@dataclass
class ToxicityModel:
    """What a row of the table adds to the log odds of toxic, after training."""

    rows: np.ndarray
    bias: float
    words: dict[str, tuple[float, int]] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict[str, object]:
        return {"rows": self.rows, "bias": self.bias, "words": {}}

    def word(self, word: str) -> tuple[float, int]:
        ids = subwords(word.lower(), len(self.rows))
        found = float(self.rows[ids].sum()), len(ids)
        if len(word) <= 64:
            if len(self.words) >= CACHED_WORDS:
                self.words.clear()
            self.words[word] = found
        return found

    def score(self, text: str | None) -> float:
        total, number = 0.0, 0
        known = self.words.get
        for word in WORDS.findall(text or ""):
            amount, size = known(word) or self.word(word)
            total += amount
            number += size
        odds = self.bias + total / max(number, 1)
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, odds))))


def train(
    texts: Sequence[str | None],
    toxic: Sequence[int],
    share: float,
    buckets: int = 1 << 17,
    dims: int = 8,
    epochs: int = 8,
    rate: float = 0.35,
    seed: int = 7,
    again: int = 1,
) -> ToxicityModel:
    """Train the table and the softmax together by Adagrad, one text at a step.

    A toxic text is taken ``again`` times in each round.
    """
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dims, 1 / dims, (buckets, dims)).astype(np.float32)
    out = rng.normal(0, 0.1, (dims, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    past_table = np.full(buckets, 1e-4, np.float32)
    past_out, past_bias = np.full_like(out, 1e-4), np.full_like(bias, 1e-4)
    bags = []
    known: dict[str, array] = {}  # compact: the driver holds all of the sample's bags
    for text in texts:
        ids = array("i")
        for word in WORDS.findall((text or "").lower()):
            if word not in known:
                if len(known) >= CACHED_TRAINING:
                    known.clear()
                known[word] = array("i", subwords(word, buckets))
            ids.extend(known[word])
        rows, counts = np.unique(np.frombuffer(ids, np.int32), return_counts=True)
        bags.append((rows, (counts / max(1, counts.sum())).astype(np.float32)))
    known.clear()
    labels = np.asarray(toxic)
    order = np.repeat(np.arange(len(bags)), np.where(labels == 1, again, 1))
    for _ in range(epochs):
        for i in rng.permutation(order):
            rows, part = bags[i]
            mean = part @ table[rows]
            odds = mean @ out + bias
            chance = np.exp(odds - odds.max())
            chance /= chance.sum()
            miss = chance
            miss[labels[i]] -= 1
            back = out @ miss
            step_out = np.outer(mean, miss)
            past_out += step_out**2
            past_bias += miss**2
            out -= rate * step_out / np.sqrt(past_out)
            bias -= rate * 0.1 * miss / np.sqrt(past_bias)
            # The rows' gradients are part[r] * back; one scale for each row keeps the state small.
            past_table[rows] += part**2 * float(back @ back)
            table[rows] -= (rate * part / np.sqrt(past_table[rows]))[:, None] * back
    mean_share = min(max(float(labels[order].mean()), 1e-6), 1 - 1e-6)
    prior = math.log(share / (1 - share)) - math.log(mean_share / (1 - mean_share))
    odds_rows = (table @ (out[:, 1] - out[:, 0])).astype(np.float32)
    return ToxicityModel(odds_rows, float(bias[1] - bias[0]) + prior)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    held_out_parts: int = 5,
    sample: int = SAMPLE,
    longest: int = LONGEST_SAMPLED,
) -> ToxicityModel | None:
    """Train on labelled rows outside the held-out part; None if one kind has no row.

    ``sample`` bounds the rows of both kinds together and ``longest`` the characters of each.
    """
    usable = (
        labels.where(F.col(label).isin(0, 1) & (crc_part(doc_id, held_out_parts) != 0))
        .groupBy(doc_id)
        .agg(F.max(label).alias("_toxic"))
    )
    sizes = {r["_toxic"]: r["count"] for r in usable.groupBy("_toxic").count().collect()}
    if len(sizes) < 2:
        return None
    rows: list[tuple[str, int]] = []
    begin = F.substring(F.col(text).cast("string"), 1, longest)
    short = docs.select(doc_id, begin.alias("_text")).where("_text IS NOT NULL")
    order = F.xxhash64(F.lit("toxicity"), F.col(doc_id)), F.col(doc_id)
    # The ids are taken first, so that only the texts of the sample are moved.
    few = [usable.where(F.col("_toxic") == k).orderBy(*order).limit(sample // 2) for k in (0, 1)]
    taken = few[0].unionByName(few[1])
    # One row per id, made in the tasks first: the driver gets no more than the sample.
    once = short.join(F.broadcast(taken), doc_id).groupBy(doc_id, "_toxic").agg(F.min("_text").alias("_text"))
    for row in once.orderBy(*order).collect():
        rows.append((row["_text"], row["_toxic"]))
    if len({kind for _, kind in rows}) < 2:
        return None
    # Where toxic rows are few, each counts several times; the bias is set back afterwards.
    toxic = sum(kind for _, kind in rows)
    again = max(1, min(MOST_REPEATS, round((len(rows) - toxic) / toxic)))
    share = sizes[1] / (sizes[0] + sizes[1])
    return train([t for t, _ in rows], [k for _, k in rows], share, again=again)


def score_texts(df: DataFrame, model: ToxicityModel | None, text: str = "text", into: str = "toxicity") -> DataFrame:
    """Add ``toxicity``, the chance (0 to 1) that a text is toxic."""
    added = [T.StructField(into, T.DoubleType())]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def values(texts: list[str | None]) -> dict[str, object]:
        own = shared.value
        return {into: [own.score(t) if own else 0.0 for t in texts]}

    def done() -> None:
        # Workers live on for other stages, which need the memory.
        if shared.value:
            shared.value.words.clear()

    return with_text_columns(df, text, added, values, done=done)


def drop_toxic(df: DataFrame, model: ToxicityModel | None, limit: float = 0.5) -> DataFrame:
    """Rows whose text scores below ``limit``, with their columns."""
    score = free_name(df, "toxicity")
    scored = score_texts(df, model, into=score).where(F.col(score) < limit)
    return scored.select(*[F.col(f"`{c}`") for c in df.columns])
