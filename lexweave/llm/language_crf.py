"""Language of every word of code-switched text by a linear-chain random field.

Words are runs of letters in lower case. A word's features are its affixes of up to three characters, its character n-grams
of three with the word's ends marked, and its row of a lexicon of the words
most used in training; each has a learned weight for each language. Transitions from
language to language are learned with them. Chains are the lines of a text.
Forward-backward gives every word its chance of each language; a text's language has
the greatest mean chance over its words with a letter, ties to the first by name.

Training takes at most ``sample`` labelled rows of each language, the first ``longest``
characters of each. With more than ``MOST_ROWS`` such rows every language gives its first
before any gives its second, and so on, so no language is left out before there are that
many. Of rows that share id and language the least text counts. Training makes chains of
switched languages from runs of their words, so that transitions see switches. The
weights follow the gradient of the chain's log likelihood, all in numpy.

Null texts and texts without a letter are ``und`` with score 0. Repeated rows get
equal results. Without training rows all texts are ``und``. Lines are whole however
long they are; time and memory grow with the text's words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.llm.common import crc_part, with_text_columns

SAMPLE = 400  # labelled rows of each language that training may take
MOST_ROWS = 80_000  # labelled rows of all languages that training may take
PARTS = 64  # of a language's rows by hash, ranked apart before they are ranked together
LONGEST_SAMPLED = 20_000  # characters of a text that training takes
LEXICON = 5_000  # words of each language that have a weight of their own
BUCKETS = 1 << 16
CACHED_WORDS = 300_000
CHAIN = 40  # words of a training chain
RUNS = re.compile(r"[^\W\d_]+")
NO_LANGUAGE = "und"


def features(word: str) -> list[str]:
    """Affixes and n-grams of a lower-case word; the kinds do not mix."""
    text = f"<{word}>"
    size = len(text)
    found = [text[i : i + 3] for i in range(size - 2)]
    found += ["^" + word[:1], "^" + word[:2], "^" + word[:3]]
    found += ["$" + word[-1:], "$" + word[-2:], "$" + word[-3:]]
    return found


@dataclass
class LanguageModel:
    names: list[str]
    weights: np.ndarray  # features by languages
    lexicon: dict[str, np.ndarray]
    moves: np.ndarray  # from language by to language
    start: np.ndarray
    place: dict[str, int] = field(default_factory=dict, repr=False)
    table: np.ndarray | None = field(default=None, repr=False)
    hashed: dict[str, int] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict[str, object]:
        return self.__dict__ | {"place": {}, "table": None, "hashed": {}}

    def ids(self, word: str) -> list[int]:
        known = self.hashed
        if len(known) > CACHED_WORDS:
            known.clear()
        found = []
        for f in features(word):
            at = known.get(f)
            if at is None:
                at = known[f] = zlib.crc32(f.encode()) % len(self.weights)
            found.append(at)
        return found

    def learn(self, words: list[str]) -> None:
        """Put the emissions of unseen words into the table."""
        first = len(self.place)
        while len(self.table) < first + len(words):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        lists = [self.ids(w) for w in words]
        flat = np.array([i for x in lists for i in x], np.int64)
        starts = np.cumsum([0] + [len(x) for x in lists[:-1]])
        sums = np.add.reduceat(self.weights[flat], starts, axis=0)
        for k, word in enumerate(words):
            own = self.lexicon.get(word)
            if own is not None:
                sums[k] += own
            self.place[word] = first + k
        self.table[first : first + len(words)] = sums

    def emissions(self, words: list[str]) -> np.ndarray:
        if self.table is None:
            self.place, self.table = {}, np.zeros((1024, len(self.names)), np.float32)
        unseen = list({w for w in words if w not in self.place})
        if unseen and len(self.place) + len(unseen) > CACHED_WORDS:
            self.place.clear()
            unseen = list(set(words))
        if unseen:
            self.learn(unseen)
        place = self.place
        return self.table[[place[w] for w in words]]

    def chances(self, emissions: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each word's chance of each language; ``lengths`` are the chains' words in order."""
        first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        forward, backward = passes(emissions, first, lengths, self.moves, self.start)
        both = forward * backward
        return both / both.sum(1, keepdims=True)

    def languages(self, texts: Sequence[str | None]) -> list[tuple[str, float]]:
        words: list[str] = []
        lengths: list[int] = []
        owner: list[int] = []
        for k, text in enumerate(texts):
            for line in (text or "").split("\n"):
                own = words_of(line)
                if own:
                    words += own
                    lengths.append(len(own))
                    owner.append(k)
        found = [(NO_LANGUAGE, 0.0)] * len(texts)
        if not words or not self.names:
            return found
        chances = self.chances(self.emissions(words), np.array(lengths))
        sums = np.zeros((len(texts), len(self.names)))
        by_word = np.repeat(np.array(owner), lengths)
        for j in range(len(self.names)):
            sums[:, j] = np.bincount(by_word, chances[:, j], len(texts))
        number = np.bincount(by_word, minlength=len(texts))
        for k in np.flatnonzero(number):
            best = int(sums[k].argmax())
            found[k] = self.names[best], float(min(1.0, sums[k, best] / number[k]))
        return found


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased; runs of other word characters are left out."""
    found = RUNS.findall(text.lower())
    return [w for w in found if w.isalpha() or any(map(str.isalpha, w))]


def passes(
    emissions: np.ndarray, first: np.ndarray, lengths: np.ndarray, moves: np.ndarray, start: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward amounts of all chains at once, each position scaled to sum 1.

    Chains are sorted by length, so that the ones with a word at a step are the first.
    """
    order = np.argsort(-lengths, kind="stable")
    first, lengths = first[order], lengths[order]
    weight = np.exp(emissions - emissions.max(1, keepdims=True)).astype(np.float32) + 1e-30
    step = np.exp(moves - moves.max()).astype(np.float32)
    forward = np.empty_like(weight)
    backward = np.ones_like(weight)
    longest = int(lengths[0])
    active = np.searchsorted(-lengths, -np.arange(longest), side="left")  # chains longer than a step
    now = np.exp(start - start.max()).astype(np.float32) * weight[first]
    now /= now.sum(1, keepdims=True)
    forward[first] = now
    for t in range(1, longest):
        at = first[: active[t]] + t
        now = (now[: active[t]] @ step) * weight[at]
        now /= now.sum(1, keepdims=True)
        forward[at] = now
    for t in range(longest - 2, -1, -1):
        at = first[: active[t + 1]] + t
        back = (weight[at + 1] * backward[at + 1]) @ step.T
        backward[at] = back / back.sum(1, keepdims=True)
    return forward, backward


def train(
    texts: Sequence[str | None], langs: Sequence[str], epochs: int = 4, rate: float = 0.3, seed: int = 5
) -> LanguageModel:
    """Fit weights and transitions on chains that switch between runs of labelled texts."""
    names = sorted(set(langs))
    size = len(names)
    rng = np.random.default_rng(seed)
    own: dict[str, list[str]] = {n: [] for n in names}
    for text, lang in zip(texts, langs, strict=True):
        own[lang] += words_of(text or "")
    common = {n: Counter(own[n]).most_common(LEXICON) for n in names}
    lexicon = {w: np.zeros(size, np.float32) for n in names for w, k in common[n] if k > 1}
    model = LanguageModel(
        names, np.zeros((BUCKETS, size), np.float32), lexicon,
        np.zeros((size, size), np.float32), np.zeros(size, np.float32),
    )
    if not size or not any(own.values()):
        return LanguageModel([], model.weights[:1], {}, model.moves, model.start)
    # Runs of 4 to 24 words, dealt at random into chains of several runs.
    runs: list[tuple[int, list[str]]] = []
    for k, name in enumerate(names):
        at = 0
        while at < len(own[name]):
            length = int(rng.integers(4, 25))
            runs.append((k, own[name][at : at + length]))
            at += length
    chains: list[tuple[list[str], list[int]]] = [([], [])]
    for i in rng.permutation(len(runs)):
        k, words = runs[i]
        if len(chains[-1][0]) + len(words) > CHAIN and chains[-1][0]:
            chains.append(([], []))
        chains[-1][0].extend(words)
        chains[-1][1].extend([k] * len(words))
    slots = {w: BUCKETS + i for i, w in enumerate(lexicon)}
    weights = np.zeros((BUCKETS + len(slots), size), np.float32)
    past = np.full(weights.shape, 1e-3, np.float32)
    past_moves = np.full((size, size), 1e-3, np.float32)
    ids: dict[str, list[int]] = {}
    batch = 64
    for _ in range(epochs):
        order = rng.permutation(len(chains))
        for begin in range(0, len(order), batch):
            part = [chains[i] for i in order[begin : begin + batch]]
            words = [w for ws, _ in part for w in ws]
            truth = np.array([k for _, ks in part for k in ks])
            lengths = np.array([len(ws) for ws, _ in part])
            for w in words:
                if w not in ids:
                    ids[w] = model.ids(w) + ([slots[w]] if w in slots else [])
            lists = [ids[w] for w in words]
            flat = np.concatenate([np.array(x) for x in lists])
            counts = np.array([len(x) for x in lists])
            starts = np.cumsum(counts) - counts
            emitted = np.add.reduceat(weights[flat], starts, axis=0)
            first = np.cumsum(lengths) - lengths
            forward, backward = passes(emitted, first, lengths, model.moves, model.start)
            chance = forward * backward
            chance /= chance.sum(1, keepdims=True)
            miss = chance.copy()
            miss[np.arange(len(truth)), truth] -= 1
            # Expected and seen transitions between neighbours of one chain.
            inside = np.ones(len(truth), bool)
            inside[first] = False
            at = np.flatnonzero(inside)
            ahead = np.exp(emitted[at] - emitted[at].max(1, keepdims=True)) * backward[at]
            joint = forward[at - 1][:, :, None] * np.exp(model.moves)[None] * ahead[:, None, :]
            joint /= joint.sum((1, 2), keepdims=True)
            moved = joint.sum(0)
            np.add.at(moved, (truth[at - 1], truth[at]), -1)
            moved /= max(1, len(at))
            past_moves += moved**2
            model.moves -= rate * moved / np.sqrt(past_moves)
            rows, place = np.unique(flat, return_inverse=True)
            slope = np.zeros((len(rows), size), np.float32)
            spread = np.repeat(miss, counts, axis=0)
            for j in range(size):
                slope[:, j] = np.bincount(place, spread[:, j], len(rows))
            past[rows] += slope**2
            weights[rows] -= rate * slope / np.sqrt(past[rows])
    model.weights = weights[:BUCKETS]
    model.lexicon = {w: weights[slots[w]] for w in lexicon}
    model.hashed = {}
    return model


def fit(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    held_out_parts: int = 4, held_out: int = 2, sample: int = SAMPLE, longest: int = LONGEST_SAMPLED,
) -> LanguageModel:
    """Train on labelled rows outside the held-out part, at most ``sample`` of each language."""
    begin = F.substring(F.col(text).cast("string"), 1, longest)
    usable = docs.select(doc_id, begin.alias("_text"), F.col(lang).alias("_lang")).where(
        F.col("_lang").isNotNull() & (crc_part(doc_id, held_out_parts) != held_out) & (F.length("_text") > 0)
    )
    hashed = F.xxhash64(F.lit("language"), F.col(doc_id))
    order = hashed, F.col(doc_id)
    # The lowest hashes of each language: of its parts first, so that a language that most rows
    # have is ranked in many tasks, then of what they leave, at most ``PARTS`` times ``sample`` rows.
    parted = usable.select(doc_id, "_lang", F.pmod(hashed, F.lit(PARTS)).alias("_part")).dropDuplicates([doc_id, "_lang"])
    of_part = F.row_number().over(Window.partitionBy("_lang", "_part").orderBy(*order))
    few = parted.withColumn("_rank", of_part).where(F.col("_rank") <= sample)
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy(*order))
    keys = few.withColumn("_rank", rank).where(F.col("_rank") <= sample)
    bounded = keys.select(doc_id, "_lang", "_rank").orderBy("_rank", "_lang").limit(MOST_ROWS).drop("_rank")
    taken = usable.join(F.broadcast(bounded), [doc_id, "_lang"]).groupBy(doc_id, "_lang").agg(F.min("_text").alias("_text"))
    rows = sorted((r["_lang"], r["_text"]) for r in taken.select("_lang", "_text").collect())
    return train([t for _, t in rows], [n for n, _ in rows])


def with_language(df: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Add ``language`` and ``language_score``, the mean chance of that language."""
    added = [T.StructField("language", T.StringType()), T.StructField("language_score", T.DoubleType())]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def values(texts: list[str | None]) -> dict[str, object]:
        found = shared.value.languages(texts)
        return {"language": [n for n, _ in found], "language_score": [s for _, s in found]}

    return with_text_columns(df, text, added, values, rows=1024)
