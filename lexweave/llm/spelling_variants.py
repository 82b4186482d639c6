"""Spelling variants: words of a corpus that differ from a more frequent one by one letter.

Runs of letters are counted in every task first, then by word; words that are long and
frequent enough are the vocabulary. Words one edit apart are found with a bit-sliced
index: one bitset over words for every (position, letter). A query walks its letters
once, for all words of the index at the same time. It keeps the words that agree so far
without an error, and those with one replaced, one extra or one missing letter, the last
two read at shifted positions.

An index over the whole vocabulary would belong to one task and compare every word with
every other. So the vocabulary is dealt to small indexes: the shorter word of a pair is
cut into pieces of two letters (more than two in words beyond 64, so that no word has more
than 32 pieces); an edit falls into one piece, and both words agree in what stands before
and behind it. Each word goes to the key of every piece that could hold the edit. Keys
are sorted by length, and words of as many keys as fill an index share it. A key has few
words, as two letters only are free; where more share one, parts of them are compared with
parts, in the task's memory.

The form of a word is its most frequent neighbour, if that is enough times as frequent.
Forms grow in frequency, so following them ends; roots are found by doubling the steps.

Null texts have no words; a null id hashes as no characters. Very long texts are counted whole, words
of any length too. Equal rows count each. Ties go to the smaller word in code-point order.
Empty tables give no words. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.llm.common import stored

LEAST_LETTERS = 6
LEAST_TIMES = 5
RATIO = 5  # a form is at least this many times as frequent as its variant
DROPPED = 199  # runs whose hash this divides lose a letter
HELD_WORDS = 1_000_000  # distinct words that a task counts before it sends them on
INDEX_WORDS = 1024
INDEX_BITS = 1 << 26  # bits of an index, if it has more than one word; long words share it with few
PIECE, MOST_PIECES = 2, 32

# Letters are a-z and U+00C0 to U+00FF, one byte each in Latin-1; others end a run there.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
CODE = np.zeros(256, np.uint8)  # 0 stands for "behind the end"
CODE[[b for b in range(256) if LETTERS[b] == b and b != 32]] = np.arange(1, 91)
CODES = 91


def counted(texts: Iterator[tuple[str, str | None]], least_letters: int, dropped: int) -> Iterator[Counter]:
    """Words of the texts with their numbers, in parts of bounded size."""
    words: Counter = Counter()
    for key, text in texts:
        if text:
            begin = zlib.crc32(f"{key}:".encode())
            runs = Counter(text.encode("latin-1", "replace").translate(LETTERS).split())
            for run, n in runs.items():
                # The hash is of UTF-8, which differs from Latin-1 beyond ASCII.
                h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), begin)
                if h % dropped == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1 :]
                if len(run) >= least_letters:
                    words[run] += n
            if len(words) > HELD_WORDS:
                yield words
                words = Counter()
    if words:
        yield words


def vocabulary(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS,
    least_times: int = LEAST_TIMES, dropped: int = DROPPED,
) -> DataFrame:
    """Words and their numbers over the corpus."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    source = df.select(key.alias("key"), F.col(text).cast("string").alias("text"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True))
        for words in counted(rows, least_letters, dropped):
            names = [w.decode("latin-1") for w in words]
            yield pa.RecordBatch.from_pydict({"word": names, "n": pa.array(words.values(), pa.int64())})

    counts = source.mapInArrow(each, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_times)


class PositionIndex:
    """Bitsets over words for every position and letter, and for every length."""

    def __init__(self, words: list[bytes]) -> None:
        self.size = len(words)
        lengths = np.array([len(w) for w in words])
        self.longest = int(lengths.max())
        width = -(-self.size // 64) * 64
        codes = letter_codes(words, self.longest + 2)
        # Only letters that occur get bitsets; all others share the empty ones of number 0.
        used = np.unique(codes)
        self.number = np.zeros(CODES, np.intp)
        self.number[used[used > 0]] = 1 + np.arange((used > 0).sum())
        letters = int(self.number.max()) + 1
        self.bits = np.zeros((self.longest + 2, letters, width // 64), np.uint64)
        step = max(1, INDEX_BITS // (letters * width))
        for start in range(0, self.longest + 2, step):
            part = codes[:, start : start + step].T
            ones = np.zeros((len(part), letters, width), bool)
            place, word = np.nonzero(part)
            ones[place, self.number[part[place, word]], word] = True
            self.bits[start : start + step] = packed(ones)
        of_length = np.zeros((self.longest + 2, width), bool)
        of_length[lengths, np.arange(self.size)] = True
        self.lengths = packed(of_length)

    def at(self, place: int, codes: np.ndarray) -> np.ndarray:
        """For each query, the words that have its letter at a place."""
        return self.bits[place, codes] if 0 <= place < len(self.bits) else np.zeros_like(self.bits[0, codes])

    def having(self, length: int) -> np.ndarray:
        return self.lengths[length] if 0 <= length < len(self.lengths) else np.zeros_like(self.lengths[0])

    def one_error(self, queries: list[bytes]) -> np.ndarray:
        """For each of some queries of one length, the words exactly one edit away, as bitsets."""
        length = len(queries[0])
        codes = self.number[letter_codes(queries, length)]
        none = np.zeros((len(queries), self.bits.shape[2]), np.uint64)
        # Words that agree without an error, and with a letter replaced, more or less than the query.
        exact, replaced, longer, shorter = ~none, none, none, none
        for i in range(min(length, self.longest + 1)):
            letter = codes[:, i]
            here, next_, before = (self.at(p, letter) for p in (i, i + 1, i - 1))
            shorter = (shorter & before) | exact
            longer = (longer | exact) & next_
            replaced = (replaced & here) | (exact & ~here)
            exact = exact & here
        if length > self.longest + 1:
            return none
        longer = longer | exact
        return (replaced & self.having(length)) | (longer & self.having(length + 1)) | (shorter & self.having(length - 1))


def letter_codes(words: list[bytes], width: int) -> np.ndarray:
    """A row of letter codes per word, 0 behind its end."""
    padded = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), np.uint8)
    return CODE[padded].reshape(len(words), width)


def packed(ones: np.ndarray) -> np.ndarray:
    return np.packbits(ones, axis=-1, bitorder="little").view(np.uint64)


def places(bitsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and bits that are set."""
    row, cell = np.nonzero(bitsets)
    bits = np.unpackbits(bitsets[row, cell].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    which, bit = np.nonzero(bits)
    return row[which], cell[which] * 64 + bit


def near_pairs(words: list[bytes]) -> Iterator[tuple[int, int]]:
    """Places (shorter or equal, other) of all words of a list one edit apart, in tiles of bounded size.

    Of two words of equal length both orders come.
    """
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    start = 0
    while start < len(order):
        stop = start + 1
        while stop < len(order) and stop - start < INDEX_WORDS and (
            (stop - start + 1) * (len(words[order[stop]]) + 2) * CODES <= INDEX_BITS
        ):
            stop += 1
        index = PositionIndex([words[i] for i in order[start:stop]])
        shortest, longest = len(words[order[start]]), index.longest
        # Queries of a length, some at a time; those that no word of the index can be near are left out.
        at = 0
        while at < len(order):
            length, until = len(words[order[at]]), at
            while until < len(order) and until - at < INDEX_WORDS and len(words[order[until]]) == length:
                until += 1
            if shortest - 1 <= length <= longest:
                queries = order[at:until]
                near = index.one_error([words[i] for i in queries]) & ~index.having(length - 1)
                for q, w in zip(*(x.tolist() for x in places(near)), strict=True):
                    yield queries[q], order[start + w]
            at = until
        start = stop


def near_words(words: DataFrame) -> DataFrame:
    """Both orders of all pairs one edit apart: word, n, near, near_n. The words must be distinct."""
    sides = []
    for longer in (0, 1):
        size = F.length("word") - longer  # letters of the shorter word of a pair
        count = F.least(F.floor(size / PIECE).cast("int"), F.lit(MOST_PIECES))
        entry = words.select("word", "n", size.alias("size"), count.alias("pieces")).where("pieces > 0")
        piece = F.posexplode(F.sequence(F.lit(1), "pieces")).alias("piece", "_next")
        cut = entry.select("word", "n", "size", "pieces", piece)
        begin = F.floor(F.col("size") * F.col("piece") / F.col("pieces")).cast("int")
        end = F.floor(F.col("size") * F.col("_next") / F.col("pieces")).cast("int") + longer
        rest = [F.col("word").substr(F.lit(1), begin), F.col("word").substr(end + 1, F.length("word"))]
        sides.append(cut.select("size", F.xxhash64("size", "piece", *rest).alias("key"), "word", "n"))
    entries = sides[0].unionByName(sides[1])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(held: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
            names = list(held)
            pairs = set()
            for i, j in near_pairs(names):
                pairs |= {(i, j), (j, i)}
            if pairs:
                left, right = (np.array(x) for x in zip(*pairs, strict=True))
                shown = pa.array([w.decode("latin-1") for w in names])
                numbers = pa.array(held.values(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [shown.take(pa.array(left)), numbers.take(pa.array(left)), shown.take(pa.array(right)), numbers.take(pa.array(right))],
                    ["word", "n", "near", "near_n"],
                )

        held: dict[bytes, int] = {}  # words of whole keys that wait for an index
        group: dict[bytes, int] = {}
        last = None
        for batch in batches:
            for key, word, n in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                if key != last:
                    if len(group) > 1:
                        held |= group
                    group, last = {}, key
                    if len(held) >= INDEX_WORDS:
                        yield from sent(held)
                        held = {}
                group[word.encode("latin-1")] = n
        yield from sent(held | group if len(group) > 1 else held)

    dealt = entries.repartition("key").sortWithinPartitions("size", "key")
    return dealt.mapInArrow(each, "word string, n long, near string, near_n long")


def forms(near: DataFrame, ratio: int = RATIO) -> DataFrame:
    """Each word with neighbours: their number, and its form with the form's number where it has one."""
    once = near.repartition("word").dropDuplicates(["word", "near"])
    first = F.min(F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("form"))).alias("first")
    best = once.groupBy("word").agg(F.first("n").alias("n"), F.count("near").alias("n_near"), first)
    enough = -F.col("first.n") >= ratio * F.col("n")
    return best.select(
        "word", "n_near", F.when(enough, F.col("first.form")).alias("form"), F.when(enough, -F.col("first.n")).alias("form_n")
    )


def roots(links: DataFrame) -> DataFrame:
    """The last word that following ``form`` reaches, for each (word, form); the links have no cycle."""
    reached = stored(links.select("word", F.col("form").alias("root"), F.lit(True).alias("open")), "roots")
    while not reached.where("open").isEmpty():
        further = reached.select(F.col("word").alias("at"), F.col("root").alias("to"))
        met = reached.join(further, F.col("root") == F.col("at"), "left")
        root = F.coalesce("to", "root").alias("root")
        reached = stored(met.select("word", root, F.col("to").isNotNull().alias("open")), "roots")
    return reached.select("word", "root")


def spelling_variants(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", least_letters: int = LEAST_LETTERS,
    least_times: int = LEAST_TIMES, ratio: int = RATIO, dropped: int = DROPPED,
) -> DataFrame:
    """One row per word: form (or null), root, n, n_near and form_n."""
    words = stored(vocabulary(df, doc_id, text, least_letters, least_times, dropped), "vocabulary")
    found = stored(forms(near_words(words), ratio), "forms")
    ends = roots(found.where(F.col("form").isNotNull()))
    joined = words.join(found, "word", "left").join(ends, "word", "left")
    return joined.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), "form_n"
    )
