"""License notices in texts, exact and with a few edits.

A notice may hold a number of edits (letters inserted, deleted or replaced). It is split
into one piece more than that, so that every occurrence within the bound holds at least
one piece unchanged, where the edits before it can have moved it. Aho-Corasick finds all
pieces of all notices in one pass over a text; around each the regex library's
bounded-error matching looks for the notice between word bounds and gives the span with
the fewest edits. Of overlapping spans of a notice the one with the fewest edits stays,
then the first. Exact occurrences are spans without edits, so none is ever lost.

Words are runs of letters, digits and characters beyond ASCII, with A-Z lower-cased;
between them only word bounds count, so punctuation and line ends never matter.

Null texts are empty: no words, no spans. Very long texts are searched whole, in memory in
proportion to their length. Equal rows give equal rows, empty tables stay empty. All input
columns pass through as they are; where one has the result's name, underscores are added
to that of the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lexweave.llm.common import free_name, map_text_slices

# The phrases that count as base, and their labels.
BASE_PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]


@dataclass(frozen=True)
class Notice:
    """A notice in lower-case words; the first ``kept`` characters hold no edits."""

    label: str
    phrase: str
    edits: int
    kept: int = 0
    base: bool = False

    @property
    def pattern(self) -> str:
        """Between two spaces, the best match within the edits."""
        fuzzy = re.escape(self.phrase[self.kept :])
        inner = f"(?:{fuzzy}){{e<={self.edits}}}" if self.edits else fuzzy
        return f"(?b)(?<= ){re.escape(self.phrase[: self.kept])}{inner}(?= )"

    @property
    def seeds(self) -> list[tuple[str, int]]:
        """Pieces and their places: with at most ``edits`` edits one of them is whole."""
        size, count = len(self.phrase), self.edits + 1
        cuts = [size * i // count for i in range(count + 1)]
        return [(self.phrase[a:b], a) for a, b in zip(cuts, cuts[1:], strict=False)]


# Short names that other words resemble stay unchanged (``kept``); about one edit in ten to
# twelve letters is allowed elsewhere.
NOTICES = [
    Notice("gpl", BASE_PHRASES[0][0], 2, len("gnu "), True),
    Notice("apache", BASE_PHRASES[1][0], 1, 0, True),
    Notice("cc-by", BASE_PHRASES[2][0], 0, 0, True),
    Notice("mit", BASE_PHRASES[3][0], 1, len("mit "), True),
    Notice("agpl", "gnu affero general public license", 2, len("gnu ")),
    Notice("lgpl", "gnu lesser general public license", 2, len("gnu ")),
    Notice("bsd", "bsd license", 1, len("bsd ")),
    Notice("isc", "isc license", 1, len("isc ")),
    Notice("mpl", "mozilla public license", 2),
    Notice("epl", "eclipse public license", 2),
    Notice("cc-by", "creative commons attribution", 2),
    Notice("cc0", "creative commons zero", 2),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy", 6),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification", 6),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose", 6),
    Notice("unlicense", "this is free and unencumbered software released into the public domain", 6),
    Notice("zlib", "this software is provided as is without any express or implied warranty", 6),
    Notice("proprietary", "all rights reserved", 1),
]

SPAN = T.StructType([
    T.StructField("label", T.StringType()),
    T.StructField("phrase", T.StringType()),
    T.StructField("base", T.BooleanType()),
    T.StructField("edits", T.IntegerType()),
    T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()),
])
FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("spans", T.ArrayType(SPAN)),
])

# Bytes of words, lower-cased; everything else becomes a space. UTF-8 writes characters
# beyond ASCII with bytes from 0x80 on only.
WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


class Searcher:
    """All notices prepared: one automaton of seeds, one pattern per notice."""

    def __init__(self, notices: tuple[Notice, ...]) -> None:
        import ahocorasick
        import regex

        self.notices = notices
        self.patterns = [regex.compile(n.pattern) for n in notices]
        places: dict[str, list[tuple[int, int]]] = {}
        for number, notice in enumerate(notices):
            if not 0 <= notice.edits < len(notice.phrase):
                raise ValueError(f"a notice needs fewer edits than letters: {notice.phrase!r}")
            for seed, offset in notice.seeds:
                places.setdefault(seed, []).append((number, offset))
        self.seeds = ahocorasick.Automaton()
        for seed, at in places.items():
            self.seeds.add_word(seed, (len(seed), at))
        if places:
            self.seeds.make_automaton()

    def matches(self, padded: str) -> Iterator[tuple[int, int, int, int]]:
        """(notice, edits, start, end) of the best span around each seed, repeats left out."""
        tried: set[tuple[int, int]] = set()
        found: set[tuple[int, int, int, int]] = set()
        for last, (length, places) in self.seeds.iter(padded) if self.notices else ():
            for number, offset in places:
                begin = last + 1 - length - offset
                if (number, begin) in tried:
                    continue
                tried.add((number, begin))
                notice = self.notices[number]
                low = max(0, begin - notice.edits - 1)
                match = self.patterns[number].search(padded[low : begin + len(notice.phrase) + notice.edits + 1])
                if match:
                    found.add((number, sum(match.fuzzy_counts), low + match.start(), low + match.end()))
        yield from found

    def spans(self, padded: str) -> list[tuple[int, int, int, int]]:
        """Spans of the padded words; of overlapping ones of a notice the best stays."""
        kept: list[tuple[int, int, int, int]] = []
        group: list[tuple[int, int, int, int]] = []
        reach = 0
        for m in sorted(self.matches(padded), key=lambda m: (m[0], m[2], m[3])):
            if group and (m[0] != group[0][0] or m[2] >= reach):
                kept += apart(group)
                group, reach = [], 0
            group.append(m)
            reach = max(reach, m[3])
        return sorted(kept + apart(group), key=lambda m: (m[2], m[3], m[0]))

    def found(self, raw: bytes | None) -> dict[str, object]:
        """Number of words, score and spans of one text in UTF-8."""
        words = (raw or b"").translate(WORD_BYTES).split()
        padded = f" {b' '.join(words).decode(errors='replace')} "
        spans = self.spans(padded)
        out, best = [], 0.0
        if spans:
            places = [m.span() for m in WORD.finditer(raw.decode(errors='replace'))]
            at, word = 0, -1  # the padded text's first space stands before word 0
            for number, edits, start, end in spans:
                word += padded.count(" ", at, start)
                at = start
                until = word + padded.count(" ", start, end)
                notice = self.notices[number]
                best = max(best, 1 - edits / len(notice.phrase))
                out.append({
                    "label": notice.label, "phrase": notice.phrase, "base": notice.base and edits == 0,
                    "edits": edits, "first_word": word, "last_word": until,
                    "start": places[word][0], "end": places[until][1],
                })
        return {"n_words": len(words), "score": best, "spans": out}


def apart(group: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Of overlapping spans of one notice: fewest edits first, then leftmost, then shortest."""
    kept: list[tuple[int, int, int, int]] = []
    for m in sorted(group, key=lambda m: (m[1], m[2], m[3])):
        if all(m[3] <= k[2] or m[2] >= k[3] for k in kept):
            kept.append(m)
    return kept


@cache
def searcher(notices: tuple[Notice, ...]) -> Searcher:
    """One searcher per worker and set of notices."""
    return Searcher(notices)


def find_notices(
    df: DataFrame, text: str = "text", notices: list[Notice] | None = None, into: str = "licenses"
) -> DataFrame:
    """Add ``into``: n_words, score and spans (label, edits, words and code points) of each text.

    The score is the share of letters without an edit in the best span, 0 without one.
    Spans count words from 0, both ends included, and code points with the end excluded.
    """
    chosen = tuple(NOTICES if notices is None else notices)

    def values(texts: list[bytes | None]) -> list:
        own = searcher(chosen)
        return [[own.found(raw) for raw in texts]]

    return map_text_slices(df, text, [T.StructField(free_name(df, into), FOUND)], values)
