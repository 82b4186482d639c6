"""Exact merge-type encoding with a SentencePiece vocabulary, and decoding.

A text is cut before its space marks, which no piece of such a vocabulary reaches
across (this is checked), and a task keeps the ids of cuts it has seen. Inside a cut the
encoder goes from left to right over the longest pieces that Aho-Corasick finds,
takes a piece if it stands beside its left neighbour under the merge rules, tries
shorter pieces otherwise, and steps back when none fits. A bitfield remembers the
positions from which no encoding goes on, so every position fails at most once.
Two pieces stand beside each other if merging their joined characters gives just
these two. An encoding whose neighbours all do is the one that merging gives.

Nulls encode like the empty text. Very long texts need memory in proportion to
their length only. Equal rows give equal rows; other columns pass through unless
they have a result's name, which the result then takes.
"""

from __future__ import annotations

import codecs
import re
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lexweave.llm.common import with_text_columns

SPACE = "▁"
EACH_BYTE = "lexweave.each_byte"  # decoding puts one mark for each byte that is no character
CACHED_CUTS = 500_000  # entries a task keeps; it starts anew when they are full
CACHED_PAIRS = 400_000
LONGEST_CACHED = 64
CONTROL = b"\xff\xff"  # stands for a control piece: shown as nothing, but parts bytes


class PieceCodec:
    """Encoder and decoder for one model file."""

    def __init__(self, model_file: str) -> None:
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.model = model
        ids = range(model.vocab_size())
        self.piece = [model.id_to_piece(i) for i in ids]
        self.unknown, self.end = model.unk_id(), model.eos_id()
        self.byte_ids = {int(self.piece[i][3:5], 16): i for i in ids if model.is_byte(i)}
        special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        plain = [i for i in ids if i not in special and not model.is_unused(i)]
        self.ids = {self.piece[i]: i for i in plain}
        self.score = {self.piece[i]: model.get_score(i) for i in plain}
        # What decoding appends for an id: bytes for byte pieces, nothing for control pieces.
        self.shown: list[bytes] = []
        for i in ids:
            if model.is_byte(i):
                self.shown.append(bytes([int(self.piece[i][3:5], 16)]))
            elif model.is_control(i):
                self.shown.append(CONTROL)
            elif model.is_unknown(i):
                self.shown.append(" ⁇ ".encode())
            else:
                self.shown.append(self.piece[i].replace(SPACE, " ").encode())
        self.pairs: dict[int, bool] = {}
        self.cuts: dict[str, list[int]] = {}
        # Pieces that merging their own characters gives; others never occur.
        reachable = [p for p in self.ids if self.merged(p) == [p]]
        self.matcher = ahocorasick.Automaton()
        self.length = [len(p) for p in self.piece]
        self.shorter = [-1] * len(self.piece)  # the longest piece that begins a piece
        known = set(reachable)
        for p in reachable:
            if len(p) > 1:  # single characters are looked up instead
                self.matcher.add_word(p, (len(p) - 1, self.ids[p]))
                begins = [p[:n] for n in range(len(p) - 1, 0, -1) if p[:n] in known]
                self.shorter[self.ids[p]] = self.ids[begins[0]] if begins else -1
        self.matcher.make_automaton()
        # Cuts are made before space marks, where no piece may reach across.
        if any(SPACE in p.lstrip(SPACE) for p in reachable):
            raise ValueError("this vocabulary has pieces that hold a space between words")
        self.cut = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")

    def merged(self, text: str) -> list[str]:
        """Merge the best-scored neighbours, leftmost first, until none is a piece."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def beside(self, left: int, right: int) -> bool:
        """Whether merging the joined characters of two pieces gives just these two."""
        if len(self.pairs) >= CACHED_PAIRS:
            self.pairs.clear()
        both = [self.piece[left], self.piece[right]]
        fits = self.pairs[left << 32 | right] = self.merged("".join(both)) == both
        return fits

    def run(self, text: str) -> list[int]:
        """Ids of a text all of whose characters are pieces; KeyError if one is not."""
        ids, length, shorter, pairs = self.ids, self.length, self.shorter, self.pairs
        longest = [ids[c] for c in text]
        for end, (before, piece) in self.matcher.iter(text):
            longest[end - before] = piece  # ends ascend, so the longest from a start comes last
        failed = bytearray(len(text) // 8 + 1)
        taken: list[int] = []
        at, left, piece, size = 0, -1, longest[0], len(text)
        while True:
            while piece >= 0:
                end = at + length[piece]
                if not failed[end >> 3] >> (end & 7) & 1:
                    if left < 0:
                        break
                    fits = pairs.get(left << 32 | piece)
                    if self.beside(left, piece) if fits is None else fits:
                        break
                piece = shorter[piece]
            if piece >= 0:
                taken.append(piece)
                if end == size:
                    return taken
                at, left, piece = end, piece, longest[end]
            else:
                failed[at >> 3] |= 1 << (at & 7)
                taken.pop()
                at -= length[left]
                piece, left = shorter[left], taken[-1] if taken else -1

    def cut_ids(self, text: str) -> list[int]:
        """Ids of one cut; characters without a piece become their bytes."""
        try:
            return self.run(text)
        except KeyError:
            pass
        found: list[int] = []
        start = 0
        for i, char in enumerate(text):
            if char not in self.ids:
                if start < i:
                    found += self.run(text[start:i])
                raw = [self.byte_ids.get(b) for b in char.encode()]
                found += raw if None not in raw else [self.unknown]
                start = i + 1
        return found + self.run(text[start:]) if start < len(text) else found

    def encode(self, text: str | None, end: bool = True) -> list[int]:
        ids: list[int] = []
        if text:
            cuts = self.cuts
            for cut in self.cut.findall(self.model.normalize(text)):
                known = cuts.get(cut)
                if known is None:
                    known = self.cut_ids(cut)
                    if len(cut) <= LONGEST_CACHED:
                        if len(cuts) >= CACHED_CUTS:
                            cuts.clear()
                        cuts[cut] = known
                ids += known
        if end:
            ids.append(self.end)
        return ids

    def decode(self, ids: list[int]) -> str:
        """Text of the ids, without the space that encoding puts first.

        Bytes that are no character become U+FFFD one by one.
        """
        shown = self.shown
        raw = b"".join([shown[i] for i in ids])
        first = next((i for i in ids if shown[i] is not CONTROL), None)
        raw = raw.removesuffix(CONTROL)
        if first is not None and self.piece[first].startswith(SPACE):
            raw = raw.replace(b" ", b"", 1)
        try:
            return raw.decode()
        except UnicodeDecodeError:
            pass
        parts: list[list[int]] = [[]]
        for i in ids:
            if shown[i] is CONTROL:
                parts.append([])
            else:
                parts[-1].append(i)
        text = "".join(b"".join([shown[i] for i in part]).decode(errors=EACH_BYTE) for part in parts)
        return text[1:] if first is not None and self.piece[first].startswith(SPACE) else text


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    return "\N{REPLACEMENT CHARACTER}" * (error.end - error.start), error.end


codecs.register_error(EACH_BYTE, _each_byte)


@cache
def codec(model_file: str) -> PieceCodec:
    """One codec per worker and model."""
    return PieceCodec(model_file)


def encode_texts(df: DataFrame, model_file: str, text: str = "text") -> DataFrame:
    """Add ``ids`` (array of int, closed by the end id) and ``decoded`` (their text)."""
    added = [
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded", T.StringType()),
    ]

    def values(texts: list[str | None]) -> dict[str, object]:
        own = codec(model_file)
        ids = [own.encode(t) for t in texts]
        return {"ids": ids, "decoded": [own.decode(i) for i in ids]}

    def done() -> None:
        # The vocabulary stays with the worker, what its texts have filled goes.
        own = codec(model_file)
        own.cuts.clear()
        own.pairs.clear()

    return with_text_columns(df, text, added, values, done=done)
