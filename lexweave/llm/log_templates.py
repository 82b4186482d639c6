"""Lines that recur across documents up to variable fields, by a tree of fixed depth.

A line is parsed like a log message. Tokens with a digit are fields at once. The tree's
leaf is found by the number of tokens and the first ``DEPTH`` tokens. Within a leaf a
token that fewer than ``least`` documents have at its place is a field too; a line's
template is its tokens with fields as ``<*>``. All of this is counted, so the outcome
does not depend on an order of lines, and no leaf is gathered in one place.

A template is dropped if at least ``least`` documents have it, its constant tokens make
at least ``similar`` of its tokens, and it recurs independently: copies of one document
repeat a line between the same neighbours, a recurring line stands between different
ones. So occurrences are counted by different pairs of neighbouring lines; there must be
``least`` of them, and half as many as documents. Lines inside a passage have the same
neighbours everywhere, and a group of copies may outnumber all other documents of a
template; so it is also dropped if ``least`` witnesses have it, whatever else does. A
witness has at least one word in ``OWN`` in lines without a template, and witnesses whose
least hash of such a line is the same count once. Texts whose five-word n-grams are similar
at 0.8 have at most one word in nine apart from each other, so near copies of that kind are
no witnesses, and a group of them keeps its text. Equal texts are one document here. Lines
of fewer than ``shortest`` tokens stay.

Only leaves are shuffled for all lines; lines are shuffled for leaves in enough
documents, which a bitmap of fixed size picks before an exact join. Hot lines are
aggregated in each task first.

Null texts stay null, empty ones empty. Very long texts are one row. Repeated rows get
equal results. A text whose lines all go becomes the empty text. Empty tables stay empty. Input
columns pass through; ``lines_dropped`` gets underscores where one has its name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.functions.types import quoted
from lexweave.llm.common import BITMAP, bitmap_of, free_name, in_bitmap, stored

DEPTH = 3
OWN = 8
FIELD = b"<*>"
DIGIT = re.compile(rb"[0-9]")


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def parsed(line: bytes) -> list[bytes]:
    """Tokens of a line, those with a digit as fields."""
    tokens = line.split()
    return [FIELD if DIGIT.search(t) else t for t in tokens] if DIGIT.search(line) else tokens


def leaf_of(tokens: list[bytes]) -> int:
    return signed(xxhash.xxh3_64_intdigest(b"%d " % len(tokens) + b" ".join(tokens[:DEPTH])))


def lines_of(text: str, shortest: int) -> Iterator[tuple[int, list[bytes], int]]:
    """Place, tokens and leaf of each line that is long enough."""
    for place, line in enumerate(text.encode().split(b"\n")):
        tokens = parsed(line)
        if len(tokens) >= shortest:
            yield place, tokens, leaf_of(tokens)


def leaves(texts: DataFrame, shortest: int) -> DataFrame:
    """Distinct (``key``, ``leaf``) of each text."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[int] = []
            found: list[int] = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = {leaf for _, _, leaf in lines_of(text.as_py(), shortest)}
                found += own
                keys += [key] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(found, pa.int64())], ["key", "leaf"])

    return texts.mapInArrow(each, "key long, leaf long")


LINE_SCHEMA = "key long, place int, leaf long, line long, context long, total long, rest long, tokens array<binary>"
LINE_ARROW = pa.schema([
    ("key", pa.int64()), ("place", pa.int32()), ("leaf", pa.int64()), ("line", pa.int64()),
    ("context", pa.int64()), ("total", pa.int64()), ("rest", pa.int64()), ("tokens", pa.list_(pa.binary())),
])


def lines_in(texts: DataFrame, bits: np.ndarray, shortest: int) -> DataFrame:
    """Lines of the leaves whose bit is set, with their neighbours' hash as context.

    ``total`` is the words of the text, ``rest`` the least hash of its other lines.
    """
    shared = texts.sparkSession.sparkContext.broadcast(bits)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                rows = []
                part = batch.slice(start, 256)
                for key, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    raw = text.as_py().encode().split(b"\n")
                    own = list(lines_of(text.as_py(), shortest))
                    if not own:
                        continue
                    seen = in_bitmap(shared.value, np.array([leaf for _, _, leaf in own], np.int64) & (BITMAP - 1))
                    if not seen.any():
                        continue
                    total = sum(len(x.split()) for x in raw)
                    taken = {place for (place, _, _), held in zip(own, seen.tolist(), strict=True) if held}
                    others = (b" ".join(x.split()) for n, x in enumerate(raw) if n not in taken)
                    rest = min((signed(xxhash.xxh3_64_intdigest(x)) for x in others if x), default=None)
                    for (place, tokens, leaf), held in zip(own, seen.tolist(), strict=True):
                        if held:
                            before = raw[place - 1] if place else b""
                            after = raw[place + 1] if place + 1 < len(raw) else b""
                            around = xxhash.xxh3_64_intdigest(before.strip() + b"\n" + after.strip())
                            line = xxhash.xxh3_64_intdigest(b" ".join(tokens))
                            rows.append((key, place, leaf, signed(line), signed(around), total, rest, tokens))
                if rows:
                    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), LINE_ARROW, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, schema=LINE_ARROW)

    return texts.mapInArrow(each, LINE_SCHEMA)


def leaf_place() -> Column:
    """A leaf is a hash already: its low bits are its place in the bitmap."""
    return F.col("leaf").bitwiseAND(F.lit(BITMAP - 1))


def witnesses(found: DataFrame) -> DataFrame:
    """``key`` and ``witness`` of the texts with enough words in lines without a template."""
    bare = F.col("template").isNull()
    texts = found.groupBy("key").agg(
        F.first("total").alias("total"),
        F.first("rest").alias("rest"),
        F.sum(F.when(bare, 0).otherwise(F.col("words"))).alias("templated"),
        F.min(F.when(bare, F.col("line"))).alias("bare"),
    )
    enough = texts.where(OWN * (F.col("total") - F.col("templated")) >= F.col("total"))
    return enough.select("key", F.coalesce(F.least("rest", "bare"), "key").alias("witness"))


def recurring_lines(
    docs: DataFrame, text: str = "text", least: int = 3, similar: float = 0.6, shortest: int = 4
) -> DataFrame:
    """``key`` (hash of the text) and ``places`` of the lines whose template recurs."""
    texts = docs.select(F.xxhash64(quoted(text).cast("string")).alias("key"), quoted(text).cast("string").alias("t"))
    texts = texts.where("t is not null")
    counted = leaves(texts, shortest).distinct().groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    hot = stored(counted.where(F.col("n") >= least).select("leaf"), "leaves")
    exact = lines_in(texts, bitmap_of(hot, leaf_place()), shortest).join(hot, "leaf", "left_semi")
    # Equal texts are one document.
    lines = stored(exact.dropDuplicates(["key", "place"]), "lines")
    own = lines.groupBy("leaf", "line", "key").agg(F.lit(1).alias("one"))
    distinct = own.groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("docs"))
    shown = lines.groupBy("leaf", "line").agg(F.first("tokens").alias("tokens"))
    forms = stored(shown.join(distinct, ["leaf", "line"]), "forms")
    tokens = forms.select("leaf", "line", "docs", F.posexplode_outer("tokens").alias("at", "token"))
    constant = (
        tokens.groupBy("leaf", "at", "token")
        .agg(F.sum("docs").alias("n"))
        .where((F.col("n") >= least) & (F.col("token") != F.lit(FIELD)))
    )
    kept = tokens.join(stored(constant.drop("n"), "constants"), ["leaf", "at", "token"])
    part = F.struct("at", F.xxhash64("token").alias("h"))
    templates = (
        kept.groupBy("leaf", "line")
        .agg(F.sort_array(F.collect_list(part)).alias("fixed"))
        .join(forms.select("leaf", "line", F.size("tokens").alias("size")), ["leaf", "line"])
        .where(F.size("fixed") >= F.lit(similar) * F.col("size"))
        .select("leaf", "line", F.xxhash64("leaf", "fixed").alias("template"))
    )
    templates = stored(templates, "templates")
    found = lines.select("key", "place", "leaf", "line", "context", "total", "rest", F.size("tokens").alias("words"))
    found = found.join(templates, ["leaf", "line"], "left").drop("leaf")
    found = stored(found, "found")
    placed = found.where("template is not null").select("key", "place", "template", "context")
    texts_with = placed.select("template", "key").distinct().groupBy("template").agg(F.count(F.lit(1)).alias("docs"))
    around = placed.select("template", "context").distinct().groupBy("template").agg(F.count(F.lit(1)).alias("contexts"))
    both = texts_with.join(around, "template")
    seen = placed.select("template", "key").distinct().join(stored(witnesses(found), "witnesses"), "key")
    shown = seen.select("template", "witness").distinct().groupBy("template").agg(F.count(F.lit(1)).alias("shown"))
    both = both.join(shown, "template", "left")
    apart = (F.col("contexts") >= least) & (2 * F.col("contexts") >= F.col("docs"))
    dropped = both.where((F.col("docs") >= least) & (apart | F.coalesce(F.col("shown") >= least, F.lit(False))))
    gone = placed.join(stored(dropped.select("template"), "dropped"), "template")
    return gone.groupBy("key").agg(F.collect_list("place").alias("places"))


def drop_recurring(
    docs: DataFrame, text: str = "text", least: int = 3, similar: float = 0.6, shortest: int = 4,
    into: str = "lines_dropped",
) -> DataFrame:
    """The rows with recurring lines taken out of the text; ``into`` counts them (see the module for clashes)."""
    gone = stored(recurring_lines(docs, text, least, similar, shortest), "places")
    into, own, held = (free_name(docs, n) for n in (into, "_key", "places"))
    fields = [T.StructField(text, T.StringType()) if f.name == text else f for f in docs.schema.fields]
    at = [f.name for f in fields].index(text)
    whole = quoted(text).cast("string")
    source = docs.select(*[whole.alias(text) if c == text else quoted(c) for c in docs.columns], F.xxhash64(whole).alias(own))
    # Dealt by the text's hash at every size: the places grow with the texts.
    places = gone.select(F.col("key").alias(own), F.col("places").alias(held)).hint("merge")
    joined = source.join(places, own, "left").select(*[quoted(f.name) for f in fields], held)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                places = part.column(part.num_columns - 1).to_pylist()
                texts = part.column(at).to_pylist()
                for i, own in enumerate(places):
                    if own:
                        drop = set(own)
                        lines = texts[i].split("\n")
                        texts[i] = "\n".join(x for n, x in enumerate(lines) if n not in drop)
                columns = [part.column(i) for i in range(part.num_columns - 1)]
                columns[at] = pa.array(texts, part.column(at).type)
                columns.append(pa.array([len(p or ()) for p in places], pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, part.schema.names[:-1] + [into])

    return joined.mapInArrow(each, T.StructType([*fields, T.StructField(into, T.LongType())]))
