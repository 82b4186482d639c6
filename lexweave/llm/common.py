"""Helpers that several of these operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lexweave.functions.types import quoted
from lexweave.session import scratch_path
from lexweave.sources.files import remove

TEXT = "_text_"
SLICE = 1 << 20  # bytes of text that a worker's function gets at a time

BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def stored(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """The frame written below the shared checkpoint folder and read back: lineage ends here."""
    path = scratch_path(df.sparkSession, label)
    (df.write if codec is None else df.write.option("compression", codec)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settled(df: DataFrame, label: str) -> DataFrame:
    """``stored``, with the shuffle files behind the table dropped at once; ``df`` must not be used again.

    The table is on shared storage, so what made it is not needed to survive a lost executor.
    """
    spark = df.sparkSession
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        out = stored(df, label, "zstd")
    finally:
        spark.conf.set(SHUFFLES_GO, before)
    out.scratch_files = out.inputFiles()
    return out


def discard(*tables: DataFrame) -> None:
    """Remove ``settled`` tables that nothing reads any more; what came from them must be stored."""
    for table in tables:
        for folder in {f.rpartition("/")[0] for f in table.scratch_files}:
            remove(table.sparkSession, folder)


def row_key(doc_id: str, *rest: str) -> Column:
    """A key that equal rows share; never null, so that it joins."""
    values = [F.coalesce(F.col(name).cast("string"), F.lit("\x00")) for name in (doc_id, *rest)]
    return F.md5(F.concat_ws("\x01", *values))


def crc_part(doc_id: str, parts: int) -> Column:
    """``crc32(doc_id as text) mod parts``; rows without an id fall to part 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts, F.lit(0))


def with_text_columns(
    df: DataFrame,
    text: str,
    added: list[T.StructField],
    values: Callable[[list[str | None]], dict[str, object]],
    rows: int = 512,
    done: Callable[[], None] | None = None,
) -> DataFrame:
    """Add columns that ``values`` computes from lists of texts, in Arrow batches; ``done`` ends a task.

    ``values`` gets up to ``rows`` texts of about ``SLICE`` bytes together, one text at least,
    and returns a sequence of each added column. All other columns pass through as they are; one that has an added
    column's name is replaced.
    """
    names = [f.name for f in added]
    kept = [f for f in df.schema.fields if f.name not in names]
    source = df.select(*[quoted(f.name) for f in kept], quoted(text).cast("string").alias(free_name(df, TEXT)))
    kinds = [to_arrow_type(f.dataType) for f in added]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                some = batch.slice(start, rows)
                for part, texts in text_slices(some, some.column(some.num_columns - 1), SLICE):
                    found = values(texts.to_pylist())
                    columns = [part.column(i) for i in range(part.num_columns - 1)]
                    columns += [pa.array(found[n], k) for n, k in zip(names, kinds, strict=True)]
                    schema = part.schema.names[:-1] + names
                    yield pa.RecordBatch.from_arrays(columns, schema)
        if done is not None:
            done()
        # Workers live on for other stages, which need the memory.
        pa.default_memory_pool().release_unused()

    return source.mapInArrow(each, T.StructType(kept + added))


BITMAP = 1 << 23  # bits of a bitmap: one MB, whatever it stands for


def bitmap_place(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(BITMAP))


def bitmap_of(df: DataFrame, place: Column) -> np.ndarray:
    """Bits at the places of all rows: a filter of fixed size before an exact join."""
    bits = np.zeros(BITMAP // 8, np.uint8)
    # These functions number positions from 1, in parts of 32,768 bits that count from 1 too.
    marked = df.select((place + 1).alias("_at"))
    parts = marked.groupBy(F.bitmap_bucket_number("_at").alias("part"))
    for part, bitmap in parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position("_at"))).collect():
        start = (part - 1) * len(bitmap)
        bits[start : start + len(bitmap)] |= np.frombuffer(bitmap, np.uint8)
    return bits


def in_bitmap(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Which of some places have their bit set."""
    return (bits[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores until no column of the frame has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_slices(batch: pa.RecordBatch, texts: pa.Array, size: int) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Parts of a batch with about ``size`` bytes of text each, one row at least."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(lengths) // size
    starts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(starts, starts[1:], strict=False):
        if a < b:
            yield batch.slice(a, b - a), texts.slice(a, b - a)


def map_text_slices(
    df: DataFrame,
    text: str,
    added: list[T.StructField],
    values: Callable[[list[bytes | None]], list],
    size: int = 1 << 20,
) -> DataFrame:
    """Add columns that ``values`` computes from texts in UTF-8, some bytes of text at a time.

    The added names must be free (``free_name``); all input columns pass through.
    """
    own = free_name(df, TEXT)
    source = df.select(*[quoted(c) for c in df.columns], F.col(text).cast("string").cast("binary").alias(own))
    kinds = [to_arrow_type(f.dataType) for f in added]
    names = [*df.columns, *[f.name for f in added]]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_slices(batch, batch.column(batch.num_columns - 1), size):
                columns = [part.column(i) for i in range(part.num_columns - 1)]
                found = values(texts.to_pylist())
                columns += [pa.array(f, k) for f, k in zip(found, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return source.mapInArrow(each, T.StructType([*df.schema.fields, *added]))
