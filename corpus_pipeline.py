"""Documents into training rows: toxic texts out, recurring lines out, near copies out, sources mixed, encoded.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it
kept. ``run`` writes every stage's result below the shared checkpoint folder and reads it
again, so a lost executor repeats tasks of one stage only. Null texts pass every stage
until encoding, where they count as empty; empty tables stay empty. Columns besides
doc_id, text, source and n_chars pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexweave.llm import log_templates, ngram_join, piece_codec, poisson_mixing, toxicity
from lexweave.llm.catalogue import piece_model, table
from lexweave.llm.common import BLANKS, free_name, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half."""
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that recur; one of which no word is left goes."""
    into = free_name(docs, "lines_dropped")
    cleaned = log_templates.drop_recurring(docs, into=into)
    wordless = F.length(F.translate("text", BLANKS, "")) == 0
    left = cleaned.where(~F.coalesce((F.col(into) > 0) & wordless, F.lit(False)))
    number = F.when(F.col(into) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", number).select(*[F.col(f"`{c}`") for c in docs.columns])


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word n-grams at a similarity of 0.8."""
    return ngram_join.one_of_each(docs, width=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, in shuffled order."""
    return poisson_mixing.mix(docs).select(*[F.col(f"`{c}`") for c in docs.columns])


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, and whether decoding gives the text back."""
    coded = piece_codec.encode_texts(docs, piece_model())
    whole = F.col("decoded") == F.coalesce(F.col("text"), F.lit(""))
    return coded.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", whole.alias("round_trip")
    )


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("line_dedup", without_recurring_lines),
    ("near_duplicates", one_of_near_copies),
    ("mixing", mixed),
    ("encoding", encoded),
]
ORACLE_SQL: str | None = None  # trained scores and merges of a vocabulary have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
