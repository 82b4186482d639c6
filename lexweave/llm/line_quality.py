"""Quality rules over lines that recur in many documents of a host.

Lines are normalised (letters A-Z lower-cased, digits as 0, blanks as one space),
hashed, and counted by host in distinct documents. A line above the limit is removed;
a document that keeps too few words, or too small a part of them, is rejected. Each
row is a document, so a repeated row counts again. The limit is a count that holds
for all hosts plus a share of the host's documents, whatever the host's size.

Everything is built-in functions. A text is split and normalised once: its counts and the
hashes and words of its lines are stored, and all that follows reads that table. Only line
hashes and word counts are shuffled. The lines of a document are made distinct before they
are counted, counts are summed in each task first, and lines above the limit are joined
back as a stored table, whose join Spark can split where one line or host has very many rows.

Null texts have no word and no line. A null host is a host of its own. Lines without a
word are no lines. Columns are picked by name; other columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.functions.types import quoted
from lexweave.llm.common import LOWER, UPPER, WORD, row_key, stored

SYMBOLS = "[#*$%&|<>]+"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Words as an array, without the empty ends that splitting leaves."""
    return F.array_remove(F.split(text, BLANK_RUN), "")


def has_word(line: Column) -> Column:
    return line.rlike(WORD)


def lines_of(text: Column) -> Column:
    """Lines that hold a word."""
    return F.filter(F.split(text, "\n"), has_word)


def normalised(line: Column) -> Column:
    plain = F.translate(line, UPPER + "123456789", LOWER + "0" * 9)
    return F.trim(F.regexp_replace(plain, BLANK_RUN, " "))


def line_keys(lines: str) -> Column:
    """Hash and number of words of each line as it is normalised."""
    words = lambda x: F.length(x) - F.length(F.replace(x, F.lit(" "))) + 1
    return F.transform(
        F.transform(lines, normalised),
        lambda x: F.struct(F.xxhash64(x).alias("line"), words(x).cast("int").alias("words")),
    )


def windows(words: str) -> Column:
    """Hashes of the three-word windows, by start."""
    last = F.size(words) - 3
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(
        at, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    )


def in_order(keys: str) -> Column:
    """Windows with their starts, sorted; null where none repeats, which a set tells."""
    starts = F.sequence(F.lit(0), F.size(keys) - 1)
    keyed = F.arrays_zip(F.col(keys).alias("k"), starts.alias("i"))
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), F.sort_array(keyed))


def repeat_starts(ordered: str) -> Column:
    """Starts, ascending, of windows that stand beside an equal one in sorted order."""
    equal = lambda x, n: F.coalesce(x["k"] == F.get(ordered, n)["k"], F.lit(False))
    again = F.filter(ordered, lambda x, n: equal(x, n - 1) | equal(x, n + 1))
    return F.sort_array(F.transform(again, lambda x: x["i"]))


def covered(starts: str) -> Column:
    """Words in the windows at these ascending starts, each counted once."""
    steps = F.transform(
        starts, lambda s, n: F.least(F.lit(3), F.coalesce(F.get(starts, n + 1) - s, F.lit(3)))
    )
    return F.coalesce(F.aggregate(steps, F.lit(0), lambda a, b: a + b), F.lit(0))


def base_rules(docs: DataFrame, doc_id: str, text: str, host: str) -> DataFrame:
    """One row per document: its key, host, counts and the hash and words of each line."""
    source = docs.select(
        row_key(doc_id, host, text).alias("_key"),
        quoted(doc_id).alias("doc_id"),
        quoted(host).cast("string").alias("_host"),
        F.coalesce(quoted(text).cast("string"), F.lit("")).alias("_text"),
    )
    cut = source.withColumns({"_words": words_of(F.col("_text")), "_all": lines_of(F.col("_text"))})
    # Each step is a column of its own: inside a lambda an expression would run for each element.
    counted = (
        cut.withColumn("_keys", windows("_words"))
        .withColumn("_ordered", in_order("_keys"))
        .withColumn("_starts", repeat_starts("_ordered"))
    )
    return counted.select(
        "_key",
        "doc_id",
        "_host",
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_all") - F.size(F.array_distinct("_all"))).cast("long").alias("n_dup_lines"),
        covered("_starts").cast("long").alias("n_repeat_words"),
        line_keys("_all").alias("_lines"),
    )


def document_lines(read: DataFrame) -> DataFrame:
    """One row per document and line: its hash and its words."""
    return (
        read.select("_key", "_host", F.explode_outer("_lines").alias("_l"))
        .where("_l is not null")
        .select("_key", "_host", F.col("_l.line").alias("line"), F.col("_l.words").alias("words"))
    )


def host_key() -> Column:
    return F.coalesce(F.concat(F.lit("="), "_host"), F.lit(""))


def common_lines(read: DataFrame, most_documents: int, most_share: float) -> DataFrame:
    """Hashes of the lines above the limit, by host."""
    hosts = read.groupBy(host_key().alias("_at"))
    sizes = stored(hosts.agg(F.count(F.lit(1)).alias("_docs")), "hosts")
    own = read.select("_host", F.array_distinct("_lines.line").alias("_lines"))
    counted = (
        own.select(host_key().alias("_at"), F.explode_outer("_lines").alias("line"))
        .where("line is not null")
        .groupBy("_at", "line")
        .agg(F.count(F.lit(1)).alias("_in"))
        .where(F.col("_in") > most_documents)
    )
    limit = F.lit(most_documents) + F.lit(most_share) * F.col("_docs")
    return stored(
        counted.join(sizes, "_at").where(F.col("_in") > limit).select("_at", "line"), "common-lines"
    )


def removed_lines(lines: DataFrame, common: DataFrame) -> DataFrame:
    """Of all documents' lines those above the limit."""
    return lines.withColumn("_at", host_key()).join(common, ["_at", "line"])


def without_common_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    most_documents: int = 20,
    most_share: float = 0.002,
) -> DataFrame:
    """The rows of ``docs`` with the lines above the limit taken out of the text.

    Other lines stay as they are, also those without a word. Null texts stay null; a text
    whose lines all go becomes the empty text.
    """
    read = stored(base_rules(docs, doc_id, text, host).select("_key", "_host", "_lines"), "documents")
    removed = removed_lines(document_lines(read), common_lines(read, most_documents, most_share))
    gone = removed.groupBy(F.col("_key").alias("_lq_key")).agg(F.collect_set("line").alias("_lq_gone"))
    marked = docs.withColumn("_lq_key", row_key(doc_id, host, text))
    joined = marked.join(stored(gone, "removed-lines"), "_lq_key", "left")
    whole = quoted(text).cast("string")
    out = lambda x: has_word(x) & F.array_contains("_lq_gone", F.xxhash64(normalised(x)))
    left = F.concat_ws("\n", F.filter(F.split(whole, "\n"), lambda x: ~out(x)))
    cleaned = F.when(F.col("_lq_gone").isNull(), whole).otherwise(left).alias(text)
    return joined.select(*[cleaned if c == text else quoted(c) for c in docs.columns])


def line_quality(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    most_documents: int = 20,
    most_share: float = 0.002,
    least_words: int = 50,
    least_part: float = 0.3,
) -> DataFrame:
    """Base counts of each document and the verdict of the line rules.

    A line is removed where more than ``most_documents + most_share * documents of
    the host`` documents of the host have it. ``kept`` is false if ``base_failed``, or
    if fewer than ``least_words`` words or ``least_part`` of the words stay.
    """
    read = stored(base_rules(docs, doc_id, text, host), "documents")
    removed = (
        removed_lines(document_lines(read), common_lines(read, most_documents, most_share))
        .groupBy("_key")
        .agg(F.sum("words").alias("_words_out"), F.count(F.lit(1)).alias("_lines_out"))
    )
    # A repeated row sends its lines once for each copy: the sums are divided by the copies.
    copies = F.count(F.lit(1)).alias("_copies")
    return finish(read, removed, copies, least_words, least_part)


def finish(
    base: DataFrame, removed: DataFrame, copies: Column, least_words: int, least_part: float
) -> DataFrame:
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    rows = base.groupBy("_key", *columns).agg(copies)
    joined = rows.join(removed, "_key", "left")
    out = lambda name: (F.coalesce(F.col(name), F.lit(0)) / F.col("_copies")).cast("long")
    left = F.col("n_words") - F.col("removed_words")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    enough = (left >= least_words) & (left >= least_part * F.col("n_words"))
    judged = joined.withColumns({"removed_lines": out("_lines_out"), "removed_words": out("_words_out")})
    return (
        judged.withColumns({"base_failed": failed, "kept": ~failed & enough})
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select(*columns, "base_failed", "kept", "removed_lines", "removed_words")
    )
