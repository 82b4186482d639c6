"""Mixing of sources to target weights by Poisson replication.

A source's rate is the mean number of times its documents are to be repeated: its
share of the mix, times the size of the mix, over its documents. Each document gets
a uniform number from a seeded hash of its id and its place in the shuffled order, and
the number of copies whose Poisson distribution function first exceeds it. A rate above
``PART_RATE`` is split into equal parts, each with a uniform number of its own: the sum of
their counts follows the Poisson distribution of the whole rate. A copy's
place in the mix is another seeded hash: rows are dealt to partitions by it and sorted
by it within them, which is a global shuffle with one exchange.

Nothing but built-in functions is used. The rates are one stored row per source;
Spark broadcasts them by their size or splits a hot source's join. Rows of a null
source form a source of their own. Rows that share an id and a text get the same
number of copies. Null texts are rows like any other. Of an empty table nothing is
left. Columns pass through as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.functions.types import quoted
from lexweave.llm.common import free_name, row_key, stored

DIGITS = 12  # hexadecimal digits of a uniform number: 48 bits
MOST_COPIES = 64  # of a part: rates up to 16 leave less than 1e-17 beyond it
PART_RATE = 16.0


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the MD5 of the parts."""
    digits = F.substring(F.md5(F.concat_ws("|", *parts)), 1, DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**DIGITS))


def poisson_count(number: Column, steps: Column) -> Column:
    """How many steps of a distribution function a uniform number has passed."""
    return F.size(F.filter(steps, lambda s: s <= number))


def poisson_steps(rate: Column) -> Column:
    """The Poisson distribution function at 0, 1, ... up to the most copies."""
    first = F.struct(F.exp(-rate).alias("p"), F.exp(-rate).alias("f"), F.array(F.exp(-rate)).alias("all"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * rate / k
        f = state["f"] + p
        return F.struct(p.alias("p"), f.alias("f"), F.concat(state["all"], F.array(f)).alias("all"))

    up_to = F.sequence(F.lit(1), F.lit(MOST_COPIES - 1))
    return F.aggregate(up_to, first, step, lambda state: state["all"])


def source_rates(docs: DataFrame, source: str, weights: dict[str, float] | None, power: float, size: float) -> DataFrame:
    """One row per source: its key, rate, parts of the rate and a part's distribution function.

    Without ``weights`` a source's weight is its documents to the ``power``. The mix
    has ``size`` times as many documents as the input.
    """
    key = source_key(source)
    counts = docs.groupBy(key.alias("_mix_key")).agg(F.count(F.lit(1)).alias("_mix_docs"))
    if weights is None:
        weight = F.pow(F.col("_mix_docs").cast("double"), F.lit(power))
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("_mix_key") == "=" + name, F.lit(float(value))).otherwise(weight)
    weighed = stored(counts.withColumn("_mix_weight", weight), "sources")
    totals = weighed.agg(F.sum("_mix_weight").alias("_w"), F.sum("_mix_docs").alias("_n"))
    rate = F.col("_mix_weight") / F.col("_w") * F.col("_n") * size / F.col("_mix_docs")
    rated = weighed.crossJoin(F.broadcast(totals)).withColumn("mix_rate", F.coalesce(rate, F.lit(0.0)))
    parts = F.greatest(F.ceil(F.col("mix_rate") / PART_RATE), F.lit(1))
    rated = rated.withColumn("_mix_parts", parts)
    steps = poisson_steps(F.col("mix_rate") / F.col("_mix_parts"))
    return rated.select("_mix_key", "mix_rate", "_mix_parts", steps.alias("_mix_steps"))


def source_key(source: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), quoted(source).cast("string")), F.lit(""))


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: dict[str, float] | None = None,
    power: float = 0.7,
    size: float = 1.0,
    seed: str = "mix-1",
) -> DataFrame:
    """The documents repeated to the target weights and shuffled, with ``mix_copy`` from 1 and ``mix_place``.

    Input columns stay as they are; where one has a result's name, underscores are added to the result's.
    """
    rates = stored(source_rates(docs, source, weights, power, size), "rates")
    own = {n: free_name(docs, n) for n in ("_mix_key", "_mix_id", "_mix_copies", "_mix_steps", "_mix_parts", "mix_rate", "mix_copy", "mix_place")}
    rates = rates.withColumnsRenamed({c: own[c] for c in rates.columns})
    drawn = lambda *part: poisson_count(
        uniform(F.lit(seed), F.lit("copies"), F.col(own["_mix_id"]), *part), F.col(own["_mix_steps"])
    )
    parts, number = F.col(own["_mix_parts"]), F.col(own["_mix_copies"])
    others = F.sequence(F.lit(2).cast("long"), parts)
    more = F.aggregate(others, F.lit(0), lambda n, part: n + drawn(part.cast("string")))
    copies = F.when(parts > 1, drawn() + more).otherwise(drawn())
    repeated = (
        docs.withColumns({own["_mix_key"]: source_key(source), own["_mix_id"]: row_key(doc_id, text)})
        .join(rates, own["_mix_key"])
        .withColumn(own["_mix_copies"], copies)
        # Explode without "outer" would hash every text twice, for a filter.
        .withColumn(own["mix_copy"], F.explode_outer(F.sequence(F.lit(1), F.when(number > 0, number))))
        .where(F.col(own["mix_copy"]).isNotNull())
    )
    place = uniform(F.lit(seed), F.lit("place"), F.col(own["_mix_id"]), F.col(own["mix_copy"]))
    placed = repeated.withColumn(own["mix_place"], place)
    return (
        placed.repartition(own["mix_place"])
        .sortWithinPartitions(own["mix_place"])
        .select(*[quoted(c) for c in docs.columns], own["mix_copy"], own["mix_place"])
    )
