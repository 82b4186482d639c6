"""Rollups declared in the warehouse: posts, targets, case values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def posts_by_date(posts: DataFrame) -> DataFrame:
    """Posts, comments and likes per day."""
    return posts.groupBy(F.to_date("PostDate").alias("Date_Date")).agg(
        F.count(F.lit(1)).alias("Posts"),
        F.sum("Comments").alias("Comments"),
        F.sum("Likes").alias("Likes"),
    )


def posts_by_hashtag(posts: DataFrame) -> DataFrame:
    """Posts per hashtag and day; a tag repeated in one caption counts once."""
    tags = F.array_distinct(F.regexp_extract_all("Caption", F.lit(r"#(\w+)"), F.lit(1)))
    day = F.to_date("PostDate").alias("Hashtag_Date")
    tagged = posts.select(F.explode(tags).alias("Hashtag"), day)
    return tagged.groupBy("Hashtag", "Hashtag_Date").agg(F.count(F.lit(1)).alias("Posts"))


def posts_by_media_type(posts: DataFrame) -> DataFrame:
    return posts.groupBy("Media_Type", F.to_date("PostDate").alias("Media_Type_Date")).agg(
        F.count(F.lit(1)).alias("Posts")
    )


def posts_by_hour(posts: DataFrame) -> DataFrame:
    return posts.groupBy(
        F.hour("PostDate").alias("Hour"), F.to_date("PostDate").alias("Hours_Date")
    ).agg(F.count(F.lit(1)).alias("Posts"))


GRAINS = {
    "year": ["Year"],
    "quarter": ["Year", "Quarter"],
    "month": ["Year", "Quarter", "Month"],
    "week": ["Year", "Quarter", "Month", "Week"],
}


def period_columns(day: Column) -> dict[str, Column]:
    return {
        "Year": F.year(day),
        "Quarter": F.quarter(day),
        "Month": F.month(day),
        "Week": F.weekofyear(day),
    }


def target_attainment(targets: DataFrame, actuals: DataFrame, grain: str) -> DataFrame:
    """Target and actual amount per team member and period.

    ``actuals`` has ``Team_member_id``, ``amount`` and the period columns. Both
    sides are summed before they are joined.
    """
    keys = ["Team_member_id", *GRAINS[grain]]
    goal = targets.groupBy(*keys).agg(F.sum("Target").alias("target"))
    done = actuals.groupBy(*keys).agg(F.sum("amount").alias("actual"))
    return goal.join(done, keys, "left").select(
        *keys,
        "target",
        F.coalesce("actual", F.lit(0)).alias("actual"),
        F.when(F.col("target") != 0, F.coalesce("actual", F.lit(0)) >= F.col("target"))
        .alias("attained"),
    )


def attainment_by_grain(facts: DataFrame) -> DataFrame:
    """``target_attainment`` for all grains in one pass and one shuffle.

    ``facts`` has ``Team_member_id``, the period columns, ``Target`` (null on rows that set
    none) and ``amount`` (null on rows that are no actual). The result names its ``grain``;
    periods finer than that are null.
    """
    periods = GRAINS["week"]
    columns = ["Team_member_id", *periods]
    sets = [["Team_member_id", *keys] for keys in GRAINS.values()]
    grouped = facts.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
        F.sum("Target").alias("target"), F.sum("amount").alias("actual"),
        F.count("Target").alias("goals"), F.grouping_id().alias("_id"),
    )
    # The bits of the columns that a set leaves out tell which one a row belongs to.
    ids = {grain: sum(1 << i for i, c in enumerate(reversed(periods)) if c not in keys) for grain, keys in GRAINS.items()}
    grain = F.coalesce(*[F.when(F.col("_id") == i, F.lit(g)) for g, i in ids.items()])
    actual = F.coalesce("actual", F.lit(0))
    return grouped.where("goals > 0").select(
        grain.alias("grain"), *columns, "target", actual.alias("actual"),
        F.when(F.col("target") != 0, actual >= F.col("target")).alias("attained"),
    )


def post_rollups(posts: DataFrame, sign: Column | None = None) -> DataFrame:
    """All post rollups in one pass: (rollup, key, day) with posts, comments and likes.

    ``date`` has no key, ``hashtag``, ``media_type`` and ``hour`` have theirs as text. ``sign``
    is 1 for posts that come and -1 for versions that go, so what changed since the last
    rollup is the rollup of the changes, and ``merge_rollups`` adds it.
    """
    day, one = F.to_date("PostDate"), F.lit(1) if sign is None else sign

    def entry(name: str, key: Column) -> Column:
        return F.struct(F.lit(name).alias("rollup"), key.cast("string").alias("key"))

    tags = F.array_distinct(F.regexp_extract_all("Caption", F.lit(r"#(\w+)"), F.lit(1)))
    entries = F.concat(
        F.array(entry("date", F.lit(None)), entry("media_type", F.col("Media_Type")), entry("hour", F.hour("PostDate"))),
        F.coalesce(F.transform(tags, lambda tag: entry("hashtag", tag)), F.array().cast("array<struct<rollup:string,key:string>>")),
    )
    counts = [(F.lit(1) * one).alias("p"), (F.col("Comments") * one).alias("c"), (F.col("Likes") * one).alias("l")]
    # Not explode: Spark would compute the entries once more, as a filter below it.
    fanned = posts.select(day.alias("day"), *counts, F.inline_outer(entries))
    return fanned.groupBy("rollup", "key", "day").agg(
        F.sum("p").cast("bigint").alias("Posts"), F.sum("c").cast("bigint").alias("Comments"), F.sum("l").cast("bigint").alias("Likes")
    )


def merge_rollups(*rollups: DataFrame) -> DataFrame:
    """Rollups added up; entries of which no post is left are gone."""
    whole = reduce(DataFrame.unionByName, rollups).groupBy("rollup", "key", "day")
    return whole.agg(*[F.sum(c).alias(c) for c in ("Posts", "Comments", "Likes")]).where("Posts <> 0")


def post_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rollups of what updates change: the old versions of posts go, the new ones come."""
    both = before.withColumn("_sign", F.lit(-1)).unionByName(after.withColumn("_sign", F.lit(1)))
    return post_rollups(both, F.col("_sign"))


# Case values are placed on a grid over their range; a cluster begins where a bin of the grid does.
GRID = 1 << 20
BIN, FINE = 1024, 16  # places per bin, and per bin where more than one case in HEAVY falls into one
HEAVY = 64


def case_value_clusters(
    cases: DataFrame, value: str, bounds_k: int = 7, ks: Sequence[int] = range(2, 8)
) -> DataFrame:
    """Cluster label of every distinct value for each k, with the bounds of its cluster.

    The clusters are those of least squared distance to their means, weighed by cases, among
    all that begin at a bin: 1,024 bins over the range, each of the few with more than a
    64th of the cases cut into 64 more. Values closer than a millionth of the range are not told
    apart. Labels ascend with the values. Two passes count the bins; what reaches the driver is
    a few thousand sums, and every run gives the same labels, as the sums are whole numbers.
    """
    known = cases.select(F.col(value).cast("double").alias("final_value")).where("final_value IS NOT NULL AND NOT isnan(final_value)")
    values = known.groupBy("final_value").agg(F.count(F.lit(1)).alias("weight"))
    ends = values.agg(F.min("final_value").alias("low"), F.max("final_value").alias("high")).first()
    low, wide = ends["low"] or 0.0, (ends["high"] or 0.0) - (ends["low"] or 0.0)
    share = (F.col("final_value") - F.lit(low)) / F.lit(wide or 1.0)
    placed = values.withColumn("place", F.floor(share * F.lit(float(GRID - 1))))
    sums = [F.sum("weight").alias("n"), F.sum(F.col("weight") * F.col("place")).alias("s"),
            F.sum(F.col("weight").cast("decimal(18,0)") * F.col("place") * F.col("place")).alias("q")]
    coarse = placed.groupBy(F.floor(F.col("place") / BIN).alias("bin")).agg(*sums).collect()
    total = sum(r["n"] for r in coarse)
    heavy = sorted(r["bin"] for r in coarse if r["n"] * HEAVY > total)
    bin_of, fine_of = F.floor(F.col("place") / BIN), F.floor(F.col("place") / FINE)
    binned = placed.withColumn("bin", F.when(bin_of.isin(heavy), fine_of).otherwise(bin_of * (BIN // FINE)))
    fine = binned.where(bin_of.isin(heavy)).groupBy("bin").agg(*sums).collect()
    bins = [(r["bin"], r["n"], r["s"], int(r["q"])) for r in fine]
    bins += [(r["bin"] * (BIN // FINE), r["n"], r["s"], int(r["q"])) for r in coarse if r["bin"] not in heavy]
    starts = cluster_starts(sorted(bins), max(ks))
    labels = {
        f"clusters_{k}": sum((F.when(F.col("bin") >= c, 1).otherwise(0) for c in starts[min(k, len(bins))]), F.lit(0))
        for k in ks
    }
    chosen = f"clusters_{bounds_k}"
    labelled = binned.select("final_value", *[c.alias(n) for n, c in labels.items()])
    bounds = labelled.groupBy(chosen).agg(
        F.floor(F.min("final_value")).cast("int").alias("clusters_lower_bound"),
        F.ceil(F.max("final_value")).cast("int").alias("clusters_upper_bound"),
    )
    # One row per cluster of the chosen k.
    joined = labelled.join(F.broadcast(bounds), chosen)
    return joined.select("final_value", *labels, "clusters_lower_bound", "clusters_upper_bound")


def cluster_starts(bins: Sequence[tuple[int, int, int, int]], most: int) -> dict[int, list[int]]:
    """For each k up to ``most`` the bins that begin the clusters after the first, of least cost.

    ``bins`` are (id, cases, sum, sum of squares) in order. The cost of a run of bins follows
    from sums up to its ends; the best k clusters of the first bins are the best k - 1 of fewer
    bins and one run more. Ties go to the earlier start.
    """
    n, s, q = (np.array([0, *accumulate(b[i] for b in bins)], dtype=float) for i in (1, 2, 3))
    size = len(bins)
    best = np.full(size + 1, np.inf)
    best[0] = 0.0
    origin = np.zeros((most + 1, size + 1), int)
    for k in range(1, most + 1):
        before, best = best, np.full(size + 1, np.inf)
        for j in range(k, size + 1):
            run = slice(k - 1, j)
            cost = before[run] + ((q[j] - q[run]) - (s[j] - s[run]) * (s[j] - s[run]) / (n[j] - n[run]))
            origin[k, j] = k - 1 + int(np.argmin(cost))
            best[j] = cost[origin[k, j] - (k - 1)]
    starts: dict[int, list[int]] = {0: []}
    for k in range(1, min(most, size) + 1):
        ends, at = [], size
        for step in range(k, 1, -1):
            at = int(origin[step, at])
            ends.append(bins[at][0])
        starts[k] = ends[::-1]
    return starts
