"""Near duplicates by the Jaccard similarity of word n-grams, without a lost link.

Adaptive multi-match prefixes: a document's n-grams are put in one global order, rare
ones first. Of two sets that are similar enough, the prefixes that end ``l`` places
after the shortest possible one share at least ``l`` n-grams. Each document takes the
``l`` that makes its estimated candidate cost least: a longer prefix reads more
postings, but a partner must share more of it. Two documents are verified when they
share at least the smaller of their two ``l`` within their prefixes, and as many as the
overlap needs besides what lies behind the prefix that ends first.

The order and the estimates come from counts of all n-grams in ``BUCKETS`` hash
buckets, which is all that is collected and broadcast. Equal sets form one class and
are joined once. Postings of n-grams that only one class has are dropped early.

N-grams of at most ``RARE`` classes give their pairs at once. A class with fewer common
n-grams in its prefix than it must share has a rare one with every partner, so it needs
no others. Only classes made mostly of common n-grams are left: large groups of near
copies, documents that are little but a passage. A group of k near copies has k * k / 2
similar pairs, which are not needed to know the group. So every common n-gram names one
class as its hub, and every class is verified against the hub it shares most with. Pairs
that are in one component by then need no verification. Rounds with other hubs go on
while many pairs are open; a last step then verifies every pair that is still open, so
no link between components is missed.

Documents without a word have an empty set and are linked with nothing; shorter ones
than an n-gram have one n-gram, their whole sequence. Null texts count as empty. A null
id never names a component unless its documents have no other; rows that share an id
are separate documents of one name. Repeated rows are equal sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.functions.types import quoted
from lexweave.llm.common import bitmap_of, bitmap_place, discard, free_name, in_bitmap
from lexweave.llm.common import settled as stored
from lexweave.llm.components import components

BUCKETS = 1 << 17  # of the n-gram counts that order the prefixes
LONGEST = 12  # most n-grams that prefixes must share
RARE = 16  # most classes of an n-gram whose pairs are all met at once
VERIFY_COST = 4.0  # of a candidate pair against one posting
OPEN_PAIRS = 2.0  # pairs still open for each posting, above which another round of hubs is made
ROUNDS = 6
PROGRESS = 0.8  # of the open pairs, above which a round of hubs has not helped and is the last
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads neighbours."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Distinct hashes, ascending, of the runs of ``width`` words; A-Z are lower-cased."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(width, len(words))
    runs = len(words) - size + 1
    found = np.full(runs, size * MIX[2] % (1 << 64), np.uint64)
    for k in range(size):
        found = mixed(found + own[k : k + runs])
    return np.unique(found)


def bucket_counts(docs: DataFrame, width: int) -> np.ndarray:
    """How many documents have an n-gram of each bucket, summed over all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            parts = [shingles(t.as_py(), width) for t in batch.column(0)]
            if parts:
                buckets = (np.concatenate(parts) % np.uint64(BUCKETS)).astype(np.int64)
                total += np.bincount(buckets, minlength=BUCKETS)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    counted = docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket")
    counts = np.zeros(BUCKETS, np.int64)
    for bucket, n in counted.agg(F.sum("n").alias("n")).collect():
        counts[bucket] = n
    return counts


def prefix(grams: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The prefix of a set, in global order, and the number of its n-grams a partner must share."""
    size = len(grams)
    held = counts[(grams % np.uint64(len(counts))).astype(np.int64)]
    order = np.lexsort((grams, held))
    overlap = -(-percent * size // 100)  # least overlap with any similar set
    first = size - overlap + 1
    most = min(LONGEST, overlap)
    # A bucket holds other n-grams too: what it has above the mean is this one's.
    expected = np.maximum(held[order] - counts.mean(), 1.0)
    postings = np.cumsum(expected[: first + most - 1])[first - 1 :]
    need = np.arange(1, most + 1)
    cost = postings + VERIFY_COST * postings / need
    best = most // 2 + int(np.argmin(cost[most // 2 :]))  # at least half of the most
    return grams[order[: first + best]], best + 1


def end_of(tokens: np.ndarray, counts: np.ndarray) -> int:
    """The place in the global order at which a prefix ends, cut to 63 bits.

    A smaller number is an earlier place; equal ones may be either way round.
    """
    held = int(counts[int(tokens[-1] % np.uint64(len(counts)))])
    return min(held, (1 << 40) - 1) << 23 | int(tokens[-1]) >> 41


def with_sets(docs: DataFrame, width: int, percent: int, counts: np.ndarray) -> DataFrame:
    """Each document's size, fingerprint of its whole set, and prefix."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                sizes, prints, needs, stops, prefixes = [], [], [], [], []
                for text in part.column(2):
                    grams = shingles(text.as_py(), width)
                    sizes.append(len(grams))
                    prints.append(xxhash.xxh3_128_digest(grams.tobytes()))
                    tokens, need = prefix(grams, shared.value, percent) if len(grams) else (grams, 0)
                    needs.append(need)
                    stops.append(end_of(tokens, shared.value) if need else 0)
                    prefixes.append(tokens.view(np.int64))
                ends = np.cumsum([0] + [len(p) for p in prefixes]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(prefixes)))
                columns = [part.column(0), part.column(1), pa.array(sizes, pa.int64())]
                columns += [pa.array(prints, pa.binary()), pa.array(needs, pa.int32()), pa.array(stops, pa.int64()), lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "n", "print", "need", "end", "prefix"])

    schema = "doc_id long, key long, n long, print binary, need int, end long, prefix array<long>"
    return docs.mapInArrow(each, schema)


def sets_of(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """Whole sets of the wanted classes: ``node`` and its n-grams, from their first documents.

    A bitmap of the wanted documents, of a fixed size, spares most other texts; the join
    after it is exact.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bitmap_of(wanted, bitmap_place("doc_id", "key")))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = np.flatnonzero(in_bitmap(shared.value, batch.column(3).to_numpy()))
            for start in range(0, len(seen), 512):
                part = batch.take(pa.array(seen[start : start + 512]))
                grams = [shingles(t.as_py(), width).view(np.int64) for t in part.column(2)]
                ends = np.cumsum([0] + [len(g) for g in grams]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(grams)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), lists], ["doc_id", "key", "grams"])

    rows = docs.select("doc_id", "key", "text", bitmap_place("doc_id", "key").alias("at"))
    found = rows.mapInArrow(each, "doc_id long, key long, grams array<long>")
    both = F.xxhash64("doc_id", "key")
    found = found.withColumn("_both", both)
    same = wanted.withColumn("_both", both).withColumnsRenamed({"doc_id": "_id", "key": "_key"})
    equal = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key"))
    joined = found.join(same.hint("merge"), "_both").where(equal).select("_both", "node", "grams")
    # Repeated rows meet where the join has dealt them.
    return joined.dropDuplicates(["_both", "node"]).select("node", "grams")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` whose whole sets are similar enough."""
    # Whole sets are dealt by class at every size: pairs grow with the documents.
    left = sets.select(F.col("node").alias("a"), F.col("grams").alias("_x")).hint("merge")
    right = sets.select(F.col("node").alias("b"), F.col("grams").alias("_y")).hint("merge")
    joined = pairs.select("a", "b").join(left, "a").join(right, "b")
    both = joined.select("a", "b", F.size("_x").alias("x"), F.size("_y").alias("y"),
                         F.size(F.array_intersect("_x", "_y")).alias("i"))
    return both.where(100 * F.col("i") >= percent * (F.col("x") + F.col("y") - F.col("i"))).select("a", "b")


def of_earlier(a: Column, b: Column, end_a: str, end_b: str) -> Column:
    """Of two bounds the one of the class whose prefix ends first; the greater if that is not known."""
    known = F.when(F.col(end_a) < F.col(end_b), a).when(F.col(end_b) < F.col(end_a), b)
    return known.otherwise(F.greatest(a, b))


def could_link(percent: int, a: str, b: str, most_a: str, most_b: str, end_a: str, end_b: str) -> Column:
    """Whether the sizes and what can be shared at most allow the similarity.

    What the earlier prefix has alone is nowhere in the other set. The later one's may
    stand behind the end of the earlier.
    """
    most = of_earlier(F.col(most_a), F.col(most_b), end_a, end_b)
    shared = F.least(F.col(a), F.col(b), most)
    return 100 * shared >= percent * (F.col(a) + F.col(b) - shared)


def least_shared(percent: int) -> Column:
    """How many n-grams a similar pair shares within its prefixes at least.

    The earlier prefix's shared n-grams all lie in the other one, and of the overlap only
    what is behind its end can be missing.
    """
    overlap = F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100 + percent))
    behind = lambda tail: F.ceil(F.col("n" + tail) * percent / 100) - F.col("need" + tail)
    rest = of_earlier(behind("_a"), behind("_b"), "end_a", "end_b")
    return F.greatest(F.least("need_a", "need_b"), overlap - rest)


def documents_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        quoted(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(quoted(text).cast("string")).alias("key"),
        quoted(text).cast("string").alias("text"),
    )


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 3, percent: int = 90
) -> DataFrame:
    """``doc_id``, ``key`` (hash of the text), ``n_shingles``, ``component_id`` of every row.

    ``first_key`` and ``first_id`` tell the component's first document by id, null ids last.
    """
    source = documents_of(docs, doc_id, text)
    counts = bucket_counts(source, width)
    rows = stored(with_sets(source, width, percent, counts), "sets")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    # One class for each set; the prefix depends on the set alone.
    wide = stored(
        rows.where("n > 0")
        .groupBy("print")
        .agg(F.min(order).alias("first"), F.first("n").alias("n"), F.first("need").alias("need"), F.first("end").alias("end"), F.first("prefix").alias("prefix"))
        .withColumn("node", F.monotonically_increasing_id()),
        "prefixes",
    )
    # Prefixes are the bulk of both tables, and read once more only.
    narrow = stored(rows.select("doc_id", "key", "n", "print"), "documents")
    classes = stored(wide.drop("prefix"), "classes")
    discard(rows)
    roots = class_components(source, classes, wide, width, percent)
    named = classes.select("print", "node", "first").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    # The first of a component; nearly all components are one class, so few rows are moved.
    firsts = stored(
        named.join(roots.select("root").distinct(), "root", "left_semi")
        .groupBy("root")
        .agg(F.min("first").alias("least")),
        "firsts",
    )
    known = stored(
        named.join(firsts, "root", "left").select("print", F.coalesce("least", "first").alias("least")), "known"
    )
    joined = narrow.join(known, "print", "left")
    alone = F.col("n") == 0
    return joined.select(
        "doc_id",
        "key",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
        F.when(~alone, F.col("least.doc_id")).alias("first_id"),
        F.when(~alone, F.col("least.key")).alias("first_key"),
    )


def class_components(
    source: DataFrame, classes: DataFrame, wide: DataFrame, width: int, percent: int
) -> DataFrame:
    """``node`` and ``root`` of the classes that are linked with another; ``wide`` has their prefixes and goes."""
    held = shared_postings(classes, wide, percent)
    rare = rare_pairs(held.where(F.col("df") <= RARE), percent)
    pairs = stored(rare, "pairs")
    # N-grams of many classes are needed only among classes made mostly of such.
    common = held.where((F.col("df") > RARE) & F.col("heavy")).select("token", "node", "n", "need", "most", "end", "low")
    first = common = stored(common, "common-postings")
    discard(held)
    several = common.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1").select("token")
    common = common.join(stored(several, "common-tokens"), "token")
    own = common.groupBy("node").agg(F.count(F.lit(1)).alias("c"), F.first(F.least("need", "low")).alias("l"))
    able = stored(own.where("c >= l").select("node"), "heavy")
    common = stored(common.join(able, "node", "left_semi").drop("low"), "common-postings")
    discard(first)
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).unionByName(able).distinct()
    wanted = classes.join(ends, "node", "left_semi")
    few = wanted.select("node", F.col("first.doc_id").alias("doc_id"), F.col("first.key").alias("key"))
    sets = stored(sets_of(source, few, width), "whole-sets")
    links = stored(verified(pairs, sets, percent), "verified")
    roots = stored(components(links), "components")
    every, sets = sets, stored(sets.join(able, "node", "left_semi"), "heavy-sets")
    discard(every)
    tried, before = pairs, float("inf")
    for turn in range(ROUNDS + 1):
        current = common.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        # Of each n-gram whose classes are in several components: its classes.
        several = current.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"))
        still = stored(several.where("low <> high").select("token"), "open-tokens")
        current = stored(current.join(still, "token"), "open-postings")
        still_open, size = pairs_open(current)
        last = turn == ROUNDS or still_open <= OPEN_PAIRS * size or still_open > PROGRESS * before
        before = still_open
        pairs = open_pairs(current, percent) if last else hub_pairs(current, turn, percent)
        pairs = stored(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        discard(still, current)
        links = links.unionByName(stored(verified(pairs, sets, percent), "verified"))
        roots = stored(components(links), "components")
        if last:
            return roots
        tried = tried.unionByName(pairs)
    raise AssertionError("the last turn returns")


def shared_postings(classes: DataFrame, wide: DataFrame, percent: int) -> DataFrame:
    """Postings of n-grams that several classes have in their prefixes, by class.

    ``df`` is the n-gram's number of classes, ``common`` the class's n-grams above
    ``RARE``, ``most`` the n-grams it could share at most with classes whose prefixes end
    no earlier than its own, at ``end``; ``low`` is the least that any partner of the class
    asks for. A class is
    ``heavy`` if all that it must share could be common n-grams; any other shares a
    rare one with each of its partners.
    """
    packed = (F.col("n") * (2 * LONGEST) + F.col("need")).alias("size")
    postings = wide.select(F.explode_outer("prefix").alias("token"), "node", packed)
    tokens = postings.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    tokens = stored(tokens, "tokens")
    held = stored(postings.join(tokens, "token"), "postings")
    discard(wide, tokens)
    counts = held.groupBy("node").agg(
        F.count_if(F.col("df") > RARE).alias("common"), F.count(F.lit(1)).alias("held")
    )
    counts = counts.join(classes.select("node", "end"), "node")
    n, need = F.floor(F.col("size") / (2 * LONGEST)), F.col("size") % (2 * LONGEST)
    sized = held.join(stored(counts, "held-counts"), "node").select(
        "token", "node", "df", "common", "held", "end", n.alias("n"), need.alias("need")
    )
    # The prefix's n-grams that no other prefix has. Others may have them behind an earlier end.
    alone = F.col("n") - F.ceil(F.col("n") * percent / 100) + F.col("need") - F.col("held")
    sized = sized.withColumn("most", F.col("n") - alone).drop("held")
    smallest = F.ceil(F.lit(percent * percent) * F.col("n") / 10_000)  # least overlap a partner has
    low = F.ceil(F.least(F.lit(LONGEST), smallest) / 2)
    lowest = sized.withColumn("low", F.greatest(low, F.lit(1)))
    out = stored(lowest.withColumn("heavy", F.col("common") >= F.least("need", "low")), "sized-postings")
    discard(held)
    return out


def rare_pairs(rare: DataFrame, percent: int) -> DataFrame:
    """Pairs that share enough rare n-grams, for what common ones they may share besides.

    At most ``RARE`` classes have an n-gram here, so the pairs grow with the postings.
    """
    side = lambda node, tail: rare.select("token", F.col("node").alias(node), *[F.col(c).alias(c + tail) for c in ("n", "need", "common", "most", "end")])
    met = side("a", "_a").join(side("b", "_b"), "token")
    near = met.where((F.col("a") < F.col("b")) & could_link(percent, "n_a", "n_b", "most_a", "most_b", "end_a", "end_b"))
    least = least_shared(percent) - F.least("common_a", "common_b")
    counted = near.groupBy("a", "b").agg(F.count(F.lit(1)).alias("c"), F.first(least).alias("least"))
    return counted.where(F.col("c") >= F.col("least")).select("a", "b")


def pairs_open(current: DataFrame) -> tuple[float, float]:
    """Pairs of postings in different components, and postings."""
    by_root = current.groupBy("token", "root").agg(F.count(F.lit(1)).alias("k"))
    squares = by_root.groupBy("token").agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("own"))
    both = squares.agg(F.sum((F.col("k") * F.col("k") - F.col("own")) / 2), F.sum("k")).first()
    return float(both[0] or 0), float(both[1] or 0)


def hub_pairs(current: DataFrame, turn: int, percent: int) -> DataFrame:
    """For each class the hub of another component with which it shares most n-grams.

    Only hubs that share as many as a partner must are taken; other pairs can wait.
    """
    # The first hubs are the classes with the smallest part of n-grams of their own, which
    # lie in the middle of their groups; later ones are chosen by chance.
    middle = (1 - F.col("most") / F.col("n")) if turn == 0 else F.lit(0.0)
    rank = F.struct(middle.alias("m"), F.xxhash64("node", F.lit(turn)).alias("h"))
    hubs = current.groupBy("token").agg(F.min(F.struct(rank.alias("r"), "node", "n", "root", "need", "most", "end")).alias("hub"))
    named = current.join(stored(hubs, "hubs"), "token").where("hub.root <> root")
    near = named.where(could_link(percent, "n", "hub.n", "most", "hub.most", "end", "hub.end"))
    shared = near.groupBy("node", F.col("hub.node").alias("other")).agg(
        F.count(F.lit(1)).alias("c"), F.first(F.least("need", "hub.need")).alias("need")
    )
    best = shared.where("c >= need").groupBy("node").agg(F.max(F.struct("c", "other")).alias("best"))
    pair = best.select("node", F.col("best.other").alias("other"))
    return pair.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def open_pairs(current: DataFrame, percent: int) -> DataFrame:
    """Every pair of different components that shares as many n-grams as its prefixes ask.

    A pair meets at each n-gram it shares and is made at the smallest alone, so that no
    row is made for pairs that share too few.
    """
    lists = current.groupBy("node").agg(F.sort_array(F.collect_list("token")).alias("tokens"))
    held = stored(current.join(stored(lists, "open-lists"), "node"), "open-lists")
    names = ("n", "need", "root", "most", "end", "tokens")
    side = lambda node, tail: held.select("token", F.col("node").alias(node), *[F.col(c).alias(c + tail) for c in names])
    shared = F.array_intersect("tokens_a", "tokens_b")
    met = side("a", "_a").hint("merge").join(
        side("b", "_b").withColumnRenamed("token", "same"),
        (F.col("token") == F.col("same"))
        & (F.col("a") < F.col("b"))
        & (F.col("root_a") != F.col("root_b"))
        & could_link(percent, "n_a", "n_b", "most_a", "most_b", "end_a", "end_b")
        & (F.array_min(shared) == F.col("token"))
        & (F.size(shared) >= least_shared(percent)),
    )
    return met.select("a", "b")


def one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """The rows of ``docs`` with one document of each component, the first by id.

    Rows without a word all stay. Of repeated rows one stays.
    """
    found = near_duplicates(docs, doc_id, text, width, percent).where("n_shingles > 0")
    first = found.where(F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("key") == F.col("first_key")))
    named = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    own, hashed = free_name(docs, "_id"), free_name(docs, "_key")
    keepers = first.select(named(F.col("doc_id")).alias(own), F.col("key").alias(hashed)).distinct()
    whole = quoted(text).cast("string")
    wordy = F.coalesce(F.length(F.translate(whole, "\x20\x09\x0a\x0b\x0c\x0d", "")) > 0, F.lit(False))
    marked = docs.withColumns({own: named(quoted(doc_id).cast("long")), hashed: F.xxhash64(whole)})
    kept = marked.where(wordy).join(stored(keepers, "keepers"), [own, hashed], "left_semi")
    columns = [quoted(c) for c in docs.columns]
    single = kept.dropDuplicates([own, hashed]).select(*columns)
    return single.unionByName(docs.where(~wordy).select(*columns))
