"""Personal data by candidate generation and gradient boosting, in built-in functions.

Four base kinds are exact patterns with checks. High-recall generators propose
further, overlapping spans. A span's format (digits, length, case, separators, dots)
and its neighbouring characters are binned into
small integers. Spans of all documents are counted by their bins, so that training
sees every one of them in at most ``BINS`` rows, the product of the bins. Depth-two
trees are boosted on these counts; a generator's spans count as positive where a base
span covers them, a seed pattern holds or a telling word stands before them. That word is
no feature, so that it can confirm what the trees select. Trees become one expression.
Spans that overlap a base span are not added, so they do not count for a threshold either:
a generator's is the lowest at which its other spans in held-out documents keep the wanted
precision; without one nothing is added.

Places are code points. They come from running sums over the lengths of matches and
of the gaps between them, in blocks, so a text's cost grows with its length. The
patterns match the same text as the plain ones but cannot backtrack without end.

Null texts have no span. Repeated rows get equal spans. Other columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexweave.functions.types import quoted
from lexweave.llm.common import crc_part

LOCAL, LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
# Base kinds in their order: pattern, and a text that every match holds.
BASE = {
    "email": (rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++", "@"),
    "ip": (r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "[0-9]"),
    "card": (r"[0-9](?:[\x20-]?[0-9])++", "[0-9]"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
# Generators of further spans: pattern, text that every match holds, seed of sure positives.
GENERATORS = {
    "number": (r"(?<![0-9])[0-9](?:[\x20().-]{0,2}[0-9]){6,}+", "[0-9]", r"^$"),
    "secret": (r"(?<![A-Za-z0-9_])[A-Za-z0-9_]{16,}+", "[0-9]", r"^AKIA[0-9A-Z]{16}$"),
    "handle": (r"(?<![^\s@])[^\s@]++@[^\s@]++", "@", r"^$"),
}
TELLING = r"(?i)(?:pass(?:word|wd)?|pwd|secret|token|api.?key|tel|phone|call|mail|card|iban|ssn)\W{0,4}$"
KINDS = [*BASE, *GENERATORS]
BLOCK = 256
CONTEXT = 24
FEATURES = {  # bins of each feature
    "digits": 9, "length": 6, "case": 4, "separators": 3, "dots": 3,
    "plus": 2, "before": 4, "after": 4,
}
BINS = len(GENERATORS) * math.prod(FEATURES.values()) * 8  # by label, part and cover


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(lengths: Column) -> Column:
    """Sums of the elements before each element, block by block."""

    def sums(values: Column, amount: Callable[[Column], Column]) -> Column:
        none = F.array().cast("array<int>")
        return F.aggregate(
            values,
            F.struct(F.lit(0).alias("total"), none.alias("all")),
            lambda s, x: F.struct(
                (s["total"] + amount(x)).alias("total"),
                F.concat(s["all"], F.array(s["total"])).alias("all"),
            ),
        )

    def whole(values: Column) -> Column:
        firsts = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / BLOCK).cast("int"))
        blocks = F.transform(
            firsts, lambda b: sums(F.slice(values, b * BLOCK + 1, F.lit(BLOCK)), lambda x: x)
        )
        return bound(blocks, joined)

    def joined(blocks: Column) -> Column:
        offsets = sums(blocks, lambda block: block["total"])["all"]
        shifted = F.zip_with(
            blocks, offsets, lambda block, off: F.transform(block["all"], lambda x: x + off)
        )
        return F.flatten(shifted)

    empty = F.array().cast("array<int>")
    return F.when(F.size(lengths) > 0, bound(lengths, whole)).otherwise(empty)


def with_matches(df: DataFrame, name: str, pattern: str, needs: str) -> DataFrame:
    """Add ``_<name>``: the pattern's matches with place and neighbouring text."""
    gaps, found, at = f"_{name}_gaps", f"_{name}_found", f"_{name}_at"
    holds = F.contains("_text", F.lit(needs)) if len(needs) == 1 else F.col("_text").rlike(needs)
    none = F.array().cast("array<string>")
    cut = df.withColumns({
        gaps: F.when(holds, F.split("_text", pattern, -1)).otherwise(none),
        found: F.when(holds, F.regexp_extract_all("_text", F.lit(pattern), F.lit(0))).otherwise(none),
    })
    steps = F.transform(found, lambda x, i: F.length(x) + F.length(F.get(gaps, i)))
    cut = cut.withColumn(at, F.when(F.size(found) > 0, running(steps)))
    start = lambda i: F.get(at, i) + F.length(F.get(gaps, i))
    spans = F.transform(
        found,
        lambda x, i: F.struct(
            F.lit(KINDS.index(name)).alias("kind"),
            start(i).alias("start"),
            (start(i) + F.length(x)).alias("end"),
            x.alias("text"),
            F.substring(F.get(gaps, i), -CONTEXT, CONTEXT).alias("before"),
            F.substring(F.get(gaps, i + 1), 1, 1).alias("after"),
        ),
    )
    return cut.withColumn(f"_{name}", spans).drop(gaps, found, at)


def only_digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    turned = F.split(F.reverse(digits), "")
    value = lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2))
    values = F.transform(turned, lambda c, i: value(c.cast("int"), i))
    total = F.aggregate(F.filter(values, lambda v: v.isNotNull()), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def passes(kind: str, text: Column) -> Column:
    """The check that a match of a base kind must pass."""
    if kind == "ip":
        parts = F.transform(F.split(text, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
        small = lambda p: (p == "") | ((F.length(p) <= 3) & (F.left(p, F.lit(3)).cast("int") <= 255))
        return F.forall(parts, small)
    number = F.length(only_digits(text))
    if kind == "card":
        return number.between(16, 19) & luhn(F.left(only_digits(text), F.lit(19)))
    if kind == "phone":
        return number.between(8, 15)
    return F.lit(True)


def bins(span: Column) -> dict[str, Column]:
    """Format and context of a span as small integers, in the order of ``FEATURES``."""
    text, number = span["text"], F.length(only_digits(span["text"]))
    steps = lambda value, cuts: sum((F.when(value >= c, 1).otherwise(0) for c in cuts), F.lit(0))
    one = lambda test: F.when(test, 1).otherwise(0)
    side = lambda c: (
        F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike("[A-Za-z0-9]"), 2).otherwise(3)
    )
    count = lambda chars: F.length(F.regexp_replace(text, f"[^{chars}]", ""))
    return {
        "digits": steps(number, (1, 4, 7, 8, 10, 12, 16, 20)),
        "length": steps(F.length(text), (10, 15, 20, 24, 40)),
        "case": one(text.rlike("[A-Z]")) * 2 + one(text.rlike("[a-z]")),
        "separators": steps(count(r"\x20()-"), (1, 3)),
        "dots": steps(count("."), (1, 3)),
        "plus": one(F.right(span["before"], F.lit(1)) == "+"),
        "before": side(F.right(span["before"], F.lit(1))),
        "after": side(span["after"]),
    }


def spans_of(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Base spans that passed and binned candidates of each document, as arrays."""
    whole = F.coalesce(quoted(text).cast("string"), F.lit(""))
    cut = docs.select(quoted(doc_id).alias("doc_id"), whole.alias("_text"))
    for kind, (pattern, needs) in BASE.items():
        cut = with_matches(cut, kind, pattern, needs)
    for kind, (pattern, needs, _) in GENERATORS.items():
        cut = with_matches(cut, kind, pattern, needs)
    place = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))

    def sound(kind: str) -> Column:
        return F.transform(F.filter(f"_{kind}", lambda s: passes(kind, s["text"])), place)

    def candidates(kind: str, seed: str) -> Column:
        def featured(s: Column) -> Column:
            overlap = F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
            return F.struct(
                s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                overlap.alias("covered"),
                s["text"].rlike(seed).alias("seeded"),
                s["before"].rlike(TELLING).alias("telling"),
                *[c.alias(n) for n, c in bins(s).items()],
            )

        return F.transform(F.filter(f"_{kind}", lambda s: s["text"].rlike("[0-9@]")), featured)

    cut = cut.withColumn("base", F.concat(*[sound(kind) for kind in BASE]))
    found = [candidates(kind, seed) for kind, (_, _, seed) in GENERATORS.items()]
    return cut.select("doc_id", "_text", "base", F.concat(*found).alias("candidates"))


@dataclass
class PiiModel:
    """Boosted trees over binned features, and each generator's threshold."""

    trees: list[tuple]
    start: float
    thresholds: dict[int, float]

    def score(self, span: Column) -> Column:
        """Log odds of a span as one expression."""

        def tree(node: tuple) -> Column:
            if len(node) == 1:
                return F.lit(float(node[0]))
            name, cut, low, high = node
            return F.when(span[name] <= cut, tree(low)).otherwise(tree(high))

        return sum((tree(t) for t in self.trees), F.lit(self.start))

    def odds(self, row: dict[str, int]) -> float:
        total = self.start
        for node in self.trees:
            while len(node) > 1:
                node = node[2] if row[node[0]] <= node[1] else node[3]
            total += node[0]
        return total


def boost(rows: Sequence[dict], rounds: int = 25, rate: float = 0.3, ridge: float = 4.0) -> tuple[list[tuple], float]:
    """Depth-two trees on counted rows (features, ``kind``, ``label``, ``n``) by Newton steps."""
    names = [*FEATURES, "kind"]
    total = sum(r["n"] for r in rows)
    positive = sum(r["n"] for r in rows if r["label"])
    start = math.log((positive + 1) / (total - positive + 1))
    odds = [start] * len(rows)
    trees: list[tuple] = []

    def leaf(ids: list[int]) -> tuple:
        g = sum(slopes[i][0] for i in ids)
        h = sum(slopes[i][1] for i in ids)
        return (rate * g / (h + ridge),)

    def split(ids: list[int], depth: int) -> tuple:
        whole_g = sum(slopes[i][0] for i in ids)
        whole_h = sum(slopes[i][1] for i in ids)
        best = (1e-6, None, None)
        for name in names:
            sums: dict[int, list[float]] = {}
            for i in ids:
                s = sums.setdefault(rows[i][name], [0.0, 0.0])
                s[0] += slopes[i][0]
                s[1] += slopes[i][1]
            g = h = 0.0
            for value in sorted(sums)[:-1]:
                g, h = g + sums[value][0], h + sums[value][1]
                gain = g * g / (h + ridge) + (whole_g - g) ** 2 / (whole_h - h + ridge)
                gain -= whole_g**2 / (whole_h + ridge)
                if gain > best[0] + 1e-9:
                    best = (gain, name, value)
        if best[1] is None or not depth:
            return leaf(ids)
        low = [i for i in ids if rows[i][best[1]] <= best[2]]
        high = [i for i in ids if rows[i][best[1]] > best[2]]
        return best[1], best[2], split(low, depth - 1), split(high, depth - 1)

    for _ in range(rounds):
        slopes = []
        for row, now in zip(rows, odds, strict=True):
            chance = 1 / (1 + math.exp(-now))
            slopes.append((row["n"] * (row["label"] - chance), row["n"] * chance * (1 - chance)))
        tree = split(list(range(len(rows))), 2)
        trees.append(tree)
        for i, row in enumerate(rows):
            node = tree
            while len(node) > 1:
                node = node[2] if row[node[0]] <= node[1] else node[3]
            odds[i] += node[0]
    return trees, start


def fit(spans: DataFrame, precision: float = 0.98) -> PiiModel:
    """Boost on the counts of all candidates; thresholds from documents held out by id."""
    # Explode without "outer" would push a copy of the whole expression below as a filter.
    part = (crc_part("doc_id", 5) == 0).alias("held")
    each = spans.select(part, F.explode_outer("candidates").alias("c")).where("c is not null")
    label = (F.col("c.covered") | F.col("c.seeded") | F.col("c.telling")).cast("int")
    names = [*FEATURES, "kind"]
    counted = each.groupBy("held", "c.covered", label.alias("label"), *[F.col(f"c.{n}").alias(n) for n in names])
    rows = [r.asDict() for r in counted.agg(F.count(F.lit(1)).alias("n")).limit(BINS).collect()]
    rows.sort(key=lambda r: sorted(r.items()))
    seen = [r for r in rows if not r["held"]]
    if len({r["label"] for r in seen}) < 2:
        return PiiModel([], 0.0, {})
    model = PiiModel(*boost(seen), {})
    for kind in range(len(BASE), len(KINDS)):
        able = (r for r in rows if r["held"] and r["kind"] == kind and not r["covered"])
        scored = sorted(((model.odds(r), r) for r in able), key=lambda x: -x[0])
        right = taken = 0
        for place, (odds, row) in enumerate(scored):
            right, taken = right + row["n"] * row["label"], taken + row["n"]
            last = place + 1 == len(scored) or scored[place + 1][0] < odds
            if last and right >= precision * taken:
                model.thresholds[kind] = odds
    return model


def with_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text``, ``base`` and ``added`` spans (kind, start, end), ordered by kind and start."""
    spans = spans_of(docs, doc_id, text)
    model = fit(spans)

    def chosen(c: Column) -> Column:
        limit = F.lit(None).cast("double")
        for kind, least in model.thresholds.items():
            limit = F.when(c["kind"] == kind, F.lit(least - 1e-9)).otherwise(limit)
        return ~c["covered"] & F.coalesce(model.score(c) >= limit, F.lit(False))

    place = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    added = F.transform(F.filter("candidates", chosen), place)
    return spans.select("doc_id", F.col("_text").alias("text"), "base", F.array_sort(added).alias("added"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    each = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    return F.concat_ws(",", F.transform(spans, each))


def redact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and the text with every span replaced by its kind in angle brackets.

    Spans that overlap are replaced together under the kind that starts first.
    """
    found = with_spans(docs, doc_id, text)
    by_start = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    ordered = found.withColumn("_s", F.array_sort(F.transform(F.concat("base", "added"), by_start)))
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, s: Column) -> Column:
        between = F.substring(F.col("text"), state["at"] + 1, s["start"] - state["at"])
        fresh = F.concat(state["out"], F.array(between, F.get(names, s["kind"])))
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(s["start"] >= state["at"], fresh).otherwise(state["out"]).alias("out"),
        )

    folded = ordered.withColumn("_f", F.aggregate("_s", first, step))
    rest = F.substring(F.col("text"), F.col("_f.at") + 1, F.length("text"))
    return folded.select("doc_id", F.concat(F.concat_ws("", "_f.out"), rest).alias("text"))
