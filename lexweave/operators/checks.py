"""Constraint checks against the declared warehouse.

Every check returns ``table_name, check, column_name, violations`` rows, or the
offending keys with their row counts. Keys are counted before they are compared,
so a value that fills much of a table is shuffled as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.config.warehouse import ForeignKey, WarehouseTable, warehouse_table
from lexweave.functions.types import quoted


def _column_name(df: DataFrame, name: str) -> str | None:
    return {c.lower(): c for c in df.columns}.get(name.lower())


def conform(
    df: DataFrame, table: WarehouseTable, renames: dict[str, str] | None = None
) -> DataFrame:
    """The declared columns in order and type; absent ones are typed nulls.

    Ids are 64 bits wide whatever width is declared: sources count beyond 2^31. What a
    cast cannot keep is counted by ``check_values`` and listed by ``rejected``.
    """
    df = _renamed(df, renames)
    out = []
    for field in table.schema().fields:
        kind = _kind(field)
        source = _column_name(df, field.name)
        if source is None:
            out.append(F.lit(None).cast(kind).alias(field.name))
            continue
        column = quoted(source).try_cast(kind)
        have = df.schema[source].dataType
        if isinstance(field.dataType, T.DecimalType) and isinstance(have, T.NumericType):
            # Failing casts are slow, so values known to fail are not tried.
            column = F.when(~_out_of_range(quoted(source), have, field.dataType), column)
        out.append(column.alias(field.name))
    return df.select(*out)


def _renamed(df: DataFrame, renames: dict[str, str] | None) -> DataFrame:
    for old, new in (renames or {}).items():
        df = df.withColumnRenamed(old, new)
    return df


def _kind(field: T.StructField) -> str:
    """The type a declared column is stored as."""
    if isinstance(field.dataType, (T.VarcharType, T.CharType)):
        return "string"
    if isinstance(field.dataType, T.IntegerType) and field.name.lower().endswith("id"):
        return "bigint"
    return field.dataType.simpleString()


def _cast_tests(df: DataFrame, table: WarehouseTable) -> dict[str, Column]:
    """For each column that has another type than declared: whether its cast loses a value."""
    tests = {}
    for field in table.schema().fields:
        source = _column_name(df, field.name)
        kind = _kind(field)
        if source is None or kind == "string" or isinstance(field.dataType, T.DecimalType):
            continue
        if df.schema[source].dataType.simpleString() != kind:
            column = quoted(source)
            tests[field.name] = column.isNotNull() & column.try_cast(kind).isNull()
    return tests


def rejected(
    df: DataFrame, table: WarehouseTable, renames: dict[str, str] | None = None
) -> DataFrame:
    """Rows with a value that the declared type cannot hold, with ``bad_columns``."""
    df = _renamed(df, renames)
    tests = _cast_tests(df, table)
    for field in table.schema().fields:
        source = _column_name(df, field.name)
        if source is not None and isinstance(field.dataType, T.DecimalType):
            tests[field.name] = _out_of_range(quoted(source), df.schema[source].dataType, field.dataType)
    named = [F.when(bad, F.lit(name)) for name, bad in tests.items()]
    bad = F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")
    return df.withColumn("bad_columns", bad).where(F.size("bad_columns") > 0)


def _violation_rows(df: DataFrame, table: str, tests: list[tuple[str, str, Column]]) -> DataFrame:
    """One pass: each test is a condition that counts offending rows."""
    spark = df.sparkSession
    if not tests:
        return spark.createDataFrame(
            [], "table_name string, check string, column_name string, violations bigint"
        )
    counts = df.agg(
        *[F.count_if(bad).alias(f"v{i}") for i, (_, _, bad) in enumerate(tests)]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(check).alias("check"),
                F.lit(column).alias("column_name"),
                F.col(f"v{i}").alias("violations"),
            )
            for i, (check, column, _) in enumerate(tests)
        ]
    )
    return counts.select(F.inline(rows))


def _out_of_range(column: Column, have: T.DataType, want: T.DecimalType) -> Column:
    """Whether a value does not fit the decimal once rounded to its scale."""
    if not isinstance(have, T.NumericType):
        return column.try_cast(want.simpleString()).isNull() & column.isNotNull()
    # A plain comparison: casting each value to find the few that fail is far slower.
    limit = Decimal(10) ** (want.precision - want.scale) - Decimal(5).scaleb(-want.scale - 1)
    exact = isinstance(have, (T.DecimalType, T.IntegralType))
    return F.abs(column) >= (F.lit(limit) if exact else F.lit(float(limit)))


def _value_tests(df: DataFrame, table: WarehouseTable) -> list[tuple[str, str, Column]]:
    """(check, column, condition) of NOT NULL, text length, decimal range and lost casts."""
    tests = [("cast", name, bad) for name, bad in _cast_tests(df, table).items()]
    for field in table.schema().fields:
        source = _column_name(df, field.name)
        column = F.lit(None) if source is None else quoted(source)
        if not field.nullable:
            tests.append(("not_null", field.name, column.isNull()))
        if source is None:
            continue
        if isinstance(field.dataType, (T.VarcharType, T.CharType)):
            long = F.length(column.cast("string")) > field.dataType.length
            tests.append(("length", field.name, long))
        elif isinstance(field.dataType, T.DecimalType):
            lost = _out_of_range(column, df.schema[source].dataType, field.dataType)
            tests.append(("decimal", field.name, lost))
    return tests


def check_values(df: DataFrame, table: WarehouseTable, kinds: Sequence[str] = ()) -> DataFrame:
    """NOT NULL, text length, decimal range and lost casts of all columns, in one aggregate."""
    wanted = [t for t in _value_tests(df, table) if not kinds or t[0] in kinds]
    return _violation_rows(df, table.name, wanted)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that more than one row has. Rows with a null key part are not compared."""
    return (
        df.dropna(subset=list(keys)).groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
    )


def orphans(child: DataFrame, key: ForeignKey, parent: DataFrame) -> DataFrame:
    """Referenced values that the parent lacks, with the rows that refer to them."""
    used = (
        child.dropna(subset=list(key.columns)).groupBy(*key.columns)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    renamed = parent.select(
        *[F.col(p).alias(c) for c, p in zip(key.columns, key.parent_columns)]
    )
    return used.join(renamed, list(key.columns), "left_anti")


@dataclass(frozen=True)
class Rule:
    """One line of a report: a condition on rows, a key that must be unique, or a reference."""

    table: str
    check: str
    column_name: str


def check_table(
    df: DataFrame, table: WarehouseTable, parents: dict[str, DataFrame] | None = None
) -> DataFrame:
    """All declared constraints of one table as violation counts.

    References are checked where ``parents`` has the table they name.
    """
    return _report({table.name: df}, [table], parents or {})


def check_warehouse(frames: dict[str, DataFrame]) -> DataFrame:
    """Every declared constraint of the given tables, references among them included."""
    return _report(frames, [warehouse_table(name) for name in frames], frames)


def _report(frames: dict[str, DataFrame], tables: list[WarehouseTable], parents: dict[str, DataFrame]) -> DataFrame:
    """One pass over every table and one shuffle for all constraints.

    Each row becomes an entry (rule, key) for every condition it violates, key it has, and
    reference it makes or answers. Entries are counted in their tasks before they are
    shuffled, so neither a hot key nor a condition that all rows violate reaches one task whole.
    """
    rules: list[Rule] = []
    entries: dict[str, list[Column]] = {}
    sources = {**parents, **frames}

    def add(rule: Rule) -> int:
        rules.append(rule)
        return len(rules) - 1

    def entry(number: int, when: Column, key: list[Column], known: bool = False) -> Column:
        parts = F.array(*key) if key else F.array().cast("array<string>")
        made = F.struct(F.lit(number).alias("rule"), parts.alias("key"), F.lit(known).alias("known"))
        return F.when(when, made)

    def whole(columns: list[Column]) -> Column:
        return reduce(lambda a, b: a & b, [c.isNotNull() for c in columns])

    for table in tables:
        df, own = frames[table.name], entries.setdefault(table.name, [])
        for check, name, bad in _value_tests(df, table):
            own.append(entry(add(Rule(table.name, check, name)), bad, []))
        uniques = [("primary_key", table.primary_key)] if table.primary_key else []
        for check, columns in [*uniques, *[("unique", (c,)) for c in table.unique]]:
            key = [_key_text(df, c, df.schema[_column_name(df, c)].dataType) for c in columns]
            own.append(entry(add(Rule(table.name, check, ",".join(columns))), whole(key), key))
        for ref in table.references:
            if ref.parent not in parents:
                continue
            other = sources[ref.parent]
            pairs = [
                (c, p, other.schema[_column_name(other, p)].dataType, df.schema[_column_name(df, c)].dataType)
                for c, p in zip(ref.columns, ref.parent_columns, strict=True)
            ]
            number = add(Rule(table.name, "foreign_key", ",".join(ref.columns)))
            refers = [_key_text(df, c, have, want) for c, _, want, have in pairs]
            own.append(entry(number, whole(refers), refers))
            answers = [_key_text(other, p, want, have) for _, p, want, have in pairs]
            entries.setdefault(ref.parent, []).append(entry(number, whole(answers), answers, True))

    spark = next(iter(frames.values())).sparkSession
    if not rules:
        return spark.createDataFrame([], "table_name string, check string, column_name string, violations bigint")
    # Not explode: Spark would compute the entries once more, as a filter below it.
    fanned = [
        sources[name].select(F.inline_outer(F.array_compact(F.array(*own)))).where("rule IS NOT NULL")
        for name, own in entries.items() if own
    ]
    counted = reduce(DataFrame.unionByName, fanned).groupBy("rule", "key").agg(
        F.count_if(~F.col("known")).alias("n"), F.max("known").alias("known")
    )
    check = F.element_at(F.array(*[F.lit(r.check) for r in rules]), F.col("rule") + 1)
    fine = F.when(check.isin("primary_key", "unique"), F.col("n") < 2).when(check == "foreign_key", F.col("known"))
    sums = counted.groupBy("rule").agg(F.sum(F.when(F.coalesce(fine, F.lit(False)), 0).otherwise(F.col("n"))).alias("bad"))
    lines = F.array(*[
        F.struct(F.lit(i).alias("line"), *[F.lit(v).alias(n) for n, v in zip(("table_name", "check", "column_name"),
                 (r.table, r.check, r.column_name), strict=True)])
        for i, r in enumerate(rules)
    ])
    every = spark.range(1).select(F.inline(lines))
    joined = every.join(sums, F.col("line") == F.col("rule"), "left")
    return joined.select("table_name", "check", "column_name", F.coalesce("bad", F.lit(0)).cast("bigint").alias("violations"))


def _key_text(df: DataFrame, name: str, *kinds: T.DataType) -> Column:
    """A key part as text, the same for equal values of all the types it is compared among."""
    column = quoted(_column_name(df, name))
    if all(isinstance(k, T.IntegralType) for k in kinds):
        return column.cast("bigint").cast("string")
    if all(isinstance(k, T.NumericType) for k in kinds) and len({k.simpleString() for k in kinds}) > 1:
        return (column.cast("double") + F.lit(0.0)).cast("string")
    if all(isinstance(k, (T.DoubleType, T.FloatType)) for k in kinds):
        return (column + F.lit(0.0)).cast("string")  # -0.0 and 0.0 are equal
    return column.cast("string")


def column_drift(
    built: T.StructType, table: WarehouseTable, renames: dict[str, str] | None = None
) -> list[tuple[str, str, str]]:
    """(column, built type, declared type) wherever a builder and the declaration differ."""
    names = {f.name: (renames or {}).get(f.name, f.name) for f in built.fields}
    have = {names[f.name].lower(): (f.name, f.dataType.simpleString()) for f in built.fields}
    want = {f.name.lower(): (f.name, f.dataType.simpleString()) for f in table.schema().fields}
    drift = []
    for key in dict.fromkeys([*want, *have]):
        name = (want.get(key) or have[key])[0]
        pair = (have.get(key, ("", "absent"))[1], want.get(key, ("", "undeclared"))[1])
        if pair[0] != pair[1]:
            drift.append((name, *pair))
    return drift


def profile(df: DataFrame, name: str) -> DataFrame:
    """Row count and null count per column, in one pass."""
    rows = F.count(F.lit(1))
    nulls = [F.count_if(quoted(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    counts = df.agg(rows.alias("n_rows"), *nulls)
    columns = F.array(
        *[
            F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("n_nulls"))
            for i, c in enumerate(df.columns)
        ]
    )
    return counts.select(
        F.lit(name).alias("table_name"), "n_rows", F.inline(columns)
    )
