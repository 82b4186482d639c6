"""Joins whose left side may hold very many rows of one key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.functions.types import quoted

SALTS = 8
NESTED = (T.StructType, T.ArrayType, T.MapType, T.VariantType)


def spread_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, salts: int = SALTS
) -> DataFrame:
    """Join with a right side of few rows per key, rows of a hot key spread out.

    Each left row falls to one of ``salts`` by its content and each right row is
    there for all of them, so the result is that of the plain join. Needed where
    the right side is an aggregate on the join key: Spark then reuses the
    aggregate's shuffle, and such a join is not split at run time. This one has
    shuffles of its own, so what is still too large is split adaptively.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"rows of the right side are repeated: no {how} join")
    payload = [f for f in left.schema.fields if f.name not in on]
    plain = [quoted(f.name) for f in payload if not isinstance(f.dataType, NESTED)]
    if not payload:
        return left.join(right, list(on), how)
    content = plain or [F.to_json(F.struct(*[quoted(f.name) for f in payload]))]
    spread = left.withColumn("_salt", F.pmod(F.xxhash64(*content), F.lit(salts)).cast("int"))
    copies = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(copies, [*on, "_salt"], how).drop("_salt")
