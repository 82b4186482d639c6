"""Exact top-k by inner product with Fagin's threshold algorithm.

Vectors are packed into blocks, each with one list of its rows per dimension, sorted by
that dimension. A query goes down the lists of all its dimensions at once, from the top
for positive components and from the bottom for negative ones, and scores each row that
it meets in full. Rows not met yet cannot score more than the bound, the sum over the
dimensions of the query's component times the value reached. It stops when the bound is
below its kth score: an equal bound could still hide a row with a smaller id.

Queries are packed into blocks too, and every pair of blocks is searched in a task of
its own; a query's results of all blocks are merged by score, then id. A block holds at
most ``BLOCK`` rows, so memory does not grow with the table.

Components become ``floor(scale * x)`` as doubles; scores are exact integers while they
are below 2 ** 53. Rows with a null id, a null vector, or a null or non-finite component
take no part, and vectors only meet vectors of their length. A
query never meets rows of its own id. Of rows that share a query's id the least vector
asks; as candidates all rows count. An empty table has no results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexweave.functions.types import quoted
from lexweave.llm.common import stored

BLOCK = 4096  # candidates of a block
QUERY_BLOCK = 1024
DEEPER = 32  # entries of each list that are read before the bound is tested again


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & F.forall(vector, finite)


def packed(rows: DataFrame, size: int, lists: bool) -> DataFrame:
    """Blocks of at most ``size`` rows of one length: ids, components and sorted lists as bytes."""

    def block(ids: list[int], vectors: list[np.ndarray]) -> dict[str, object]:
        values = np.stack(vectors) if len(vectors[0]) else np.zeros((len(ids), 0))
        order = np.argsort(-values, axis=0, kind="stable").T.astype(np.int16 if size < 1 << 15 else np.int32)
        return {
            "dims": values.shape[1],
            "ids": np.array(ids, np.int64).tobytes(),
            "data": values.tobytes(),
            "lists": np.ascontiguousarray(order).tobytes() if lists else b"",
        }

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[int], list[np.ndarray]]] = {}
        schema = pa.schema([("dims", pa.int32()), ("ids", pa.binary()), ("data", pa.binary()), ("lists", pa.binary())])
        for batch in batches:
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = vector.values.to_numpy(zero_copy_only=False)
                ids, vectors = held.setdefault(len(own), ([], []))
                ids.append(vec_id)
                vectors.append(own)
                if len(ids) == size:
                    yield pa.RecordBatch.from_pylist([block(*held.pop(len(own)))], schema)
        for ids, vectors in held.values():
            yield pa.RecordBatch.from_pylist([block(ids, vectors)], schema)

    return rows.mapInArrow(each, "dims int, ids binary, data binary, lists binary")


def threshold_search(
    query: np.ndarray, own: int, ids: np.ndarray, data: np.ndarray, lists: np.ndarray, k: int
) -> tuple[list[int], list[int]]:
    """Ids and scores of the best ``k`` rows of a block, best first, ties to the smaller id."""
    size = len(ids)
    used = np.flatnonzero(query)
    down = query[used] > 0
    met = np.zeros(size, bool)
    best_ids, best = np.empty(0, np.int64), np.empty(0)
    at = 0
    while at < size:
        end = min(size, at + DEEPER) if len(used) else size
        if len(used):
            found = np.zeros(size, bool)
            found[lists[used[down], at:end].ravel()] = True
            found[lists[used[~down], size - end : size - at].ravel()] = True
            fresh = np.flatnonzero(found & ~met)
        else:
            fresh = np.arange(size)
        met[fresh] = True
        fresh = fresh[ids[fresh] != own]
        scores = data[fresh] @ query
        if len(best) == k:
            better = scores >= best[-1]
            fresh, scores = fresh[better], scores[better]
        all_ids, all_scores = np.concatenate([best_ids, ids[fresh]]), np.concatenate([best, scores])
        keep = np.lexsort((all_ids, -all_scores))[:k]
        best_ids, best = all_ids[keep], all_scores[keep]
        at = end
        if at < size and len(best) == k:
            reached = np.where(down, lists[used, at - 1], lists[used, size - at])
            if float(query[used] @ data[reached, used]) < best[-1]:
                break
    return best_ids.tolist(), [int(x) for x in best]


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: float = 256.0,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id`` and ``score`` of each query's best rows."""
    number = lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("double")
    rows = (
        vectors.withColumn("_query", F.coalesce(is_query, F.lit(False)))
        .select(quoted(vec_id).cast("long").alias("vec_id"), quoted(vector).alias("v"), "_query")
        .where(F.col("vec_id").isNotNull() & usable(F.col("v")))
        .select("vec_id", F.transform("v", number).alias("v"), "_query")
    )
    candidates = stored(packed(rows.select("vec_id", "v"), BLOCK, True), "candidates")
    asked = rows.where("_query").groupBy("vec_id").agg(F.min("v").alias("v"))
    queries = stored(packed(asked, QUERY_BLOCK, False), "queries")
    named = queries.select(*[F.col(c).alias("q_" + c) for c in ("dims", "ids", "data")])
    # A stated query set against all rows, block by block. Lengths are compared in the
    # task: as a join condition they would send all blocks of the one usual length to one.
    met = candidates.crossJoin(named)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (r for i in range(batch.num_rows) for r in batch.slice(i, 1).to_pylist()):
                if row["dims"] != row["q_dims"]:
                    continue
                dims, ids = row["dims"], np.frombuffer(row["ids"], np.int64)
                data = np.frombuffer(row["data"]).reshape(len(ids), dims)
                lists = np.frombuffer(row["lists"], np.int16).reshape(dims, len(ids))
                asked_ids = np.frombuffer(row["q_ids"], np.int64)
                asked_data = np.frombuffer(row["q_data"]).reshape(len(asked_ids), dims)
                out: tuple[list[int], list[int], list[int]] = ([], [], [])
                for own, query in zip(asked_ids.tolist(), asked_data, strict=True):
                    found, scores = threshold_search(query, own, ids, data, lists, k)
                    out[0].extend([own] * len(found))
                    out[1].extend(found)
                    out[2].extend(scores)
                columns = [pa.array(c, pa.int64()) for c in out]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    best = met.mapInArrow(search, "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    merged = best.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return merged.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
