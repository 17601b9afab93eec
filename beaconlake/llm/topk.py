"""Exact top-k by inner product: columnar branch and bound.

Vectors are whole numbers floor(scale * x). They are stored in blocks, a row of memory per dimension, longest vectors
first. Scores of a block of queries grow by `DIMS` dimensions at a time; what is missing is at most the product of the
lengths of both remainders. Candidates that can reach the k-th score of no query of the block are squeezed out before
the next dimensions.

Vectors that are null or hold a null or non-finite component take no part; an empty vector scores 0 everywhere. Shorter
vectors count as padded with zeros. Ties go to the smaller id, null ids last; a repeated id is a candidate like any
other, only the query's own row is left out. No queries give no rows.

Scale: queries in blocks meet candidates in blocks; a task holds one of each, and leaves at most k rows per query and
block. Blocks hold a bounded number of bytes. The sums are exact: 32-bit floats while they are whole numbers below
2^24, else 64-bit floats below 2^52, else Python's integers; a score beyond 64 bits is an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from beaconlake.session import staged

BLOCK_BYTES = 8 << 20
QUERY_ROWS = 512
GROUP = 32  # queries that share a list of candidates
DIMS = 16
NO_ID = np.iinfo(np.int64).max
BLOCK = "block long, dims int, ids binary, rows binary, numbers binary"
FOUND = "query_row long, query_id long, vec_id long, score long"


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    x = F.col(vector_col)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))))
    numbers = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long"))
    rows = vectors.where(x.isNotNull() & finite)
    return rows.select(F.col(id_col).cast("long").alias("id"), numbers.alias("numbers"), F.monotonically_increasing_id().alias("row"))


def _blocks(rows: DataFrame, most_rows: int | None) -> DataFrame:
    """Consecutive rows of a partition as blocks; a block is named after its first row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int | None, int, list[int]]] = []
        dims = 0

        def block() -> pa.RecordBatch:
            x = np.zeros((dims, len(held)), np.int64)
            for j, (_, _, numbers) in enumerate(held):
                x[: len(numbers), j] = numbers
            longest = np.argsort(-(x.astype(np.float64) ** 2).sum(0), kind="stable")
            ids = np.array([NO_ID if i is None else i for i, _, _ in held], np.int64)[longest]
            own = np.array([r for _, r, _ in held], np.int64)[longest]
            columns = [[int(own.min())], [dims], [ids.tobytes()], [own.tobytes()], [x[:, longest].tobytes()]]
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)], names=["block", "dims", "ids", "rows", "numbers"])

        for batch in batches:
            for i, r, numbers in zip(batch["id"].to_pylist(), batch["row"].to_pylist(), batch["numbers"].to_pylist()):
                wide = max(dims, len(numbers))
                full = len(held) >= most_rows if most_rows else (len(held) + 1) * wide * 8 > BLOCK_BYTES
                if held and full:
                    yield block()
                    held, dims = [], 0
                held.append((i, r, numbers))
                dims = max(dims, len(numbers))
        if held:
            yield block()

    return rows.mapInArrow(work, BLOCK)


def _suffix_lengths(x: np.ndarray) -> np.ndarray:
    """Length of what is left of each column from every DIMS-th dimension on."""
    squares = x.astype(np.float64) ** 2
    return np.array([np.sqrt(squares[at:].sum(0)) for at in range(0, len(x) + DIMS, DIMS)])


def best(q: np.ndarray, own: np.ndarray, x: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, positions of its k best columns of x, their scores), by falling score and rising id."""
    dims = max(len(q), len(x))
    q = np.pad(q, ((0, dims - len(q)), (0, 0)))
    x = np.pad(x, ((0, dims - len(x)), (0, 0)))
    most = float(np.sqrt((q.astype(np.float64) ** 2).sum(0).max(initial=0)) * np.sqrt((x.astype(np.float64) ** 2).sum(0).max(initial=0)))
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**52 else object
    q_left, x_left = _suffix_lengths(q), _suffix_lengths(x)
    q, x = q.astype(kind), x.astype(kind)
    for low in range(0, q.shape[1], GROUP):
        some = slice(low, min(low + GROUP, q.shape[1]))
        # The longest vectors give a first bound on the k-th score; one more than k, as the query may be among them.
        head = (q[:, some].T @ x[:, : 8 * k + 1]).astype(np.float64)
        bound = np.full(len(head), -np.inf) if head.shape[1] <= k else np.partition(head, -k - 1, axis=1)[:, -k - 1]
        alive = np.arange(x.shape[1])
        sums = np.zeros((len(head), len(alive)), kind)
        for step, at in enumerate(range(0, dims, DIMS)):
            sums = sums + q[at : at + DIMS, some].T @ x[at : at + DIMS, alive]
            if at + DIMS >= dims:
                break
            reach = sums + np.outer(q_left[step + 1, some], x_left[step + 1, alive])
            kept = (reach + (1e-6 * np.abs(reach) + 1) >= bound[:, None]).any(0)
            if kept.sum() < 0.9 * len(alive):
                alive, sums = alive[kept], sums[:, kept]
        for j in range(len(head)):
            score = sums[j]
            others = np.flatnonzero(rows[alive] != own[low + j])
            if len(others) > k:
                least = np.partition(score[others], -k)[-k]
                others = others[score[others] >= least]
            order = np.lexsort((rows[alive[others]], ids[alive[others]], -score[others]))[:k]
            yield low + j, alive[others[order]], score[others[order]]


def top_k(
    vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 20, scale: int = 64,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows of each query; `is_query` tells queries by their id."""
    rows = staged(whole_vectors(vectors, id_col, vector_col, scale), "vectors")
    candidates = _blocks(rows, None)
    asked = staged(_blocks(rows.where(is_query(F.col("id"))), QUERY_ROWS), "query-blocks")
    # Every candidate block visits each slot, and a query block lies in one.
    slots = max(1, asked.count())
    slot = F.pmod(F.xxhash64("block"), F.lit(slots))
    asked = asked.select(slot.alias("slot"), *[F.col(c).alias("q_" + c) for c in asked.columns])
    visits = candidates.withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))))
    return _ranked(visits.join(asked, "slot"), k)


def _ranked(pairs: DataFrame, k: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, rows = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["rows"], np.int64)
                q_ids, q_rows = np.frombuffer(row["q_ids"], np.int64), np.frombuffer(row["q_rows"], np.int64)
                x = np.frombuffer(row["numbers"], np.int64).reshape(row["dims"], len(ids))
                q = np.frombuffer(row["q_numbers"], np.int64).reshape(row["q_dims"], len(q_ids))
                found = [(np.full(len(at), j), at, np.array([int(s) for s in score], np.int64)) for j, at, score in best(q, q_rows, x, ids, rows, k)]
                j, at, score = (np.concatenate(c) for c in zip(*found))
                vec = pa.array(ids[at], mask=ids[at] == NO_ID)
                yield pa.record_batch([pa.array(q_rows[j]), pa.array(q_ids[j]), vec, pa.array(score)], names=["query_row", "query_id", "vec_id", "score"])

    found = pairs.mapInArrow(work, FOUND)
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
