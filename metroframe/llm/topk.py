"""Exact top-k inner products by no-random-access aggregation.

Candidates are dealt into blocks of about ``block_rows``. For a block, every
coordinate has its list of candidates in the order of that coordinate. A
query reads all its lists from the good end, in steps of growing depth. What
it has read of a candidate gives a lower bound (unread coordinates at their
list's worst value) and an upper bound (unread ones at the last value read).
When no candidate outside those seen can still reach the k-th best lower
bound and few of those seen can, reading stops, and only then these get their
final scores.

Queries are dealt into blocks too; a task handles one pair of blocks, so memory
is bounded by the two block sizes, and leaves k rows per query. Every query first
meets one block of candidates. Its k-th best score there is the bound to beat in
all others, where reading stops as soon as nobody can.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroframe.llm.common import named, stored

#: bounds are exact in doubles below this
EXACT = 2.0**52
#: reading goes on while more than one in so many candidates may still be among the best
FEW = 16


class Lists:
    """The sorted lists of one block of candidates.

    List i holds coordinate i from its largest value on, list dims + i from its
    smallest. A query reads list i where its own coordinate is positive and
    list dims + i where it is negative, so with the query split into those two
    parts the bounds of all queries at one depth are matrix products."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.vectors = vectors
        n = len(vectors)
        down = np.argsort(-vectors, axis=0, kind="stable")
        order = np.concatenate([down, down[::-1]], axis=1)
        self.both = np.concatenate([vectors, vectors], axis=1).astype(np.float64)
        self.value = np.take_along_axis(self.both, order, 0)
        self.place = np.empty(order.shape, np.int32)  # of each candidate in each list
        np.put_along_axis(self.place, order, np.arange(n, dtype=np.int32)[:, None], 0)
        self.depths = sorted({min(n, max(1, n * part // 32)) for part in (5, 8, 12, 16, 24, 32)})
        self.largest = float(np.abs(vectors).max(initial=0))
        self.read_to: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def gains(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """What the entries read so far give over the last value read, and over
        the worst value of their list (0 for entries not read)."""
        if depth not in self.read_to:
            read = self.place < depth
            self.read_to[depth] = (np.where(read, self.both - self.value[depth - 1], 0.0), np.where(read, self.both - self.value[-1], 0.0))
        return self.read_to[depth]

    def top(self, queries: np.ndarray, k: int, reach: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query (candidate, score) of all that may be among its k
        best and have a score of at least ``reach``, and at times more."""
        n, dims = self.vectors.shape
        if self.largest * float(np.abs(queries).max(initial=0)) * dims >= EXACT:
            return [(np.arange(n), self.vectors @ q) for q in queries]
        out: list = [None] * len(queries)
        parts = np.concatenate([np.maximum(queries, 0), np.minimum(queries, 0)], axis=1).astype(np.float64)
        reach = reach.copy()
        left = np.arange(len(queries))
        for depth in self.depths:
            over_last, over_worst = self.gains(depth)
            outside = parts[left] @ self.value[depth - 1]  # no candidate that no list has shown can have more
            upper = outside[:, None] + parts[left] @ over_last.T
            if n > k:
                lower = (parts[left] @ self.value[-1])[:, None] + parts[left] @ over_worst.T
                reach[left] = np.maximum(reach[left], np.partition(lower, n - k, axis=1)[:, n - k])
            open_ = upper >= reach[left][:, None]  # an unseen candidate's upper bound is `outside`
            stop = (outside < reach[left]) & (open_.sum(axis=1) <= n // FEW) | (depth == n)
            for at in np.flatnonzero(stop):
                rows = np.flatnonzero(open_[at])
                out[left[at]] = rows, self.vectors[rows] @ queries[left[at]]
            left = left[~stop]
            if not len(left):
                break
        return out


def finite(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def top_k(df: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding",
          block_rows: int = 1024, query_rows: int = 1024) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that ``is_query`` (a
    condition on ``id_col``) marks, the ``k`` other rows of the largest inner
    product of the vectors floor(scale * x), ties to the smaller id.

    Rows with a null id, and vectors that are null, empty or hold null or
    non-finite components, take no part; vectors of different lengths do not
    compare. Rows equal in id and vector count once; a row is never its own
    result, nor is another row of the same id. Fewer candidates give fewer
    rows; an empty table none. Other columns are not read. Scores are long
    integers; components beyond 2^31 / scale are not meant."""
    rows = df.select(named(id_col).alias("vec_id"), named(vector_col).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & finite(F.col("vector")) & (F.size("vector") > 0))
    whole = F.transform("vector", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    rows = stored(rows.select("vec_id", "asks", whole.alias("vector")).distinct(), "top-k-rows")
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).first()
    blocks, query_blocks = max(1, -(-counts.n // block_rows)), max(1, -(-counts.q // query_rows))
    key = F.xxhash64("vec_id", "vector")
    rows = rows.withColumn("row_key", key)

    def numbers(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    candidates = rows.select(F.pmod("row_key", F.lit(blocks)).cast("int").alias("block"), numbers(query_blocks).alias("query_block"), "vec_id", "vector")
    asking = rows.where("asks").select(F.pmod(F.xxhash64("row_key"), F.lit(query_blocks)).cast("int").alias("query_block"), "vec_id", "vector", "row_key")
    is_first = F.col("block") == F.pmod("query_block", F.lit(blocks))
    id_type = rows.schema["vec_id"].dataType.simpleString()

    def matrices(t: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        lists = t.column("vector").combine_chunks()
        flat, size = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
        ends = np.cumsum(size)
        for dims in np.unique(size):
            at = np.flatnonzero(size == dims)
            yield at, flat[(ends[at] - dims)[:, None] + np.arange(dims)]

    def search(asked: pa.Table, offered: pa.Table) -> pa.Table:
        of_length = {m.shape[1]: (at, Lists(m)) for at, m in matrices(offered)} if asked.num_rows else {}
        bounds = asked.column("bound").cast(pa.float64()).fill_null(-np.inf).to_numpy()
        asked_ids, offered_ids = asked.column("vec_id").to_numpy(), offered.column("vec_id").to_numpy()
        found = []
        for at, matrix in matrices(asked):
            if matrix.shape[1] not in of_length:
                continue
            place, lists = of_length[matrix.shape[1]]
            ids = offered_ids[place]
            by_id = np.argsort(ids, kind="stable")
            left, right = (np.searchsorted(ids[by_id], asked_ids[at], side=s) for s in ("left", "right"))
            own = int((right - left).max())  # rows of a query's own id, left out below
            for start in range(0, len(at), 128):
                some = at[start:start + 128]
                for row, (who, score) in zip(some.tolist(), lists.top(matrix[start:start + 128], k + own, bounds[some])):
                    other = ids[who] != asked_ids[row]
                    who, score = who[other], score[other]
                    if len(who) > k:
                        near = score >= np.partition(score, len(score) - k)[len(score) - k]
                        who, score = who[near], score[near]
                    first = np.lexsort((ids[who], -score))[:k]
                    found.append((np.full(len(first), row), place[who[first]], score[first]))
        q, c, s = (np.concatenate(x) if x else np.empty(0, np.int64) for x in (zip(*found) if found else ((), (), ())))
        return pa.table({"query_id": asked.column("vec_id").take(pa.array(q, pa.int64())), "query_key": asked.column("row_key").take(pa.array(q, pa.int64())),
                         "vec_id": offered.column("vec_id").take(pa.array(c, pa.int64())), "score": pa.array(s, pa.int64())})

    def meet(queries: DataFrame, candidates: DataFrame) -> DataFrame:
        queries, candidates = (x.select(*(F.col(c).alias(c) for c in x.columns)) for x in (queries, candidates))
        return (queries.groupBy("block", "query_block").cogroup(candidates.groupBy("block", "query_block"))
                .applyInArrow(search, f"query_id {id_type}, query_key long, vec_id {id_type}, score long"))

    everywhere = asking.withColumn("block", numbers(blocks))
    near = meet(everywhere.where(is_first).withColumn("bound", F.lit(None).cast("long")), candidates.where(is_first))
    if blocks > 1:
        near = stored(near, "top-k-first")
        bound = near.groupBy("query_id", "query_key").agg(F.min("score").alias("bound"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
        bounded = asking.join(bound, (F.col("vec_id") == F.col("query_id")) & (F.col("row_key") == F.col("query_key")), "left")
        others = bounded.select("query_block", "vec_id", "vector", "row_key", "bound", numbers(blocks).alias("block")).where(~is_first)
        near = near.unionByName(meet(others, candidates.where(~is_first)))
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return (near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
