"""Exact top-k by inner product, by no-random-access aggregation of sorted lists.

Vectors are integers: floor(1024 * x) of each component. Candidates and queries are dealt to
blocks; each task meets one block of candidates and one of queries. There, each dimension is a
list of candidates sorted by component, which a query reads from the top where its own
component is positive and from the bottom where it is negative, a stretch further in each
round. What a candidate's unread components can still contribute lies between the frontier and
the list's end, which bounds its score below and above. A round ends for a query when no
candidate outside the ``k`` best lower bounds, but few, has an upper bound that reaches the
``k``-th lower one; the final scores of those that remain are then resolved.

Blocks of candidates lie in at most ``GROUPS`` groups, and each group gets one copy of the queries.
Both sides are shuffled: copies of the queries are never broadcast, which would bring them to the driver.
Each pair of blocks returns at most ``k`` rows a query, from which a query's best are taken.

Cases: vectors that are null, empty, or hold a null or non-finite component take no part; rows
that repeat an id and a vector count once; shorter vectors are padded with zeros; ties go to the
smaller id; fewer than ``k`` candidates give fewer rows; without queries there are no rows;
other columns are not read. Scores that leave 64 bits are cut to their ends.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

CANDIDATES, QUERIES = 4096, 256  # vectors of a block
GROUPS = 64  # groups of candidate blocks at most, and so copies of the queries
FIRST_READ = 4  # the first round reads this fraction of the lists, each later one twice as much
FEW = 8  # a query stops when at most so many times k candidates remain
EXACT = 1 << 52  # sums below this are exact in double precision


def quantized(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * component) of each component, as integers."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, finite), F.lit(False))


def bounded_rounds(queries: np.ndarray, own: np.ndarray, values: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each query (row) the candidates that may be among its ``k`` best, as (query, places)."""
    count = len(values)
    x = values.astype(np.float64)
    order = np.argsort(x, axis=0, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(count)[:, None], order.shape), 0)
    in_order = np.take_along_axis(x, order, 0)
    low, high = in_order[0], in_order[-1]
    left = np.arange(len(queries))
    read = max(1, count // FIRST_READ)
    while len(left):
        read = min(read, count)
        q = queries[left].astype(np.float64)
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        top, bottom = place >= count - read, place < read
        top_edge, bottom_edge = in_order[count - read], in_order[read - 1]
        least = up @ np.where(top, x, low).T + down @ np.where(bottom, x, high).T
        most = up @ np.where(top, x, top_edge).T + down @ np.where(bottom, x, bottom_edge).T
        itself = ids[None, :] == own[left][:, None]
        least[itself] = -np.inf
        most[itself] = -np.inf
        others = count - itself.sum(1)
        stay = []
        for row in range(len(left)):
            if others[row] <= k:
                yield left[row], np.flatnonzero(~itself[row])
                continue
            edge = np.partition(least[row], count - k)[count - k]
            may = np.flatnonzero(most[row] >= edge)
            if len(may) <= FEW * k or read == count:
                yield left[row], may
            else:
                stay.append(row)
        left = left[stay]
        read *= 2


def best_of_block(queries: np.ndarray, own: np.ndarray, values: np.ndarray, ids: np.ndarray, k: int):
    """(query, candidate, score) arrays of each query's ``k`` best in one block."""
    width = max(queries.shape[1], values.shape[1])
    fit = lambda m: np.pad(m, ((0, 0), (0, width - m.shape[1])))
    queries, values = fit(queries), fit(values)
    reach = int(np.abs(queries).max(initial=0)) * int(np.abs(values).max(initial=0)) * width
    if reach < EXACT:
        rounds, dot = bounded_rounds(queries, own, values, ids, k), lambda q, v: v @ q
    else:  # the bounds would not be exact: resolve all
        rounds = ((i, np.flatnonzero(ids != own[i])) for i in range(len(queries)))
        ends = np.iinfo(np.int64)
        dot = lambda q, v: np.array([max(ends.min, min(ends.max, int(s))) for s in v.astype(object) @ q.astype(object)], np.int64)
    out = []
    for row, may in rounds:
        score = dot(queries[row], values[may])
        best = np.lexsort((ids[may], -score.astype(np.float64) if reach < EXACT else -score))[:k]
        out.append((np.full(len(best), own[row]), ids[may][best], score[best]))
    return [np.concatenate(x) if out else np.zeros(0, np.int64) for x in (zip(*out) if out else ((), (), ()))]


def _packed(vectors: DataFrame, blocks: int, groups: int = 1) -> DataFrame:
    """(group, ids, width, vectors) with each block's vectors in one row."""
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int")).withColumn("group", F.col("block") % groups)

    def run(group: pa.Table) -> pa.Table:
        lists = group.column("v").combine_chunks()
        sizes = np.array(lists.value_lengths(), np.int64)
        matrix = np.zeros((len(lists), int(sizes.max(initial=0))), np.int64)
        matrix[np.arange(matrix.shape[1])[None, :] < sizes[:, None]] = lists.flatten().to_numpy()
        return pa.table(
            {
                "group": pa.array([group.column("group")[0].as_py()], pa.int32()),
                "ids": pa.array([group.column("id").to_numpy().astype(np.int64).tobytes()], pa.binary()),
                "width": pa.array([matrix.shape[1]], pa.int32()),
                "vectors": pa.array([matrix.tobytes()], pa.binary()),
            }
        )

    return dealt.groupBy("group", "block").applyInArrow(run, "group int, ids binary, width int, vectors binary")


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best candidates of each query.

    ``is_query``: which rows of ``vectors`` are queries.
    """
    rows = vectors.where(usable(F.col(f"`{vector}`")) & F.col(f"`{vec_id}`").isNotNull()).select(
        F.col(f"`{vec_id}`").cast("long").alias("id"),
        quantized(F.col(f"`{vector}`")).alias("v"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).distinct()
    size, asking = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0))).first()
    blocks, query_blocks = max(1, -(-size // CANDIDATES)), max(1, -(-asking // QUERIES))
    groups = min(blocks, GROUPS)
    asked = _packed(rows.where("asks").drop("asks"), query_blocks).select(
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
        F.col("ids").alias("query_ids"), F.col("width").alias("query_width"), F.col("vectors").alias("queries"),
    )
    # The planner counts the queries without their copies, and would broadcast all copies for that.
    met = _packed(rows.drop("asks"), blocks, groups).join(asked.hint("merge"), "group")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                at = lambda name: batch.column(name)[row].as_py()
                ids, own = np.frombuffer(at("ids"), np.int64), np.frombuffer(at("query_ids"), np.int64)
                values = np.frombuffer(at("vectors"), np.int64).reshape(len(ids), at("width"))
                queries = np.frombuffer(at("queries"), np.int64).reshape(len(own), at("query_width"))
                query, found, score = best_of_block(queries, own, values, ids, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query, pa.int64()), pa.array(found, pa.int64()), pa.array(score, pa.int64())],
                    ["query_id", "vec_id", "score"],
                )

    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    best = met.mapInArrow(run, "query_id long, vec_id long, score long")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
