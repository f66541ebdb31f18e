"""Exact top-k inner products by block-at-a-time pruning.

Candidates in order of their ids lie in packs of blocks of BLOCK vectors; a block has the greatest and least value of each
component. A query's bound for a block is the sum over components of what its value times those can be at most. Each query
takes a pack's blocks from the highest bound down, scores them through the block's vectors, and stops when the bound is
below its k-th score so far. Every pack of queries meets every pack of candidates in one of `parts` tasks' streams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from plumbago.llm.common import partitions

BLOCK, PACK, QUERY_PACK = 256, 8192, 512
#: Below this, sums of products are exact in doubles.
EXACT = 2.0**53
PACKED = "pack long, dim int, ids binary, vectors binary"


def _packs(size: int):  # noqa: ANN202
    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        pack = TaskContext.get().partitionId() << 32

        def emit(dim: int) -> pa.RecordBatch:
            nonlocal pack
            ids, vectors = held.pop(dim)
            pack += 1
            data = [pa.array([x], kind) for x, kind in ((pack, pa.int64()), (dim, pa.int32()), (np.array(ids, "<i8").tobytes(), pa.binary()), (np.concatenate(vectors).astype("<i8").tobytes(), pa.binary()))]
            return pa.RecordBatch.from_arrays(data, ["pack", "dim", "ids", "vectors"])

        for batch in batches:
            column = batch.column("vector")
            values, offsets = np.asarray(column.flatten()), np.concatenate([[0], np.cumsum(np.asarray(batch.column("dim")))])
            for k, (vec_id, dim) in enumerate(zip(batch.column("vec_id").to_pylist(), batch.column("dim").to_pylist(), strict=True)):
                ids, vectors = held.setdefault(dim, ([], []))
                ids.append(vec_id)
                vectors.append(values[offsets[k] : offsets[k + 1]])
                if len(ids) >= size:
                    yield emit(dim)
        for dim in list(held):
            yield emit(dim)

    return packed


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Integer inner products: by doubles where those are exact."""
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(1, queries.shape[1])
    if largest < EXACT:
        return (queries.astype(np.float64) @ vectors.astype(np.float64).T).astype(np.int64)
    return queries @ vectors.T


def _bounds(queries: np.ndarray, highest: np.ndarray, lowest: np.ndarray) -> np.ndarray:
    q = queries.astype(np.float64)
    bound = np.maximum(q, 0) @ highest.astype(np.float64).T + np.minimum(q, 0) @ lowest.astype(np.float64).T
    return bound + np.abs(bound) * 1e-12 + 1e-9  # never below the true sum


class Best:
    """The k highest scores of each query so far, ties to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k, self.scores, self.ids = k, np.full((n, k), np.iinfo(np.int64).min), np.full((n, k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate([self.scores[rows], scores], 1)
        ids = np.concatenate([self.ids[rows], ids], 1)
        order = np.lexsort((ids, ~scores), axis=1)[:, : self.k]  # ~ turns the order round without overflow
        self.scores[rows], self.ids[rows] = np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def search(queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, best: Best, block: int = BLOCK) -> int:
    """Puts one pack's candidates into best; returns how many scores it computed."""
    cuts = range(0, len(ids), block)
    parts = [slice(c, min(c + block, len(ids))) for c in cuts]
    bounds = _bounds(queries, np.stack([vectors[p].max(0) for p in parts]), np.stack([vectors[p].min(0) for p in parts]))
    order = np.argsort(-bounds, axis=1, kind="stable")
    live, n = np.arange(len(queries)), 0
    for turn in range(len(parts)):
        mine = order[live, turn]
        open_ = bounds[live, mine] >= best.scores[live, -1]  # an equal score may win by its id
        live, mine = live[open_], mine[open_]
        if not len(live):
            break
        for b in np.unique(mine):
            rows, part = live[mine == b], parts[b]
            scores = _scores(queries[rows], vectors[part])
            n += scores.size
            own = ids[part][None, :] == query_ids[rows][:, None]
            scores = np.where(own, np.iinfo(np.int64).min, scores)
            best.add(rows, scores, np.where(own, np.iinfo(np.int64).max, np.broadcast_to(ids[part], scores.shape)))
    return n


def _met(k: int):  # noqa: ANN202
    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by query pack; a pack's scores so far carry over to its next candidates."""
        now, best, query_ids, queries = None, None, None, None

        def result() -> pa.RecordBatch:
            real = best.ids != np.iinfo(np.int64).max
            return pa.RecordBatch.from_arrays([pa.array(np.repeat(query_ids, real.sum(1))), pa.array(best.ids[real]), pa.array(best.scores[real])], ["query_id", "vec_id", "score"])

        for batch in batches:
            for row in range(batch.num_rows):
                pack, dim = batch.column("q_pack")[row].as_py(), batch.column("dim")[row].as_py()
                if pack != now:
                    if now is not None:
                        yield result()
                    now, query_ids = pack, np.frombuffer(batch.column("q_ids")[row].as_py(), "<i8")
                    queries, best = np.frombuffer(batch.column("q_vectors")[row].as_py(), "<i8").reshape(len(query_ids), dim), Best(len(query_ids), k)
                ids = np.frombuffer(batch.column("ids")[row].as_py(), "<i8")
                search(queries, query_ids, np.frombuffer(batch.column("vectors")[row].as_py(), "<i8").reshape(len(ids), dim), ids, best)
        if now is not None:
            yield result()

    return met


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest inner products of floor(scale * x) for each query of (vec_id, embedding).

    Candidates are all rows of vectors but those with the query's own vec_id; ties go to the smaller vec_id. A row whose vec_id
    or embedding is null, or whose embedding holds a null or non-finite component, takes no part; a query meets candidates of its own
    dimension only. Of queries with one vec_id, the least vector is taken; candidates that repeat a vec_id each count. With fewer candidates
    than k, all are returned; empty tables give no rows. Other columns are not read. Queries are not broadcast: packs of
    them are dealt with packs of candidates, so memory does not grow with either.
    """
    spark = vectors.sparkSession
    x = F.col("embedding")
    sound = F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    whole = lambda df: df.where(sound).select("vec_id", F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("vector"), F.size(x).alias("dim"))
    n = partitions(spark)
    candidates = whole(vectors).repartitionByRange(n, "vec_id").sortWithinPartitions("vec_id").mapInArrow(_packs(PACK), PACKED)
    asked = whole(queries).groupBy("vec_id").agg(F.min(F.struct("dim", "vector")).alias("v")).select("vec_id", "v.vector", "v.dim")
    asked = asked.repartitionByRange(n, "vec_id").mapInArrow(_packs(QUERY_PACK), PACKED)
    # Candidate packs stay apart by part; every pack of queries goes to every part.
    dealt = candidates.withColumn("part", F.pmod(F.shiftright("pack", 32) + F.col("pack"), F.lit(n)).cast("int"))
    asked = asked.select(F.col("pack").alias("q_pack"), "dim", F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("part"))
    pairs = dealt.join(asked.hint("shuffle_hash"), ["part", "dim"]).select("part", "q_pack", "dim", "q_ids", "q_vectors", "ids", "vectors")
    local = pairs.sortWithinPartitions("q_pack").mapInArrow(_met(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
