"""Nearest vectors of a small set of queries, exact and int8.

Points stream through NumPy in Arrow batches against the matrix of all queries; each task
keeps the best ``k`` of each query, and only those meet in the final ranking. Filters are
applied to the points first, so they reach the scan.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from lodegrain.functions.vectors import quantise
from lodegrain.session import scratch, ship

#: Digits of a score that count in comparisons; ties go to the smaller id.
DIGITS = 6
#: Queries in a call: their matrix is sent with the tasks.
MOST_QUERIES = 1024
#: Scores of points by queries, or by cells of an index, that a task holds at once, whatever the number of queries or cells.
SCORES = 1 << 21


def matrix(batch: pa.Array) -> np.ndarray:
    """List vectors of one length as a matrix, without a loop over rows."""
    flat = batch.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(batch), -1) if len(batch) else flat.reshape(0, 0)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties by id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= least)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def candidates(points: DataFrame, queries: np.ndarray, k: int, id_col: str, vector_col: str, scale: float = 1.0, cell_col: str | None = None, probes: list[set[int]] | None = None) -> DataFrame:
    """(qid, id, vector_score): each task's best ``k`` of each query.

    With ``cell_col`` and ``probes``, query q is only held against points of its own cells.
    """
    if len(queries) > MOST_QUERIES:
        raise ValueError(f"at most {MOST_QUERIES} queries in a call")
    ship(points.sparkSession)
    q = np.ascontiguousarray(queries, np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(np.zeros(0, np.int64), np.zeros(0)) for _ in q]
        rows = max(1, SCORES // max(1, len(q)))
        for batch in (b.slice(at, rows) for b in batches for at in range(0, b.num_rows, rows)):
            if batch.column(1).null_count:
                batch = batch.filter(batch.column(1).is_valid())
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            v = matrix(batch.column(1)).astype(np.float64)
            if not len(ids):
                continue
            scores = v @ q.T
            scores *= scale
            np.round(scores, DIGITS, out=scores)
            cells = batch.column(2).to_numpy(zero_copy_only=False) if cell_col else None
            for i in range(len(q)):
                chosen = np.isin(cells, list(probes[i])) if probes is not None else slice(None)
                a, s = np.concatenate([held[i][0], ids[chosen]]), np.concatenate([held[i][1], scores[chosen, i]])
                top = best(a, s, k)
                held[i] = a[top], s[top]
        n = [len(a) for a, _ in held]
        if sum(n):
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(q)), n).astype(np.int32)), pa.array(np.concatenate([a for a, _ in held])), pa.array(np.concatenate([s for _, s in held]))], ["qid", "id", "vector_score"])

    columns = [F.col(id_col).cast("long").alias("id"), F.col(vector_col)] + ([F.col(cell_col)] if cell_col else [])
    # Rows without a vector are left out in the tasks: as a filter, the vector's expression (a model, perhaps) would run twice.
    return points.select(*columns).mapInArrow(run, "qid int, id long, vector_score double")


def cut(rows: DataFrame, k: int, score: str = "vector_score", name: str = "rank") -> DataFrame:
    """The best ``k`` rows of each query with their rank."""
    w = Window.partitionBy("qid").orderBy(F.desc(score), "id")
    return rows.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= k)


def top_k(points: DataFrame, queries: np.ndarray, k: int, id_col: str = "vec_id", vector_col: str = "embedding", where: Column | None = None) -> DataFrame:
    """(qid, id, vector_score, rank): exact nearest points of each query."""
    return cut(candidates(points if where is None else points.filter(where), queries, k, id_col, vector_col), k)


#: Values that come to the driver at once, and bins of a pass.
MOST_VALUES, BINS = 50_000, 4096


def order_statistics(values: DataFrame, places: list[int], most: int = MOST_VALUES) -> list[float]:
    """The values at 0-based places of the sorted column ``x``, exact.

    Each pass counts the values of equal bins and goes on with the bin that holds the place,
    until its values are few or all the same. A pass keeps a count for each bin, whatever
    the number of values, and no task or driver holds more than ``most`` of them.
    """
    out = []
    for place in places:
        inside, before = values, 0
        while True:
            low, high, n = inside.agg(F.min("x"), F.max("x"), F.count("x")).first()
            if low == high:
                out.append(low)
                break
            if n <= most:
                out.append(sorted(r[0] for r in inside.select("x").collect())[place - before])
                break
            step = (high - low) / BINS
            bins = F.least(F.floor((F.col("x") - low) / F.lit(step)), F.lit(BINS - 1))
            for k, count in sorted(inside.groupBy(bins.alias("k")).count().collect()):
                if place < before + count:
                    inside = inside.filter(bins == k)
                    break
                before += count
    return out


def clip_value(points: DataFrame, vector_col: str = "embedding", quantile: float = 0.99, exact: bool = False) -> float:
    """The quantile of all components' sizes, past which int8 saturates.

    The default is a bounded sketch; the exact form interpolates between order statistics, in a few passes.
    """
    parts = points.select(F.explode(vector_col).alias("x")).select(F.abs(F.col("x").cast("double")).alias("x")).filter("x is not null")
    if not exact:
        return parts.agg(F.percentile_approx("x", quantile, 100_000)).first()[0]
    n = parts.count()
    if not n:
        return None
    at = quantile * (n - 1)
    low, high = order_statistics(parts, [math.floor(at), math.ceil(at)])
    return low + (high - low) * (at - math.floor(at))


def quantised(points: DataFrame, clip: float, vector_col: str = "embedding", name: str = "embedding_i8") -> DataFrame:
    """Adds the int8 form of each vector."""
    return points.withColumn(name, quantise(F.col(vector_col), F.lit(clip)))


def quantise_queries(queries: np.ndarray, clip: float) -> np.ndarray:
    return np.floor(np.clip(np.asarray(queries, np.float64) / clip, -1, 1) * 127 + 0.5)


def top_k_quantised(points: DataFrame, queries: np.ndarray, k: int, clip: float, oversampling: float = 2.0, rescore: bool = True, id_col: str = "vec_id", vector_col: str = "embedding", i8_col: str = "embedding_i8", where: Column | None = None) -> DataFrame:
    """Nearest points by int8 scores; with ``rescore``, the oversampled best are scored again in full precision."""
    chosen = points if where is None else points.filter(where)
    fetch = math.ceil(k * oversampling) if rescore else k
    rough = cut(candidates(chosen, quantise_queries(queries, clip), fetch, id_col, i8_col, (clip / 127) ** 2), fetch)
    if not rescore:
        return rough
    q = np.ascontiguousarray(queries, np.float64)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = matrix(batch.column(2)).astype(np.float64)
            qid = batch.column(0).to_numpy(zero_copy_only=False)
            scores = np.round((v * q[qid]).sum(1), DIGITS) if len(qid) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores)], ["qid", "id", "vector_score"])

    # At most queries x fetch rows, so the candidates are the broadcast side.
    full = chosen.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).join(F.broadcast(rough.select("qid", "id")), "id").select("qid", "id", "v")
    return cut(full.mapInArrow(again, "qid int, id long, vector_score double"), k)


def recall(found: DataFrame, truth: DataFrame) -> DataFrame:
    """(qid, found, wanted, recall): the share of the exact result that an approximate one has."""
    hit = truth.select("qid", "id").join(found.select("qid", "id").withColumn("hit", F.lit(1)), ["qid", "id"], "left")
    return hit.groupBy("qid").agg(F.count("hit").alias("found"), F.count("*").alias("wanted"), (F.count("hit") / F.count("*")).alias("recall"))


def random_unit(dim: int, n: int = 1, seed: int = 0) -> np.ndarray:
    """Seeded random directions."""
    v = np.random.default_rng(seed).standard_normal((n, dim))
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def top_k_join(points: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", block: int = MOST_QUERIES, search=top_k, **options) -> DataFrame:
    """(query_id, id, vector_score, rank) for a table of queries, taken in blocks of at most ``block``.

    One block's vectors are on the driver at a time, whatever the number of queries; each
    block is one pass over the points. Results of more than one block are written to the
    shared scratch folder as they come, so the plan doesn't grow with the number of blocks.
    """
    spark, folder, held, blocks = points.sparkSession, None, [], 0

    def found(rows: list) -> DataFrame:
        hits = search(points, np.array([r[1] for r in rows], np.float64), k, id_col=id_col, vector_col=vector_col, **options)
        names = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "qid int, query_id long")
        return hits.join(F.broadcast(names), "qid").select("query_id", "id", "vector_score", "rank")

    for row in queries.select(F.col(id_col).cast("long"), vector_col).filter(F.col(vector_col).isNotNull()).orderBy(id_col).toLocalIterator():
        if len(held) == block:
            folder = folder or scratch(spark, "neighbours")
            found(held).write.parquet(f"{folder}/block={blocks}")
            held, blocks = [], blocks + 1
        held.append(row)
    if not held:
        return spark.createDataFrame([], "query_id long, id long, vector_score double, rank int")
    last = found(held)
    if folder is None:
        return last
    last.write.parquet(f"{folder}/block={blocks}")
    return spark.read.schema("query_id long, id long, vector_score double, rank int").parquet(*[f"{folder}/block={i}" for i in range(blocks + 1)])
