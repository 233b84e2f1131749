"""An inverted-file index: vectors in the cells of centroids, searched in the cells nearest to a query.

It takes the place of a graph index. Building is a job of its own, so loading points
never waits for it. Centroids are fitted on a bounded sample; every row is indexed, in its
``spill`` nearest cells: more copies of a row cost space and save probes. How many cells a search of the default width has to probe is
measured on the sample when the index is fitted, and stored with the centroids; wider
searches probe more in proportion.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodegrain.operators import knn
from lodegrain.session import read_text, ship, write_text


#: The search width at which the measured number of probes is taken, and the recall that it must reach on the sample.
WIDTH, RECALL = 64, 0.95


def nearest(vectors: np.ndarray, centroids: np.ndarray, n: int = 1) -> np.ndarray:
    """The ``n`` best centroids of each vector, best first, ties by number; vectors are taken in blocks of ``knn.SCORES`` scores."""
    n = min(n, len(centroids))
    out = np.empty((len(vectors), n), np.int64)
    block = max(1, knn.SCORES // len(centroids))
    for at in range(0, len(vectors), block):
        scores = np.asarray(vectors[at : at + block], np.float64) @ centroids.T
        rows = np.arange(len(scores))
        if n > 8:
            out[at : at + block] = np.argsort(-scores, axis=1, kind="stable")[:, :n]
            continue
        for k in range(n):
            best = scores.argmax(1)
            out[at : at + block, k] = best
            scores[rows, best] = -np.inf
    return out


@dataclass(frozen=True)
class Cells:
    """Unit centroids, one row each; how many cells a vector is stored in, and how many a search probes."""

    centroids: np.ndarray
    spill: int = 1
    probes: int = 8

    def nearest(self, vectors: np.ndarray, n: int = 1) -> np.ndarray:
        return nearest(np.asarray(vectors), self.centroids, n)

    def probes_for(self, width: int) -> int:
        """Cells to probe for a search width; the width plays the part that it does in a graph."""
        return min(len(self.centroids), max(1, math.ceil(self.probes * width / WIDTH)))

    def to_json(self) -> str:
        return json.dumps({"centroids": self.centroids.tolist(), "spill": self.spill, "probes": self.probes})

    @classmethod
    def from_json(cls, text: str) -> Cells:
        got = json.loads(text)
        return cls(np.array(got["centroids"], np.float64), got["spill"], got["probes"])


def _probes(x: np.ndarray, centroids: np.ndarray, spill: int, k: int = 10, n: int = 200) -> int:
    """The fewest probes that find ``RECALL`` of the sample's own nearest ``k``, on average over ``n`` of its vectors."""
    queries = x[:n]
    scores = queries @ x.T
    scores[np.arange(len(queries)), np.arange(len(queries))] = -np.inf  # not itself
    truth = np.argsort(-scores, axis=1, kind="stable")[:, : min(k, len(x) - 1)]
    if not truth.size:
        return 1
    own = nearest(x, centroids, spill)
    order = np.argsort(np.argsort(-(queries @ centroids.T), axis=1, kind="stable"), axis=1)  # the place of each cell for each query
    first = order[np.arange(len(queries))[:, None, None], own[truth]].min(2)  # the probe that finds a neighbour
    return int(np.quantile(first, RECALL, method="higher")) + 1


def fit(points: DataFrame, cells: int | None = None, sample: int = 20_000, rounds: int = 10, spill: int = 1, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = 0) -> Cells:
    """Spherical k-means on at most ``sample`` vectors, chosen by a hash of the id.

    Without ``cells``, four times the square root of the number of rows, a fourth of the sample at most.
    """
    rows = points.filter(F.col(vector_col).isNotNull())
    n = rows.count()
    cells = max(1, cells or min(round(4 * math.sqrt(n)), sample // 4, n // 4))
    got = rows.orderBy(F.xxhash64(F.lit(seed), id_col)).limit(sample).select(vector_col).toPandas()
    x = np.array(got[vector_col].tolist(), np.float64)
    if not len(x):
        raise ValueError("no vectors to fit on")
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    rng = np.random.default_rng(seed)
    centroids = x[rng.choice(len(x), min(cells, len(x)), replace=False)]
    for _ in range(rounds):
        own = nearest(x, centroids)[:, 0]
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(size > 1e-12, sums / np.maximum(size, 1e-12), centroids)
    spill = min(spill, len(centroids))
    return Cells(centroids, spill, min(len(centroids), _probes(x, centroids, spill)))


def assign(points: DataFrame, cells: Cells, vector_col: str = "embedding", name: str = "cell") -> DataFrame:
    """Each vector's row once for each of its cells; rows without a vector have a null cell."""
    ship(points.sparkSession)

    def own(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for column in columns:
            there = column.notna().to_numpy()
            out: list = [None] * len(column)
            if there.any():
                found = cells.nearest(np.array(column[there].tolist(), np.float64), cells.spill).astype(np.int32)
                for i, row in zip(np.flatnonzero(there), found):
                    out[i] = row
            yield pd.Series(out, dtype=object)

    own.__annotations__ = {"columns": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return points.withColumn(name, F.explode_outer(F.pandas_udf(own, "array<int>")(F.col(vector_col))))


def write(points: DataFrame, cells: Cells, path: str, vector_col: str = "embedding") -> None:
    """Store the points by cell, so that a search reads only the cells it probes, and the centroids beside them."""
    assign(points, cells, vector_col).repartition("cell").write.mode("overwrite").partitionBy("cell").parquet(path)
    write_text(points.sparkSession, f"{path.rstrip('/')}/_centroids.json", cells.to_json())


def load(spark: SparkSession, path: str) -> tuple[DataFrame, Cells]:
    """A stored index, in whatever session: its points by cell, and its centroids."""
    text = read_text(spark, f"{path.rstrip('/')}/_centroids.json")
    if text is None:
        raise FileNotFoundError(f"no centroids in {path}")
    return spark.read.parquet(path), Cells.from_json(text)


def search(indexed: DataFrame, cells: Cells, queries: np.ndarray, k: int, probes: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding", where: Column | None = None) -> DataFrame:
    """(qid, id, vector_score, rank) within the ``probes`` cells nearest to each query.

    The cells probed are a filter on the stored partitions; ``where`` is applied before the ranking.
    """
    near = cells.nearest(queries, cells.probes if probes is None else probes)
    chosen = indexed.filter(F.col("cell").isin(*sorted({int(c) for c in near.ravel()})))
    chosen = chosen if where is None else chosen.filter(where)
    # A vector may be met in each of its cells.
    rows = knn.candidates(chosen, queries, k * cells.spill, id_col, vector_col, cell_col="cell", probes=[{int(c) for c in row} for row in near])
    return knn.cut(rows.distinct() if cells.spill > 1 else rows, k)
