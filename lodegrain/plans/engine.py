"""Search over a collection: by meaning, in batches, and by keyword.

Order of work: filter, candidates, payload of the candidates only, merging of copies,
reranking, cutting. Merging comes before reranking, so copies cost no model calls. Counts of
copies are within the candidates fetched, not the whole collection.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame, functions as F

from lodegrain.functions.text import rerank_text
from lodegrain.operators import dedupe, index, knn, models, predicates, projections
from lodegrain.settings import Settings


@dataclass(frozen=True)
class SearchRequest:
    queries: tuple[str, ...]
    filters: predicates.Filters = predicates.Filters()
    limit: int = 10
    candidates: int = 50
    rerank: bool = True
    dedupe: bool = True
    raw: bool = False
    ef: int = 64
    rescore: bool = False
    oversampling: float = 2.0
    exact: bool = False

    def checked(self) -> SearchRequest:
        predicates.check_queries(list(self.queries))
        for name, value in (("limit", self.limit), ("candidates", self.candidates), ("hnsw_ef", self.ef), ("oversampling", self.oversampling)):
            predicates.check(name, value)
        return self

    @property
    def fetch(self) -> int:
        """Candidates of a query: more than the limit only if they are to be reranked."""
        return max(self.candidates, self.limit) if self.rerank else self.limit


@dataclass(frozen=True)
class KeywordRequest:
    text: str
    filters: predicates.Filters = predicates.Filters()
    limit: int = 5
    phrase: bool = False
    dedupe: bool = True
    rerank: bool = False
    raw: bool = False

    def checked(self) -> KeywordRequest:
        predicates.check_queries([self.text], 1, predicates.KEYWORD_CHARS)
        predicates.check("limit", self.limit)
        return self

    @property
    def fetch(self) -> int:
        return min(self.limit * 10, 500) if self.dedupe or self.rerank else self.limit


class Engine:
    """Queries over points (point_id, embedding, payload columns).

    ``embedder`` and ``reranker`` are factories; without a reranker, requests for one fetch
    as many candidates and keep the vector order. With ``cells`` and points stored by cell,
    candidates come from the inverted file; with ``clip`` and an int8 column, from int8 scores.
    """

    def __init__(self, points: DataFrame, embedder: Callable[[], models.Embedder] | None = None, reranker: Callable[[], models.Reranker] | None = None, settings: Settings = Settings(), cells: index.Cells | None = None, clip: float | None = None, id_col: str = "vec_id", vector_col: str = "embedding"):
        self.points, self.embedder, self.reranker, self.settings = points, embedder, reranker, settings
        self.cells, self.clip, self.id_col, self.vector_col = cells, clip, id_col, vector_col

    def embed_queries(self, queries: list[str]) -> np.ndarray:
        """Vectors of all queries in one call."""
        if self.embedder is None:
            raise ValueError("no embedder was given")
        return np.asarray(self.embedder().encode(list(queries)), np.float64)

    def candidates(self, vectors: np.ndarray, request: SearchRequest) -> DataFrame:
        """(qid, id, vector_score, rank) of the points that match the filters."""
        where = request.filters.condition()
        common = {"id_col": self.id_col, "vector_col": self.vector_col, "where": where}
        if not request.exact and self.cells is not None:
            width = max(request.ef, request.fetch)
            return index.search(self.points, self.cells, vectors, request.fetch, probes=self.cells.probes_for(width), **common)
        if not request.exact and self.clip is not None:
            return knn.top_k_quantised(self.points, vectors, request.fetch, self.clip, request.oversampling, request.rescore, **common)
        return knn.top_k(self.points, vectors, request.fetch, **common)

    def _queries(self, queries: tuple[str, ...]) -> DataFrame:
        return self.points.sparkSession.createDataFrame(list(enumerate(queries)), "qid int, query string")

    def _payload(self, found: DataFrame, keep: tuple[str, ...], raw: bool) -> DataFrame:
        """The candidates' payload, joined back late; there are at most queries x fetch of them."""
        rest = [c for c in self.points.columns if c not in (self.vector_col, "embedding_i8", "cell", *keep)]
        rows = self.points.select(*rest, F.col(self.id_col).cast("long").alias("__id")).join(F.broadcast(found.withColumnRenamed("id", "__id")), "__id")
        items = rows.withColumn("payload", projections.payload_json(self.points.select(*rest), rest)) if raw else rows.withColumn("payload", F.lit(None).cast("string"))
        return projections.to_items(items, (*keep, F.col("__id").alias("id"), "payload"))

    def refine(self, items: DataFrame, request: SearchRequest | KeywordRequest, queries: tuple[str, ...]) -> DataFrame:
        """Merge copies, rerank, cut."""
        if request.dedupe:
            own = F.coalesce(F.col("openalex_id"), F.col("id").cast("string"))
            key = dedupe.duplicate_key(dedupe.normalise(F.col("title")), dedupe.normalise(F.col("abstract")), own)
            items = dedupe.dedupe(items, key, [F.col("rank")], ["qid"])
        else:
            items = items.withColumn("duplicates", F.lit(1))
        if request.rerank and self.reranker is not None:
            rows = items.join(F.broadcast(self._queries(queries)), "qid")
            items = models.rerank(rows, self.reranker, rerank_text(F.col("title"), F.col("abstract")), request.limit).drop("rank", "query").withColumnRenamed("rerank_rank", "rank")
        else:
            items = dedupe.ranked(items.withColumnRenamed("rank", "__before"), [F.col("__before")], ["qid"]).drop("__before").filter(F.col("rank") <= request.limit)
        return projections.to_hits(items, raw=request.raw)

    def search_batch(self, request: SearchRequest, vectors: np.ndarray | None = None) -> DataFrame:
        """Hits of each query, by ``qid`` and ``rank``. Vectors may be given in place of texts to embed."""
        return self._hits(request.checked(), vectors)

    def _hits(self, request: SearchRequest, vectors: np.ndarray | None = None) -> DataFrame:
        vectors = self.embed_queries(list(request.queries)) if vectors is None else np.asarray(vectors, np.float64)
        if len(vectors) != len(request.queries):
            raise ValueError("as many vectors as queries are wanted")
        found = self.candidates(vectors, request)
        return self.refine(self._payload(found, ("qid", "rank", "vector_score"), request.raw), request, request.queries)

    def search(self, query: str, **options) -> DataFrame:
        """Hits of one query."""
        return self.search_batch(SearchRequest((query,), **options))

    def keyword(self, request: KeywordRequest, order: str = "point_id") -> DataFrame:
        """Title matches in key order; without a reranker they have no score."""
        request.checked()
        found = predicates.keyword_filter(self.points.filter(request.filters.condition()), request.text, phrase=request.phrase)
        order = order if order in self.points.columns else self.id_col
        top = found.drop(self.vector_col).orderBy(order).limit(request.fetch)
        ranked = dedupe.ranked(top.withColumn("qid", F.lit(0)), [F.col(order)], ["qid"])
        payload = projections.payload_json(top) if request.raw else F.lit(None).cast("string")
        items = projections.to_items(ranked.withColumn("payload", payload), ("qid", "rank", F.col(self.id_col).cast("long").alias("id"), "payload"))
        return self.refine(items, request, (request.text,))

    def local(self, request: SearchRequest, vectors: np.ndarray | None = None) -> DataFrame:
        """As ``search_batch``, but the full number of candidates is fetched even without reranking."""
        wide = replace(request.checked(), limit=max(request.candidates, request.limit))  # the request's own limit is checked, not the widened one
        hits = self._hits(wide, vectors)
        return hits.filter(F.col("rank") <= request.limit)

    def respond(self, request: SearchRequest | KeywordRequest, vectors: np.ndarray | None = None) -> list[dict]:
        """Results in their envelope, one for each query.

        The envelope says what was asked, how (``vector`` or ``keyword``), how many hits came,
        how many candidates were fetched, how many copies were merged among the hits' own, whether
        the hits were reranked, and how long all queries took.
        """
        began = time.perf_counter()
        keyword = isinstance(request, KeywordRequest)
        hits = (self.keyword(request) if keyword else self.search_batch(request, vectors)).orderBy("qid", "rank").collect()
        took = round((time.perf_counter() - began) * 1000, 1)
        queries = (request.text,) if keyword else request.queries
        out = []
        for i, query in enumerate(queries):
            own = [r.asDict(recursive=True) for r in hits if r["qid"] == i]
            merged = sum((r.get("duplicates") or 1) - 1 for r in own)
            out.append({"query": query, "mode": "keyword" if keyword else "vector", "count": len(own), "took_ms": took, "candidates": request.fetch, "reranked": bool(request.rerank and self.reranker is not None), "deduped": merged if request.dedupe else 0, "results": [{k: v for k, v in r.items() if k != "qid"} for r in own]})
        return out

    def health(self) -> dict:
        """What the engine serves: points, models by name, index and quantisation."""
        points, indexed = self.points.agg(F.count("*"), F.count(self.vector_col)).first()
        name = lambda factory: getattr(factory, "__name__", type(factory).__name__) if factory is not None else None
        cells = {"cells": len(self.cells.centroids), "probes": self.cells.probes, "spill": self.cells.spill} if self.cells is not None else None
        return {"status": "ok", "points": points, "indexed": indexed, "embedding_model": self.embedder is not None, "reranker_model": self.reranker is not None, "models": [name(self.embedder), name(self.reranker)], "device": "cpu", "index": cells, "clip": self.clip}

    def warm(self) -> int:
        """Keep the points in memory, spilling to disk; returns how many there are."""
        self.points = self.points.persist()
        n = self.points.count()
        if self.embedder is not None:
            for query in WARM_QUERIES:
                self.search(query, limit=1, rerank=False).count()
        return n


#: Asked once on warming, so that models and plans are ready for the first real query.
WARM_QUERIES = ("climate", "protein folding", "machine learning")


def summary(hits: DataFrame, fetched: DataFrame) -> DataFrame:
    """(qid, candidates, count): what was fetched and what is returned."""
    a = fetched.groupBy("qid").agg(F.count("*").alias("candidates"))
    return a.join(hits.groupBy("qid").agg(F.count("*").alias("count")), "qid", "left").select("qid", "candidates", F.coalesce("count", F.lit(0)).alias("count"))
