"""Embedding and reranking models as plug-ins, applied in Arrow batches.

A model is an object with ``encode(texts) -> matrix`` or ``score(pairs) -> numbers``, made
once for each Python worker by a factory. The two models here are deterministic stand-ins
without learned quality: they make every path runnable where no model can be loaded.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from lodegrain.session import ship

_WORD = re.compile(r"\w+")


class Embedder(Protocol):
    dim: int

    def encode(self, texts: list[str]) -> np.ndarray: ...


class Reranker(Protocol):
    def score(self, pairs: list[tuple[str, str]]) -> list[float]: ...


class HashingEmbedder:
    """Words hashed to signed coordinates, summed and normalised. A stand-in.

    A text without words, or whose words cancel each other, counts as one word, so that only blank ones have no direction.
    """

    def __init__(self, dim: int = 64):
        self.dim = dim
        self.known: dict[str, int] = {}

    def _place(self, word: str) -> int:
        """A word's coordinate, past ``dim`` for a negative sign; short words are remembered, up to a bound."""
        h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
        place = h % self.dim + (0 if h >> 63 else self.dim)
        if len(word) <= 32:
            if len(self.known) >= 200_000:
                self.known.clear()
            self.known[word] = place
        return place

    def encode(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), np.float32)
        for row, text in zip(out, texts):
            places = [self.known[w] if w in self.known else self._place(w) for w in _WORD.findall(text.lower())]
            counts = np.bincount(places, minlength=2 * self.dim) if places else np.zeros(2 * self.dim)
            row += counts[: self.dim] - counts[self.dim :]
            if not row.any() and text.strip():
                place = self._place(text.strip().lower())
                row[place % self.dim] = 1 if place < self.dim else -1
        size = np.linalg.norm(out, axis=1, keepdims=True)
        return np.divide(out, size, out=out, where=size > 0)


class OverlapReranker:
    """The share of the query's words that the document has. A stand-in."""

    def score(self, pairs: list[tuple[str, str]]) -> list[float]:
        out = []
        for query, text in pairs:
            wanted = set(_WORD.findall(query.lower()))
            out.append(len(wanted & set(_WORD.findall(text.lower()))) / len(wanted) if wanted else 0.0)
        return out


def in_batches(call: Callable[[list], list], items: list, size: int) -> list:
    """Results of ``call`` over slices; where memory runs out, the slice is halved down to one item."""
    out, at = [], 0
    while at < len(items):
        try:
            out.extend(call(items[at : at + size]))
            at += size
        except MemoryError:
            if size == 1:
                raise
            size //= 2
    return out


def embed(texts: Column, factory: Callable[[], Embedder], batch: int = 64) -> Column:
    """Unit vectors of texts; null or blank text has no vector."""

    def run(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for column in columns:
            bodies = column.fillna("").tolist()
            filled = [i for i, b in enumerate(bodies) if b.strip()]
            vectors = in_batches(lambda part: list(model.encode(part)), [bodies[i] for i in filled], batch)
            if len(vectors) != len(filled):
                raise ValueError(f"the model gave {len(vectors)} vectors for {len(filled)} texts")
            out: list = [None] * len(bodies)
            for i, v in zip(filled, vectors):
                out[i] = np.asarray(v, np.float32)
            yield pd.Series(out, dtype=object)

    run.__annotations__ = {"columns": Iterator[pd.Series], "return": Iterator[pd.Series]}
    ship()
    return F.pandas_udf(run, "array<float>")(texts)


def check_vectors(df: DataFrame, dim: int, vector: str = "embedding", key: str = "id") -> DataFrame:
    """The rows as they are; a vector of another size, or of zeros where there is text, is an error naming the row."""
    v = F.col(vector)
    bad = v.isNotNull() & ((F.size(v) != dim) | ~F.exists(v, lambda x: x != 0))
    message = F.concat(F.lit("unusable vector for "), F.coalesce(F.col(key).cast("string"), F.lit("a row without id")))
    return df.withColumn(vector, F.when(bad, F.raise_error(message).cast("array<float>")).otherwise(v))


def pair_scores(query: Column, text: Column, factory: Callable[[], Reranker], batch: int = 16) -> Column:
    """The reranker's score of each (query, text) row."""

    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = factory()
        for queries, bodies in parts:
            yield pd.Series(in_batches(model.score, list(zip(queries.fillna(""), bodies.fillna(""))), batch), dtype=float)

    run.__annotations__ = {"parts": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    ship()
    return F.pandas_udf(run, "double")(query, text)


def rerank(rows: DataFrame, factory: Callable[[], Reranker], text: Column, top_k: int, query: str = "query", within: str = "qid", before: str = "rank") -> DataFrame:
    """Adds ``rerank_score`` and ``rerank_rank``, best first; equal scores keep their order; ``top_k`` of each query stay."""
    scored = rows.withColumn("rerank_score", pair_scores(F.col(query), text, factory))
    w = Window.partitionBy(within).orderBy(F.desc("rerank_score"), before)
    return scored.withColumn("rerank_rank", F.row_number().over(w)).filter(F.col("rerank_rank") <= top_k)
