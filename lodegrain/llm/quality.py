"""Document quality by regularised quadratic discriminant analysis.

Each text is described by transformed statistics (logs of counts, arcsine roots of shares). For
each class, mean and covariance are estimated on labelled rows; a covariance is shrunk
towards the pooled one and that towards its mean variance, so it is always positive
definite. Its Cholesky factor is computed once and kept: a text's Mahalanobis distance is
a triangular product, and the log determinant is read off the diagonal. The score is the
posterior probability of class 1.

Defined results: null text counts as empty and is described like any other; labels that
are null or other than 0 and 1 are left out; without rows of both classes the score is the
share of class 1 among the labels (0.5 without labels); repeated rows repeat; an empty
table gives an empty result; extra columns are ignored; a very long text is described
whole, in time in proportion to its length.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodegrain.llm import common

SCHEMA = "doc_id long, held_out boolean, score double, predicted int"
FEATURES = ("size", "words", "word_length", "distinct", "top_word", "repeats", "upper", "symbols", "marks", "digits", "long_words", "line_repeats", "line_words", "stops", "short_lines")

_SYMBOLS = re.compile(r"[#$%&*|<>{}\[\]@^~=+\\/_]+")
_MARKS = re.compile(r"[!?]+")
_DIGITS = re.compile(r"[0-9]+")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_STOPS = re.compile(r"[.;:,](?:\s|$)")


def _share(part: float, whole: float) -> float:
    """A share by the arcsine of its root: what a text doesn't have is 0, however short the text."""
    return float(np.arcsin(np.sqrt(min(part, whole) / whole))) if whole else 0.0


def statistics(text: str) -> list[float]:
    """The transformed statistics of a whole text, in the order of FEATURES."""
    words = text.split()
    n, size = len(words), len(text)
    counts = Counter(words)
    covered = lambda pattern: sum(map(len, pattern.findall(text)))
    lines = [x for x in text.split("\n") if x.strip()]
    same = sum(a == b for a, b in zip(words, words[1:]))
    return [
        float(np.log1p(size)),
        float(np.log1p(n)),
        float(np.log1p(sum(map(len, words)) / n)) if n else 0.0,
        _share(len(counts), n),
        _share(max(counts.values(), default=0), n),
        _share(same, n),
        _share(covered(_UPPER), size),
        _share(covered(_SYMBOLS), size),
        _share(covered(_MARKS), size),
        _share(covered(_DIGITS), size),
        _share(sum(len(w) > 20 for w in words), n),
        _share(len(lines) - len(set(lines)), len(lines)),
        float(np.log1p(n / len(lines))) if lines else 0.0,
        _share(len(_STOPS.findall(text)), n),
        _share(sum(len(x) < 30 for x in lines), len(lines)),
    ]


class Discriminant:
    """Two shrunken Gaussian classes with cached Cholesky factors."""

    def __init__(self, x: np.ndarray, y: np.ndarray, shrink: float = 0.3, ridge: float = 0.01):
        self.prior = float(y.mean()) if len(y) else 0.5
        self.classes = []
        if not 0 < self.prior < 1 or len(y) < 4:
            return
        self.centre, self.scale = x.mean(0), np.maximum(x.std(0), 1e-3)
        z = (x - self.centre) / self.scale
        parts = [z[y == k] for k in (0, 1)]
        scatter = [(p - p.mean(0)).T @ (p - p.mean(0)) for p in parts]
        pooled = sum(scatter) / len(z)
        for p, s in zip(parts, scatter):
            own = (1 - shrink) * s / len(p) + shrink * pooled
            own = (1 - ridge) * own + ridge * np.trace(own) / len(own) * np.eye(len(own)) + 1e-6 * np.eye(len(own))
            root = np.linalg.cholesky(own)
            self.classes.append((p.mean(0), np.linalg.inv(root), 2 * np.log(np.diag(root)).sum(), np.log(len(p) / len(z))))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Posterior probability of class 1 for each row."""
        if not self.classes:
            return np.full(len(x), self.prior)
        z = (x - self.centre) / self.scale
        logs = [prior - 0.5 * (logdet + (((z - mean) @ inverse.T) ** 2).sum(1)) for mean, inverse, logdet, prior in self.classes]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 3000, label_col: str = "quality", **options) -> Discriminant:
    """Learn from the labelled rows of ``docs``, about ``per_class`` of each class chosen by a hash of the id.

    The sample's bound is a parameter: only the statistics of at most so many rows come
    to the driver, at any corpus size. Of rows that repeat an id, one is learnt from: that
    with the least statistics.
    """
    valid = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)").distinct()
    ranked = F.xxhash64(F.lit("quality"), "doc_id")
    chosen = None
    for k in (0, 1):
        part = valid.filter(F.col("y") == k).orderBy(ranked, "doc_id").limit(per_class)
        chosen = part if chosen is None else chosen.unionAll(part)
    rows = common.texts(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "y")  # at most twice per_class rows of two numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [statistics(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64())), batch.column(2)], ["doc_id", "x", "y"])

    got = common.map_batches(rows, run, "doc_id long, x array<double>, y int").groupBy("doc_id", "y").agg(F.min("x").alias("x")).toPandas()
    # In an order of their own, as sums of floats depend on it.
    both = sorted(zip(map(tuple, got["x"]), got["y"]))
    x = np.array([a for a, _ in both], float).reshape(len(both), len(FEATURES))
    return Discriminant(x, np.array([b for _, b in both], int), **options)


def score(docs: DataFrame, model: Discriminant, held_out=None, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    plain = common.texts(docs).withColumn("held_out", F.lit(False) if held_out is None else held_out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([statistics(t or "") for t in batch.column(1).to_pylist()], float).reshape(-1, len(FEATURES))
            p = shared.value.score(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(p), pa.array((p >= threshold).astype(np.int32))], [f.split()[0] for f in SCHEMA.split(", ")])

    return common.map_batches(plain, run, SCHEMA)
