"""Cells of vectors in bounded memory."""

import tracemalloc

import numpy as np

from lodegrain.operators import index, knn


def test_nearest_cells_are_found_in_blocks():
    vectors, centroids = knn.random_unit(8, 10_000, 1), knn.random_unit(8, 2_000, 2)
    centroids[7] = centroids[1900] = centroids[3]  # ties go to the lower number
    tracemalloc.start()
    got = index.Cells(centroids, 3).nearest(vectors, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20  # all scores together are 160 MB
    scores = vectors @ centroids.T
    assert (got == np.argsort(-scores, axis=1, kind="stable")[:, :3]).all()
    assert (index.Cells(centroids).nearest(vectors[:50], 20) == np.argsort(-scores[:50], axis=1, kind="stable")[:, :20]).all()


def test_exact_neighbours_in_small_blocks(spark, monkeypatch):
    v = knn.random_unit(8, 200, 3)
    points = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(999, None)], "vec_id long, embedding array<double>").coalesce(2)
    whole = sorted(map(tuple, knn.top_k(points, v[:5], 6).collect()))
    monkeypatch.setattr(knn, "SCORES", 35)
    assert sorted(map(tuple, knn.top_k(points, v[:5], 6).collect())) == whole and len(whole) == 30
