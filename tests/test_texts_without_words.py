"""Vectors of texts whose words give no direction."""

import itertools

import numpy as np

from lodegrain import queries
from lodegrain.operators import models


def test_every_text_that_is_not_blank_gets_a_vector(spark, tmp_path):
    model = models.HashingEmbedder()
    words = [f"w{i}" for i in range(400)]
    a, b = next((a, b) for a, b in itertools.combinations(words, 2) if abs(model._place(a) - model._place(b)) == model.dim)
    docs = [(1, "..."), (2, f"{a} {b}"), (3, f" {b.upper()} {a} "), (4, "—"), (5, " \n"), (6, None), (7, "a word")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["embedding"] for r in queries.QUERIES["embed_documents"](spark, str(tmp_path)).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6, 7] and got[5] is None and got[6] is None
    assert all(abs(np.linalg.norm(got[i]) - 1) < 1e-6 for i in (1, 2, 3, 4, 7))
    assert got[7] == models.HashingEmbedder().encode(["a word"])[0].tolist()
