"""Keys of whole texts."""

from lodegrain import queries


def test_normalised_key_looks_at_the_whole_text(spark, tmp_path):
    same = "word " * 60
    docs = [(1, same + "one ending"), (2, same + "another ending"), (3, same.upper() + "ONE, ending!"), (4, "short"), (5, "Short."), (6, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["duplicates"] for r in queries.QUERIES["normalised_key"](spark, str(tmp_path)).collect()}
    assert got == {1: 2, 2: 1, 4: 2, 6: 1}
