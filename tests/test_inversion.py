"""Texts to inverted indexes and back."""

from pyspark.sql import functions as F

from lodegrain import queries
from lodegrain.functions import text

TEXTS = [(1, " b  a b\tc\n"), (2, None), (3, ""), (4, " \n "), (5, "a"), (5, "b a"), (6, "é　漢字 é"), (7, "x " * 3000 + "y")]


def test_a_text_is_inverted_within_its_row(spark):
    rows = spark.createDataFrame(TEXTS[:6], "i int, t string").select(text.text_to_inverted(F.col("t")).alias("v")).collect()
    assert [r["v"] for r in rows] == [{"b": [1, 3], "a": [2], "c": [4]}, None, {}, {}, {"a": [0]}, {"b": [0], "a": [1]}]


def test_round_trip_shuffles_no_words(spark, tmp_path):
    spark.createDataFrame(TEXTS, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.QUERIES["invert_roundtrip"](spark, str(tmp_path))
    want = [(i, None if t is None or not t.split() else " ".join(t.split())) for i, t in TEXTS]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
