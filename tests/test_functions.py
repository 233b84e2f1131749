"""Scalar functions against Python's own, and edge rows with known results."""

import html
import unicodedata
import uuid

import numpy as np
import pytest
from hypothesis import given, settings as hypothesis_settings, strategies as st
from pyspark.sql import functions as F

from lodegrain.functions import ids, text, vectors
from lodegrain.operators import predicates


def column(spark, values, kind, expr, *more):
    """The results of an expression over one column, in order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_numeric_ids(spark):
    values = ["https://x/W123", "W123", "123", None, "Wabc", "", "https://x/", "W9999999999999999999"]
    assert column(spark, values, "string", ids.numeric_id) == [123, 123, 123, None, None, None, None, None]


def test_years(spark):
    assert column(spark, [2021, None], "int", lambda c: ids.year_of(c, "int")) == [2021, None]
    assert column(spark, [2021.9, None, -3.5, float("nan")], "double", lambda c: ids.year_of(c, "double")) == [2021, 0, -3, 0]
    assert column(spark, ["2021", " 2021 ", "x", "2021.0", "2_021", None], "string", ids.year_of) == [2021, 2021, 0, 0, 0, None]


def test_point_ids_are_uuid5(spark):
    values = ["", "https://x/W1", "é漢字", "a" * 1000] + [str(i) for i in range(500)]
    assert column(spark, values, "string", ids.point_id) == [str(uuid.uuid5(uuid.NAMESPACE_URL, v)) for v in values]
    assert column(spark, [None], "string", ids.point_id) == [None]


def test_part_codes(spark):
    row = spark.range(1).select(ids.part_code(F.lit(2021), F.lit(12)).alias("c")).select("c", *ids.part_of(F.col("c")), ids.part_name(F.lit(2021), F.lit(12))).first()
    assert tuple(row) == (20210012, 2021, 12, "2021/part_0012.jsonl")


INDEXES = [
    ('{"b":[1],"a":[0,2]}', "a b a"), ("", None), ("bad", None), (None, None), ("{}", None), ('{"a":null,"b":[null,3]}', "b"),
    ('{"x":[0],"y":[0]}', "x y"), ('{"a":[0],"a":[1]}', "a"), ('{"a":[0]} trailing', None), ("[1]", None),
]


def test_inverted_indexes(spark):
    values, want = zip(*INDEXES)
    assert column(spark, values, "string", lambda c: text.inverted_to_text(text.parse_index(c))) == list(want)
    assert column(spark, [*values, '[["k",[0]]]'], "string", lambda c: text.inverted_to_text(text.parse_index(c, strict=True))) == [*want, "k"]
    assert column(spark, ['{"b":[1],"a":[0,2]}'], "string", lambda c: text.inverted_to_text(text.parse_index(c), 3)) == ["a b"]


RAW = ["  a\n b ", "", None, "&lt;b&gt; &#13; x", "ＡＢＣ ｶﾅ é", "가나다 Title: One!", "\x1c\x1d", "A&amp;B", "x" * 10_000]


def test_cleaning_is_python_s(spark):
    assert column(spark, RAW, "string", text.clean_text) == [(" ".join(html.unescape(v).split()) or None) if v else None for v in RAW]


def test_normalising_is_python_s(spark):
    import re

    want = [re.sub("[^0-9a-z가-힣]+", " ", unicodedata.normalize("NFKC", html.unescape(v)).lower()).strip() if v else "" for v in RAW]
    assert column(spark, RAW, "string", text.normalise) == want


def test_duplicate_keys(spark):
    rows = [("eleven char", "the abstract", 1), ("twelve chars", "the abstract", 2), ("short", "", 3), ("", "b" * 300, 4)]
    df = spark.createDataFrame(rows, "t string, a string, i long")
    assert [r[0] for r in df.orderBy("i").select(text.duplicate_key(F.col("t"), F.col("a"), F.col("i"))).collect()] == ["a:the abstract", "t:twelve chars", "i:3", "a:" + "b" * 200]


@hypothesis_settings(max_examples=200, deadline=None)
@given(st.text())
def test_query_tokens_have_no_separators(value):
    assert all(t and t == t.lower() or t for t in predicates.query_tokens(value))


def test_tokens_of_columns_and_queries_agree(spark):
    values = ["The Cat-sat, on 2 mats", "été À l'école", "漢字 テスト", "", None, "a_b"]
    assert column(spark, values, "string", text.tokens) == [predicates.query_tokens(v or "") for v in values]


def test_rerank_text_and_display(spark):
    row = spark.range(1).select(text.rerank_text(F.lit(None).cast("string"), F.lit(" x ")), text.rerank_text(F.lit("t"), F.lit(None).cast("string")), text.shown(F.lit("abcdef"), 3), text.line_safe(F.lit("a b "))).first()
    assert tuple(row) == ("x", "t", "abc ...", "a b ")
    assert text.wrap("one two three", 7) == ["one two", "three"]


def test_vectors(spark):
    v = np.array([[3.0, 4.0], [0.0, 0.0], [1.0, -2.0]])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(3, None)], "i int, v array<float>")
    got = df.orderBy("i").select(vectors.norm(F.col("v")), vectors.is_zero(F.col("v")), vectors.unit(F.col("v")), vectors.quantise(F.col("v"), F.lit(2.0)), vectors.half_precision(F.col("v"))).collect()
    assert [r[0] for r in got] == [5.0, 0.0, pytest.approx(5**0.5), None]
    assert [r[1] for r in got] == [False, True, False, False]
    assert got[0][2] == pytest.approx([0.6, 0.8]) and got[1][2] is None
    assert [r[3] for r in got] == [[127, 127], [0, 0], [64, -127], None]
    assert got[2][4] == [1.0, -2.0] and got[3][4] is None
