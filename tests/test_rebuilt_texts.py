"""Which texts the preparation path rebuilds, and how often."""

import re

from pyspark.sql import functions as F

from lodegrain import schema
from lodegrain.operators import joins
from lodegrain.plans import prepare
from lodegrain.settings import Settings


def test_a_null_text_is_the_last_choice(spark):
    works = spark.createDataFrame([(1,), (2,)], "id64 long")
    texts = spark.createDataFrame([(1, None), (1, "a text"), (2, None)], "id64 long, abstract string")
    assert sorted(map(tuple, joins.attach_text(works, texts).collect())) == [(1, "a text"), (2, None)]


def test_texts_are_rebuilt_once_and_only_for_wanted_works(spark):
    blank = {c: None for c in schema.WORK_COLUMNS}
    works = spark.createDataFrame([tuple((blank | {"id": f"W{i}", "publication_year": y})[c] for c in schema.WORK_COLUMNS) for i, y in ((1, "2021"), (2, "1900"), (3, "2022"), (4, "2021"))], schema.WORKS)
    abstracts = spark.createDataFrame([("W1", "{}"), ("W1", '{"b":[1],"a":[0]}'), ("W2", '{"x":[0]}'), ("W3", "bad"), ("W9", '{"y":[0]}'), (None, '{"z":[0]}'), ("W4", None)], schema.ABSTRACTS)
    out = prepare.prepare(works, abstracts, None, Settings(years=(2021, 2022)))
    assert sorted(map(tuple, out.select("id", "abstract").collect())) == [("W1", "a b"), ("W3", None)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("array_join", plan)) == 1 and len(re.findall("LeftSemi", plan)) == 2
