"""What merging by normalised texts computes and shuffles."""

import html
import re
import unicodedata

from pyspark.sql import functions as F

from lodegrain import queries
from lodegrain.functions import text

RAW = ["", None, " A&amp;B  c", "ÀÉ ﬁ ½ K", "가나 ㄱ ᄀ힣 x", "İ ı ſ", "\x00a\x85b c\x1fd", "a_b-9", "漢字", "".join(map(chr, range(1, 0x3000))), "".join(map(chr, range(0xF000, 0x10400)))]


def test_normalising_is_the_pattern_s(spark):
    want = [re.sub(text.OUTSIDE, " ", unicodedata.normalize("NFKC", html.unescape(x or "")).lower()).strip(" ") for x in RAW]
    df = spark.createDataFrame(list(enumerate(RAW)), "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(text.normalise(F.col("t"))).collect()] == want


def test_no_text_is_shuffled(spark, tmp_path):
    spark.createDataFrame([(1, "a b"), (2, "A, b"), (3, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.QUERIES["normalised_key"](spark, str(tmp_path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    carried = re.search(r"partial_min_by\(struct\(([^)]*)\)", plan)[1]
    assert "doc_id" in carried and "title" not in carried and "abstract" not in carried and "regexp_replace" not in plan
    assert sorted(map(tuple, out.collect())) == [(1, 2), (3, 1)]
