"""The pipeline drops near copies of 0.80 similarity; bands follow from the similarity asked for."""

import random

import corpus_pipeline
from lodegrain.llm import near_duplicates


def test_bands_follow_the_similarity():
    assert [near_duplicates.rows_of(p) for p in (95, 85, 80)] == [8, 8, 4]
    for percent in (95, 90, 85, 80, 75, 70):
        rows = near_duplicates.rows_of(percent)
        assert (1 - (percent / 100) ** rows) ** (near_duplicates.BINS // rows) <= near_duplicates.MISS


def test_stage_links_pairs_between_80_and_85(spark):
    docs = []
    for k in range(60):
        words = [f"w{k}x{random.Random(k).randint(0, 9)}n{i}" for i in range(104)]
        copy = list(words)
        copy[30], copy[70] = "other", "changed"  # 90 of 110 shingles: 0.818
        far = list(words)
        far[20], far[50], far[80] = "one", "two", "three"  # 85 of 115: 0.739
        docs += [(10 * k, " ".join(words)), (10 * k + 1, " ".join(copy)), (10 * k + 5, " ".join(far))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"] for r in corpus_pipeline.deduplicate(spark, df, "").collect()}
    assert got == {10 * k + d for k in range(60) for d in (0, 5)}
    assert near_duplicates.keep_one(df).count() == len(docs)
