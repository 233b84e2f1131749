"""The media query's features come from tensor batches with time spans, written and read back."""

import numpy as np
from pyspark.sql import functions as F

from lodegrain.llm import audio


def test_features_pass_through_tensors(monkeypatch):
    written = []
    pack = audio.pack_tensors
    monkeypatch.setattr(audio, "pack_tensors", lambda batch: written.append(batch) or pack(batch))
    samples = audio.payload("some words " * 3000)[0]
    patches, spans, active = audio.features(samples, audio.RATE)
    assert audio.feature(samples, audio.RATE) == audio.summary(patches, active)
    assert len(written) == 1 and written[0].schema.names == ["log_mel", "t_start", "t_end"]
    back, times = audio.unpack_tensors(pack(written[0]))
    assert np.array_equal(back, patches) and np.array_equal(times, spans)


def test_the_query_gives_these_features(spark):
    texts = [None, "", "x", "some words " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("more", F.lit(1))
    got = {r["doc_id"]: r["feature"] for r in audio.describe(df).collect()}
    assert got == {i: audio.feature(audio.payload(t)[0], audio.RATE) for i, t in enumerate(texts)}
