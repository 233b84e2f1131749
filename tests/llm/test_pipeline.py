"""The pipeline's stages on a small corpus where each has something to do."""

import random

import corpus_pipeline

WORDS = {"en": "the and of that with from this have which there".split(), "de": "und der die das nicht mit für auf eine sich".split()}


def prose(seed, n, lang="en"):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS[lang]) + str(r.randint(0, 99)) for _ in range(n))


def test_stages(spark, tmp_path):
    passage = prose(500, 30)
    docs = [(i, prose(i, 60, "en" if i % 2 else "de"), "en" if i % 2 else "de", "s", 0) for i in range(40)]
    docs += [(100, docs[1][1], "en", "s", 0), (101, docs[1][1] + " tail", "en", "s", 0), (102, passage, "en", "s", 0), (103, None, "en", "s", 0), (104, "12345 !!", "en", "s", 0)]
    docs += [(105, f"{prose(600, 400)} {passage} {prose(601, 400)}", "en", "s", 0), (106, prose(602, 50) + " password=abcdefgh12", "en", "s", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    held = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, kept = held.columns, {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, held, str(tmp_path))
        assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{n}")
        held = spark.read.parquet(f"{tmp_path}/{n}")
        kept[name] = {r["doc_id"]: r for r in held.collect()}
    clean = set(range(40)) | {105, 106}
    assert set(kept["language_id"]) == clean | {100, 101, 102}
    assert set(kept["near_duplicates"]) == clean | {102}
    assert set(kept["decontamination"]) == clean
    assert passage not in kept["decontamination"][105]["text"] and kept["decontamination"][105]["n_chars"] == len(kept["decontamination"][105]["text"])
    assert "abcdefgh12" not in kept["secret_scan"][106]["text"] and set(kept["secret_scan"]) == clean
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in pieces} == clean
    assert sorted(r["doc_id"] for r in corpus_pipeline.STAGES[-1][1](spark, held, str(tmp_path)).collect()) == sorted(r["doc_id"] for r in pieces)
