"""Collections keep what was committed, whoever committed it; indexes and requests at their defaults."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodegrain.operators import index, knn, models
from lodegrain.plans import engine
from lodegrain.sources import readers, writers
from lodegrain.streaming import incremental

KIND = "k string, v double"


def points(df):
    return df.select(F.col("k").alias("point_id"), F.array("v").alias("embedding"))


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps({"k": k, "v": v}) for k, v in rows))


@pytest.fixture
def loader(spark, tmp_path):
    from pyspark.sql.types import _parse_datatype_string

    kind = _parse_datatype_string(KIND)
    held = writers.Collection(spark, f"{tmp_path}/c", dim=1)
    load = lambda: incremental.load_new(spark, f"{tmp_path}/in", kind, held, points, f"{tmp_path}/cp")
    given = lambda rows: held.upsert(points(spark.createDataFrame(rows, KIND)))
    now = lambda: {r["point_id"]: r["embedding"][0] for r in held.read().collect()}
    return held, load, given, now, tmp_path


def test_loads_and_upserts_share_one_order(loader):
    held, load, given, now, at = loader
    put(at / "in", "1.json", [("a", 1.0), ("b", 1.0)])
    assert load() == 1
    given([("b", 2.0), ("c", 2.0)])
    put(at / "in", "2.json", [("a", 3.0)])
    assert load() == 1
    assert now() == {"a": 3.0, "b": 2.0, "c": 2.0}


def test_a_restart_after_compacting_loads_again(loader, spark):
    held, load, given, now, at = loader
    put(at / "in", "1.json", [("a", 1.0)])
    load()
    given([("a", 2.0)])
    held.compact()
    assert now() == {"a": 2.0} and held.describe()["segments"] == 1
    incremental.restart(spark, f"{at}/cp")
    put(at / "in", "2.json", [("d", 4.0)])
    assert load() == 1
    assert now() == {"a": 1.0, "d": 4.0}


def test_recreating_forgets_progress(loader):
    held, load, given, now, at = loader
    put(at / "in", "1.json", [("a", 1.0)])
    load()
    with pytest.raises(ValueError):
        held.recreate()
    held.recreate(confirm=True)
    assert held.read() is None and load() == 1 and now() == {"a": 1.0}


def test_a_batch_handed_over_twice_is_one_commit(loader, spark):
    held, load, given, now, at = loader
    rows = points(spark.createDataFrame([("a", 1.0)], KIND))
    held.upsert(rows, 0, "s")
    given([("a", 2.0)])
    held.upsert(rows, 0, "s")
    assert now() == {"a": 2.0}
    held.compact()
    held.upsert(rows, 0, "s")
    assert now() == {"a": 2.0}
    held.upsert(rows, 0, "another stream")
    assert now() == {"a": 1.0}


def test_what_was_agreed_is_stored(spark, tmp_path):
    held = writers.Collection(spark, f"{tmp_path}/c", dim=1)
    held.create(clip=0.5, embedding_model="m")
    again = writers.Collection(spark, f"{tmp_path}/c")
    assert again.dim == 1 and again.describe()["quantisation"] == {"type": "int8", "clip": 0.5}
    assert again.create_indexes(["type", "title"]) == ["type", "title"] and again.drop_indexes(keep=["type"]) == ["type"]
    again.bulk(True)
    again.upsert(points(spark.createDataFrame([("a", 1.0)], KIND)))
    again.compact()
    assert again.describe()["status"] == "bulk" and again.describe()["segments"] == 1
    again.bulk(False)
    assert again.describe()["status"] == "ready" and again._parts()[0][0] == 0
    with pytest.raises(ValueError):
        writers.Collection(spark, f"{tmp_path}/c", dim=2)
    with pytest.raises(ValueError):
        held.upsert(spark.createDataFrame([("a", "x")], "point_id string, embedding string"))


def test_the_index_finds_nine_tenths_at_its_defaults(spark, tmp_path):
    x = np.random.default_rng(1).standard_normal((1500, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)] + [(9999, None)], "vec_id long, embedding array<float>")
    index.write(df, index.fit(df, spill=3), f"{tmp_path}/ivf")
    stored, cells = index.load(spark, f"{tmp_path}/ivf")
    assert cells.probes < len(cells.centroids) / 4
    queries = x[:40]
    found = engine.Engine(stored, cells=cells).candidates(queries, engine.SearchRequest(("",) * 40, limit=10, rerank=False))
    truth = knn.top_k(df, queries, 10)
    assert knn.recall(found, truth).agg(F.avg("recall")).first()[0] >= 0.9
    assert found.groupBy("qid", "id").count().filter("count > 1").count() == 0
    assert cells.probes_for(128) == min(len(cells.centroids), 2 * cells.probes)


def test_quantiles_are_exact(spark, monkeypatch):
    monkeypatch.setattr(knn, "BINS", 8)
    r = np.random.default_rng(2)
    for values in (r.standard_normal(3000), np.repeat([0.5, 0.25], [900, 100]), np.array([7.0])):
        df = spark.createDataFrame([([float(v)],) for v in values], "embedding array<double>")
        monkeypatch.setattr(knn.order_statistics, "__defaults__", (50,))
        assert knn.clip_value(df, exact=True) == pytest.approx(np.quantile(np.abs(values), 0.99), abs=1e-12)


def test_texts_are_embedded_once(spark):
    docs = spark.createDataFrame([(i, f"title {i}", f"words {i}") for i in range(5)], "vec_id long, title string, abstract string").withColumn("openalex_id", F.col("vec_id").cast("string"))
    held = docs.withColumn("embedding", models.embed(F.col("abstract"), models.HashingEmbedder))
    found = engine.Engine(held, models.HashingEmbedder, models.OverlapReranker)
    plan = found.search_batch(engine.SearchRequest(("words 1",)))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython [run(abstract") == 1


def test_envelopes_and_wide_local_searches(spark):
    docs = spark.createDataFrame([(i, f"same title of them {i % 3}", f"words {i % 3}") for i in range(9)], "vec_id long, title string, abstract string").withColumn("openalex_id", F.col("vec_id").cast("string"))
    held = docs.withColumn("embedding", models.embed(F.col("abstract"), models.HashingEmbedder))
    found = engine.Engine(held, models.HashingEmbedder)
    got = found.respond(engine.SearchRequest(("words 1", "words 2"), limit=2, candidates=9))
    assert [x["query"] for x in got] == ["words 1", "words 2"] and got[0]["mode"] == "vector" and got[0]["count"] == 2
    assert got[0]["reranked"] is False and got[0]["candidates"] == 9 and got[0]["deduped"] == 4
    kept = found.respond(engine.KeywordRequest("same title"))[0]
    assert (kept["mode"], kept["count"], kept["deduped"]) == ("keyword", 3, 6)
    assert found.local(engine.SearchRequest(("words 1",), limit=2, candidates=300, rerank=False)).count() == 2
    with pytest.raises(ValueError):
        found.local(engine.SearchRequest(("words 1",), limit=300))


def test_files_by_name_and_by_size(spark, tmp_path):
    for name, n in (("b", 5), ("a", 1), ("c", 5)):
        (tmp_path / name).write_bytes(b"x" * n)
    assert readers.files(spark, f"file://{tmp_path}") == [("a", 1), ("b", 5), ("c", 5)]
    assert [x for x, _ in readers.files(spark, f"file://{tmp_path}", largest_first=True)] == ["b", "c", "a"]
