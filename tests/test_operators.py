"""Operators on edge rows whose results are known."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodegrain import schema
from lodegrain.operators import dedupe, index, joins, knn, models, predicates, projections, stats
from lodegrain.plans import engine, prepare
from lodegrain.settings import Settings


def test_filters_ignore_what_is_not_given(spark):
    df = spark.createDataFrame([(1, "a", 2020), (2, "b", 2021), (3, None, None)], "i int, type string, publication_year int")
    count = lambda **k: df.filter(predicates.Filters(**k).condition({"type": "type"})).count()
    assert (count(), count(year_from=0, country=""), count(type="a"), count(year_from=2021), count(year=2020, year_from=2021), count(year_to=2020)) == (3, 3, 1, 1, 1, 1)


def test_filters_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, "a", 2020, "x")], "i int, type string, publication_year int, body string").write.parquet(f"{tmp_path}/t")
    plan = spark.read.parquet(f"{tmp_path}/t").filter(predicates.Filters(type="a", year_from=2000).condition({"type": "type"})).select("i")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(type,a)" in text and "GreaterThanOrEqual(publication_ye" in text and "body" not in text


def test_requests_are_held_to_ranges():
    predicates.check("limit", 200)
    for name, value in (("limit", 0), ("limit", 201), ("candidates", 1001), ("hnsw_ef", 15), ("oversampling", 0.5)):
        with pytest.raises(ValueError):
            predicates.check(name, value)
    for bad in ([], [""], ["x"] * 33, ["x" * 4001]):
        with pytest.raises(ValueError):
            predicates.check_queries(bad)


def test_dedupe_keeps_the_first(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, "a"), (5, None), (6, None)], "i int, k string")
    got = dedupe.dedupe(df, F.col("k"), [F.col("i")]).orderBy("i").collect()
    assert [tuple(r) for r in got] == [(1, "a", 3), (2, "b", 1), (5, None, 1), (6, None, 1)]
    again = dedupe.dedupe(dedupe.dedupe(df, F.col("k"), [F.col("i")]).drop("duplicates"), F.col("k"), [F.col("i")])
    assert again.agg(F.max("duplicates")).first()[0] == 1


def test_lookup_first_wins_and_bad_ids_match_nothing(spark):
    sources = spark.createDataFrame([("S1", "US", "f1"), ("S1", "DE", "f2"), ("S2", "", "f1"), ("bad", "FR", "f1"), (None, "IT", "f1")], "id string, country_code string, file string")
    works = spark.createDataFrame([("W1", "S1"), ("W2", "S2"), ("W3", "bad"), ("W4", None), ("W5", "S9")], "id string, primary_location__source__id string")
    got = joins.attach_country(works, joins.country_lookup(sources, F.col("file"))).orderBy("id").collect()
    assert [r["country"] for r in got] == ["US", None, None, None, None]


def test_fill_gives_all_rows_of_an_id_the_text(spark):
    works = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "w")], "id64 long, t string")
    texts = spark.createDataFrame([(1, "short"), (1, "longer text"), (None, "no")], "id64 long, abstract string")
    got = {(r["t"], r["abstract"]) for r in joins.attach_text(works, texts).collect()}
    assert got == {("x", "longer text"), ("y", "longer text"), ("z", None), ("w", None)}
    assert tuple(stats.fill_stats(joins.attach_text(works, texts)).first()) == (4, 2, 2)


def test_numbers_are_gapless_with_ties(spark):
    df = spark.createDataFrame([(i % 7, "g" if i % 3 else "h", i) for i in range(100)], "o long, g string, i long")
    got = joins.numbered(df, "o", "n", ("g",), ("i",)).collect()
    for g in "gh":
        own = sorted((r["n"], r["o"]) for r in got if r["g"] == g)
        assert [n for n, _ in own] == list(range(len(own))) and [o for _, o in own] == sorted(o for _, o in own)


def brute(points, queries, k):
    out = []
    for q, v in enumerate(queries):
        s = sorted(((-round(float(np.dot(p, v)), 6), i) for i, p in points))[:k]
        out += [(q, i, -x, n + 1) for n, (x, i) in enumerate(s)]
    return out


@pytest.fixture(scope="module")
def points(spark):
    v = knn.random_unit(8, 300, 1)
    v[10] = v[11] = v[12]
    return [(i, x) for i, x in enumerate(v)], spark.createDataFrame([(i, x.tolist(), i % 3) for i, x in enumerate(v)] + [(999, None, 0)], "vec_id long, embedding array<double>, label int").repartition(5)


def test_exact_neighbours_are_brute_force(points):
    raw, df = points
    queries = np.array([raw[i][1] for i in (0, 11, 200)])
    got = sorted(tuple(r) for r in knn.top_k(df, queries, 7).collect())
    want = sorted(brute(raw, queries, 7))
    assert [(a, b, d) for a, b, _, d in got] == [(a, b, d) for a, b, _, d in want] and np.allclose([r[2] for r in got], [r[2] for r in want])
    kept = knn.top_k(df, queries, 7, where=F.col("label") == 1).collect()
    assert all(r["id"] % 3 == 1 for r in kept) and len(kept) == 21
    few = knn.top_k_join(df, df.filter("vec_id < 5"), 3, block=2).collect()
    assert len(few) == 15 and all(r["id"] == r["query_id"] for r in few if r["rank"] == 1)


def test_rescored_neighbours(points):
    raw, df = points
    queries = np.array([raw[i][1] for i in (3, 4)])
    clip = knn.clip_value(df)
    got = knn.top_k_quantised(knn.quantised(df, clip), queries, 5, clip, 4.0)
    truth = knn.top_k(df, queries, 5)
    assert all(r["recall"] >= 0.8 for r in knn.recall(got, truth).collect())
    assert {r["vector_score"] for r in got.collect()} <= {r["vector_score"] for r in knn.top_k(df, queries, 300).collect()}


def test_inverted_file_indexes_every_row_and_recalls(spark, points, tmp_path):
    raw, df = points
    cells = index.fit(df, cells=12)
    index.write(df, cells, f"{tmp_path}/ivf")
    stored = spark.read.parquet(f"{tmp_path}/ivf")
    assert stored.count() == 301
    queries = np.array([raw[i][1] for i in range(0, 300, 30)])
    truth = knn.top_k(df, queries, 10)
    assert knn.recall(index.search(stored, cells, queries, 10, probes=12), truth).agg(F.min("recall")).first()[0] == 1.0
    assert knn.recall(index.search(stored, cells, queries, 10, probes=8), truth).agg(F.avg("recall")).first()[0] >= 0.9
    assert "PartitionFilters: [isnotnull(cell" in index.search(stored, cells, queries[:1], 5, probes=1)._jdf.queryExecution().executedPlan().toString()


def test_rerank_is_stable(spark):
    df = spark.createDataFrame([(0, "q", "q x", 1), (0, "q", "y", 2), (0, "q", "q z", 3)], "qid int, query string, t string, rank int")
    got = models.rerank(df, models.OverlapReranker, F.col("t"), 2).orderBy("rerank_rank").collect()
    assert [(r["t"], r["rerank_rank"]) for r in got] == [("q x", 1), ("q z", 2)]


def test_batches_are_halved_when_memory_runs_out():
    sizes = []

    def call(part):
        sizes.append(len(part))
        if len(part) > 2:
            raise MemoryError
        return part

    assert models.in_batches(call, list(range(9)), 8) == list(range(9)) and sizes[:3] == [8, 4, 2]


def test_unusable_vectors_are_errors(spark):
    good = spark.createDataFrame([("a", [1.0, 0.0]), ("b", None)], "id string, embedding array<float>")
    assert models.check_vectors(good, 2).count() == 2
    for bad in ([0.0, 0.0], [1.0]):
        with pytest.raises(Exception, match="unusable vector for c"):
            models.check_vectors(spark.createDataFrame([("c", bad)], good.schema), 2).collect()


def test_payload_drops_blanks_and_keeps_zero(spark):
    df = spark.createDataFrame([("W1", None, "", 0, False)], "id string, doi string, title string, n int, b boolean")
    payload = projections.to_payload(df)
    assert payload.select(projections.payload_json(payload)).first()[0] == '{"openalex_id":"W1","n":0,"b":false}'


def corpus(spark):
    blank = {c: None for c in schema.WORK_COLUMNS}
    works = [blank | {"id": f"https://x/W{i}", "title": t, "publication_year": y, "primary_location__source__id": s} for i, t, y, s in [(1, "One", "2021", "S1"), (2, "Two", "2020", "S1"), (3, "Three", "2022", None), (4, "Four", "2021", "S1"), (5, "Five", "bad", "S1")]]
    w = spark.createDataFrame([tuple(r[c] for c in schema.WORK_COLUMNS) for r in works], schema.WORKS)
    a = spark.createDataFrame([("W1", '{"b":[1],"a":[0]}'), ("W2", '{"x":[0]}'), ("W3", "{}"), ("W4", None), ("W5", '{"y":[0]}')], schema.ABSTRACTS)
    s = spark.createDataFrame([("S1", "US")], schema.SOURCES)
    return w, a, s


def test_preparation(spark):
    got = prepare.prepare(*corpus(spark), Settings(dim=16), lambda: models.HashingEmbedder(16)).orderBy("id").collect()
    assert [(r["id"], r["country_code"], r["abstract"], r["publication_year"]) for r in got] == [("https://x/W1", "US", "a b", 2021), ("https://x/W3", None, None, 2022)]
    assert len(got[0]["embedding"]) == 16 and got[1]["embedding"] is None
    assert prepare.prepare(*corpus(spark), Settings(attach_country=False)).columns == [c for c in schema.RECORD_COLUMNS if c != "country_code"] + ["abstract"]


@pytest.fixture(scope="module")
def collection(spark):
    texts = ["the green cat sat on the mat", "the green cat sat on the mat", "a blue dog ran far away", "stars and planets in the sky", "green planets far away"]
    rows = [(i, f"p{i}", f"W{i}", t, t, 2020 + i, "US" if i % 2 else "DE") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "vec_id long, point_id string, openalex_id string, title string, abstract string, publication_year int, country_code string")
    return df.withColumn("embedding", models.embed(F.col("abstract"), models.HashingEmbedder))


def test_search_merges_then_cuts(collection):
    found = engine.Engine(collection, models.HashingEmbedder)
    hits = found.search("green cat on the mat", limit=2, rerank=False).orderBy("rank").collect()
    assert hits[0]["openalex_id"] == "W0" and hits[0]["duplicates"] == 2 and len(hits) == 1  # merging shrinks what was fetched
    wide = found.local(engine.SearchRequest(("green cat on the mat",), limit=2, rerank=False)).orderBy("rank").collect()
    assert [r["rank"] for r in wide] == [1, 2] and wide[0]["score"] == wide[0]["vector_score"]
    assert found.search("green cat", limit=5, rerank=False, dedupe=False).count() == 5
    assert [r["openalex_id"] for r in found.search("green", filters=predicates.Filters(country="US"), dedupe=False, rerank=False).collect() if r["publication_year"] % 2 == 0] == []


def test_search_reranks(collection):
    found = engine.Engine(collection, models.HashingEmbedder, models.OverlapReranker)
    hits = found.search_batch(engine.SearchRequest(("blue dog", "planets far"), limit=2, raw=True)).orderBy("qid", "rank").collect()
    assert [(h["qid"], h["rank"]) for h in hits] == [(0, 1), (0, 2), (1, 1), (1, 2)]
    assert hits[0]["openalex_id"] == "W2" and hits[0]["score"] == hits[0]["rerank_score"] == 1.0 and '"openalex_id":"W2"' in hits[0]["payload"]
    assert hits[2]["openalex_id"] == "W4"


def test_keyword_search(collection):
    found = engine.Engine(collection)
    hits = found.keyword(engine.KeywordRequest("GREEN the")).collect()
    assert [(h["openalex_id"], h["duplicates"], h["score"]) for h in hits] == [("W0", 2, None)]
    assert found.keyword(engine.KeywordRequest("far away", phrase=True)).count() == 2
    assert engine.KeywordRequest("x", limit=100).fetch == 500 and engine.KeywordRequest("x", limit=7, dedupe=False).fetch == 7
    assert engine.SearchRequest(("x",), limit=60).fetch == 60 and engine.SearchRequest(("x",), limit=60, rerank=False).fetch == 60 and engine.SearchRequest(("x",)).fetch == 50


def test_telemetry_helpers(spark):
    tree = {"a": [{"segment_type": "plain", "num_points": 3}, {"segment_type": "indexed", "num_points": 9, "num_indexed_vectors": 9}], "b": {"c": 1}}
    got = {r["segment_type"]: (r["segments"], r["points"], r["share"]) for r in stats.segment_rollup(spark.createDataFrame(stats.segments_of(tree))).collect()}
    assert got == {"plain": (1, 3, 0.25), "indexed": (1, 9, 0.75)}
    assert stats.at_path(tree, "b", "c") == 1 and stats.at_path(tree, "b", "x", default=0) == 0
    assert stats.count_of({"count": 4}) == 4 and stats.count_of(5) == 5 and stats.avg_ms({"avg_duration_micros": 1500}) == 1.5 and stats.avg_ms(3) is None
    assert stats.memory_info("MemFree: 12 kB\nbad") == {"MemFree": 12288}
