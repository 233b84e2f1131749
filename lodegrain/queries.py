"""The library's operators as queries over the driver's tables, with the SQL that gives the same rows.

The tables stand in for a scholarly dump: orders for works, line items for the set of works
that have a text, customers and nations for sources and countries, documents for texts.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from lodegrain import functions, schema
from lodegrain.functions import ids, text, vectors
from lodegrain.operators import dedupe, index, joins, knn, models, predicates, projections, stats
from lodegrain.plans import engine, prepare
from lodegrain.session import scratch
from lodegrain.settings import Settings
from lodegrain.sources import readers, writers
from lodegrain.streaming import incremental

T = readers.table
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
K = 10
YEARS = (1993, 1994, 1995)


def query(sql: str | None = None):
    """Registers a function under its name, with its SQL."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


# Nearest vectors. Queries are the rows whose id is divisible by 100.

_KNN = """
WITH s AS (SELECT q.vec_id AS query_id, p.vec_id AS id, round(list_inner_product(CAST(q.embedding AS DOUBLE[]), CAST(p.embedding AS DOUBLE[])), 6) AS vector_score
  FROM embeddings q, embeddings p WHERE q.vec_id % 100 = 0 {where})
SELECT query_id, id, vector_score, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY vector_score DESC, id) AS r FROM s) WHERE r <= 10
"""


def _every_hundredth(points: DataFrame) -> DataFrame:
    return points.filter(F.col("vec_id") % 100 == 0)


@query(_KNN.format(where=""))
def knn_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = T(spark, sf_dir, "embeddings")
    return knn.top_k_join(points, _every_hundredth(points), K)


@query(_KNN.format(where="AND p.label < 5"))
def knn_filtered_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = T(spark, sf_dir, "embeddings")
    return knn.top_k_join(points, _every_hundredth(points), K, where=F.col("label") < 5)


@query("SELECT round(quantile_cont(abs(x), 0.99), 6) AS clip FROM (SELECT unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings)")
def quantile_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    clip = knn.clip_value(T(spark, sf_dir, "embeddings"), exact=True)
    return spark.createDataFrame([(clip,)], "clip double").select(F.round("clip", 6).alias("clip"))


@query("""
WITH c AS (SELECT quantile_cont(abs(x), 0.99) AS c FROM (SELECT unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings)
), i AS (SELECT vec_id, embedding, list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(greatest(least(x / c, 1.0), -1.0) * 127 + 0.5)) AS e, c FROM embeddings, c
), s AS (SELECT q.vec_id AS query_id, p.vec_id AS id, round(list_inner_product(q.e, p.e) * (q.c / 127) * (q.c / 127), 6) AS rough,
    round(list_inner_product(CAST(q.embedding AS DOUBLE[]), CAST(p.embedding AS DOUBLE[])), 6) AS vector_score FROM i q, i p WHERE q.vec_id % 100 = 0
), o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rough DESC, id) AS n FROM s) WHERE n <= 20)
SELECT query_id, id, vector_score, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY vector_score DESC, id) AS r FROM o) WHERE r <= 10
""")
def quantised_rescore_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = T(spark, sf_dir, "embeddings")
    clip = knn.clip_value(points, exact=True)
    return knn.top_k_join(knn.quantised(points, clip), _every_hundredth(points), K, search=lambda p, q, k, **o: knn.top_k_quantised(p, q, k, clip, 2.0, True, **o))


@query()
def ann_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The inverted file's recall against the exact result, for each query, at the engine's default width."""
    points = T(spark, sf_dir, "embeddings")
    cells = index.fit(points, spill=3)
    indexed = index.assign(points, cells)
    found = engine.Engine(indexed, cells=cells)
    search = lambda p, q, k, **o: found.candidates(q, engine.SearchRequest(("",) * len(q), limit=k, rerank=False))
    rename = lambda d: d.withColumnRenamed("query_id", "qid")
    return knn.recall(rename(knn.top_k_join(indexed, _every_hundredth(points), K, search=search)), rename(knn.top_k_join(points, _every_hundredth(points), K)))


@query("""
SELECT vec_id, round(sqrt(list_sum(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * x))), 5) AS size, round(CAST(embedding[1] AS DOUBLE), 5) AS first,
  len(list_filter(embedding, lambda x: x <> 0)) = 0 AS is_zero FROM embeddings
""")
def vector_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("embedding")
    return T(spark, sf_dir, "embeddings").select("vec_id", F.round(vectors.norm(v), 5).alias("size"), F.round(F.get(v, F.lit(0)).cast("double"), 5).alias("first"), vectors.is_zero(v).alias("is_zero"))


# Documents: keys, keywords, hits.

_ASCII = "trim(regexp_replace(lower(coalesce(text, '')), '[^0-9a-z가-힣]+', ' ', 'g'))"


@query(f"""
WITH k AS (SELECT doc_id, {_ASCII} AS n FROM documents
), t AS (SELECT doc_id, CASE WHEN length(n) >= 12 THEN 't:' || n WHEN length(n) > 0 THEN 'a:' || left(n, 200) ELSE 'i:' || doc_id END AS key FROM k)
SELECT min(doc_id) AS doc_id, sha256(key) AS key, CAST(count(*) AS INTEGER) AS duplicates FROM t GROUP BY key
""")
def dedupe_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies by the whole normalised text as title; keys are compared by their digests, which are what is shuffled."""
    docs = T(spark, sf_dir, "documents").select("doc_id", text.normalise_ascii(F.col("text")).alias("n"))
    items = docs.select("doc_id", F.sha2(text.duplicate_key(F.col("n"), F.col("n"), F.col("doc_id")), 256).alias("key"))
    return dedupe.dedupe(items, F.col("key"), [F.col("doc_id")])


_TOKENS = "list_filter(regexp_split_to_array(lower(coalesce({c}, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"


@query(f"SELECT doc_id FROM (SELECT doc_id, {_TOKENS.format(c='text')} AS t FROM documents) WHERE list_contains(t, 'the') AND list_contains(t, 'of')")
def keyword_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicates.keyword_filter(T(spark, sf_dir, "documents"), "The OF", "text").select("doc_id")


@query(f"SELECT doc_id FROM (SELECT doc_id, {_TOKENS.format(c='text')} AS t FROM documents) WHERE contains(' ' || array_to_string(t, ' ') || ' ', ' of the ')")
def keyword_phrase(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicates.keyword_filter(T(spark, sf_dir, "documents"), "of, the", "text", phrase=True).select("doc_id")


@query("SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'red') ")
def keyword_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T(spark, sf_dir, "part").filter(F.lower("p_name").contains("red")).select("p_partkey", "p_name")


@query("""
WITH h AS (SELECT doc_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(CAST(doc_id AS VARCHAR))) AS h FROM documents)
SELECT doc_id, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || substr('89ab89ab89ab89ab', CAST(('0x' || h[17:17])::INTEGER + 1 AS INTEGER), 1) || h[18:20] || '-' || h[21:32] AS point_id FROM h
""")
def point_id_uuid5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T(spark, sf_dir, "documents").select("doc_id", ids.point_id(F.col("doc_id").cast("string")).alias("point_id"))


@query("SELECT doc_id, nullif(trim(regexp_replace(text, '\\s+', ' ', 'g')), '') AS text FROM documents")
def invert_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each text as an inverted index and back."""
    docs = T(spark, sf_dir, "documents").withColumn("value", text.text_to_inverted(F.col("text")))
    return docs.select("doc_id", text.inverted_to_text(F.col("value")).alias("text"))


@query("SELECT doc_id, left(regexp_replace(text, '[  ]', ' ', 'g'), 300) || CASE WHEN length(text) > 300 THEN ' ...' ELSE '' END AS shown, length(text) > 300 AS was_cut FROM documents")
def shown_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T(spark, sf_dir, "documents").select("doc_id", text.shown(text.line_safe(F.col("text"))).alias("shown"), (F.length("text") > 300).alias("was_cut"))


@query("""
SELECT doc_id, CAST(row_number() OVER (ORDER BY n_chars DESC, doc_id) AS INTEGER) AS rank, CAST(n_chars AS DOUBLE) AS score, trim(coalesce(source, '') || chr(10) || coalesce(lang, '')) AS body
FROM documents WHERE lang = 'en' QUALIFY rank <= 20
""")
def hit_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report of the longest documents with rank, score and the reranker's text."""
    docs = T(spark, sf_dir, "documents").filter(predicates.Filters(type="en").condition({"type": "lang"}, "n_chars"))
    top = docs.orderBy(F.desc("n_chars"), "doc_id").limit(20).withColumn("qid", F.lit(0))
    items = dedupe.ranked(top, [F.desc("n_chars"), F.col("doc_id")], ["qid"]).withColumn("vector_score", F.col("n_chars").cast("double"))
    return projections.to_hits(items).select("doc_id", "rank", "score", text.rerank_text(F.col("source"), F.col("lang")).alias("body"))


@query("SELECT lang AS type, source, doc_id AS openalex_id FROM documents WHERE lang = 'de' AND n_chars >= 500 AND n_chars <= 2000")
def search_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = predicates.Filters(type="de", country="", year_from=500, year_to=2000).condition({"type": "lang", "country": "source"}, "n_chars")
    return T(spark, sf_dir, "documents").filter(where).select(F.col("lang").alias("type"), "source", F.col("doc_id").alias("openalex_id"))


@query()
def clean_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T(spark, sf_dir, "pages").select("page_id", text.clean_text(F.regexp_replace("html", "<[^>]*>", " ")).alias("text"))


@query()
def normalised_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies merged by the full normaliser; the whole text is the title."""
    docs = T(spark, sf_dir, "documents").select("doc_id", text.normalise(F.col("text")).alias("n"))
    items = docs.select("doc_id", text.duplicate_key(F.col("n"), F.col("n"), F.col("doc_id")).alias("key"))
    return dedupe.dedupe_documents(items.select("doc_id", F.sha2("key", 256).alias("key")), [F.col("doc_id")], key=F.col("key")).select("doc_id", "duplicates")


@query()
def embed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = T(spark, sf_dir, "documents").withColumn("embedding", models.embed(F.col("text"), models.HashingEmbedder))
    return models.check_vectors(docs, 64, key="doc_id").select("doc_id", "embedding")


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as points of a collection, with vectors of the stand-in embedder."""
    docs = T(spark, sf_dir, "documents")
    payload = docs.select(
        F.col("doc_id").alias("vec_id"), ids.point_id(F.col("doc_id").cast("string")).alias("point_id"), F.col("doc_id").cast("string").alias("openalex_id"),
        F.substring_index("text", ".", 1).alias("title"), F.col("text").alias("abstract"), F.col("n_chars").alias("publication_year"),
        F.col("source").alias("primary_location__source__display_name"), F.col("lang").alias("type"),
    )
    return payload.withColumn("embedding", models.embed(F.col("abstract"), models.HashingEmbedder))


@query()
def search_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two queries by meaning: candidates, merging, reranking."""
    found = engine.Engine(_points(spark, sf_dir), models.HashingEmbedder, models.OverlapReranker)
    request = engine.SearchRequest(("the station of that time", "que los de la"), limit=10, candidates=50)
    return found.search_batch(request).select("qid", "rank", "openalex_id", "score", "duplicates")


@query()
def search_keyword(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = engine.Engine(_points(spark, sf_dir))
    return found.keyword(engine.KeywordRequest("the of", limit=20)).select("rank", "openalex_id", "title", "duplicates")


# Preparation: semi-join, lookup, fill, shards.

_DATED = "SELECT *, CAST(year(o_orderdate) AS BIGINT) AS y FROM orders WHERE year(o_orderdate) IN (1993, 1994, 1995)"


@query(f"""
SELECT y AS year, n_name AS country, count(*) AS works FROM ({_DATED}) o LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY ALL
""")
def prepare_semi_lookup_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    year = F.year("o_orderdate").cast("long")
    works = T(spark, sf_dir, "orders").filter(predicates.in_years(F.year("o_orderdate"), YEARS)).select(F.col("o_orderkey").alias("id64"), F.col("o_custkey"), year.alias("year"))
    kept = joins.only_in(works, T(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id64")))
    lookup = T(spark, sf_dir, "customer").join(joins.small(T(spark, sf_dir, "nation"), 1000), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("o_custkey"), F.col("n_name").alias("country"))
    return kept.join(lookup, "o_custkey", "left").groupBy("year", "country").agg(F.count("*").alias("works"))


@query("""
SELECT count(*) AS total, count(t) AS filled, count(*) - count(t) AS unfilled FROM orders
LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS t FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) ON o_orderkey = l_orderkey
""")
def fill_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = T(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("id64"), F.col("l_shipdate").cast("string").alias("abstract"))
    return stats.fill_stats(joins.attach_text(T(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "id64"), texts))


@query("""
WITH n AS (SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, row_number() OVER (PARTITION BY year(o_orderdate) ORDER BY o_orderkey) - 1 AS r FROM orders)
SELECT o_orderkey, year, CAST(r // 500 AS INTEGER) AS part, CAST(year * 10000 + r // 500 AS INTEGER) AS code, printf('%d/part_%04d.jsonl', year, CAST(r // 500 AS INTEGER)) AS path FROM n
""")
def part_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = T(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"))
    parted = writers.with_parts(orders, 500, "year", "o_orderkey")
    return parted.select("o_orderkey", "year", "part", "code", ids.part_name(F.col("year"), F.col("part")).alias("path"))


@query("""
SELECT o_orderkey, o_orderkey AS id64, CAST(NULL AS BIGINT) AS bad, CAST(year(o_orderdate) AS BIGINT) AS from_text, CAST(trunc(o_totalprice) AS BIGINT) AS from_float, CAST(0 AS BIGINT) AS from_word FROM orders
""")
def parse_id_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = T(spark, sf_dir, "orders")
    url = F.concat(F.lit("https://host/W"), F.col("o_orderkey").cast("string"))
    return orders.select(
        "o_orderkey", ids.numeric_id(url).alias("id64"), ids.numeric_id(F.concat(url, F.lit("x"))).alias("bad"),
        ids.year_of(F.year("o_orderdate").cast("string")).alias("from_text"), ids.year_of(F.col("o_totalprice"), "double").alias("from_float"), ids.year_of(F.col("o_orderpriority")).alias("from_word"),
    )


@query("SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY 1")
def still_to_do(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = T(spark, sf_dir, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return incremental.still_to_do(T(spark, sf_dir, "lineitem"), done, "l_orderkey").groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("""
WITH a AS (SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) - 1 AS n FROM customer), b AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS n FROM supplier)
SELECT c_custkey, c_name, s_suppkey FROM a JOIN b USING (n)
""")
def positional_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    left, right = T(spark, sf_dir, "customer").select("c_custkey", "c_name"), T(spark, sf_dir, "supplier").select("s_suppkey")
    return joins.zip_by_position(left, right, "c_custkey", "s_suppkey")


@query("SELECT c_nationkey, min(c_custkey) AS c_custkey, arg_min(c_mktsegment, c_custkey) AS c_mktsegment FROM customer GROUP BY 1")
def lookup_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joins.first_by(T(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", "c_mktsegment"), "c_nationkey", [F.col("c_custkey")])


@query("""
WITH a AS (SELECT l_orderkey, string_agg(t, ' ' ORDER BY l_linenumber, t) AS abstract FROM (SELECT DISTINCT l_orderkey, l_linenumber, 'k' || l_partkey || '_' || l_linenumber AS t FROM lineitem) GROUP BY 1)
SELECT 'https://host/W' || o_orderkey AS id, o_orderpriority AS title, CAST(year(o_orderdate) AS BIGINT) AS publication_year, left(n_name, 8) AS country_code, abstract
FROM orders JOIN a ON l_orderkey = o_orderkey LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey WHERE year(o_orderdate) IN (1993, 1994, 1995)
""")
def prepare_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole preparation path: years, semi-join, country, texts rebuilt from inverted indexes."""
    orders, nations = T(spark, sf_dir, "orders"), joins.small(T(spark, sf_dir, "nation"), 1000)
    given = {"id": F.concat(F.lit("https://host/W"), "o_orderkey"), "title": F.col("o_orderpriority"), "publication_year": F.year("o_orderdate").cast("string"), "primary_location__source__id": F.concat(F.lit("S"), "o_custkey")}
    works = orders.select(*[given.get(c, F.lit(None).cast("string")).cast("string").alias(c) for c in schema.WORK_COLUMNS])
    sources = T(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("S"), "c_custkey").alias("id"), F.col("n_name").alias("country_code"))
    token = F.concat(F.lit("k"), "l_partkey", F.lit("_"), "l_linenumber")
    index = T(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.to_json(F.map_from_entries(F.array_sort(F.collect_set(F.struct(token, F.array("l_linenumber")))))).alias("value"))
    abstracts = index.select(F.concat(F.lit("W"), "l_orderkey").alias("id"), "value")
    made = prepare.prepare(works, abstracts, sources, Settings(years=YEARS))
    return made.select("id", "title", "publication_year", "country_code", "abstract")


@query("SELECT vec_id, label FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r FROM embeddings) WHERE r <= 8")
def first_rows_per_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row limit of 5 for each part, rounded up to batches of 4."""
    return joins.first_rows(T(spark, sf_dir, "embeddings").select("vec_id", "label"), 5, "vec_id", ("label",), 4)


@query("SELECT o_orderkey, o_orderkey AS id64, lower(o_orderpriority) AS lowered FROM orders")
def registered_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    functions.register(spark)
    T(spark, sf_dir, "orders").createOrReplaceTempView("orders_view")
    return spark.sql("SELECT o_orderkey, numeric_id(concat('https://host/W', o_orderkey)) AS id64, lower(html_unescape(o_orderpriority)) AS lowered FROM orders_view")


# Payloads, batches, counters.


@query("""
SELECT event_type, count(*) AS rows, round(sum(CAST(json_extract_string(props, '$.k') AS DOUBLE)), 4) AS total FROM events GROUP BY 1
""")
def payload_json_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "map<string,string>")
    return T(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("rows"), F.round(F.sum(F.element_at(props, "k").try_cast("double")), 4).alias("total"))


@query("SELECT c_custkey AS openalex_id, nullif(c_name, '') AS c_name, c_nationkey, c_acctbal, nullif(c_mktsegment, '') AS c_mktsegment FROM customer")
def payload_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.to_payload(T(spark, sf_dir, "customer"), "c_custkey")


@query("SELECT user_id, arg_max(event_id, ts) AS event_id, arg_max(value, ts) AS value FROM (SELECT user_id, event_id, value, struct_pack(a := ts, b := event_id) AS ts FROM events) GROUP BY 1")
def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest row of each key."""
    return incremental.latest(T(spark, sf_dir, "events").select("user_id", "event_id", "value", "ts"), "user_id", [F.col("ts"), F.col("event_id")]).select("user_id", "event_id", "value")


@query("SELECT user_id AS point_id, arg_max(event_id, struct_pack(h := event_id % 3, t := event_id)) AS event_id FROM events GROUP BY 1")
def collection_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three commits to a collection, the second compacted with the first; the latest commit wins for a key."""
    held = writers.Collection(spark, scratch(spark, "collection"), dim=1)
    rows = T(spark, sf_dir, "events").select("user_id", "event_id")
    for k in range(3):
        part = rows.filter(F.col("event_id") % 3 == k).groupBy("user_id").agg(F.max("event_id").alias("event_id"))
        held.upsert(part.select(F.col("user_id").alias("point_id"), "event_id", F.array(F.lit(1.0)).alias("embedding")))
        if k == 1:
            held.compact()
    return held.read().select("point_id", "event_id")


@query("""
SELECT event_id, round(value - lag(value) OVER w, 6) + 0.0 AS delta, CASE WHEN epoch(ts) - epoch(lag(ts) OVER w) > 0 THEN round((value - lag(value) OVER w) / (epoch(ts) - epoch(lag(ts) OVER w)), 6) + 0.0 END AS rate
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def counter_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = stats.counter_rate(T(spark, sf_dir, "events"), "value", F.col("ts"), ["user_id"], "event_id")
    return rated.select("event_id", (F.round("delta", 6) + 0.0).alias("delta"), (F.round("rate", 6) + 0.0).alias("rate"))


@query("""
SELECT event_type AS segment_type, count(*) AS segments, CAST(sum(user_id) AS BIGINT) AS points, CAST(sum(event_id) AS BIGINT) AS indexed, round(sum(user_id) / (SELECT sum(user_id) FROM events), 6) AS share FROM events GROUP BY 1
""")
def segment_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T(spark, sf_dir, "events").select(F.col("event_type").alias("segment_type"), F.col("user_id").alias("num_points"), F.col("event_id").alias("num_indexed_vectors"))
    return stats.segment_rollup(rows).withColumn("share", F.round("share", 6))


@query("SELECT event_type AS path, 'other' AS kind, CAST(sum(user_id) AS BIGINT) AS calls, round(avg(CASE WHEN value > 0 THEN value END), 6) AS avg_ms FROM events GROUP BY 1")
def path_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = T(spark, sf_dir, "events").select(F.col("event_type").alias("path"), F.col("user_id").alias("count"), F.col("value").alias("avg_ms"))
    return stats.path_counters(rows).withColumn("avg_ms", F.round("avg_ms", 6))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def state_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.histogram(T(spark, sf_dir, "events"), "event_type")


@query("SELECT p_partkey, p_name, p_brand FROM part WHERE p_size > 10 ORDER BY p_partkey LIMIT 50")
def scroll(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.scroll(T(spark, sf_dir, "part"), F.col("p_size") > 10, 50, "p_partkey", "embedding").select("p_partkey", "p_name", "p_brand")


@query("""
WITH s AS (SELECT lang AS qid, doc_id, n_chars % 7 AS score, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS before FROM documents)
SELECT qid, doc_id, CAST(score AS DOUBLE) AS rerank_score, CAST(r AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, before) AS r FROM s) WHERE r <= 20
""")
def rerank_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top 20 of each language by a score with many ties, which keep their order."""
    docs = T(spark, sf_dir, "documents").select(F.coalesce("lang", F.lit("")).alias("query"), F.col("lang").alias("qid"), "doc_id", (F.col("n_chars") % 7).cast("string").alias("body"))
    found = models.rerank(docs, lambda: _NumberReranker(), F.col("body"), 20, before="doc_id")
    return found.select("qid", "doc_id", "rerank_score", F.col("rerank_rank").cast("int").alias("rank"))


class _NumberReranker:
    """The text's own number as score: many ties."""

    def score(self, pairs: list[tuple[str, str]]) -> list[float]:
        return [float(text) for _, text in pairs]


@query("SELECT lang, count(*) AS candidates, count(DISTINCT text) AS kept, count(*) - count(DISTINCT text) AS removed FROM documents WHERE text IS NOT NULL GROUP BY 1")
def removed_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = T(spark, sf_dir, "documents").filter("text is not null").select("lang", "doc_id", F.sha2("text", 256).alias("key"))
    return dedupe.removed(docs, dedupe.dedupe(docs, F.col("key"), [F.col("doc_id")], ["lang"]), "lang")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact nearest points of every hundredth one."""
    return knn_exact_topk(spark, sf_dir)
