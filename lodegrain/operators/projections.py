"""Projections: records, payloads, result items and hits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lodegrain import schema
from lodegrain.functions.ids import point_id
from lodegrain.functions.text import clean_text, line_safe


def to_record(works: DataFrame, year: Column, country: Column | None) -> DataFrame:
    """Works as records: fixed columns in order, renamed; the country only where one is given."""
    columns = []
    renamed = {new: old for old, new in schema.RECORD_NAMES.items()}
    for name in schema.RECORD_COLUMNS:
        if name == "publication_year":
            columns.append(year.cast("long").alias(name))
        elif name == "country_code":
            columns += [] if country is None else [country.alias(name)]
        else:
            columns.append(line_safe(F.col(renamed.get(name, name))).alias(name))
    return works.select(*columns)


def blank_to_null(df: DataFrame) -> DataFrame:
    """Empty strings as null; numbers and booleans stay."""
    return df.select(*[F.nullif(F.col(f"`{f.name}`"), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema.fields])


def to_payload(records: DataFrame, key: str = "id", name: str = schema.PAYLOAD_ID) -> DataFrame:
    """Flat payload columns: the id renamed, blanks null."""
    return blank_to_null(records.withColumnRenamed(key, name))


def payload_json(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The payload as JSON without null fields; blanks count as null."""
    chosen = [f for f in df.schema.fields if columns is None or f.name in columns]
    value = lambda f: F.nullif(F.col(f"`{f.name}`"), F.lit("")) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
    return F.to_json(F.struct(*[value(f).alias(f.name) for f in chosen]))


def to_points(payload: DataFrame, vector: str = "embedding", key: str = schema.PAYLOAD_ID) -> DataFrame:
    """(point_id, vector, payload columns): what a collection stores."""
    return payload.select(point_id(F.col(key)).alias("point_id"), vector, *[c for c in payload.columns if c != vector])


def to_items(points: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Result items with cleaned texts and short names; columns that aren't there are null."""
    has = set(points.columns)
    pick = lambda c: F.col(c) if c in has else F.lit(None).cast("string")
    return points.select(
        *keep, pick("openalex_id").alias("openalex_id"), pick("doi").alias("doi"),
        clean_text(pick("title")).alias("title"), clean_text(pick("abstract")).alias("abstract"),
        pick("publication_year").alias("publication_year"),
        pick(schema.FILTER_FIELDS["source"]).alias("source"), pick(schema.FILTER_FIELDS["topic"]).alias("topic"),
        pick(schema.FILTER_FIELDS["field"]).alias("field"), pick(schema.FILTER_FIELDS["country"]).alias("country"), pick("type").alias("type"),
    )


def to_hits(items: DataFrame, rank: str = "rank", raw: bool = False) -> DataFrame:
    """The score is the reranker's, else the vector's; the payload is there only if asked for."""
    has = set(items.columns)
    number = lambda c: F.col(c).cast("double") if c in has else F.lit(None).cast("double")
    payload = F.col("payload") if raw and "payload" in has else F.lit(None).cast("string")
    return items.withColumn("vector_score", number("vector_score")).withColumn("rerank_score", number("rerank_score")).withColumn(
        "score", F.coalesce("rerank_score", "vector_score")
    ).withColumn("duplicates", F.coalesce(F.col("duplicates"), F.lit(1)).cast("int") if "duplicates" in has else F.lit(1)).withColumn("payload", payload).withColumn("rank", F.col(rank).cast("int"))
