"""Merging copies by key: the first is kept, with the number of copies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodegrain.functions.text import duplicate_key, normalise


def dedupe(items: DataFrame, key: Column, order: list[Column], within: list[str] | None = None, count: str = "duplicates") -> DataFrame:
    """Of each key (in each query, where ``within`` names its columns) the first row in order, with a count.

    Rows without a key are never merged. Counts and first rows come from one aggregation
    with partial sums before the shuffle, so a key that many rows share is no burden.
    """
    names = items.columns
    alone = F.when(F.col("__key").isNull(), F.monotonically_increasing_id())
    marked = items.withColumns({"__key": key, "__o": F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])}).withColumn("__alone", alone)
    grouped = marked.groupBy(*(within or []), "__key", "__alone").agg(F.min_by(F.struct(*names), "__o").alias("__first"), F.count("*").cast("int").alias(count))
    return grouped.select("__first.*", count)


def document_key(title: str = "title", abstract: str = "abstract", own: str = "openalex_id") -> Column:
    """The default key: normalised title, else the abstract's beginning, else the id."""
    return duplicate_key(normalise(F.col(title)), normalise(F.col(abstract)), F.col(own))


def dedupe_documents(items: DataFrame, order: list[Column], within: list[str] | None = None, key: Column | Callable[[DataFrame], Column] | None = None) -> DataFrame:
    """``dedupe`` with the default key, another Column, or a function of the items that gives one.

    Keys may be whole texts, so their digests are what is compared and shuffled.
    """
    chosen = document_key() if key is None else key(items) if callable(key) else key
    return dedupe(items, F.sha2(chosen.cast("string"), 256), order, within)


def removed(before: DataFrame, after: DataFrame, by: str) -> DataFrame:
    """(query, candidates, kept, removed): how many rows merging took from each query."""
    a = before.groupBy(by).agg(F.count("*").alias("candidates"))
    b = after.groupBy(by).agg(F.count("*").alias("kept"))
    return a.join(b, by, "left").select(by, "candidates", F.coalesce("kept", F.lit(0)).alias("kept"), (F.col("candidates") - F.coalesce("kept", F.lit(0))).alias("removed"))


def ranked(items: DataFrame, order: list[Column], within: list[str], name: str = "rank") -> DataFrame:
    """Adds 1, 2, ... in order, for each query."""
    return items.withColumn(name, F.row_number().over(Window.partitionBy(*within).orderBy(*order)))
