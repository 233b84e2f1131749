"""Counts and rollups of the preparation path and of operating counters."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window, functions as F


def per_year(df: DataFrame, year: str = "publication_year") -> DataFrame:
    """Rows of each year."""
    return df.groupBy(year).agg(F.count("*").alias("rows"))


def fill_stats(df: DataFrame, column: str = "abstract") -> DataFrame:
    """Rows, and how many have the column filled."""
    return df.agg(F.count("*").alias("total"), F.count(column).alias("filled"), (F.count("*") - F.count(column)).alias("unfilled"))


def embed_stats(df: DataFrame, vector: str = "embedding") -> DataFrame:
    return df.agg(F.count(vector).alias("embedded"), F.sum(F.when(F.col(vector).isNull(), 1).otherwise(0)).alias("empty"))


def load_stats(points: DataFrame, ready: DataFrame, key: str) -> DataFrame:
    """How many rows were ready, how many of them are stored, and how many aren't."""
    marked = ready.select(key).join(points.select(key).distinct().withColumn("__in", F.lit(True)), key, "left")
    return marked.agg(F.count("*").alias("ready"), F.count("__in").alias("posted"), (F.count("*") - F.count("__in")).alias("skipped"))


def segment_rollup(segments: DataFrame) -> DataFrame:
    """By segment type: segments, points, indexed vectors, and the share of all points."""
    own = segments.groupBy("segment_type").agg(F.count("*").alias("segments"), F.sum("num_points").alias("points"), F.sum("num_indexed_vectors").alias("indexed"))
    return own.withColumn("share", F.col("points") / F.sum("points").over(Window.partitionBy()))


def path_counters(counters: DataFrame) -> DataFrame:
    """By search path: calls, mean of the positive average durations, and whether it used the index or scanned."""
    low = F.lower("path")
    kind = F.when(low.contains("hnsw") | low.contains("large_cardinality"), "graph").when(low.contains("plain") | low.contains("exact"), "scan").otherwise("other")
    return counters.groupBy("path", kind.alias("kind")).agg(F.sum("count").alias("calls"), F.avg(F.when(F.col("avg_ms") > 0, F.col("avg_ms"))).alias("avg_ms"))


def histogram(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def counter_rate(df: DataFrame, value: str, at: Column, by: list[str], tie: str) -> DataFrame:
    """Adds ``delta`` and ``rate`` a second against the row before, for each counter."""
    w = Window.partitionBy(*by).orderBy(at, tie)
    seconds = at.cast("timestamp").cast("double") - F.lag(at).over(w).cast("timestamp").cast("double")
    delta = F.col(value) - F.lag(value).over(w)
    return df.withColumn("delta", delta).withColumn("rate", F.when(seconds > 0, delta / seconds))


def find_nodes(tree, wanted: Callable[[dict], bool]) -> Iterator[dict]:
    """Every object in nested JSON that ``wanted`` accepts, outermost first."""
    todo = [tree]
    while todo:
        node = todo.pop()
        if isinstance(node, dict):
            if wanted(node):
                yield node
            todo.extend(reversed(list(node.values())))
        elif isinstance(node, list):
            todo.extend(reversed(node))


def at_path(tree, *keys, default=None):
    """What nested keys lead to, or the default."""
    for key in keys:
        if not isinstance(tree, dict) or key not in tree:
            return default
        tree = tree[key]
    return tree


def count_of(value) -> int:
    """The count of a counter given as a number or as an object."""
    return int((value.get("count") or 0) if isinstance(value, dict) else value or 0)


def avg_ms(value) -> float | None:
    """The mean duration of a counter in milliseconds, where it has one."""
    if not isinstance(value, dict) or value.get("avg_duration_micros") is None:
        return None
    return float(value["avg_duration_micros"]) / 1000


def segments_of(telemetry: dict | str) -> list[dict]:
    """The segment records in a telemetry document."""
    tree = json.loads(telemetry) if isinstance(telemetry, str) else telemetry
    return [{"segment_type": str(n.get("segment_type", "?")), "num_points": int(n.get("num_points") or 0), "num_indexed_vectors": int(n.get("num_indexed_vectors") or 0)} for n in find_nodes(tree, lambda n: "segment_type" in n or "num_indexed_vectors" in n)]


def memory_info(text: str) -> dict[str, int]:
    """``name: value kB`` lines as bytes by name."""
    out = {}
    for line in text.splitlines():
        name, colon, rest = line.partition(":")
        number = rest.split()[:1]
        if colon and number and number[0].isdigit():
            out[name.strip()] = int(number[0]) * (1024 if "kB" in rest else 1)
    return out
