"""Joins of the preparation path.

Ids that can't be read are null and match nothing. Which side is broadcast is left to
Catalyst's statistics; ``small`` broadcasts a side only after its rows were counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lodegrain.functions.ids import numeric_id


def small(df: DataFrame, most: int) -> DataFrame:
    """The table with a broadcast hint if it has at most ``most`` rows, else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def with_number(df: DataFrame, column: str = "id", name: str = "id64") -> DataFrame:
    return df.withColumn(name, numeric_id(F.col(column)))


def only_in(left: DataFrame, right: DataFrame, key: str = "id64") -> DataFrame:
    """Rows of ``left`` whose key occurs in ``right``."""
    return left.join(right.select(key), key, "left_semi")


def not_in(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key doesn't occur in ``right``: what is still to do."""
    return left.join(right.select(key), key, "left_anti")


def first_by(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """One row of each key, the first in order. Partial aggregation comes before the shuffle."""
    names = df.columns
    ranked = df.withColumn("__o", F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]))
    return ranked.groupBy(key).agg(F.min_by(F.struct(*names), "__o").alias("__r")).select("__r.*")


def country_lookup(sources: DataFrame, file_order: Column | None = None) -> DataFrame:
    """(source64, country) with one row for each source: the first by file order, then by code.

    Blank countries are null and codes are cut to 8 characters.
    """
    order = [file_order] if file_order is not None else []
    code = F.nullif(F.substring("country_code", 1, 8), F.lit(""))
    rows = sources.select(numeric_id(F.col("id")).alias("source64"), code.alias("country"), *[o.alias("__file") for o in order]).filter("source64 is not null")
    by = ([F.col("__file")] if order else []) + [F.col("country").isNull(), F.col("country")]
    return first_by(rows, "source64", by).select("source64", "country")


def attach_country(works: DataFrame, lookup: DataFrame, source_column: str = "primary_location__source__id", most: int = 2_000_000) -> DataFrame:
    """Adds ``country`` by the source; works without a known source keep null."""
    keyed = works.withColumn("source64", numeric_id(F.col(source_column)))
    return keyed.join(small(lookup, most), "source64", "left").drop("source64")


def attach_text(works: DataFrame, texts: DataFrame, key: str = "id64", name: str = "abstract") -> DataFrame:
    """Adds the text of each id; rows that repeat an id all get it, rows without one keep null.

    Of several texts for an id the longest is taken, and of equally long ones the first in order; null is the last.
    """
    one = first_by(texts.select(key, name), key, [F.col(name).isNull(), -F.length(name), F.col(name)])
    return works.join(one, key, "left")


def zip_by_position(left: DataFrame, right: DataFrame, order_left: str, order_right: str) -> DataFrame:
    """Row N with row N, where both give their order by a column; unequal sizes leave rows out of the join.

    Numbers come from counts of ordered ranges, not from one global window.
    """
    return numbered(left, order_left, "__n").join(numbered(right, order_right, "__n"), "__n").drop("__n")


def numbered(df: DataFrame, order: str, name: str, by: tuple[str, ...] = (), tie: tuple[str, ...] = ()) -> DataFrame:
    """Adds 0, 1, ... in the order of a numeric column, for each group of ``by``.

    Rows are dealt into ranges of the column; each range numbers its own rows and adds the
    sizes of the ranges before. So neither a group nor the whole meets in one task.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The bounds are values, so that every evaluation deals rows alike.
    bounds = sorted(set(df.stat.approxQuantile(order, [i / parts for i in range(1, parts)], 0.001))) if parts > 1 else []
    piece = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: F.col(order) > b)) if bounds else F.lit(0)
    dealt = df.withColumn("__piece", piece)
    sizes = Window.partitionBy(*by).orderBy("__piece") if by else Window.orderBy("__piece")
    before = dealt.groupBy(*by, "__piece").count().withColumn("__before", F.sum("count").over(sizes) - F.col("count")).drop("count")
    within = F.row_number().over(Window.partitionBy(*by, "__piece").orderBy(order, *tie)) - 1
    return dealt.withColumn("__within", within).join(before, [*by, "__piece"]).withColumn(name, F.col("__within") + F.col("__before")).drop("__piece", "__within", "__before")


def first_rows(df: DataFrame, n: int, order: str, by: tuple[str, ...] = (), batch: int = 1) -> DataFrame:
    """At most ``n`` rows of each group in order, rounded up to whole batches."""
    most = -(-n // batch) * batch
    return numbered(df, order, "__row", by).filter(F.col("__row") < most).drop("__row")
