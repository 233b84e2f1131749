"""Scalar functions as Column builders, and their registration for SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from lodegrain.functions.ids import *  # noqa: F403
from lodegrain.functions.text import *  # noqa: F403
from lodegrain.functions.vectors import *  # noqa: F403

# SQL bodies of the functions that need no Python.
_SQL = {
    "numeric_id": ("id string", "bigint", r"try_cast(regexp_extract(id, '^(?:.*/)?[A-Za-z]?([0-9]+)$', 1) as bigint)"),
    "dot_product": ("a array<double>, b array<double>", "double", "aggregate(zip_with(a, b, (x, y) -> x * y), 0D, (s, x) -> s + x)"),
    "normalise_ascii": ("t string", "string", "trim(regexp_replace(lower(coalesce(t, '')), '[^0-9a-z가-힣]+', ' '))"),
    "line_safe": ("t string", "string", r"regexp_replace(t, '[\\u2028\\u2029]', ' ')"),
    "part_code": ("year int, part int", "int", "year * 10000 + part"),
}


def register(spark: SparkSession) -> list[str]:
    """Make functions known to ``spark.sql``; those with SQL bodies stay visible to the optimizer."""
    from lodegrain.functions import text
    from lodegrain.session import ship

    ship(spark)
    for name, (arguments, kind, body) in _SQL.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {body}")
    spark.udf.register("html_unescape", text._unescape)
    spark.udf.register("compatible_lower", text._compatible)
    return [*_SQL, "html_unescape", "compatible_lower"]
