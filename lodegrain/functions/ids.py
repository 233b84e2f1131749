"""Identifiers, years and part codes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Fixed value: the namespace of URL identifiers in RFC 4122.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def numeric_id(c: Column) -> Column:
    """The number of an id like ``https://host/W123`` or ``W123``; null where there is none.

    Each row is read by itself, and an id that can't be read matches nothing.
    """
    return F.regexp_extract(c.cast("string"), r"^(?:.*/)?[A-Za-z]?([0-9]+)$", 1).try_cast("bigint")


def year_of(c: Column, kind: str = "string") -> Column:
    """A year as bigint: floats are cut, strings must be whole numbers; null floats and bad strings are 0."""
    if kind in ("double", "float"):
        return F.coalesce(F.when(~F.isnan(c), F.floor(F.abs(c)) * F.signum(c)).cast("bigint"), F.lit(0).cast("bigint"))
    if kind == "string":
        return F.when(c.isNotNull(), F.coalesce(F.when(F.trim(c).rlike(r"^[+-]?[0-9]+$"), F.trim(c)).try_cast("bigint"), F.lit(0).cast("bigint")))
    return c.cast("bigint")


def point_id(c: Column) -> Column:
    """UUID version 5 of a URL name, from SHA-1 alone."""
    h = F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), F.encode(c, "UTF-8")))
    variant = F.substring(F.lit("89ab89ab89ab89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") + 1, F.lit(1))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))


def part_code(year: Column, part: Column) -> Column:
    """Year and part as one integer."""
    return (year * 10000 + part).cast("int")


def part_of(code: Column) -> tuple[Column, Column]:
    """(year, part) of a code."""
    return F.floor(code / 10000).cast("int"), (code % 10000).cast("int")


def part_name(year: Column, part: Column) -> Column:
    return F.format_string("%d/part_%04d.jsonl", year.cast("int"), part.cast("int"))
