"""Filters: years, search requests, title matches, request validation."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lodegrain import schema
from lodegrain.functions.text import tokens

# The ranges that requests are held to.
LIMITS = {"limit": (1, 200), "candidates": (1, 1000), "hnsw_ef": (16, 1024), "oversampling": (1.0, 10.0)}
QUERY_CHARS, KEYWORD_CHARS, BATCH_QUERIES = 4000, 500, 32


def in_years(year: Column, years: Iterable[int]) -> Column:
    """Membership; a null year is not a member."""
    return F.coalesce(year.isin(*years), F.lit(False))


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


@dataclass(frozen=True)
class Filters:
    """Optional equalities and a year range; 0 and "" count as not given.

    ``year``, where given, takes the place of the range.
    """

    year_from: int | None = None
    year_to: int | None = None
    field: str | None = None
    subfield: str | None = None
    domain: str | None = None
    topic: str | None = None
    source: str | None = None
    type: str | None = None
    country: str | None = None
    year: int | None = None

    def condition(self, names: dict[str, str] | None = None, year_column: str = "publication_year") -> Column:
        """The filter as one Column, which Catalyst pushes to the scan."""
        out = [F.col(column) == getattr(self, key) for key, column in (names or schema.FILTER_FIELDS).items() if getattr(self, key)]
        year = F.col(year_column)
        if self.year:
            out.append(year == self.year)
        else:
            out += [year >= self.year_from] if self.year_from else []
            out += [year <= self.year_to] if self.year_to else []
        return all_of(out)


def matches_tokens(doc_tokens: Column, text: str) -> Column:
    """All tokens of ``text`` occur; none in ``text`` matches nothing."""
    wanted = query_tokens(text)
    return all_of(F.array_contains(doc_tokens, w) for w in wanted) if wanted else F.lit(False)


def matches_phrase(doc_tokens: Column, text: str) -> Column:
    """The tokens of ``text`` occur next to each other in order."""
    wanted = query_tokens(text)
    return F.contains(F.concat(F.lit(" "), F.array_join(doc_tokens, " "), F.lit(" ")), F.lit(f" {' '.join(wanted)} ")) if wanted else F.lit(False)


def query_tokens(text: str) -> list[str]:
    """The tokens of a short text, as ``functions.text.tokens`` gives them for a column."""
    words, word = [], ""
    for ch in text.lower() + " ":
        if ch.isalpha() or ch.isnumeric():
            word += ch
        elif word:
            words.append(word)
            word = ""
    return words


def keyword_filter(df: DataFrame, text: str, column: str = "title", phrase: bool = False) -> DataFrame:
    return df.filter((matches_phrase if phrase else matches_tokens)(tokens(F.col(column)), text))


def check(name: str, value):
    """A request's number, if it is within the range for its name."""
    low, high = LIMITS[name]
    if not low <= value <= high:
        raise ValueError(f"{name} must be within {low} .. {high}, not {value}")
    return value


def check_queries(queries: list[str], most: int = BATCH_QUERIES, chars: int = QUERY_CHARS) -> list[str]:
    if not 1 <= len(queries) <= most:
        raise ValueError(f"1 to {most} queries are taken, not {len(queries)}")
    for q in queries:
        if not 1 <= len(q) <= chars:
            raise ValueError(f"a query has 1 to {chars} characters, not {len(q)}")
    return queries
