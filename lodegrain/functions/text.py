"""Text: inverted indexes, cleaning, normalising, keys, tokens."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from lodegrain.session import ship

#: White space as Python's ``str.split`` sees it.
SPACE = r"(?U)[\s\x1c-\x1f]+"
#: Fixed value: what normalising replaces by a space.
OUTSIDE = "[^0-9a-z가-힣]+"
KEY_TITLE, KEY_ABSTRACT = 12, 200
POSITIONS = "map<string,array<int>>"


def inverted_to_text(index: Column, max_chars: int | None = None) -> Column:
    """The text of a ``map<token, positions>``: tokens by position, in map order where positions tie; empty is null."""
    place = lambda p, i, j, t: F.struct(p.alias("p"), i.alias("i"), j.alias("j"), t.alias("t"))
    spread = lambda e, i: F.transform(F.coalesce(e["value"], F.array().cast("array<int>")), lambda p, j: place(p, i, j, e["key"]))
    placed = F.filter(F.flatten(F.transform(F.map_entries(index), spread)), lambda x: x["p"].isNotNull())
    text = F.array_join(F.transform(F.sort_array(placed), lambda x: x["t"]), " ")  # array_sort would call a lambda for each comparison
    return F.nullif(F.left(text, F.lit(max_chars)) if max_chars else text, F.lit(""))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def text_to_inverted(c: Column) -> Column:
    """A text's words with their positions, as ``map<token, positions>``; null stays null.

    Words are sorted with their places, so that each token is one run, within the row: no
    word is shuffled, and the work is that of sorting the text's own words.
    """
    words = F.filter(F.transform(F.split(c, SPACE), lambda t, p: F.struct(t.alias("t"), p.alias("p"))), lambda x: x["t"] != "")
    places = lambda s: F.when(F.size(s) == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.size(s) - 1))
    starts = lambda s: F.filter(places(s), lambda i: (i == 0) | (F.get(s, i)["t"] != F.get(s, i - 1)["t"]))
    positions = lambda s, a, b: F.transform(F.sequence(a, b - 1), lambda i: F.get(s, i)["p"])
    entry = lambda s, at, a, k: F.struct(F.get(s, a)["t"].alias("key"), positions(s, a, F.coalesce(F.get(at, k + 1), F.size(s))).alias("value"))
    entries = _let(F.sort_array(words), lambda s: _let(starts(s), lambda at: F.transform(at, lambda a, k: entry(s, at, a, k))))
    return F.map_from_entries(entries)


@F.pandas_udf(T.MapType(T.StringType(), T.ArrayType(T.IntegerType())))
def _strict_index(values: pd.Series) -> pd.Series:
    import json

    def read(value):
        try:
            found = json.loads(value)
            items = found.items() if isinstance(found, dict) else [(k, v) for k, v in found]
            return {str(k): [None if p is None else int(p) for p in v] if v is not None else None for k, v in items}
        except (ValueError, TypeError):
            return None

    return values.map(read)


def parse_index(c: Column, strict: bool = False) -> Column:
    """A JSON inverted index as a map; what isn't one is null.

    The plain form stays in the JVM and takes JSON objects; of a repeated key the last
    entry counts. It wants the text to end with a brace, so trailing content makes it
    null. The strict form also takes lists of pairs.
    """
    if strict:
        ship()
        return _strict_index(c)
    whole = F.when(F.trim(c).rlike(r"(?s)^\{.*\}$"), F.trim(c))
    keys = lambda e: F.transform(e, lambda x: x["key"])
    last = lambda e, k: F.filter(e, lambda x, i: ~F.array_contains(F.slice(k, i + 2, F.size(k)), x["key"]))
    once = lambda e: _let(keys(e), lambda k: F.when(F.size(F.array_distinct(k)) == F.size(k), e).otherwise(last(e, k)))
    return F.map_from_entries(_let(F.map_entries(F.from_json(whole, POSITIONS)), once))


def squeeze(c: Column) -> Column:
    """White space runs to one space, none at the ends; empty is null."""
    return F.nullif(F.regexp_replace(F.regexp_replace(c, SPACE, " "), "^ | $", ""), F.lit(""))


@F.pandas_udf(T.StringType())
def _unescape(values: pd.Series) -> pd.Series:
    import html

    return values.map(lambda x: html.unescape(x) if isinstance(x, str) and "&" in x else x)


@F.pandas_udf(T.StringType())
def _compatible(values: pd.Series) -> pd.Series:
    import html
    import unicodedata

    return values.map(lambda x: unicodedata.normalize("NFKC", html.unescape(x)).lower() if isinstance(x, str) else x)


#: ASCII letters and digits as they are in lower case, other ASCII to a space, the bytes of longer characters as they are.
_KEPT = bytes(b if b > 127 or chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" else 32 for b in range(256))


@F.pandas_udf(T.StringType())
def _normalised(values: pd.Series) -> pd.Series:
    import html
    import re
    import unicodedata

    outside = re.compile("[^\x00-\x7f가-힣]+")

    def run(x):
        if not isinstance(x, str):
            return ""
        x = unicodedata.normalize("NFKC", html.unescape(x) if "&" in x else x).lower()
        x = x if x.isascii() else outside.sub(" ", x)
        return b" ".join(x.encode().translate(_KEPT).split()).decode()

    return values.map(run)


def clean_text(c: Column) -> Column:
    """HTML entities resolved and white space squeezed; empty is null."""
    ship()
    return squeeze(_unescape(c))


def normalise_ascii(c: Column) -> Column:
    """The part of ``normalise`` that needs no Python: lower case, other characters to a space."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), OUTSIDE, " "))


def normalise(c: Column) -> Column:
    """Entities resolved, compatibility forms unified, lower case, all but digits, a-z and Hangul to spaces."""
    ship()
    return _normalised(c)


def duplicate_key(title: Column, abstract: Column, own: Column) -> Column:
    """Key of a document for merging copies, from normalised title and abstract and a unique id."""
    return (
        F.when(F.length(title) >= KEY_TITLE, F.concat(F.lit("t:"), title))
        .when(F.length(abstract) > 0, F.concat(F.lit("a:"), F.substring(abstract, 1, KEY_ABSTRACT)))
        .otherwise(F.concat(F.lit("i:"), own.cast("string")))
    )


def tokens(c: Column) -> Column:
    """Lower-case word tokens: runs of letters and digits of any script."""
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def line_safe(c: Column) -> Column:
    """Line and paragraph separators to spaces, so that a record stays one line."""
    return F.regexp_replace(c, "[\\u2028\\u2029]", " ")


def rerank_text(title: Column, abstract: Column) -> Column:
    """Title and abstract on two lines, without white space at the ends."""
    both = F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(abstract, F.lit("")))
    return F.regexp_replace(both, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def shown(c: Column, width: int = 300) -> Column:
    """At most ``width`` characters, with a mark where something was cut."""
    return F.when(F.length(c) > width, F.concat(F.left(c, F.lit(width)), F.lit(" ..."))).otherwise(c)


def wrap(text: str, width: int) -> list[str]:
    """Lines of whole words, for display."""
    import textwrap

    return textwrap.wrap(text, width, break_long_words=False, break_on_hyphens=False)
