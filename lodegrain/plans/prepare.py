"""The preparation path: works, abstracts and sources to records with text and vectors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from lodegrain.functions.ids import year_of
from lodegrain.functions.text import inverted_to_text, line_safe, parse_index
from lodegrain.operators import joins, models, predicates, projections
from lodegrain.settings import Settings
from lodegrain.sources import readers


def dated_works(works: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Works of the configured years with ``__year`` and ``id64``."""
    kind = dict(works.dtypes)["publication_year"]
    dated = works.withColumn("__year", year_of(F.col("publication_year"), kind)).filter(predicates.in_years(F.col("__year"), settings.years))
    return joins.with_number(dated)


def filter_works(works: DataFrame, abstracts: DataFrame, sources: DataFrame | None, settings: Settings = Settings()) -> DataFrame:
    """Records of works in the configured years that have an abstract, with ``id64``.

    The year filter stands below the semi-join; the lookup is broadcast only if counted small.
    """
    kept = joins.only_in(dated_works(works, settings), readers.ids_with_text(abstracts))
    country = None
    if settings.attach_country and sources is not None:
        order = F.col("file") if "file" in sources.columns else None
        kept = joins.attach_country(kept, joins.country_lookup(sources, order), most=settings.broadcast_rows)
        country = F.col("country")
    return projections.to_record(kept, F.col("__year"), country).withColumn("id64", joins.numeric_id(F.col("id")))


def _rebuilt(abstracts: DataFrame, settings: Settings, strict: bool, wanted: DataFrame | None = None) -> DataFrame:
    """(id64, abstract) of rows with a readable id, null where the index isn't readable or is empty."""
    value = F.col("value")
    index = parse_index(value, strict) if dict(abstracts.dtypes)["value"] == "string" else value
    numbered = joins.with_number(abstracts.filter(value.isNotNull())).filter("id64 is not null")
    numbered = numbered if wanted is None else joins.only_in(numbered, wanted)
    return numbered.select("id64", line_safe(inverted_to_text(index, settings.max_abstract_chars)).alias("abstract"))


def texts(abstracts: DataFrame, settings: Settings = Settings(), strict: bool = False) -> DataFrame:
    """(id64, abstract) rebuilt from inverted indexes, given as JSON or as a map."""
    return _rebuilt(abstracts, settings, strict).filter("abstract is not null")


def fill(records: DataFrame, texts: DataFrame) -> DataFrame:
    """Records with their abstract; null where there is none."""
    return joins.attach_text(records, texts)


def prepare(works: DataFrame, abstracts: DataFrame, sources: DataFrame | None, settings: Settings = Settings(), embedder: Callable[[], models.Embedder] | None = None, strict: bool = False) -> DataFrame:
    """The whole path as one plan; with an embedder, vectors of the abstracts as well.

    Only texts of works in the configured years are rebuilt, each once: a filter on the
    rebuilt text would be pushed below it and rebuild it twice, so null texts are left to ``fill``.
    """
    wanted = dated_works(works, settings).select("id64")
    out = fill(filter_works(works, abstracts, sources, settings), _rebuilt(abstracts, settings, strict, wanted)).drop("id64")
    if embedder is None:
        return out
    text = F.trim(F.col("abstract"))
    if settings.fallback_to_title:
        text = F.coalesce(F.nullif(text, F.lit("")), F.trim("title"))
    return models.check_vectors(out.withColumn("embedding", models.embed(text, embedder)), settings.dim)
