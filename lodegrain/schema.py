"""Explicit schemas. Column names are those of the public flattened dump: fixed values of its format."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()

# The columns read from a works table.
WORK_COLUMNS = (
    "id", "doi", "title", "publication_date", "publication_year", "type",
    "primary_location__source__id", "primary_location__source__display_name", "primary_location__source__issn_l",
    "primary_location__source__host_organization", "primary_location__source__host_organization_name",
    "primary_topic__id", "primary_topic__display_name",
    "primary_topic__domain__id", "primary_topic__domain__display_name",
    "primary_topic__field__id", "primary_topic__field__display_name",
    "primary_topic__subfield__id", "primary_topic__subfield__display_name",
)
ABSTRACT_COLUMNS = ("id", "value")
SOURCE_COLUMNS = ("id", "country_code")

# Columns that a record names differently from the works table.
RECORD_NAMES = {"primary_location__source__id": "primary_location_source_id", "primary_location__source__issn_l": "issn_l"}

# The record's columns in order; the country is optional and the abstract comes last.
RECORD_COLUMNS = (
    "id", "doi", "title", "publication_date", "publication_year", "type", "country_code",
    "primary_location__source__host_organization", "primary_location__source__host_organization_name",
    "primary_location_source_id", "primary_location__source__display_name", "issn_l",
    "primary_topic__domain__id", "primary_topic__domain__display_name",
    "primary_topic__field__id", "primary_topic__field__display_name",
    "primary_topic__subfield__id", "primary_topic__subfield__display_name",
    "primary_topic__id", "primary_topic__display_name",
)


def record_schema(country: bool = True, abstract: bool = True) -> T.StructType:
    """The schema of a record as written to and read from JSON lines."""
    names = [n for n in RECORD_COLUMNS if country or n != "country_code"] + ["abstract"] * abstract
    return T.StructType([T.StructField(n, L if n == "publication_year" else S) for n in names])


WORKS = T.StructType([T.StructField(n, S) for n in WORK_COLUMNS])
ABSTRACTS = T.StructType([T.StructField(n, S) for n in ABSTRACT_COLUMNS])
SOURCES = T.StructType([T.StructField(n, S) for n in SOURCE_COLUMNS])

# The payload's name of the record's id, and search fields by request parameter.
PAYLOAD_ID = "openalex_id"
FILTER_FIELDS = {
    "field": "primary_topic__field__display_name",
    "subfield": "primary_topic__subfield__display_name",
    "domain": "primary_topic__domain__display_name",
    "topic": "primary_topic__display_name",
    "source": "primary_location__source__display_name",
    "type": "type",
    "country": "country_code",
}
#: Filterable columns by kind: what a store would partition, sort or cluster by.
INDEXED = {"keyword": tuple(sorted(FILTER_FIELDS.values())), "text": ("title",), "integer": ("publication_year",), "datetime": ()}

HIT_COLUMNS = ("rank", "score", "vector_score", "rerank_score", "duplicates", "openalex_id", "doi", "title", "abstract", "publication_year", "source", "topic", "field", "country", "type", "payload")
