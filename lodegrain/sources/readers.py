"""Sources: tables, records, vectors and queries, all with explicit schemas."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lodegrain import schema
from lodegrain.functions.ids import numeric_id
from lodegrain.session import ship


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def check_folder(spark: SparkSession, path: str) -> str:
    """The path, if it is there and holds parquet files; says where they are if one level down."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(target):
        raise FileNotFoundError(f"{path} doesn't exist")
    entries = list(fs.listStatus(target))
    if any(e.getPath().getName().endswith(".parquet") for e in entries) or fs.getFileStatus(target).isFile():
        return path
    below = [e.getPath().toString() for e in entries if e.isDirectory()]
    hint = f"; did you mean {below[0]}?" if len(below) == 1 else ""
    raise FileNotFoundError(f"{path} holds no parquet files{hint}")


def read_columns(spark: SparkSession, path: str, columns: Iterable[str]) -> DataFrame:
    """A parquet folder's named columns; others aren't decoded."""
    return spark.read.parquet(path).select(*columns)


def works(spark: SparkSession, path: str) -> DataFrame:
    return read_columns(spark, path, schema.WORK_COLUMNS)


def abstracts(spark: SparkSession, path: str) -> DataFrame:
    return read_columns(spark, path, schema.ABSTRACT_COLUMNS)


def sources(spark: SparkSession, path: str) -> DataFrame:
    """Sources with the name of the file each came from, which decides between repeated ids."""
    return read_columns(spark, path, schema.SOURCE_COLUMNS).withColumn("file", F.input_file_name())


def ids_with_text(abstracts: DataFrame, value: str = "value", flag: str | None = None) -> DataFrame:
    """(id64) of rows with a text; by a stored flag column where there is one, which spares decoding the text."""
    there = F.col(flag) if flag and flag in abstracts.columns else F.col(value).isNotNull()
    return abstracts.filter(there).select(numeric_id(F.col("id")).alias("id64")).filter("id64 is not null")


def texts_for(abstracts: DataFrame, wanted: DataFrame, id64: str = "id64") -> DataFrame:
    """Rows of ``abstracts`` that carry a stored ``id64``, cut to the wanted ids' range first.

    The range is pushed to the scan, where it skips row groups by their statistics; for
    that, store the table sorted by ``id64``.
    """
    low, high = wanted.agg(F.min(id64), F.max(id64)).first()
    if low is None:
        return abstracts.limit(0)
    return abstracts.filter(F.col(id64).between(low, high)).join(wanted.select(id64), id64, "left_semi")


def records(spark: SparkSession, path: str, country: bool = True, years: Iterable[int] | None = None) -> DataFrame:
    """JSON-lines records with their year and part folders; ``years`` prunes folders.

    Lines that aren't JSON objects, and rows without an id, are left out.
    """
    kept = T.StructType([*schema.record_schema(country), T.StructField("_corrupt", T.StringType())])
    df = spark.read.schema(kept.add("year", T.IntegerType()).add("part", T.IntegerType())).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    df = df if years is None else df.filter(F.col("year").isin(*years))
    return df.filter(F.col("_corrupt").isNull() & F.coalesce(F.col("id") != "", F.lit(False))).drop("_corrupt")


def parse_lines(lines: DataFrame, column: str = "value", row_schema: T.StructType | None = None, text_field: str = "abstract", fallback: str | None = None) -> DataFrame:
    """(row, text) of raw lines: blank lines, bad JSON, other than objects and rows without id give a null row and "".

    The text is stripped; ``fallback`` names a field that takes the place of an empty one.
    """
    kept = row_schema or schema.record_schema()
    line = F.trim(F.col(column))
    row = F.when(line.rlike(r"(?s)^\{.*\}$"), F.from_json(line, kept))
    row = F.when(F.coalesce(row["id"], F.lit("")) != "", row)
    strip = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    text = strip(row[text_field])
    text = F.when(text == "", strip(row[fallback])).otherwise(text) if fallback else text
    return lines.select(row.alias("row"), text.alias("text"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines; bytes that aren't UTF-8 become the replacement character."""
    return spark.read.text(path)


def line_count(spark: SparkSession, path: str) -> int:
    return lines(spark, path).count()


def parts(records: DataFrame) -> DataFrame:
    """(year, part, rows) of a record folder, in order."""
    return records.groupBy("year", "part").count().withColumnRenamed("count", "rows").orderBy("year", "part")


def binary_vectors(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """(file, n, embedding) of files of 16-bit floats, n being the row within its file.

    Files whose size isn't a whole number of rows are an error. A file is one row of
    Spark's reader, so files are to be of a part's size, not larger.
    """
    from collections.abc import Iterator

    import numpy as np
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = np.frombuffer(body.as_buffer(), np.float16)
                if len(raw) % dim:
                    raise EOFError(f"{file} ends within a row of {dim}")
                rows = raw.reshape(-1, dim)
                for at in range(0, len(rows), 4096):
                    part = rows[at : at + 4096].astype(np.float32)
                    offsets = pa.array(np.arange(0, part.size + 1, dim, dtype=np.int32))
                    yield pa.RecordBatch.from_arrays([pa.array([file] * len(part)), pa.array(np.arange(at, at + len(part))), pa.ListArray.from_arrays(offsets, pa.array(part.ravel()))], ["file", "n", "embedding"])

    ship(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, "file string, n long, embedding array<float>")


def scroll(points: DataFrame, where: Column | None, limit: int, order: str = "point_id", vector: str = "embedding") -> DataFrame:
    """The first points in key order that match, without their vectors."""
    chosen = points if where is None else points.filter(where)
    return chosen.drop(vector).orderBy(order).limit(limit)


def queries_from(spark: SparkSession, path: str | None = None, given: Iterable[str] = ()) -> list[str]:
    """Queries given one by one, then those of a file, a non-blank line each."""
    out = [q.strip() for q in given if q.strip()]
    if path:
        out += [r[0].strip() for r in lines(spark, path).filter(F.trim("value") != "").collect()]
    return out


def read_json(text: str):
    return json.loads(text)


def files(spark: SparkSession, folder: str, largest_first: bool = False) -> list[tuple[str, int]]:
    """(name, bytes) of the files of a folder, by name, or the largest first (equal sizes by name)."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sorted((x.getPath().getName(), x.getLen()) for x in fs.listStatus(target) if x.isFile())
    return sorted(found, key=lambda x: -x[1]) if largest_first else found
