"""What the operators of this subpackage share: projections, shipping, scratch space."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lodegrain.session import ship

#: Texts handled together in one vectorised step hold about so many bytes.
CHUNK_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, read by Spark so that any store works."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns the operators work on, as (doc_id long, text string).

    Everything else is pruned here, so extra columns, whatever their names,
    neither reach the scan nor clash with columns that an operator adds.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


#: Rows and bytes of an Arrow batch of texts; bound what a worker and the JVM hold of them at once.
BATCH_ROWS, BATCH_BYTES = 2000, 4 << 20

_held: dict[str, object] = {}
_stage: list[int] = []


def new_stage() -> None:
    """Let go of what this worker holds from an earlier stage, so that what operators remember doesn't add up."""
    context = TaskContext.get()
    stage = context.stageId() if context else -1
    if [stage] != _stage:
        _stage[:] = [stage]
        _held.clear()
        give_back()


def give_back() -> None:
    """Return to the system what the allocators of this worker hold but no object uses.

    Workers outlive stages, so what a stage freed would otherwise still count beside the
    next stage's memory. Of the C library it takes glibc; with another nothing is done.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what one of them took is given back before the next is asked for."""
    for batch in batches:
        yield batch
        del batch
        give_back()


def held(label: str, make: Callable[[], object]):
    """A worker's large object, made when first asked for and kept for the stage."""
    new_stage()
    if label not in _held:
        _held[label] = make()
    return _held[label]


def small_batches(spark: SparkSession) -> None:
    """Texts are long: ship them in small batches, unless still smaller ones are set.

    The settings are the session's, as Spark reads them only when a plan runs; on other
    queries of the session they have no effect but the size of Arrow batches.
    """
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        if not 0 < int(re.sub(r"[^0-9-]", "", spark.conf.get(name))) <= most:
            spark.conf.set(name, most)


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` after the package was shipped, in small batches."""
    ship(df.sparkSession)
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new_stage()
        yield from fn(returned(batches))

    return df.mapInArrow(run, schema)


def map_texts(df: DataFrame, text_col: str, fn: Callable[[list[str | None]], list], kind: str) -> Column:
    """A column of ``fn``'s value for each text, computed from Arrow arrays of that column alone."""
    ship(df.sparkSession)
    small_batches(df.sparkSession)
    types = {"double": pa.float64(), "string": pa.string()}

    def run(column: pa.Array) -> pa.Array:
        new_stage()
        bodies = column.to_pylist()
        out: list = []
        for _, part in slices(bodies, bodies):
            out += fn(part)
        del bodies
        give_back()
        return pa.array(out, types[kind])

    run.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, kind)(F.col(text_col))


def fresh(taken: Iterable[str], *wanted: str) -> list[str]:
    """Names like those wanted that no column has, whatever the columns are called."""
    low = {c.lower() for c in taken}
    out = []
    for name in wanted:
        while name.lower() in low:
            name += "_"
        low.add(name.lower())
        out.append(name)
    return out


def slices(ids: list, bodies: list, limit: int = CHUNK_BYTES) -> Iterator[tuple[list, list]]:
    """Consecutive rows whose texts hold about ``limit`` characters; a longer text stands alone."""
    at, held = 0, 0
    for i, body in enumerate(bodies):
        held += len(body) if body else 0
        if held >= limit:
            yield ids[at : i + 1], bodies[at : i + 1]
            at, held = i + 1, 0
    if at < len(bodies):
        yield ids[at:], bodies[at:]


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder's path below the shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``. Where that is unset, a temporary one
    of this machine is taken if all executors are on it, as in tests; on a cluster it is an
    error. What is left in it is removed when the application ends.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not base:
        current = context._jsc.sc().getCheckpointDir()
        base = current.get() if current.isDefined() else None
    if not base:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="lodegrain-scratch")
        context.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(context._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    fs.deleteOnExit(target)
    return path


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write to scratch and read again: cuts lineage with files all executors see."""
    path = scratch(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path + "/data")
    out = df.sparkSession.read.schema(df.schema).parquet(path + "/data")
    out._lodegrain_scratch = path
    return out


def drop(*tables: DataFrame) -> None:
    """Remove the files of settled tables that no pending plan reads any more."""
    for df in tables:
        path = getattr(df, "_lodegrain_scratch", None)
        if path:
            context = df.sparkSession.sparkContext
            target = context._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)
