"""Files that arrive over time, each handled once.

A file source with a checkpoint takes the place of progress files: what a run has committed
is not read again, and a run that broke off is taken up where its last commit stands.
Sinks are idempotent by batch number, so a batch that is handed over twice is stored once.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lodegrain.operators.joins import not_in
from lodegrain.session import read_text, remove
from lodegrain.sources.writers import Collection


def run_available(spark: SparkSession, source: str, schema: T.StructType, kind: str, sink: Callable[[DataFrame, int], None], checkpoint: str, files_per_batch: int | None = None) -> int:
    """Hand all new files to ``sink(batch, number)``; returns the number of batches handed over."""
    reader = spark.readStream.schema(schema).format(kind)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = reader.load(source).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sum(1 for p in query.recentProgress if p["numInputRows"])


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps as long as its checkpoint; a stream that starts anew has another."""
    return json.loads(read_text(spark, f"{checkpoint.rstrip('/')}/metadata"))["id"]


def load_new(spark: SparkSession, source: str, schema: T.StructType, collection: Collection, to_points: Callable[[DataFrame], DataFrame], checkpoint: str, kind: str = "json", files_per_batch: int | None = None) -> int:
    """Upsert the points of new files; the latest commit wins for a key, be it of this stream or another."""
    return run_available(spark, source, schema, kind, lambda df, n: _put(spark, collection, to_points(df), n, checkpoint), checkpoint, files_per_batch)


def _put(spark: SparkSession, collection: Collection, points: DataFrame, number: int, checkpoint: str) -> None:
    collection.upsert(points, number, stream_id(spark, checkpoint), checkpoint)


def append_new(spark: SparkSession, source: str, schema: T.StructType, transform: Callable[[DataFrame], DataFrame], target: str, checkpoint: str, kind: str = "parquet", files_per_batch: int | None = None) -> int:
    """Write the transformed rows of new files, a folder for each batch."""
    return run_available(spark, source, schema, kind, lambda df, n: transform(df).write.mode("overwrite").parquet(f"{target}/batch={n}"), checkpoint, files_per_batch)


def still_to_do(rows: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose key isn't among what was done."""
    return not_in(rows, done, key)


def restart(spark: SparkSession, checkpoint: str) -> None:
    """Forget progress: the next run reads all files again."""
    remove(spark, checkpoint)


def is_done(spark: SparkSession, path: str) -> bool:
    """Whether a stage's output was committed as a whole."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def latest(rows: DataFrame, key: str, order: list) -> DataFrame:
    """Each key's last row in order, from partial sums."""
    names = rows.columns
    return rows.groupBy(key).agg(F.max_by(F.struct(*names), F.struct(*order)).alias("__r")).select("__r.*")
