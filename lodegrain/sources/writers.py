"""Sinks: sharded records, vectors, and a keyed collection of points.

A collection is a folder with data in parquet and a log of commits. Data is written to a
folder of its own and becomes part of the collection with one small log file, whose number
is the order of commits, whoever makes them: streams, calls, compactions. Reading takes each
key's row from the latest commit. A stream's batch that is handed over twice is one
commit, as the log has the stream's own id and the batch's number in it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lodegrain.functions.ids import numeric_id, part_code
from lodegrain.operators.joins import numbered
from lodegrain.schema import INDEXED
from lodegrain.session import names_in, read_text, remove, write_text


def with_parts(df: DataFrame, rows_per_part: int, year: str = "publication_year", order: str | None = None) -> DataFrame:
    """Adds ``part`` (0, 1, ... within a year) and ``code``, by the order of the numeric id."""
    keyed = df if order else df.withColumn("__id64", F.coalesce(numeric_id(F.col("id")), F.lit(-1).cast("bigint")))
    out = numbered(keyed, order or "__id64", "__row", (year,)).withColumn("part", F.floor(F.col("__row") / rows_per_part).cast("int"))
    return out.withColumn("code", part_code(F.col(year), F.col("part"))).drop("__row", "__id64")


def write_records(records: DataFrame, path: str, rows_per_part: int = 1_000_000, year: str = "publication_year") -> None:
    """JSON lines in ``year=/part=`` folders of at most ``rows_per_part`` rows."""
    sharded = with_parts(records, rows_per_part, year).drop("code").withColumn("year", F.col(year))
    sharded.repartition("year", "part").write.mode("overwrite").partitionBy("year", "part").option("ignoreNullFields", "false").json(path)


def manifest(records: DataFrame, rows_per_part: int, year: str = "publication_year") -> DataFrame:
    """(id, path) of each record: which shard it is in."""
    parted = with_parts(records, rows_per_part, year)
    return parted.select("id", F.format_string("%d/part_%04d.jsonl", F.col(year).cast("int"), F.col("part")).alias("path"))


def write_vectors(df: DataFrame, path: str, mode: str = "append") -> None:
    """Vectors as a parquet array column; rows without one are null, not zeros."""
    df.write.mode(mode).parquet(path)


def zero_filled(df: DataFrame, dim: int, vector: str = "embedding") -> DataFrame:
    """A view with zero vectors in place of null, for readers that go by row position."""
    return df.withColumn(vector, F.coalesce(F.col(vector), F.array_repeat(F.lit(0.0).cast("float"), dim)))


def to_json_text(df: DataFrame, indent: int | None = 2) -> str:
    """A small result as JSON text."""
    return json.dumps([json.loads(x) for x in df.toJSON().collect()], ensure_ascii=False, indent=indent)


class Collection:
    """Points by key in a folder; what was agreed on creating it is stored with it."""

    def __init__(self, spark: SparkSession, path: str, key: str = "point_id", vector: str = "embedding", dim: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.meta = json.loads(read_text(spark, f"{self.path}/meta.json") or "{}")
        self.key, self.vector, self.dim = self.meta.get("key", key), self.meta.get("vector", vector), self.meta.get("dim", dim)
        if dim is not None and self.dim != dim:
            raise ValueError(f"the collection holds vectors of {self.dim}, not {dim}")

    def create(self, **agreed) -> None:
        """Store what is agreed: key, vector, dim, and anything given, such as ``clip`` or ``embedding_model``."""
        self._agree(key=self.key, vector=self.vector, dim=self.dim, indexed=list(self.meta.get("indexed", [])), bulk=False, **agreed)

    def _agree(self, **fields) -> None:
        self.meta = {**self.meta, **fields}
        write_text(self.spark, f"{self.path}/meta.json", json.dumps(self.meta, ensure_ascii=False))

    # Commits

    def _log(self) -> list[dict]:
        """All commits in order, with their numbers."""
        numbers = [int(n.removesuffix(".json")) for n in names_in(self.spark, f"{self.path}/log") if n.endswith(".json") and not n.startswith(".")]
        return [{"seq": n, **json.loads(read_text(self.spark, f"{self.path}/log/{n:012d}.json") or "{}")} for n in sorted(numbers)]

    def _commit(self, entry: dict) -> int:
        n = max((x["seq"] for x in self._log()), default=0) + 1
        while not write_text(self.spark, f"{self.path}/log/{n:012d}.json", json.dumps(entry), overwrite=False):
            n += 1  # another writer was faster
        return n

    def _parts(self) -> list[tuple[int, str]]:
        """(place in the order, data folder) of what is to be read."""
        log = self._log()
        base = max((x for x in log if x["kind"] == "base"), key=lambda x: x["seq"], default=None)
        upto = base["upto"] if base else 0
        parts = {("base",): (0, base["folder"])} if base else {}
        first: dict[tuple, int] = {}
        for x in log:
            if x["kind"] != "batch":
                continue
            name = (x["stream"], x["n"]) if x["n"] is not None else (x["seq"],)
            seq = first.setdefault(name, x["seq"])
            if x["seq"] <= upto or seq <= upto and x["stream"]:
                continue  # in the base already; a stream's batch handed over again holds what it held
            parts[name] = (seq if seq > upto else x["seq"], x["folder"])
        return sorted(parts.values())

    def check(self, points: DataFrame) -> DataFrame:
        """The points, if key and vector are there and vectors have the size agreed."""
        missing = {self.key, self.vector} - set(points.columns)
        if missing:
            raise ValueError(f"points lack {sorted(missing)}")
        kind = points.schema[self.vector].dataType
        if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.FloatType, T.DoubleType))):
            raise ValueError(f"{self.vector} must hold arrays of floating point numbers, not {kind.simpleString()}")
        if self.dim is None:
            return points
        size = F.size(self.vector)
        return points.withColumn(self.vector, F.when(F.col(self.vector).isNotNull() & (size != self.dim), F.raise_error(F.format_string("a vector of %d where %d is agreed", size, F.lit(self.dim))).cast(kind)).otherwise(F.col(self.vector)))

    def upsert(self, points: DataFrame, batch: int | None = None, stream: str = "", checkpoint: str | None = None) -> int:
        """Store points as the next commit; a batch number of the same stream again replaces that batch, in its place."""
        folder = f"data/{uuid.uuid4().hex}"
        self.check(points).write.parquet(f"{self.path}/{folder}")
        return self._commit({"kind": "batch", "folder": folder, "stream": stream, "n": batch, "checkpoint": checkpoint})

    def read(self) -> DataFrame | None:
        """Each key's latest row; within a batch, repeated keys are settled by the rows' hashes."""
        parts = self._parts()
        if not parts:
            return None
        if len(parts) == 1 and parts[0][0] == 0:
            return self.spark.read.parquet(f"{self.path}/{parts[0][1]}")
        rows = None
        for n, folder in parts:
            part = self.spark.read.parquet(f"{self.path}/{folder}").withColumn("__seq", F.lit(n))
            rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
        names = [c for c in rows.columns if c != "__seq"]
        order = F.struct("__seq", F.xxhash64(*names))
        return rows.groupBy(self.key).agg(F.max_by(F.struct(*names), order).alias("__r")).select("__r.*")

    def flat(self, name: str) -> DataFrame | None:
        """Rows as a document store returns them: payload with ``_id`` and ``_collection_name``, without vectors."""
        rows = self.read()
        return None if rows is None else rows.drop(self.vector).withColumnRenamed(self.key, "_id").withColumn("_collection_name", F.lit(name))

    # Payload indexes: the columns by which compacted data is sorted, so that scans skip row groups.

    def create_indexes(self, columns: Iterable[str] | None = None) -> list[str]:
        """Columns to sort compacted data by, the first one first; those that no point has are left out on compacting."""
        columns = [c for many in INDEXED.values() for c in many] if columns is None else columns
        self._agree(indexed=[*self.meta.get("indexed", []), *[c for c in columns if c not in self.meta.get("indexed", [])]])
        return self.meta["indexed"]

    def drop_indexes(self, keep: Iterable[str] = ()) -> list[str]:
        """Forget all indexes but those to keep."""
        self._agree(indexed=[c for c in self.meta.get("indexed", []) if c in set(keep)])
        return self.meta["indexed"]

    def bulk(self, on: bool) -> None:
        """While bulk mode is on, compaction is put off; leaving it compacts."""
        self._agree(bulk=on)
        if not on:
            self.compact()

    def cluster_by(self, path: str, columns: list[str]) -> None:
        """A copy sorted by hot filter columns."""
        self.read().repartitionByRange(*columns).sortWithinPartitions(*columns).write.mode("overwrite").parquet(path)

    def compact(self) -> None:
        """One base of the latest rows, sorted by the indexed columns, or by key; what it holds goes as files but stays in the log."""
        log = self._log()
        upto, parts, rows = max((x["seq"] for x in log), default=0), self._parts(), self.read()
        if rows is None or self.meta.get("bulk") or [n for n, _ in parts] == [0]:
            return
        order = [c for c in self.meta.get("indexed", []) if c in rows.columns] or [self.key]
        folder = f"data/{uuid.uuid4().hex}"
        rows.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{self.path}/{folder}")
        self._commit({"kind": "base", "folder": folder, "upto": upto})
        for x in log:
            if "folder" in x:
                remove(self.spark, f"{self.path}/{x['folder']}")

    def delete(self, confirm: bool = False) -> None:
        """Remove everything, the progress of streams into it included; wants ``confirm``."""
        if not confirm:
            raise ValueError("deleting a collection wants confirm=True")
        for checkpoint in {x.get("checkpoint") for x in self._log()} - {None}:
            remove(self.spark, checkpoint)
        remove(self.spark, self.path)

    def recreate(self, confirm: bool = False) -> None:
        """Empty, with what was agreed kept; streams into it start anew."""
        self.delete(confirm)
        self.create()

    def describe(self) -> dict:
        """Points, how many have vectors, the stored parts, and what was agreed."""
        parts, rows = self._parts(), self.read()
        points, indexed = rows.agg(F.count("*"), F.count(self.vector)).first() if rows is not None else (0, 0)
        status = "bulk" if self.meta.get("bulk") else "ready" if rows is not None else "empty"
        quantisation = {"type": "int8", "clip": self.meta["clip"]} if self.meta.get("clip") else None
        return {"status": status, "points": points, "indexed": indexed, "segments": len(parts), "key": self.key, "dim": self.dim, "distance": "cosine", "quantisation": quantisation, "index": self.meta.get("index"), "payload_indexes": self.meta.get("indexed", []), "device": "cpu", "embedding_model": self.meta.get("embedding_model")}
