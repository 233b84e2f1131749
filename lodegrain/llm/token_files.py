"""Token ids as Arrow files of equal-length sequences, written and read back.

Documents are range partitioned by ``doc_id`` (rows of one id by their texts' hashes) into
shards of about equal bytes; each partition streams one shard: an
Arrow IPC file whose batches hold ``input_ids`` and ``mask`` as fixed-size lists, so
sequence *k* is found by arithmetic and read without a copy from a memory map, and an
index file with each document's place in the shard. Files appear under their final name
only when whole, so a repeated or doubled task leaves the same files; what a failed one
began is removed.

Defined results: null text counts as empty and yields the end id alone; a null doc_id
sorts first; repeated rows are written again, those of one doc_id in the order of their
texts' hashes; an empty table gives an empty result; extra columns are ignored; a very
long text is one document over as many sequences and batches as it needs.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lodegrain.llm import common, vocab

MANIFEST = "shard long, sequences string, index string, docs long, tokens long"
#: Text bytes of a shard, and how many shards (and tasks) there are about at most: beyond, shards grow.
SHARD_BYTES, MOST_SHARDS = 32 << 20, 40_000
RESULT = "doc_id long, start long, n_tokens long, ids_crc32 long"


class ShardWriter:
    """Streams token ids into fixed-size-list batches and documents into an index."""

    def __init__(self, fs, base: str, dtype, length: int, rows: int = 256):
        self.fs, self.base, self.dtype, self.length, self.rows = fs, base, dtype, length, rows
        self.held, self.n_held, self.tokens, self.docs = [], 0, 0, []
        kind = pa.from_numpy_dtype(dtype)
        self.schema = pa.schema([("input_ids", pa.list_(kind, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.attempt = f".{uuid.uuid4().hex}.part"
        self.out = fs.open_output_stream(base + ".arrow" + self.attempt)
        self.writer = pa.ipc.new_file(self.out, self.schema)

    def add(self, doc_id, ids) -> None:
        self.docs.append((doc_id, self.tokens, len(ids)))
        self.tokens += len(ids)
        self.held.append(ids)
        self.n_held += len(ids)
        while self.n_held >= self.rows * self.length:
            self._flush(self.rows * self.length)

    def _flush(self, size: int) -> None:
        import numpy as np

        flat = np.concatenate(self.held)
        self.held = [flat[size:]]
        self.n_held = max(0, len(flat) - size)
        flat = flat[:size]
        padded = np.zeros(-(-len(flat) // self.length) * self.length, self.dtype)
        padded[: len(flat)] = flat
        mask = np.zeros(len(padded), bool)
        mask[: len(flat)] = True
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (padded, mask)]
        self.writer.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))

    def close(self) -> None:
        if self.n_held:
            self._flush(self.n_held)
        self.writer.close()
        self.out.close()
        index = pa.table([pa.array(c, pa.int64()) for c in zip(*self.docs)], names=["doc_id", "start", "n_tokens"])
        with self.fs.open_output_stream(self.base + ".index" + self.attempt) as out, pa.ipc.new_file(out, index.schema) as writer:
            writer.write_table(index, 65_536)
        for kind in (".arrow", ".index"):
            self.fs.move(self.base + kind + self.attempt, self.base + kind)

    def abandon(self) -> None:
        """Remove what this attempt has written."""
        self.out.close()
        for kind in (".arrow", ".index"):
            if self.fs.get_file_info(self.base + kind + self.attempt).is_file:
                self.fs.delete_file(self.base + kind + self.attempt)


def filesystem(uri: str):
    """(file system, path in it) of a URI or a plain local path."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def open_file(uri: str):
    """An Arrow file reader; local files are memory-mapped."""
    from pyarrow import fs

    store, path = filesystem(uri)
    source = pa.memory_map(path) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(path)
    return pa.ipc.open_file(source)


def write(docs: DataFrame, folder: str, vocabulary: str, length: int = 2048, end_id: int = 1, shard_bytes: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards of ``docs`` below ``folder``; returns their manifest, already settled."""
    spark = docs.sparkSession
    content = spark.sparkContext.broadcast(vocab.read_file(vocabulary))
    plain = common.texts(docs, id_col, text_col)
    total = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, -(-total // max(shard_bytes, total // MOST_SHARDS)))
    dealt = plain.repartitionByRange(shards, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        encoder, writer = vocab.word_ids(content.value), None
        end, shard = np.array([end_id], encoder.dtype), TaskContext.get().partitionId()
        store, path = filesystem(folder)
        try:
            for batch in batches:
                for ids, bodies in common.slices(batch.column(0).to_pylist(), batch.column(1).to_pylist(), vocab.TEXTS):
                    writer = writer or ShardWriter(store, f"{path}/shard-{shard:07d}", encoder.dtype, length)
                    for doc_id, raw in zip(ids, encoder.encode([b or "" for b in bodies])):
                        writer.add(doc_id, np.concatenate([np.frombuffer(raw, encoder.dtype), end]))
            if writer:
                writer.close()
        except BaseException:
            if writer:
                writer.abandon()
            raise
        if writer:
            base = f"{folder}/shard-{shard:07d}"
            row = [[shard], [base + ".arrow"], [base + ".index"], [len(writer.docs)], [writer.tokens]]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in row], [f.split()[0] for f in MANIFEST.split(", ")])

    manifest = common.settle(common.map_batches(dealt, run, MANIFEST), "manifest")
    # Attempts that ended with their executor couldn't tidy up.
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for left in fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/shard-*.part")) or ():
        fs.delete(left.getPath(), False)
    return manifest


def read(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files alone.

    ``start`` counts the ids of all documents before: a running sum over the manifest,
    which has one row for each shard.
    """
    first = F.coalesce(F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = manifest.select("shard", "sequences", "index", first.cast("long").alias("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for row in batch.to_pylist():
                stored, index = open_file(row["sequences"]), open_file(row["index"])
                flat, k, at = np.empty(0), -1, 0  # the batch at hand covers ids at .. at + len(flat)
                for i in range(index.num_record_batches):
                    part = index.get_batch(i)
                    crcs = []
                    for start, n in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                        crc, pos = 0, start
                        while pos < start + n:
                            while pos >= at + len(flat):
                                at, k = at + len(flat), k + 1
                                flat = stored.get_batch(k).column(0).flatten().to_numpy()
                            piece = flat[pos - at : start + n - at]
                            crc = zlib.crc32(piece.astype("<u4"), crc)
                            pos += len(piece)
                        crcs.append(crc)
                    starts = pa.compute.add(part.column(1), row["first"])
                    yield pa.RecordBatch.from_arrays([part.column(0), starts, part.column(2), pa.array(crcs, pa.int64())], [f.split()[0] for f in RESULT.split(", ")])

    # A number is given, as otherwise the few small rows would be coalesced into one task.
    return common.map_batches(placed.repartition(max(1, manifest.count()), "shard"), run, RESULT)


def sequence(uri: str, k: int, rows: int = 256):
    """Sequence ``k`` of a shard as (ids, mask), without reading the others."""
    batch = open_file(uri).get_batch(k // rows)
    return batch.column(0)[k % rows].values, batch.column(1)[k % rows].values


def round_trip(docs: DataFrame, vocabulary: str, folder: str | None = None, **options) -> DataFrame:
    """Write ``docs`` (to scratch unless ``folder`` is given) and read the files back."""
    folder = folder or common.scratch(docs.sparkSession, "tokens")
    return read(write(docs, folder, vocabulary, **options))
