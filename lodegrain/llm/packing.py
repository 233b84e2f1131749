"""Packing of token pieces into fixed-length sequences by shortest-pack-first.

The plan works on the length histogram alone, which has at most ``capacity`` rows at any
corpus size. Lengths are placed longest first; copies of a length join the emptiest
open packs that have room, and where none has, new packs are opened. What is kept is
patterns with counts, never single packs. Pieces then find their place by rank within
their length: the patterns own consecutive ranges of ranks.

Ranks need no global sort. Each piece has a stored unique key; pieces of one length are
dealt by that key into salted groups of bounded size, ranked there, and shifted by the
sizes of the groups before.

Defined results: null text counts as empty and yields the end id alone; repeated rows
are packed separately; an empty table gives an empty result; extra columns are ignored; a
very long text is cut into as many full pieces as it fills, and a rest.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from lodegrain.llm import common, vocab

PIECES = "piece long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

PLACE = ("p_length", "p_first", "p_end", "p_copies", "p_sequence", "p_offset")

#: Pieces of one length that one task ranks.
GROUP = 100_000


def pieces(docs: DataFrame, vocabulary: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of at most ``capacity`` ids, each with a unique ``piece`` key."""
    spark = docs.sparkSession
    content = spark.sparkContext.broadcast(vocab.read_file(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        encoder = vocab.word_ids(content.value)
        key = TaskContext.get().partitionId() << 40
        for batch in batches:
            for ids, bodies in common.slices(batch.column(0).to_pylist(), batch.column(1).to_pylist(), vocab.TEXTS):
                rows = []
                for doc_id, raw in zip(ids, encoder.encode([b or "" for b in bodies])):
                    tokens = np.append(np.frombuffer(raw, encoder.dtype).astype("<u4"), np.uint32(end_id))
                    for start in range(0, len(tokens), capacity):
                        part = tokens[start : start + capacity]
                        rows.append((key, doc_id, start, len(part), zlib.crc32(part), len(tokens)))
                        key += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], [f.split()[0] for f in PIECES.split(", ")])

    return common.map_batches(common.texts(docs, id_col, text_col), run, PIECES)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns as (number of packs, [(length, copies in a pack)]) for a length histogram."""
    serial = 0
    open_packs: list[tuple[int, int, int, list[tuple[int, int]]]] = []  # fill, serial, packs, content
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left and open_packs and open_packs[0][0] + length <= capacity:
            fill, _, packs, content = heapq.heappop(open_packs)
            taken = min(left, packs)
            if taken < packs:
                heapq.heappush(open_packs, (fill, serial, packs - taken, content))
                serial += 1
            grown = [*content[:-1], (length, content[-1][1] + 1)] if content[-1][0] == length else [*content, (length, 1)]
            heapq.heappush(open_packs, (fill + length, serial, taken, grown))
            serial += 1
            left -= taken
        copies = capacity // length
        for packs, held in ((left // copies, copies), (int(left % copies > 0), left % copies)):
            if packs:
                heapq.heappush(open_packs, (held * length, serial, packs, [(length, held)]))
                serial += 1
    return [(packs, content) for _, _, packs, content in sorted(open_packs, key=lambda x: (-x[0], x[1]))]


def slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, rank after the last, copies in a pack, first sequence, offset) for each pattern's share."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for packs, content in patterns:
        offset = 0
        for length, copies in content:
            first = used.get(length, 0)
            used[length] = first + packs * copies
            out.append((length, first, used[length], copies, sequence, offset))
            offset += length * copies
        sequence += packs
    return out


def ranked(cut: DataFrame, histogram: dict[int, int]) -> DataFrame:
    """Adds ``rank``: 0, 1, ... among the pieces of the same length."""
    spark = cut.sparkSession
    large = {n: -(-c // GROUP) for n, c in histogram.items() if c > GROUP}
    groups = F.lit(1).cast("long")
    if large:
        groups = F.coalesce(F.create_map(*[F.lit(x).cast("long") for pair in large.items() for x in pair])[F.col("length")], groups)
    dealt = cut.withColumn("salt", F.pmod(F.xxhash64("piece"), groups))
    before = (
        dealt.groupBy("length", "salt").count()
        .withColumn("shift", F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count"))
        .select("length", "salt", "shift")
    )
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("piece")).cast("long") - 1
    return dealt.withColumn("within", within).join(before, ["length", "salt"]).withColumn("rank", F.col("within") + F.col("shift")).drop("salt", "within", "shift")


def pack(docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each piece with its ``sequence_id`` and ``offset``; sequences hold at most ``capacity`` ids without gaps."""
    spark = docs.sparkSession
    cut = common.settle(pieces(docs, vocabulary, capacity, end_id, id_col, text_col), "pieces")
    histogram = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}  # at most `capacity` rows
    places = slots(plan(histogram, capacity))
    # An Arrow table reaches the plan as it is; of a list, Python workers on the executors would make rows.
    table = spark.createDataFrame(pa.table({name: pa.array((x[k] for x in places), pa.int64()) for k, name in enumerate(PLACE)}))
    # As many rows as patterns have parts, which the capacity bounds and the corpus doesn't.
    table = F.broadcast(table) if len(places) <= 64 * capacity else table
    nth = F.col("rank") - F.col("p_first")
    return (
        ranked(cut, histogram)
        .join(table, (F.col("length") == F.col("p_length")) & (F.col("rank") >= F.col("p_first")) & (F.col("rank") < F.col("p_end")))
        .select(
            "doc_id", "start", "length", "ids_crc32", "doc_tokens",
            (F.col("p_sequence") + F.expr("(rank - p_first) div p_copies")).alias("sequence_id"),
            (F.col("p_offset") + F.pmod(nth, F.col("p_copies")) * F.col("length")).alias("offset"),
        )
    )
