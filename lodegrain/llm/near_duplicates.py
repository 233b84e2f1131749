"""Near duplicates by one-permutation MinHash with optimal densification.

1. Each document's distinct five-word shingles are hashed to 64 bits. One pass over the
   sorted hashes gives the least in each of 256 bins; an empty bin copies a filled one found
   by a fixed sequence of hashed probes (optimal densification). Eight bins make a band,
   or fewer where the similarity asked for needs more bands (``rows_of``).
2. Documents with equal sets are one node. Nodes that share a band's key are joined by
   edges to the bucket's least node, a star: as many edges as members, never all pairs.
3. Each node is held against one centre on full sets: the one with which it shares most
   bands. That is one pair for each node, and it settles the groups whose members resemble
   their centre, however large they are.
4. Buckets whose nodes are in more than one component by then are looked at again, once
   for each distinct set of members: a link may join two members that don't resemble their
   centre. Buckets that overlap so much that comparing their union takes fewer pairs than
   comparing each are compared as one unit, others each by itself. Within a unit only pairs
   of different components are compared, those that sizes and signatures don't rule out on
   full sets; members of the commonest component meet only those of others. Units of any
   size are cut into blocks of bounded size; each task has one pair of blocks and returns a
   spanning forest of its links.
5. The links' components get their smallest doc_id.

At a similarity of 0.85 two sets share no band with probability below 4e-5 (32 bands of
8), at 0.80 below 1e-14 (64 bands of 4), as far as bins are independent; a signature
rules out a pair only where it is five standard errors below the similarity asked for.

Defined results: null text, or text without words, has no shingles, is linked with nothing
and is its own component; a text of fewer than five words is one shingle; a null doc_id
counts last within its component; repeated rows repeat; an empty table gives an empty
result; extra columns are ignored (``keep_one`` returns them, whatever their names); a very
long text is one set like any other, held by one task at a time beside at most a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodegrain.llm import common, components

#: Bins, and the most of them in a band.
BINS, ROWS = 256, 8
#: Two sets of the similarity asked for share no band with a probability of at most this.
MISS = 1e-4
WORDS = 5
#: Bounds of a block of a unit: members, and shingles of all members.
BLOCK_MEMBERS, BLOCK_SHINGLES = 512, 2_000_000
#: Rows to look up (an id and a hash each) are broadcast up to this number; more are joined by shuffling.
BROADCAST_IDS = 500_000

_random = np.random.Generator(np.random.PCG64(20_240_229))
_BYTE = _random.integers(0, 1 << 64, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE = _random.integers(0, 1 << 63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_ROW = _random.integers(0, 1 << 63, ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_PROBES = _random.integers(0, BINS, (BINS, 2048)).astype(np.int16)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each 64-bit value's bits over the whole value."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the base and of its inverse, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, common.CHUNK_BYTES * 2)
            self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, x, np.uint64)]), dtype=np.uint64) for x in (_BASE, _INVERSE))
        return self.up[:n], self.down[:n]


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first bytes' places) of the words in lower-cased bytes."""
    data = np.frombuffer(raw, np.uint8)
    inside = np.concatenate([[False], ~_SPACE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down = common.held("powers", Powers).to(len(data) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[:-1], dtype=np.uint64)])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts


def shingle_sets(bodies: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    raw = [(b or "").encode("utf-8", "replace").lower() for b in bodies]
    sizes = np.array([len(x) + 1 for x in raw])
    hashes, starts = word_hashes(b"\n".join(raw))
    firsts = np.searchsorted(starts, np.concatenate([[0], np.cumsum(sizes)]))
    n = len(hashes)
    sums = sum(hashes[k : n - WORDS + 1 + k] * _PLACE[k] for k in range(WORDS)) if n >= WORDS else np.zeros(0, np.uint64)
    runs = mix(sums)
    out = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= WORDS:
            out.append(np.unique(runs[a : b - WORDS + 1]))
        elif b > a:
            whole = (hashes[a:b] * _PLACE[: b - a]).sum(dtype=np.uint64)
            out.append(mix(np.array([whole + np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    """BINS 32-bit values of a set that isn't empty."""
    bins = ((shingles >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    out = np.zeros(BINS, np.uint32)
    filled = np.zeros(BINS, bool)
    out[bins[first]] = shingles[first].astype(np.uint32)
    filled[bins[first]] = True
    empty = np.flatnonzero(~filled)
    at, step = 0, 16
    while len(empty) and at < _PROBES.shape[1]:
        probes = _PROBES[empty, at : at + step]
        good = filled[probes]
        found = good.any(1)
        out[empty[found]] = out[probes[found, good[found].argmax(1)]]
        empty = empty[~found]
        at, step = at + step, step * 2
    out[empty] = out[bins[first[0]]]
    return out


def rows_of(percent: int) -> int:
    """The most bins a band may have so that a pair at ``percent`` % is missed with at most ``MISS``."""
    rows = ROWS
    while rows > 1 and (1 - (percent / 100) ** rows) ** (BINS // rows) > MISS:
        rows //= 2
    return rows


def band_keys(values: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` bins; bands don't share keys."""
    bands = values.reshape(-1, rows).astype(np.uint64)
    return mix((mix(bands) * _ROW[:rows]).sum(1, dtype=np.uint64) + np.arange(len(bands), dtype=np.uint64) * _BASE).view(np.int64)


def node(shingles: np.ndarray) -> int:
    """A set's identity: a hash of its elements whatever their order."""
    return int(mix(np.array([mix(shingles + _BASE).sum(dtype=np.uint64) ^ np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])


SIGNED = "doc_id long, text_hash long, n_shingles long, node long, keys array<long>"


def hashed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, text_hash): id and hash together tell rows apart unless they are repeated."""
    return common.texts(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))


def signed(plain: DataFrame, percent: int = 85) -> DataFrame:
    """Each row's set size, node and band keys."""
    rows = rows_of(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for _, bodies in common.slices(*[batch.column(1).to_pylist()] * 2):
                sets = shingle_sets(bodies)
                keys = [band_keys(signature(s), rows) if len(s) else None for s in sets]
                columns = [batch.column(k).slice(at, len(bodies)) for k in (0, 2)]
                columns += [pa.array(map(len, sets), pa.int64()), pa.array([node(s) if len(s) else None for s in sets], pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in SIGNED.split(", ")])
                at += len(bodies)

    return common.map_batches(plain.select("doc_id", "text", "text_hash"), run, SIGNED)


def few(df: DataFrame) -> DataFrame:
    """A settled table as the broadcast side of a join if it was counted to be small, else as it is."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def star_edges(nodes: DataFrame) -> DataFrame:
    """(a, b, shared): each bucket's least node and every other member, with the number of buckets they share."""
    rows = nodes.select("node", F.explode("keys").alias("key"))
    centres = rows.groupBy("key").agg(F.min("node").alias("a"), F.count("*").alias("m")).filter("m > 1").select("key", "a")
    return rows.join(centres, "key").filter("node > a").groupBy("a", F.col("node").alias("b")).agg(F.count("*").alias("shared"))


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    common_size = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common_size >= percent * (len(a) + len(b) - common_size)


def forest(left: list, right: list | None, percent: int) -> list[tuple[int, int]]:
    """Links that connect what the block (or the pair of blocks) links, as pairs of labels.

    Members are (label, shingles). Members of one label are connected already, so only
    pairs of different labels are compared, and none that a link found before connects.
    """
    other = left if right is None else right
    low = np.array([signature(s) for _, s in other]).astype(np.uint8)
    own = low if right is None else np.array([signature(s) for _, s in left]).astype(np.uint8)
    sizes = np.array([len(s) for _, s in other])
    names, tags = np.unique(np.array([x for x, _ in left] + ([] if right is None else [x for x, _ in right]), np.int64), return_inverse=True)
    own_tags, tags = tags[: len(left)], tags[-len(other) :]  # the same memory where there is one block
    s = percent / 100
    out = []
    for i, (_, shingles) in enumerate(left):
        first = i + 1 if right is None else 0
        n = len(shingles)
        near = first + np.flatnonzero((tags[first:] != own_tags[i]) & (100 * np.minimum(sizes[first:], n) >= percent * np.maximum(sizes[first:], n)))
        if not len(near):
            continue
        floor = s - 5 * np.sqrt(s * (1 - s) / np.minimum(BINS, np.minimum(sizes[near], n)))
        for j in near[(low[near] == own[i]).mean(1) >= floor].tolist():
            a, b = int(own_tags[i]), int(tags[j])
            if a != b and _linked(shingles, other[j][1], percent):
                out.append((int(names[a]), int(names[b])))
                own_tags[own_tags == b] = a
                tags[tags == b] = a
    return out


def with_sets(plain: DataFrame, nodes: DataFrame, dealt: DataFrame) -> DataFrame:
    """``dealt`` (node, ..., a settled table) with each node's ``shingles``, from the text of the node's first row.

    The rows to read are looked up by id and text hash. What is looked up is broadcast where
    it was counted to be few, so that sets are shuffled once, to where they are compared.
    """
    wanted = common.settle(nodes.select("node", "first_id", "first_hash").join(few(dealt), "node", "left_semi").select("first_id", "first_hash"), "wanted")
    same = (F.col("text_hash") == F.col("first_hash")) & F.col("doc_id").eqNullSafe(F.col("first_id"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, bodies in common.slices(*[batch.column(0).to_pylist()] * 2):
                made = [s for s in shingle_sets(bodies) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array([node(s) for s in made], pa.int64()), pa.array([s.tobytes() for s in made], pa.binary())], ["node", "shingles"])

    full = common.map_batches(plain.filter("text is not null").join(few(wanted), same, "left_semi").select("text"), sets, "node long, shingles binary")
    return full.join(few(dealt), "node")


LINKS = "a long, b long"


def _link_batch(made: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*made)], ["a", "b"])


def _parts(df: DataFrame) -> int:
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)


def centre_links(plain: DataFrame, nodes: DataFrame, stars: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) of each node with the centre it shares most buckets with.

    A centre's members are dealt into bounded groups, each with the centre's set in front.
    """
    best = stars.groupBy("b").agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("a"))
    best = common.settle(best.join(nodes.select(F.col("node").alias("b"), "n"), "b"), "best")
    groups = best.groupBy("a").agg(F.greatest(F.ceil(F.count("*") / BLOCK_MEMBERS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("groups"))
    members = best.join(groups, "a").select(F.col("b").alias("node"), "a", F.pmod(F.xxhash64(F.lit("group"), "b"), "groups").alias("g"), F.lit(1).alias("side"))
    centres = groups.select(F.col("a").alias("node"), "a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("g"), F.lit(0).alias("side"))
    paired = with_sets(plain, nodes, common.settle(members.unionByName(centres), "dealt"))
    paired = paired.repartition(_parts(plain), "a", "g").sortWithinPartitions("a", "g", "side").select("a", "side", "node", "shingles")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, own = None, np.zeros(0, np.uint64)
        for batch in batches:
            made = []
            for a, side, x, body in zip(*(batch.column(k).to_pylist() for k in range(4))):
                shingles = np.frombuffer(body, np.uint64)
                if side == 0:
                    centre, own = a, shingles
                elif centre == a and _linked(own, shingles, percent):
                    made.append((a, x))
            if made:
                yield _link_batch(made)

    return common.map_batches(paired, confirm, LINKS)


def units_of(nodes: DataFrame, labels: DataFrame) -> DataFrame | None:
    """(kind, unit, node, label, n): what is compared with what, for buckets with more than one label.

    A unit is a bucket (kind 1), or all buckets of a family (kind 0) where that takes fewer
    pairs. ``labels``: (node, label) of all nodes in stars. None if all buckets have one label.
    """
    member = common.settle(nodes.join(few(labels), "node").select("node", "label", "n", "keys"), "members")
    rows = member.select("node", "label", "n", F.explode("keys").alias("key"))
    seen = rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.min("node").alias("a"), F.count("*").alias("m"), F.sum(F.xxhash64("node") % (1 << 40)).alias("h1"), F.bit_xor(F.xxhash64(F.lit("set"), "node")).alias("h2"))
    # Buckets of the same members are one.
    buckets = common.settle(seen.filter("low < high").groupBy("a", "m", "h1", "h2").agg(F.min("key").alias("key")).select("key", "a", "m"), "buckets")
    if not buckets.limit(1).count():
        return None
    inside = common.settle(rows.join(few(buckets).select("key", "a"), "key"), "inside")
    families = components.connected(inside.filter("node > a").select("a", F.col("node").alias("b"))).select(F.col("v").alias("node"), "root")
    apart = buckets.join(families, F.col("a") == F.col("node")).select("key", "root", (F.col("m") * F.col("m")).alias("pairs"))
    cost = apart.groupBy("root").agg(F.sum("pairs").alias("pairs")).join(families.groupBy("root").agg(F.count("*").alias("size")), "root")
    cost = cost.select("root", (F.col("size") * F.col("size") <= F.col("pairs")).alias("whole"))
    whole = families.join(cost.filter("whole"), "root").join(member, "node").select(F.lit(0).alias("kind"), F.col("root").alias("unit"), "node", "label", "n")
    single = inside.join(apart.join(cost.filter("not whole"), "root").select("key"), "key").select(F.lit(1).alias("kind"), F.col("key").alias("unit"), "node", "label", "n")
    return common.settle(whole.unionAll(single), "units")


def dealt_units(units: DataFrame) -> DataFrame:
    """(node, label, kind, unit, i, j, side): the pairs of blocks that each member is sent to.

    Members of a unit's commonest label (blocks j < 0) meet only the blocks of others.
    """
    unit = ["kind", "unit"]
    counted = units.groupBy(*unit, "label").agg(F.count("*").alias("m"), F.sum("n").alias("n"))
    blocks = lambda m, n: F.greatest(F.ceil(m / BLOCK_MEMBERS), F.ceil(n / BLOCK_SHINGLES)).cast("int")
    shape = counted.groupBy(*unit).agg(F.max_by(F.struct("label", "m", "n"), F.struct("m", "label")).alias("most"), F.sum("m").alias("m"), F.sum("n").alias("n"))
    shape = shape.select(*unit, F.col("most.label").alias("most"), (blocks(F.col("m"), F.col("n")) == 1).alias("one"), blocks(F.col("m") - F.col("most.m"), F.col("n") - F.col("most.n")).alias("others"), blocks(F.col("most.m"), F.col("most.n")).alias("most_blocks"))
    place = lambda i, j, side: F.struct(i.alias("i"), j.alias("j"), side.alias("side"))
    none, one = F.lit(0), F.lit(1)
    own = lambda n: F.pmod(F.xxhash64(F.lit("block"), "node"), n.cast("long")).cast("int")
    mine = own(F.when(F.col("label") == F.col("most"), F.col("most_blocks")).otherwise(F.col("others")))
    upto = lambda n: F.sequence(none, n - 1)
    of_most = F.transform(upto(F.col("others")), lambda k: place(k, -1 - F.col("own"), one))
    of_others = F.transform(upto(F.col("others")), lambda k: place(F.least(k, F.col("own")), F.greatest(k, F.col("own")), F.when(k < F.col("own"), one).otherwise(none)))
    with_most = F.transform(upto(F.col("most_blocks")), lambda k: place(F.col("own"), -1 - k, none))
    places = F.when(F.col("one"), F.array(place(none, none, none))).when(F.col("label") == F.col("most"), of_most).otherwise(F.concat(of_others, with_most))
    # Both sides of the join are tables, so a unit with many rows is no burden: broadcast, or split by adaptive execution.
    return units.join(few(common.settle(shape, "shape")), unit).withColumn("own", mine).select("node", "label", *unit, F.explode(places).alias("g")).select("node", "label", *unit, "g.*")


def unit_links(plain: DataFrame, nodes: DataFrame, dealt: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between the labels of nodes in one unit."""
    key = ["kind", "unit", "i", "j"]
    paired = with_sets(plain, nodes, dealt)
    paired = paired.repartition(_parts(plain), *key).sortWithinPartitions(*key, "node").select(*key, "side", "node", "label", "shingles")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sides, made = None, ({}, {}), []

        def ended() -> list:
            left, right = (list(s.values()) for s in sides)
            apart = held is not None and held[2] != held[3]
            return forest(left, right if apart else None, percent) if left and (right or not apart) else []

        for batch in batches:
            for *at, side, x, label, body in zip(*(batch.column(k).to_pylist() for k in range(8))):
                if at != held:
                    made += ended()
                    held, sides = at, ({}, {})
                sides[side][x] = label, np.frombuffer(body, np.uint64)  # one for each node, however many rows gave it
            if made:
                yield _link_batch(made)
                made = []
        made += ended()
        if made:
            yield _link_batch(made)

    return common.map_batches(paired, confirm, LINKS)


def components_of(plain: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Each row's set size and node; the nodes with their first row; (node, root) of nodes that are linked."""
    every = common.settle(signed(plain, percent), "signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    nodes = every.filter("node is not null").groupBy("node").agg(first.alias("f"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"), F.count("*").alias("n_rows"))
    nodes = common.settle(nodes.select("node", F.col("f.doc_id").alias("first_id"), F.col("f.text_hash").alias("first_hash"), "n", "n_rows", "keys"), "nodes")
    stars = common.settle(star_edges(nodes), "stars")
    near = components.connected(common.settle(centre_links(plain, nodes, stars, percent), "links"))
    near = near.select(F.col("v").alias("node"), F.col("root").alias("label"))
    seen = stars.select(F.col("a").alias("node")).union(stars.select("b")).distinct()
    labels = common.settle(seen.join(near, "node", "left").select("node", F.coalesce("label", "node").alias("label")), "labels")
    units = units_of(nodes, labels)
    if units is not None:
        more = unit_links(plain, nodes, common.settle(dealt_units(units), "dealt"), percent)
        joined = components.connected(common.settle(more, "links")).select(F.col("v").alias("label"), "root")
        labels = labels.join(joined, "label", "left").select("node", F.coalesce("root", "label").alias("root"))
    else:
        labels = labels.select("node", F.col("label").alias("root"))
    return every.select("doc_id", "text_hash", "n_shingles", "node"), nodes.select("node", "first_id", "first_hash", "n_rows"), common.settle(labels, "members")


def cluster(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row; links need ``percent`` % similarity."""
    every, nodes, members = components_of(hashed(docs, id_col, text_col), percent)
    named = members.join(nodes.select("node", "first_id"), "node")
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    place = nodes.select("node", "first_id").join(members, "node", "left").join(least, "root", "left").select("node", F.coalesce("component_id", "first_id").alias("component_id"))
    out = every.select("doc_id", "n_shingles", "node").join(place, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))


def keep_one(docs: DataFrame, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component, all columns kept.

    Rows are told apart by id and text, so rows that share an id but not a text are judged
    each by its own text. The row with the least id stays (a null id counts last, then the
    text's hash decides); of rows that repeat its id and text one stays. Rows without words
    all stay. Texts aren't shuffled as long as what is to drop can be broadcast: it is
    what is looked up, and it is counted first.
    """
    every, nodes, members = components_of(hashed(docs, id_col, text_col), percent)
    rooted = nodes.join(members, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "first_id", "first_hash", "n_rows")
    first = F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "first_hash")).alias("f")
    best = rooted.groupBy("root").agg(first, F.sum("n_rows").alias("rows")).filter("rows > 1").select("root", F.col("f.first_id").alias("best_id"), F.col("f.first_hash").alias("best_hash"))
    place = rooted.join(best, "root").select("node", "best_id", "best_hash")
    counted = every.groupBy("doc_id", "text_hash", "node").agg(F.count("*").alias("rows")).join(place, "node")
    mine = F.col("doc_id").eqNullSafe(F.col("best_id")) & (F.col("text_hash") == F.col("best_hash"))
    gone_id, gone_hash, own = common.fresh(docs.columns, "gone_id", "gone_hash", "own_row")
    marked = common.settle(counted.filter(~mine | (F.col("rows") > 1)).select(F.col("doc_id").alias(gone_id), F.col("text_hash").alias(gone_hash), mine.alias(own)), "dropped")
    same = F.col(id_col).cast("long").eqNullSafe(F.col(gone_id)) & (F.xxhash64(F.col(text_col).cast("string")) == F.col(gone_hash))
    rest = docs.join(few(marked), same, "left_anti")
    repeated = marked.filter(own)
    if not repeated.limit(1).count():
        return rest
    whole = F.struct(*docs.columns)
    picked = docs.join(repeated, same).groupBy(gone_id, gone_hash).agg(F.min_by(whole, F.xxhash64(F.to_json(whole))).alias(own))
    return rest.unionByName(picked.select(f"{own}.*"))
