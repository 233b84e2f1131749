"""Benchmark decontamination with DataFrame functions alone.

Texts and items are normalised to words. Every run of ``n`` words of an item is a window;
an item with fewer words is one window. The distinct windows are a broadcast hash table
keyed by a 64-bit hash, and the windows of the documents are looked up in it; a hit of the
hash counts only if all words are equal. Document windows stream through the look-up
within their stage: nothing is shuffled but one row for each document and each hit.

The table is broadcast only if its bytes, counted first, are at most ``broadcast_bytes``;
windows of a larger benchmark are joined by shuffling, with the same result. Each document
window then carries its own words, so what is shuffled is in proportion to the text.

Defined results: null or empty text has no words and no hits; items without words have no
windows; repeated rows are each judged; an empty table gives an empty result, an empty
benchmark leaves all clean; extra columns, whatever their names, are kept by ``clean`` and
ignored by ``hits``; a very long text is looked up whole, its windows streaming by.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lodegrain.llm import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Fixed value: what stands between words, after A-Z were lowered.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
N = 13
#: Windows are broadcast up to so many bytes, about, and shuffled beyond.
WINDOW_BYTES = 128 << 20
#: Hits that ``clean`` joins back are broadcast up to so many bytes, and shuffled beyond.
BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    """The normalised words of a text; none for null."""
    return F.filter(F.split(F.coalesce(F.translate(text, UPPER, LOWER), F.lit("")), BETWEEN), lambda w: w != "")


def window_hash(of: Column, first: Column, n: int) -> Column:
    """Hash of ``n`` words of an array of word hashes from the 0-based place ``first``."""
    return F.xxhash64(*[F.get(of, first + k) for k in range(n)])


def windows(benchmark: DataFrame, n: int = N, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(n_words, w_hash, w_words, items): the distinct windows and the items that hold each."""
    items = benchmark.select(F.col(item_col).alias("item_id"), words(F.col(text_col)).alias("item_words")).filter(F.size("item_words") > 0)
    size = F.least(F.size("item_words"), F.lit(n))
    placed = items.select("item_id", "item_words", size.alias("n_words"), F.explode(F.sequence(F.lit(1), F.size("item_words") - size + 1)).alias("at"))
    parts = placed.select("item_id", "n_words", F.slice("item_words", F.col("at"), F.col("n_words")).alias("w_words"))
    grouped = parts.groupBy("n_words", "w_words").agg(F.collect_set("item_id").alias("items"))
    hashed = grouped.withColumn("w_hashes", F.transform("w_words", lambda w: F.xxhash64(w)))
    # Places beyond a short window are null, which the hash skips.
    return hashed.select("n_words", window_hash(F.col("w_hashes"), F.lit(0), n).alias("w_hash"), "w_words", "items")


def hits(docs: DataFrame, benchmark: DataFrame, n: int = N, id_col: str = "doc_id", text_col: str = "text", broadcast_bytes: int = WINDOW_BYTES, keys: tuple[str, ...] = ()) -> DataFrame:
    """For each row of ``docs``: doc_id, keys, n_words, n_hit, hit_words (0-based places), items (sorted ids as strings).

    ``row`` tells rows of equal ids apart within this result.
    """
    table = common.settle(windows(benchmark, n), "windows")
    size = F.sum(2 * F.octet_length(F.to_json(F.struct("w_words", "items"))) + 24 * F.col("n_words") + 64)
    shape = table.groupBy("n_words").agg(size).collect()  # at most n rows
    lengths = sorted(r[0] for r in shape) or [n]
    small = sum(r[1] for r in shape) <= broadcast_bytes
    table = F.broadcast(table) if small else table
    kept = ["row", "doc_id", *keys]
    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), *keys, words(F.col(text_col)).alias("d_words"))
    hashed = read.select(*kept, "d_words", F.transform("d_words", lambda w: F.xxhash64(w)).alias("d_hashes"))

    def of(k: int) -> Column:
        # One entry more than there are windows, so that each document has a row at least.
        ends = F.greatest(F.size("d_hashes") - k + 1, F.lit(0))

        def window(i: Column) -> Column:
            words = [] if small else [F.slice("d_words", i + 1, F.lit(k)).alias("own_words")]
            return F.struct(i.alias("at"), F.lit(k).alias("n"), window_hash(F.col("d_hashes"), i, k).alias("d_hash"), *words)

        return F.transform(F.sequence(F.lit(0), ends), window)

    placed = of(lengths[0]) if len(lengths) == 1 else F.concat(*[of(k) for k in lengths])
    carried = [*kept, "d_words"] if small else [*kept, F.size("d_words").alias("d_size")]
    # The outer form, as for the other Spark infers a filter that works out all windows again for each word.
    spread = hashed.select(*carried, placed.alias("d_windows")).select("*", F.inline_outer("d_windows")).drop("d_windows")
    own_words = F.slice("d_words", F.col("at") + 1, F.col("n")) if small else F.col("own_words")
    # Lengths are compared too: the entry past the end holds fewer words than n, and may equal a shorter item.
    same = (F.col("n") == F.col("w_n")) & (F.col("d_hash") == F.col("w_hash")) & (own_words == F.col("w_words"))
    found = spread.join(table.withColumnRenamed("n_words", "w_n"), same, "left").filter(F.col("w_hash").isNotNull() | ((F.col("at") == 0) & (F.col("n") == lengths[0])))
    found = found.select(*kept, (F.size("d_words") if small else F.col("d_size")).cast("long").alias("n_words"), F.when(F.col("w_hash").isNotNull(), F.struct("at", "n")).alias("hit"), "items")
    grouped = found.groupBy(*kept).agg(F.max("n_words").alias("n_words"), F.collect_set("hit").alias("hits"), F.flatten(F.collect_set("items")).alias("items"))
    covered = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["at"], h["at"] + h["n"] - 1)))))
    items = F.array_sort(F.array_distinct(F.transform("items", lambda x: x.cast("string"))))
    out = grouped.select(*kept, "n_words", covered.alias("hit_words"), items.alias("items"))
    return out.select(*kept, "n_words", F.size("hit_words").cast("long").alias("n_hit"), "hit_words", "items")


def contaminated(share: int = 20) -> Column:
    """Whether at least one word in ``share`` is hit."""
    return (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))


def report(docs: DataFrame, benchmark: DataFrame, n: int = N, **options) -> DataFrame:
    """One row for each document: counts, a digest of the items found, and the verdict."""
    return hits(docs, benchmark, n, **options).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, n: int = N, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without contaminated documents; of others, hit words are cut out with what follows each.

    Hits are joined back by id and text hash, and only rows with hits are rebuilt.
    """
    plain = common.texts(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    hit_id, hit_hash, hit_words, hit_bad = common.fresh(docs.columns, "hit_id", "hit_hash", "hit_words", "hit_bad")
    found = hits(plain, benchmark, n, keys=("text_hash",), **options).filter("n_hit > 0").dropDuplicates(["doc_id", "text_hash"])
    found = common.settle(found.select(F.col("doc_id").alias(hit_id), F.col("text_hash").alias(hit_hash), F.col("hit_words").alias(hit_words), contaminated().alias(hit_bad)), "hits")
    size = found.agg(F.count("*"), F.sum(F.size(hit_words))).first()
    found = F.broadcast(found) if 40 * size[0] + 4 * (size[1] or 0) <= BROADCAST_BYTES else found
    text = F.col(text_col)
    same = F.col(id_col).cast("long").eqNullSafe(F.col(hit_id)) & (F.xxhash64(text.cast("string")) == F.col(hit_hash))
    joined = docs.join(found, same, "left").filter(~F.coalesce(F.col(hit_bad), F.lit(False)))
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    pieces = F.regexp_extract_all(text, F.lit(f"{word}[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]*"), F.lit(0))
    lead = F.regexp_extract(text, r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*", 0)
    rest = F.filter(F.arrays_zip(pieces.alias("piece"), F.sequence(F.lit(0), F.size(pieces)).alias("at")), lambda x: x["piece"].isNotNull() & ~F.array_contains(F.col(hit_words), x["at"]))
    cut = F.concat(lead, F.array_join(F.transform(rest, lambda x: x["piece"]), ""))
    return joined.withColumn(text_col, F.when(F.col(hit_words).isNotNull(), cut).otherwise(text)).select(*docs.columns)
