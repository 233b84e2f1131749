"""Language identification by prediction by partial matching (PPM) over bytes.

For each language, a context tree of the orders 0 to 3 holds how often each byte followed
each context in labelled text. A byte is coded in the longest context that the tree has;
a context in which the byte never occurred is left by an escape, whose probability is
distinct / (total + distinct), and bytes that it did hold are excluded further down. Below
order 0 all remaining bytes are alike. Statistics are frozen after learning, so the code
length of a byte depends on the three bytes before it and itself. A text's code length is
the exact sum; runs of four bytes that were met before are remembered with their lengths.

Trees are sorted arrays of the runs that occurred, so a language costs bytes in proportion
to its sample and not to the alphabet. The bytes that a longer context held are a subset of
those of the shorter one; what exclusion takes from a context's sums is therefore a number
of the longer context alone, and stored with it.

The language with the shortest code is predicted; the score is its posterior probability
under equal priors.

Defined results: null text or text without a letter gives ``und`` with score 0; where no
labelled text was there to learn from, all rows are ``und``; ties go to the language that
sorts first; repeated rows repeat; an empty table gives an empty result; extra columns are
ignored by ``predict`` and kept by ``keep_identified``; a very long text is scored whole, in
blocks, so beside its bytes it takes no more memory than others.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lodegrain.llm import common

ORDER = 3
UNDETERMINED = "und"
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, bits_per_byte double"
#: Bytes of remembered code lengths in a worker; numbers looked up at once.
REMEMBERED, BLOCK = 16 << 20, 1 << 20
#: Runs of all languages together, at some 60 bytes each in the trees.
MOST_RUNS = 5_000_000
#: Bits a byte, above which even the best language's code is no shorter than the text, in texts of so many bytes.
MOST_BITS, FROM_BYTES = 8.0, 64
#: What stands before a text, in learning and in scoring.
PAD = b"\n" * ORDER


def _joined(bodies: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, each behind the padding; where each text begins and its size."""
    raw = [x.encode("utf-8", "replace") for x in bodies]
    sizes = np.array([len(x) for x in raw], np.int64)
    starts = np.cumsum(sizes + ORDER) - sizes
    return np.frombuffer(PAD + PAD.join(raw), np.uint8), starts, sizes


def learn_counts(docs: DataFrame, per_language: int, most_languages: int) -> DataFrame:
    """(lang, gram, n): how often each run of four bytes occurs in the labelled sample.

    The sample is about ``per_language`` whole texts of each language, chosen by a hash of
    id and text; counting happens in the tasks and only distinct runs leave them.
    """
    sizes = docs.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(most_languages).collect()
    if not sizes:
        return docs.sparkSession.createDataFrame([], "lang string, gram long, n long")
    share = F.create_map(*[F.lit(x) for lang, n in sizes for x in (lang, min(1.0, per_language / n))])
    sample = docs.filter(F.pmod(F.xxhash64(F.lit("sample"), "doc_id", "text"), F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            bodies = batch.column(1).to_pylist()
            for lang in sorted(set(langs.tolist())):
                own = [b for b, x in zip(bodies, langs) if x == lang]
                for _, part in common.slices(own, own):
                    data, starts, lengths = _joined(part)
                    if not lengths.sum():
                        continue
                    wide = data.astype(np.int64)
                    grams = wide[3:] | wide[2:-1] << 8 | wide[1:-2] << 16 | wide[:-3] << 24
                    inside = np.zeros(len(data) + 1, np.int64)
                    np.add.at(inside, starts, 1)
                    np.add.at(inside, starts + lengths, -1)
                    grams, n = np.unique(grams[np.cumsum(inside)[ORDER:-1] > 0], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams)), pa.array(grams), pa.array(n)], ["lang", "gram", "n"])

    counted = common.map_batches(sample.select("lang", "text"), run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of ``n``."""
    keys, place = np.unique(keys, return_inverse=True)
    return keys, np.bincount(place, n, len(keys))


def _places(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each wanted value is in the sorted keys, and whether it is there."""
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class Tree:
    """One language's contexts of the orders 0 to 3, frozen."""

    def __init__(self, grams: np.ndarray, n: np.ndarray):
        self.runs, self.contexts = [], []  # by order: (runs, counts) and (contexts, totals, distinct, what they exclude below)
        for k in range(ORDER + 1):
            runs, counts = _summed(grams & ((1 << 8 * (k + 1)) - 1), n)
            contexts, totals = _summed(runs >> 8, counts)
            distinct = np.bincount(_places(contexts, runs >> 8)[0], minlength=len(contexts)).astype(float)
            excluded = np.zeros(len(contexts))
            if k:
                shorter, least = self.runs[-1]
                excluded = np.bincount(_places(contexts, runs >> 8)[0], least[_places(shorter, runs & ((1 << 8 * k) - 1))[0]], len(contexts))
            self.runs.append((runs, counts))
            self.contexts.append((contexts, totals, distinct, excluded))

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for part in (*self.runs, *self.contexts) for x in part)

    def code_lengths(self, grams: np.ndarray) -> np.ndarray:
        """Bits of each run's last byte after the bytes before it."""
        bits = np.zeros(len(grams))
        todo = np.ones(len(grams), bool)
        gone_total = gone_distinct = np.zeros(len(grams))
        for k in range(ORDER, -1, -1):
            contexts, totals, distinct, excluded = self.contexts[k]
            at, there = _places(contexts, grams >> 8 & ((1 << 8 * k) - 1))
            live = np.where(there, distinct[at] - gone_distinct, 0)
            whole = np.where(there, totals[at] - gone_total, 0) + live
            runs, counts = self.runs[k]
            place, seen = _places(runs, grams & ((1 << 8 * (k + 1)) - 1))
            coded, left = todo & seen, todo & ~seen & (whole > 0)
            bits[coded] += np.log2(whole[coded] / counts[place[coded]])
            bits[left] += np.log2(whole[left] / live[left])
            todo &= ~seen
            gone_total, gone_distinct = np.where(there, excluded[at], 0), np.where(there, distinct[at], 0)
        bits[todo] += np.log2(256 - self.contexts[0][2][0])
        return bits


class CodeLengths:
    """Frozen PPM statistics of several languages, with a bounded memory of code lengths."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        """``counts``: by language, four-byte runs and how often each occurs."""
        self.languages = sorted(counts)
        self.trees = [Tree(np.asarray(counts[x][0], np.int64), np.asarray(counts[x][1], np.float64)) for x in self.languages]
        self.bits_of_slots = min(18, (REMEMBERED // (8 + 4 * len(self.trees))).bit_length() - 1)
        self.keys = self.lengths = None

    @property
    def nbytes(self) -> int:
        return sum(t.nbytes for t in self.trees)

    def _lengths(self, grams: np.ndarray) -> np.ndarray:
        """(runs, languages) code lengths. A run's slot holds the last run that fell on it."""
        if self.keys is None:
            self.keys = np.full(1 << self.bits_of_slots, -1, np.int64)
            self.lengths = np.zeros((1 << self.bits_of_slots, len(self.trees)), np.float32)
        slot = lambda x: (x * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - self.bits_of_slots)
        at = slot(grams)
        out = self.lengths[at]
        unmet = np.flatnonzero(self.keys[at] != grams)
        if len(unmet):
            new, place = np.unique(grams[unmet], return_inverse=True)
            made = np.column_stack([t.code_lengths(new) for t in self.trees]).astype(np.float32)
            out[unmet] = made[place]
            at = slot(new)
            self.keys[at], self.lengths[at] = -1, 0
            # Of several new runs on one slot the last stays, with its own lengths.
            last = np.full(len(self.keys), -1, np.int64)
            last[at] = np.arange(len(new))
            stay = last[at] == np.arange(len(new))
            self.keys[at[stay]], self.lengths[at[stay]] = new[stay], made[stay]
        return out

    def bits(self, bodies: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Code length of each text in each language, and the texts' sizes in bytes."""
        data, _, sizes = _joined(bodies)
        n = len(bodies)
        out = np.zeros((n + 1, len(self.trees)))
        owner = np.repeat(np.column_stack([np.full(n, n), np.arange(n)]).ravel(), np.column_stack([np.full(n, ORDER), sizes]).ravel())
        block = max(1 << 12, BLOCK // len(self.trees))
        for at in range(ORDER, len(data), block):
            end = min(at + block, len(data))
            s = data[at - ORDER : end].astype(np.int64)
            lengths = self._lengths(s[:-3] << 24 | s[1:-2] << 16 | s[2:-1] << 8 | s[3:])
            own = owner[at:end]
            first = own.min()
            for k in range(len(self.trees)):
                sums = np.bincount(own - first, lengths[:, k])
                out[first : first + len(sums), k] += sums
        return out[:n], sizes


def learn(docs: DataFrame, per_language: int = 400, most_languages: int = 1000) -> CodeLengths | None:
    """Learn from (doc_id, text, lang); rows without text or language are left out.

    The sample is bounded by both parameters: about ``per_language`` texts of each of the
    ``most_languages`` commonest languages. What comes to the driver is their distinct
    four-byte runs. The trees are sent to the executors, so their bytes are checked.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    rows = common.settle(learn_counts(known, per_language, most_languages), "grams")
    runs = rows.count()
    if runs > MOST_RUNS:
        raise ValueError(f"{runs} runs of bytes were learnt, where {MOST_RUNS} can be sent to every executor; learn from fewer texts or languages")
    got = rows.toPandas()
    common.drop(rows)
    if got.empty:
        return None
    return CodeLengths({lang: (x["gram"].to_numpy(np.int64), x["n"].to_numpy(np.int64)) for lang, x in got.groupby("lang")})


def predict(docs: DataFrame, model: CodeLengths | None, held_out=None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, lang_pred, score, bits_per_byte) for each row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    label = f"languages {uuid.uuid4().hex}"
    plain = common.texts(docs, id_col, text_col)
    plain = plain.select("doc_id", "text", (F.lit(False) if held_out is None else held_out).alias("held_out"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("worded"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = common.held(label, lambda: shared.value)
        for batch in batches:
            bodies, worded = batch.column(1).to_pylist(), np.array(batch.column(3).to_pylist(), bool)
            lang, score, rate = [], [], []
            for _, part in common.slices(bodies, [b or "" for b in bodies]):
                if model is None:
                    lang += [UNDETERMINED] * len(part)
                    score += [0.0] * len(part)
                    rate += [None] * len(part)
                    continue
                bits, sizes = model.bits(part)
                best = bits.argmin(1)
                least = bits[np.arange(len(part)), best]
                lang += [model.languages[k] for k in best]
                score += (1 / np.exp2(least[:, None] - bits).sum(1)).tolist()
                rate += [b / n if n else None for b, n in zip(least.tolist(), sizes.tolist())]
            lang = [x if w else UNDETERMINED for x, w in zip(lang, worded)]
            score = [x if w else 0.0 for x, w in zip(score, worded)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rate, pa.float64())], [f.split()[0] for f in SCHEMA.split(", ")])

    return common.map_batches(plain, run, SCHEMA)


def keep_identified(docs: DataFrame, model: CodeLengths | None, least: float = 0.5, most_bits: float = MOST_BITS, text_col: str = "text") -> DataFrame:
    """``docs``, all columns, without rows whose language isn't determined.

    That is: texts without a letter, texts whose score is below ``least``, and texts of 64
    bytes or more that no learnt language codes in ``most_bits`` bits a byte.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    label = f"languages {uuid.uuid4().hex}"

    def best(bodies: list[str | None]) -> list[float]:
        model = common.held(label, lambda: shared.value)
        if model is None:
            return [0.0] * len(bodies)
        bits, sizes = model.bits([b or "" for b in bodies])
        rate = bits.min(1) / np.maximum(sizes, 1)
        score = 1 / np.exp2(bits.min(1, keepdims=True) - bits).sum(1)
        return np.where((sizes >= FROM_BYTES) & (rate > most_bits), 0.0, score).tolist()

    worded = docs.filter(F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    return worded.filter(common.map_texts(docs, text_col, best, "double") >= least)
