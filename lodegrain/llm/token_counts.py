"""Token counts of byte-level BPE by merging, without producing ids.

Each pre-token is a doubly linked list of symbols. A heap holds the adjacent pairs that
a merge rule covers, keyed by rule rank and place. The lowest rank is merged first;
pairs that a merge made stale are skipped when popped. The count is the number of
initial byte symbols less the number of merges.

Defined results: null text counts as empty (0 bytes, 0 tokens); repeated rows give
repeated rows; an empty table gives an empty result; extra columns are ignored; a very
long text is counted whole, in time that grows with its length (a single pre-token of n
bytes takes n log n) and memory of its longest pre-token beside the text itself.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

from lodegrain.llm import common, vocab

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"

#: The published pre-token pattern of this family of vocabularies.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in vocabulary files."""
    shown = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class MergeCounter:
    """Counts tokens under the merge rules of a byte-level BPE file."""

    def __init__(self, content: str):
        import regex

        spec = json.loads(content)
        pre = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or spec["model"].get("ignore_merges"):
            raise ValueError("only byte-level vocabularies with the pattern of this module, without a normaliser, are counted")
        ids = {s: i for i, s in enumerate(byte_alphabet())}
        self.rules: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            made = ids.setdefault(left + right, len(ids))
            self.rules.setdefault((ids[left], ids[right]), (rank, made))
        special = [x["content"] for x in spec.get("added_tokens", [])]
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.marks = special
        self.pre_tokens = regex.compile(PRE_TOKEN).findall
        self.white_run = regex.compile(r" \s").search
        self.words: dict[str, int] = {}
        self.chunks: dict[str, int] = {}
        self.weight = 0

    def merged(self, word: str) -> int:
        """Tokens of one pre-token."""
        symbols = list(word.encode("utf-8"))
        n = len(symbols)
        if n < 2:
            return n
        rules = self.rules
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            rule = rules.get((symbols[i], symbols[i + 1]))
            if rule:
                heap.append((rule[0], i, rule[1], symbols[i], symbols[i + 1]))
        heapq.heapify(heap)
        merges = 0
        while heap:
            _, i, made, left, right = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = made, -1
            k = after[i] = after[j]
            merges += 1
            if k < n:
                before[k] = i
                rule = rules.get((made, symbols[k]))
                if rule:
                    heapq.heappush(heap, (rule[0], i, rule[1], made, symbols[k]))
            h = before[i]
            if h >= 0:
                rule = rules.get((symbols[h], made))
                if rule:
                    heapq.heappush(heap, (rule[0], h, rule[1], symbols[h], made))
        return n - merges

    def _pre_tokenised(self, text: str) -> int:
        total, words = 0, self.words
        for word in self.pre_tokens(text):
            count = words.get(word)
            if count is None:
                count = words[word] = self.merged(word)
                self.weight += vocab.ENTRY + len(word)
            total += count
        return total

    def _plain(self, text: str) -> int:
        """Tokens of a text without special strings.

        Where no space is followed by white space, cutting before each space never
        divides a pre-token, so counts of whole chunks can be remembered.
        """
        if self.white_run(text):
            return self._pre_tokenised(text)
        total, chunks = 0, self.chunks
        first, *rest = text.split(" ")
        if first:
            total += self._pre_tokenised(first)
        try:
            return total + sum([chunks[c] for c in rest])
        except KeyError:
            for c in rest:
                count = chunks.get(c)
                if count is None:
                    count = chunks[c] = self._pre_tokenised(" " + c)
                    self.weight += vocab.ENTRY + len(c)
                total += count
            return total

    def count(self, text: str) -> int:
        """Tokens of a text; special strings count one each, as the library takes them."""
        if self.weight > vocab.MEMORY:
            self.words.clear()
            self.chunks.clear()
            self.weight = 0
        if self.special and any(m in text for m in self.marks):
            return len(self.special.findall(text)) + sum(self._plain(part) for part in self.special.split(text))
        return self._plain(text)


def count_tokens(docs: DataFrame, vocabulary: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for each row of ``docs``; ``vocabulary`` is a file's path."""
    rules = docs.sparkSession.sparkContext.broadcast(vocab.read_file(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = common.held(f"merges {hash(rules.value)}", lambda: MergeCounter(rules.value))
        for batch in batches:
            bodies = pa.compute.fill_null(batch.column(1), "")
            counts = pa.array([counter.count(x.as_py()) for x in bodies], pa.int64())
            sizes = pa.compute.binary_length(bodies).cast(pa.int64())
            over = pa.compute.greater(counts, limit)
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, counts, over], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return common.map_batches(common.texts(docs, id_col, text_col), run, SCHEMA)
