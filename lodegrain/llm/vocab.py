"""Tokenizer files, read on the driver and handed to the tasks as text."""

from __future__ import annotations

import array
import functools
import os
import re

import pyarrow as pa
import pyarrow.compute

from lodegrain.llm import common

# A task has one core: the library's own thread pool would only spin on the others'.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Bytes that a worker's remembered chunks and their ids may take; past this the newest that take half of it stay.
MEMORY = 64 << 20
#: Bytes a remembered chunk takes in the hash table of a look-up, beside its characters and ids.
ENTRY = 40
#: Texts encoded together hold about so many characters.
TEXTS = 4 << 20
#: ASCII punctuation that words often end in.
TAIL = ".,!#$%&*|"


def read_file(path: str) -> str:
    """The vocabulary file's content; executors get it with the task, not by path."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class WordIds:
    """Token ids of texts by the ``tokenizers`` library, each distinct word encoded once.

    Texts are cut at the ASCII space and newline. For a vocabulary whose pre-tokenizer
    never joins across white space, the ids of a text are those of its chunks in order.
    Arrow makes a dictionary of the chunks of a call and looks its entries up among those
    remembered, which are one Arrow array with their ids in one NumPy array; only chunks
    not met before become Python strings. Construction checks that the file is of that
    kind; other files are encoded text by text.
    """

    def __init__(self, content: str):
        import json

        import numpy as np
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(content)
        self.library.no_padding()
        self.library.no_truncation()
        spec = json.loads(content)
        suffix = spec["model"].get("end_of_word_suffix")
        split = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        added = spec.get("added_tokens", [])
        self.by_chunk = bool(suffix) and split.get("behavior") == "Removed" and split.get("invert") and not any(
            x["lstrip"] or x["rstrip"] or x["single_word"] or re.search(r"\s", x["content"]) for x in added
        )
        size = self.library.get_vocab_size()
        self.dtype = np.uint16 if size <= 1 << 16 else np.uint32
        self.kind = functools.partial(array.array, "H" if size <= 1 << 16 else "I")
        self.letters = byte_letters()
        self._set([""], [b""])

    def _library_ids(self, items: list[str]) -> list[bytes]:
        import numpy as np

        return [np.asarray(e.ids, self.dtype).tobytes() for e in self.library.encode_batch_fast(items, add_special_tokens=False)]

    def _word(self, word: str) -> bytes:
        """Ids of lower-case Latin letters, of which normalising and pre-tokenising make the one word itself."""
        shown = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return self.kind([t.id for t in self.library.model.tokenize(shown)]).tobytes()

    def _set(self, chunks: list[str], ids: list[bytes]) -> None:
        import numpy as np

        self.known = pa.array(chunks, pa.string())
        self.ids = np.frombuffer(b"".join(ids), self.dtype)
        self.ends = np.cumsum([0, *map(len, ids)]) // self.dtype().itemsize

    def _add(self, chunks: list[str], ids: list[bytes]) -> None:
        import numpy as np

        known, old, ends = self.known, self.ids, self.ends
        self._set(chunks, ids)
        self.known = pa.concat_arrays([known, self.known])
        self.ids = np.concatenate([old, self.ids])
        self.ends = np.concatenate([ends, self.ends[1:] + ends[-1]])

    def remembered(self) -> int:
        """Bytes of the chunks remembered."""
        return self.known.get_total_buffer_size() + self.ids.nbytes + self.ends.nbytes + ENTRY * len(self.known)

    def _forget(self) -> None:
        """Keep the newest chunks that take half of the bound."""
        size = self.remembered()
        if size > MEMORY:
            first = len(self.known) - int(len(self.known) * (MEMORY / 2 / size))
            self.known = pa.concat_arrays([self.known[first:]])
            self.ids = self.ids[self.ends[first] :].copy()
            self.ends = self.ends[first:] - self.ends[first]

    def _places(self, chunks: pa.Array):
        """Where each of these distinct chunks is remembered, -1 if it isn't."""
        return pa.compute.index_in(chunks, value_set=self.known).fill_null(-1).to_numpy().copy()

    def _learn(self, chunks: list[str]) -> list[int]:
        """Remember chunks not met before; returns their places."""
        parts: dict[str, int] = {}
        words, cut = set(), []
        for chunk in chunks:
            head = chunk.rstrip(TAIL)
            low = head.lower()
            # Lower-casing may leave a mark that belongs to what follows: then the chunk isn't cut.
            if head.isalpha() and (head.isascii() or max(head) < "ɐ" and low.isalpha()):
                words.add(low)
                tail = chunk[len(head) :]
                if tail:
                    parts[tail] = -1
            else:
                low, tail = chunk, ""
            parts[low] = -1
            cut.append((low, tail))
        parts = dict(zip(parts, self._places(pa.array(parts, pa.string())).tolist()))
        new = [x for x, place in parts.items() if place < 0]
        found = {x: self._word(x) for x in new if x in words}
        other = [x for x in new if x not in words]
        found.update(zip(other, self._library_ids(other)))
        parts.update(zip(found, range(len(self.known), len(self.known) + len(found))))
        self._add(list(found), list(found.values()))
        ids, ends = memoryview(self.ids.tobytes()), (self.ends * self.ids.itemsize).tolist()
        made: dict[str, bytes] = {}
        out = []
        for chunk, (low, tail) in zip(chunks, cut):
            if low == chunk:
                out.append(parts[low])
            else:
                out.append(len(self.known) + len(made))
                spans = [parts[low], parts[tail]] if tail else [parts[low]]
                made[chunk] = b"".join([ids[ends[p] : ends[p + 1]] for p in spans])
        self._add(list(made), list(made.values()))
        return out

    def encode(self, bodies: list[str]) -> list[bytes]:
        """Ids of each text as little-endian bytes of ``dtype``."""
        import numpy as np

        if not self.by_chunk:
            return self._library_ids(bodies)
        self._forget()
        cut = pa.compute.split_pattern(pa.compute.replace_substring(pa.array(bodies, pa.string()), "\n", " "), " ")
        coded = cut.flatten().dictionary_encode()
        places = self._places(coded.dictionary)
        unseen = np.flatnonzero(places < 0)
        if len(unseen):
            places[unseen] = self._learn(coded.dictionary.take(pa.array(unseen)).to_pylist())
        at = places[coded.indices.to_numpy()]
        n = np.diff(self.ends)[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        flat = self.ids[np.repeat(self.ends[at] - ends[:-1], n) + np.arange(ends[-1])]
        stops = ends[np.cumsum(cut.value_lengths().to_numpy())].tolist()
        return [flat[a:b].tobytes() for a, b in zip([0, *stops], stops)]


def word_ids(content: str) -> WordIds:
    """One tokenizer for each worker process."""
    return common.held(f"word ids {hash(content)}", lambda: WordIds(content))
