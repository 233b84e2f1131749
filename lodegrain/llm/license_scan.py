"""License scans: statements matched to templates, then inherited down the directories.

Lines that speak of licensing are cut into statements; each is a sparse TF-IDF vector and
gets the license of the template form with the highest cosine, if that reaches the
threshold. Around them, windows of each form's own length slide over the words whatever
lines they stand on and whatever comment marks stand between, so that wrapped headers,
licence files and statements inside long lines are compared with whole forms. SPDX tags
name their licenses. A file's license is that of its best statement. The conditions that
the BSD licenses share count for the 3-clause one where its third clause is found as well.
A file that is mostly such
statements, or is named like one, is a licence file: the files below its directory that
have no license of their own inherit from the nearest ancestor directory that has one.
Inheritance is worked out for distinct directories, by joins on ancestor paths, so a
directory's size doesn't matter.

Defined results: null text counts as empty and has no statement; a null path is the root;
ties go to the license that sorts first; two licence files of a directory give it the
better score's, then the one that sorts first; repeated rows repeat; an empty table gives
an empty result; extra columns are ignored; of a very long text all parts that speak of
licensing are compared, in time in proportion to its length.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lodegrain.llm import common

# Forms in which each license is usually stated.
TEMPLATES = {
    "AGPL-3.0": ("Licensed under the GNU Affero General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    "Apache-2.0": ("Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    "BSD-2-Clause": ("Licensed under the BSD 2-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    "BSD-3-Clause": ("Licensed under the BSD 3-Clause License.", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC0-1.0": ("Released under CC0 1.0 Universal, public domain dedication.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or any later version."),
    "GPL-3.0": ("This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    "ISC": ("Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "LGPL-3.0": ("Licensed under the GNU Lesser General Public License, version 3.", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    "MIT": ("Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction"),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Licensed under the Mozilla Public License 2.0."),
    "Unlicense": ("This is free and unencumbered software released into the public domain.",),
}
ANCHOR = re.compile(r"licen[sc]|spdx|copyright|permission|redistribut|public domain|creative commons|neither the name", re.IGNORECASE)
FILE_NAME = r"(?i)(^|/)(licen[sc]e|copying|notice|unlicense)([.-][^/]*)?$"
_TERM = re.compile(r"[a-z0-9]+(?:\.[0-9]+)*")
_WORD = re.compile(r"[A-Za-z0-9]+(?:\.[0-9]+)*")
_SPDX = re.compile(r"SPDX-License-Identifier[ \t]*:[ \t]*([^\r\n]*)", re.IGNORECASE)
_SPDX_ID = re.compile(r"[A-Za-z0-9.+-]+")
#: The anchors, also where their words are on neighbouring lines of a comment.
_NEAR = re.compile(ANCHOR.pattern.replace(" ", r"\W+(?:(?:dnl|rem)\W+)?"), re.IGNORECASE)
#: Comment marks that are words.
_MARK = re.compile(r"^([ \t]*)(dnl|rem)(?=[ \t])", re.IGNORECASE | re.MULTILINE)
#: (license, form): what it yields to where both are found, as the one's text is part of the other's.
YIELDS = {("BSD-2-Clause", 1): ("BSD-3-Clause", 1)}
#: Words of a statement looked at together; a longer line is cut into overlapping ones.
SPAN = 40


def terms(text: str) -> Counter:
    """Words and pairs of neighbouring words, with counts."""
    words = _TERM.findall(text.lower())
    return Counter(words) + Counter(f"{a} {b}" for a, b in zip(words, words[1:]))


class Templates:
    """Template forms as unit TF-IDF vectors, by term."""

    def __init__(self, templates: dict[str, tuple[str, ...]]):
        forms = [(name, terms(form)) for name, many in sorted(templates.items()) for form in many]
        found = Counter(t for _, bag in forms for t in bag)
        self.weight = {t: math.log((1 + len(forms)) / (1 + n)) + 1 for t, n in found.items()}
        self.unknown = math.log(1 + len(forms)) + 1
        self.names = [name for name, _ in forms]
        places = [(name, i) for name, many in sorted(templates.items()) for i in range(len(many))]
        self.yields = {places.index(a): places.index(b) for a, b in YIELDS.items() if a in places and b in places}
        self.lengths = [len(_TERM.findall(form.lower())) for _, many in sorted(templates.items()) for form in many]
        self.spdx = {name.lower(): name for name in templates}
        self.by_term: dict[str, list[tuple[int, float]]] = {}
        for k, (_, bag) in enumerate(forms):
            norm = math.sqrt(sum((n * self.weight[t]) ** 2 for t, n in bag.items()))
            for t, n in bag.items():
                self.by_term.setdefault(t, []).append((k, n * self.weight[t] / norm))
        # By term: its part of the product with each form, and its squared weight; the last row is of unknown terms.
        self.places = {t: i for i, t in enumerate(self.weight)}
        self.products = np.zeros((len(self.places) + 1, len(forms)))
        for t, many in self.by_term.items():
            for k, w in many:
                self.products[self.places[t], k] = self.weight[t] * w
        self.squares = np.array([*self.weight.values(), self.unknown]) ** 2

    def best(self, statement: str) -> tuple[float, str]:
        """(cosine, license) of the nearest form."""
        cosine, k = self.nearest(terms(statement))
        return cosine, self.names[k] if k >= 0 else ""

    def nearest(self, bag: Counter) -> tuple[float, int]:
        """(cosine, form) of the nearest form."""
        dots, norm = self.against(bag)
        return min(((-round(d / norm, 9), k) for k, d in dots.items()), default=(0.0, -1))

    def against(self, bag: Counter) -> tuple[dict[int, float], float]:
        """Products with the forms that share a term, and the norm."""
        norm = math.sqrt(sum((n * self.weight.get(t, self.unknown)) ** 2 for t, n in bag.items()))
        dots: dict[int, float] = {}
        for t, n in bag.items():
            for k, w in self.by_term.get(t, ()):
                dots[k] = dots.get(k, 0.0) + n * self.weight[t] * w
        return dots, norm

    def windows(self, words: list[str], threshold: float) -> list[tuple[float, int, int, int]]:
        """(-cosine, form, first word, end) of each window of a form's own length that reaches the threshold.

        Repeated terms only add to a norm, so the sum of squared weights bounds it from below:
        windows whose bound doesn't reach the threshold needn't be counted.
        """
        last = len(self.places)
        one = np.array([self.places.get(w, last) for w in words], np.int64)
        two = np.array([self.places.get(f"{a} {b}", last) for a, b in zip(words, words[1:])], np.int64)
        sums = lambda of: np.concatenate([np.zeros((1, *of.shape[1:])), np.cumsum(of, 0)])
        dots, pair_dots, squares, pair_squares = sums(self.products[one]), sums(self.products[two]), sums(self.squares[one]), sums(self.squares[two])
        bags: dict[tuple[int, int], tuple[dict[int, float], float]] = {}
        out = []
        for k, length in enumerate(self.lengths):
            n = min(length, len(words))
            at = np.arange(len(words) - n + 1)
            dot = dots[at + n, k] - dots[at, k] + pair_dots[at + n - 1, k] - pair_dots[at, k]
            square = squares[at + n] - squares[at] + pair_squares[at + n - 1] - pair_squares[at]
            for a in np.flatnonzero(dot >= (threshold - 1e-6) * np.sqrt(square)).tolist():
                if (a, n) not in bags:
                    cut = words[a : a + n]
                    bags[a, n] = self.against(Counter(cut) + Counter(f"{x} {y}" for x, y in zip(cut, cut[1:])))
                found, norm = bags[a, n]
                cosine = round(found.get(k, 0.0) / norm, 9)
                if cosine >= threshold:
                    out.append((-cosine, k, a, a + n))
        return out

    def matches(self, text: str, threshold: float) -> tuple[list[tuple[float, str, int, int]], float, int]:
        """((-cosine, license, start, end) of what reaches the threshold, the best cosine, how many statements)."""
        if not _NEAR.search(text):
            return [], 0.0, 0
        graded = [(*self.nearest(terms(x)), a, b) for x, a, b in placed(text)]
        good = [g for g in graded if -g[0] >= threshold]
        for words, starts, ends in regions(text, max(self.lengths)):
            good += [(score, k, starts[a], ends[b - 1]) for score, k, a, b in self.windows(words, threshold)]
        found = {k for _, k, *_ in good}
        named = [(score, self.names[k], a, b) for score, k, a, b in good if self.yields.get(k) not in found]
        for m in _SPDX.finditer(text):
            ids = [re.sub(r"(-only|-or-later|\+)$", "", x.lower()) for x in _SPDX_ID.findall(m[1])]
            named += [(-1.0, self.spdx[x], *m.span()) for x in ids if x in self.spdx]
        return named, -min((x[0] for x in [*graded, *named]), default=0.0), len(graded) or int(bool(named))


def placed(text: str) -> list[tuple[str, int, int]]:
    """(statement, start, end) of the parts of a whole text that speak of licensing."""
    if not ANCHOR.search(text):
        return []
    out, at = [], 0
    for line in text.split("\n"):
        if ANCHOR.search(line):
            words = [(m[0], m.start() + at, m.end() + at) for m in re.finditer(r"\S+", line)]
            cut = [words[i : i + SPAN] for i in range(0, max(1, len(words) - SPAN // 2), SPAN // 2)]
            joined = [(" ".join(w for w, *_ in x), x[0][1], x[-1][2]) for x in cut if x]
            out += [x for x in joined if ANCHOR.search(x[0])]
        at += len(line) + 1
    return out


def statements(text: str) -> list[str]:
    """The parts of a whole text that speak of licensing."""
    return [x for x, *_ in placed(text)]


def regions(text: str, reach: int) -> list[tuple[list[str], list[int], list[int]]]:
    """Runs of words (and where each starts and ends) up to ``reach`` words before and after what speaks of licensing."""
    text = _MARK.sub(lambda m: m[1] + " " * len(m[2]), text)
    found = [(m[0].lower(), m.start(), m.end()) for m in _WORD.finditer(text)]
    starts = [a for _, a, _ in found]
    out: list[list[int]] = []
    for m in _NEAR.finditer(text):
        k = bisect.bisect_right(starts, m.start())
        low, high = max(0, k - 1 - reach), min(len(found), k + reach)
        if out and low <= out[-1][1]:
            out[-1][1] = high
        elif low < high:
            out.append([low, high])
    return [([w for w, *_ in found[a:b]], starts[a:b], [e for *_, e in found[a:b]]) for a, b in out]


def covered(spans: list[tuple[int, int]]) -> int:
    """Characters in at least one span."""
    total = at = 0
    for a, b in sorted(spans):
        total += max(0, b - max(a, at))
        at = max(at, b)
    return total


SCANNED = "doc_id long, path string, license string, score double, n_statements long, licensed_share double"


def scan(files: DataFrame, threshold: float = 0.6, templates: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """From (doc_id, path, text): each file's own license, its score, and how much of the text is statements."""
    chosen = templates or TEMPLATES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(chosen)
        for batch in batches:
            rows = []
            for text in batch.column(2).to_pylist():
                good, score, n = known.matches(text or "", threshold)
                rows.append((min(good)[1] if good else None, score, n, min(1.0, covered([x[2:] for x in good]) / max(1, len((text or "").strip())))))
            license, score, n, share = zip(*rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(license, pa.string()), pa.array(score, pa.float64()), pa.array(n, pa.int64()), pa.array(share, pa.float64())], [f.split()[0] for f in SCANNED.split(", ")])

    return common.map_batches(files.select("doc_id", "path", "text"), run, SCANNED)


def directory(path: Column) -> Column:
    return F.regexp_extract(F.coalesce(path, F.lit("")), r"^(.*)/[^/]*$", 1)


def inherit(scanned: DataFrame, file_share: float = 0.5) -> DataFrame:
    """Adds license_file, effective_license and inherited_from (the directory)."""
    marked = scanned.withColumn("license_file", F.col("license").isNotNull() & ((F.col("licensed_share") >= file_share) | F.coalesce(F.col("path").rlike(FILE_NAME), F.lit(False)))).withColumn("dir", directory(F.col("path")))
    held = marked.filter("license_file").groupBy("dir").agg(F.min(F.struct(-F.col("score"), "license")).alias("best"))
    held = held.select(F.col("dir").alias("above"), F.col("best.license").alias("dir_license"))
    parts = F.split("dir", "/")
    ancestors = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    near = (
        marked.filter("license is null").select("dir").distinct()
        .select("dir", F.explode(F.array_distinct(ancestors)).alias("above"))
        .join(held, "above")
        .groupBy("dir").agg(F.max_by(F.struct("above", "dir_license"), F.length("above")).alias("near"))
    )
    out = marked.join(near, "dir", "left")
    own = F.col("license").isNotNull()
    return out.select(
        *scanned.columns, "license_file",
        F.when(own, F.col("license")).otherwise(F.col("near.dir_license")).alias("effective_license"),
        F.when(~own, F.col("near.above")).alias("inherited_from"),
    )


def licenses(docs: DataFrame, path: Column, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Scan and inheritance for each row of ``docs``, whose path is given by an expression.

    Inheritance reads the scan's few columns three times, so they are written once.
    """
    files = docs.select(F.col(id_col).cast("long").alias("doc_id"), path.cast("string").alias("path"), F.col(text_col).cast("string").alias("text"))
    return inherit(common.settle(scan(files, **options), "licenses"))
