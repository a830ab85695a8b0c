"""Licence scan: headers and licence files by sparse TF-IDF cosine to templates, then inheritance from directories.

The terms are those of the templates; their document frequencies come from all texts. A line without any of a template's heavy
terms cannot reach the threshold (the rest of the template's weight bounds the cosine), so only lines with one are compared. A file
that is mostly licence text speaks for its directory; files without a header of their own take the licence of the nearest
directory above them that has one, found by joins on paths.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrimlens.llm.common import id_in, id_out, settle, slices

# How public licences are stated at the head of a file, and how their texts begin.
TEMPLATES: dict[str, list[str]] = {
    "MIT": ["Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0", "Apache License Version 2.0, January 2004", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-or-later", "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only", "GNU GENERAL PUBLIC LICENSE Version 2, June 1991"],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3.", "SPDX-License-Identifier: LGPL-3.0-only"],
    "BSD-3-Clause": ["Released under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "ISC": ["Released under the ISC License.", "SPDX-License-Identifier: ISC"],
    "Unlicense": ["This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"],
}

_TERM = re.compile(r"[^\W_]+")
LONGEST_LINE, STRIDE = 60, 30  # words; longer lines are also compared by windows of this size


def terms(text: str) -> list[str]:
    return _TERM.findall(text.lower())


VOCABULARY = sorted({t for texts in TEMPLATES.values() for x in texts for t in terms(x)})


def document_frequencies(docs: DataFrame, text: str) -> DataFrame:
    """(term, n) over all texts for the terms of the templates; term null counts the texts. Added up by task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, total, rows = frozenset(VOCABULARY), Counter(), 0
        for batch in slices(batches, "text"):
            for value in batch.column("text").to_pylist():
                total.update(wanted.intersection(terms(value or "")))
                rows += 1
        yield pa.RecordBatch.from_arrays([pa.array([*total, None], pa.string()), pa.array([*total.values(), rows], pa.int64())], names=["term", "n"])

    return docs.select(F.col(text).cast("string").alias("text")).mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


class Matcher:
    """Cosines of lines with the templates."""

    def __init__(self, frequencies: dict[str | None, int], threshold: float) -> None:
        n = frequencies.get(None, 0)
        self.threshold = threshold
        self.weight = {t: math.log((n + 1) / (frequencies.get(t, 0) + 1)) + 0.01 for t in VOCABULARY}
        #: A term that no template has weighs as much as theirs do on average.
        self.other = sum(self.weight.values()) / len(self.weight)
        self.names: list[str] = []
        self.postings: dict[str, list[tuple[int, float]]] = {}
        self.heavy: set[str] = set()
        self.numbers = {t: i for i, t in enumerate(VOCABULARY)}
        #: Squared weights by number of the term; the last is for all other terms.
        self.squares = np.array([*(self.weight[t] for t in VOCABULARY), self.other]) ** 2
        #: Of each template: its words, its heavy terms, and what each term adds to the product with it.
        self.shapes: list[tuple[int, frozenset[str], np.ndarray]] = []
        for name, texts in TEMPLATES.items():
            for text in texts:
                words = terms(text)
                vector, norm = self.vector(words)
                unit = {t: w / norm for t, w in vector.items()}
                own, gains = set(), np.zeros(len(VOCABULARY) + 1)
                number = len(self.names)
                self.names.append(name)
                left = 1.0  # squared length of what has no heavy term yet
                for t, w in sorted(unit.items(), key=lambda x: (-x[1], x[0])):
                    self.postings.setdefault(t, []).append((number, w))
                    gains[self.numbers[t]] = w * self.weight[t]
                    if left >= threshold**2:
                        own.add(t)
                        left -= w * w
                self.heavy |= own
                self.shapes.append((len(words), frozenset(own), gains))

    def vector(self, words: list[str]) -> tuple[dict[str, float], float]:
        counts = Counter(words)
        vector = {t: c * self.weight[t] for t, c in counts.items() if t in self.weight}
        rest = sum((c * self.other) ** 2 for t, c in counts.items() if t not in self.weight)
        return vector, math.sqrt(sum(w * w for w in vector.values()) + rest) or 1.0

    def line(self, words: list[str]) -> tuple[float, str] | None:
        """The best template of a line, ties by name, or nothing below the threshold."""
        vector, norm = self.vector(words)
        scores: dict[int, float] = {}
        for t, w in vector.items():
            for number, weight in self.postings.get(t, ()):
                scores[number] = scores.get(number, 0.0) + w * weight
        best: dict[str, float] = {}
        for number, score in scores.items():
            best[self.names[number]] = max(best.get(self.names[number], 0.0), min(1.0, round(score / norm, 9)))
        if not best:
            return None
        name = min(best, key=lambda x: (-best[x], x))
        return (best[name], name) if best[name] >= self.threshold else None

    def windows(self, words: list[str]) -> list[tuple[float, str, int, int]]:
        """Stretches with as many words as a template has that reach the threshold: cosine, licence, first and last word. Of those
        that overlap only the best. Every stretch with a heavy term of the template is compared, line breaks do not matter."""
        codes = np.array([self.numbers.get(w, len(VOCABULARY)) for w in words])
        # Repeated terms make a vector longer than this sum says, so the quotient is never below the cosine.
        squares = np.concatenate([[0.0], np.cumsum(self.squares[codes])])
        present, places = frozenset(words), set()
        for size, own, gains in self.shapes:
            if own.isdisjoint(present):
                continue
            size = min(size, len(words))
            product = np.concatenate([[0.0], np.cumsum(gains[codes])])
            product, square = product[size:] - product[:-size], squares[size:] - squares[:-size]
            places.update((first, size) for first in np.flatnonzero(product >= (self.threshold - 1e-6) * np.sqrt(np.maximum(square, 0.0))).tolist())
        hits = [(-now[0], now[1], first, first + size) for first, size in places if (now := self.line(words[first : first + size]))]
        taken, out = np.zeros(len(words), bool), []
        for score, name, first, last in sorted(hits):
            if not taken[first:last].any():
                taken[first:last] = True
                out.append((-score, name, first, last))
        return out

    def text(self, text: str) -> tuple[str | None, float, float]:
        """Licence, cosine and share of the words in lines and windows that state a licence."""
        low = text.lower()
        every = _TERM.findall(low)
        if self.heavy.isdisjoint(every):
            return None, 0.0, 0.0
        covered = np.zeros(len(every), bool)
        found: tuple[float, str] | None = None
        last = 0
        for line in low.split("\n"):
            words = _TERM.findall(line)
            start, last = last, last + len(words)
            if self.heavy.isdisjoint(words):
                continue
            hit = None
            for first in range(0, max(1, len(words) - STRIDE), STRIDE) if len(words) > LONGEST_LINE else (0,):
                now = self.line(words[first : first + LONGEST_LINE])
                if now and (hit is None or (-now[0], now[1]) < (-hit[0], hit[1])):
                    hit = now
            if hit:
                covered[start:last] = True
                if found is None or (-hit[0], hit[1]) < (-found[0], found[1]):
                    found = hit
        for score, name, first, end in self.windows(every):
            covered[first:end] = True
            if found is None or (-score, name) < (-found[0], found[1]):
                found = score, name
        return (found[1], found[0], float(covered.mean())) if found else (None, 0.0, 0.0)


def _parent(path: Column) -> Column:
    return F.when(F.instr(path, "/") > 0, F.regexp_replace(path, "/[^/]*$", "")).when(path.isNotNull(), F.lit(""))


def scan(
    docs: DataFrame, path: str | Column = "path", id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.6, file_share: float = 0.5,
) -> DataFrame:
    """One row per document: id, path, own_licence, own_score, is_licence_file, licence, inherited_from.

    A document's own licence is the best template of any of its lines, or of any stretch of a template's number of words, from a cosine
    of `threshold`. One whose lines and stretches with a licence hold at least `file_share` of its words is a licence file; of several in a directory the higher cosine wins, then the
    smaller id, a null id being the smallest. Documents without an own licence take that of the nearest directory upwards, their
    own included, or null. A null path has no directory, a null text no licence. Rows repeated under one id are files of their
    own with equal results; an empty table gives an empty result. Every line of a text counts, however long the text is; other
    columns are not read.
    """
    frequencies = {r["term"]: r["n"] for r in document_frequencies(docs, text_col).collect()}  # a row a term of the templates
    matcher_args = frequencies, threshold
    out = pa.schema([("id", pa.int64()), ("path", pa.string()), ("own_licence", pa.string()), ("own_score", pa.float64()), ("share", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(*matcher_args)
        for batch in slices(batches, "text"):
            names, scores, shares = zip(*(matcher.text(t or "") for t in batch.column("text").to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("path").cast(pa.string()), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(shares, pa.float64())], schema=out)

    where = (F.col(path) if isinstance(path, str) else path).cast("string")
    rows = docs.select(id_in(id_col).alias("id"), where.alias("path"), F.col(text_col).cast("string").alias("text"))
    files = rows.mapInArrow(run, "id long, path string, own_licence string, own_score double, share double")
    files = files.withColumn("is_licence_file", F.col("own_licence").isNotNull() & (F.col("share") >= file_share)).withColumn("directory", _parent(F.col("path")))
    files = settle(files)  # read three times, without texts
    stated = files.where("is_licence_file AND directory IS NOT NULL").groupBy("directory").agg(
        F.max_by(F.col("own_licence"), F.struct("own_score", -F.col("id").cast("decimal(38,0)"))).alias("given")).withColumnRenamed("directory", "ancestor")
    directories = files.where("directory IS NOT NULL").select("directory").distinct()
    steps = F.split("directory", "/")
    upwards = directories.select("directory", F.explode(F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.array_join(F.slice(steps, 1, k), "/"))).alias("ancestor")).distinct()
    nearest = upwards.join(stated, "ancestor").groupBy("directory").agg(
        F.max_by(F.struct("given", "ancestor"), F.length("ancestor")).alias("nearest"))
    return files.join(nearest, "directory", "left").select(
        id_out("id").alias(id_col), "path", "own_licence", "own_score", "is_licence_file",
        F.coalesce("own_licence", "nearest.given").alias("licence"), F.when(F.col("own_licence").isNull(), F.col("nearest.ancestor")).alias("inherited_from"))
