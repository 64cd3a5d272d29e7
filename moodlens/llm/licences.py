"""Licence scan: TF-IDF cosine to notices and full licence texts, then inheritance from the nearest directory above."""

from __future__ import annotations

import math
import pkgutil
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodlens.llm.shared import join_hot
from moodlens.session import checkpointed

# fixed values: usual notices of licences
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    ),
    "MIT": (
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    ),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    ),
    "GPL-2.0": (
        "This work is licensed under the GNU General Public License, version 2",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version",
    ),
    "LGPL-2.1": (
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version",
    ),
    "LGPL-3.0": (
        "This library is licensed under the GNU Lesser General Public License, version 3",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    ),
    "AGPL-3.0": (
        "This program is licensed under the GNU Affero General Public License, version 3",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
    ),
    "BSD-3-Clause": (
        "Released under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "CC-BY-4.0": ("Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-NC-4.0": ("Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC0-1.0": ("This work is dedicated to the public domain under CC0 1.0 Universal",),
    "ISC": ("Released under the ISC License",),
}

# fixed values: the licences whose full texts lie in the folder licence_texts
FULL_TEXTS = (
    "AGPL-3.0", "Apache-2.0", "Artistic-1.0", "BSD-2-Clause", "BSD-3-Clause", "CC0-1.0", "GFDL-1.2", "GFDL-1.3", "GPL-1.0", "GPL-2.0", "GPL-3.0",
    "ISC", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-1.1", "MPL-2.0",
)

TERM = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")
#: Cosine from which a header names a licence, from which a whole file is a notice, and from which it is a full licence text.
HEADER_COSINE, FILE_COSINE, FULL_COSINE = 0.75, 0.6, 0.8
#: What ends a sentence or a line, neighbouring pieces that are joined at most, and terms of a piece of a sentence too long to be a notice.
BREAK, JOINED, PIECE = re.compile(r"(?<=[.;:!?])[^\S\n]+|\n"), 10, 4


def _terms(text: str) -> list[str]:
    return TERM.findall(text.lower())


@cache
def full_text(name: str) -> str:
    """The full text of a licence, read beside this module."""
    return pkgutil.get_data(__package__, f"licence_texts/{name}.txt").decode()


def _notice_terms() -> set[str]:
    return {t for texts in TEMPLATES.values() for text in texts for t in _terms(text)}


def vocabulary() -> list[str]:
    """The terms of all notices and full texts; their number does not depend on the data."""
    return sorted(_notice_terms().union(*(_terms(full_text(name)) for name in FULL_TEXTS)))


def term_weights(docs: DataFrame) -> tuple[dict[str, float], float]:
    """Inverse document frequencies of the template terms over all documents, and the weight of any other term (the mean over the notices)."""
    terms = vocabulary()
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(docs["text"], F.lit(""))), F.lit(TERM.pattern), F.lit(0)))
    found = docs.select(F.explode(F.filter(words, lambda w: w.isin(terms))).alias("term"))
    counts = {r["term"]: r["count"] for r in found.groupBy("term").count().collect()}
    rows = docs.count()
    weights = {t: 1 + math.log((rows + 1) / (counts.get(t, 0) + 1)) for t in terms}
    notices = _notice_terms()
    return weights, sum(weights[t] for t in sorted(notices)) / len(notices)


class Templates:
    """Unit vectors of the notices and full texts, and the key terms of which a text needs one to reach the threshold with any of them."""

    def __init__(self, weights: dict[str, float], other: float, threshold: float):
        self.weights, self.other = weights, other
        notices = [(name, _terms(text)) for name, texts in TEMPLATES.items() for text in texts]
        self.vectors = [(name, self.unit(terms)) for name, terms in notices]
        self.full = [(name, self.unit(_terms(full_text(name)), True)) for name in FULL_TEXTS]
        self.longest = 2 * max(len(terms) for _, terms in notices)
        self.keys = self._keys(self.vectors, threshold)
        self.full_keys = self._keys(self.full, FULL_COSINE)
        self.vector_terms, self.full_terms = self._by_term(self.vectors), self._by_term(self.full)

    @staticmethod
    def _by_term(vectors: list[tuple[str, dict[str, float]]]) -> dict[str, list[tuple[int, float]]]:
        """The vectors that hold a term, with its weight there."""
        holders: dict[str, list[tuple[int, float]]] = {}
        for k, (_, vector) in enumerate(vectors):
            for term, w in vector.items():
                holders.setdefault(term, []).append((k, w))
        return holders

    def _keys(self, vectors: list[tuple[str, dict[str, float]]], threshold: float) -> set[str]:
        """Rare and long terms come first, as they seldom stand in other texts or within other words."""
        keys: set[str] = set()
        for _, vector in vectors:
            rest = sum(w * w for t, w in vector.items() if t not in keys)
            for term, w in sorted(vector.items(), key=lambda x: (-self.weights.get(x[0], self.other) - len(x[0]), x[0])):
                if rest < threshold * threshold:
                    break
                if term not in keys:
                    keys.add(term)
                    rest -= w * w
        return keys

    def unit(self, terms: list[str], damped: bool = False) -> dict[str, float]:
        """The unit vector of a text; ``damped`` counts a repeated term by the logarithm, so that common words do not lead in long texts."""
        vector = {t: (1 + math.log(n) if damped else n) * self.weights.get(t, self.other) for t, n in Counter(terms).items()}
        norm = math.sqrt(sum(w * w for w in vector.values()))
        return {t: w / norm for t, w in vector.items()} if norm else {}

    def best(self, terms: list[str]) -> tuple[float, str | None]:
        """Largest cosine to a notice and its licence, the cosine negated; ties go to the first name."""
        return self._nearest(self.unit(terms), self.vectors, self.vector_terms)

    def best_full(self, terms: list[str]) -> tuple[float, str | None]:
        """The same for the full texts."""
        return self._nearest(self.unit(terms, True), self.full, self.full_terms)

    @staticmethod
    def _nearest(unit: dict[str, float], vectors: list[tuple[str, dict[str, float]]], holders: dict[str, list[tuple[int, float]]]) -> tuple[float, str | None]:
        """Only the terms that a vector shares with the text are multiplied; most terms of a text are in no vector."""
        if not unit:
            return 0.0, None
        shared: dict[int, list[float]] = {}
        for t, w in unit.items():
            for k, v in holders.get(t, ()):
                shared.setdefault(k, []).append(w * v)
        if not shared:
            return 0.0, min((name for name, _ in vectors), default=None)
        return min((-sum(products), vectors[k][0]) for k, products in shared.items())


def _pieces(low: str, longest: int) -> list[tuple[int, int, list[str]]]:
    """Start, paragraph and terms of the sentences of every line; a sentence of more than ``longest`` terms falls into short pieces.

    A line without terms ends a paragraph.
    """
    pieces, paragraph, at = [], 0, 0
    for end in [m.span() for m in BREAK.finditer(low)] + [(len(low), len(low))]:
        found = list(TERM.finditer(low, at, end[0]))
        if len(found) > longest:
            cuts = range(0, len(found), PIECE)
            pieces += [(found[k].start() if k else at, paragraph, [m[0] for m in found[k : k + PIECE]]) for k in cuts]
        elif found:
            pieces.append((at, paragraph, [m[0] for m in found]))
        elif not low[low.rfind("\n", 0, at) + 1 : end[0]].strip(" \t\r*#/;-<>!") and low[end[0] : end[1]] == "\n":
            paragraph += 1
        at = end[1]
    return pieces


def best_header(low: str, finder: ahocorasick.Automaton, templates: Templates) -> tuple[float, str | None, int]:
    """Best cosine, licence and start over the lines with a key term and over the joined neighbours of every piece with one.

    Pieces are sentences, or parts of very long ones. A notice wrapped over several lines or standing within a long line is met whole.
    """
    header, line_end, piece_end = (0.0, None, -1), -1, -1
    pieces: list[tuple[int, int, list[str]]] = []
    starts: list[int] = []
    seen: set[tuple[int, int]] = set()
    for end, _ in finder.iter(low):
        if end > line_end:
            start = low.rfind("\n", 0, end) + 1
            line_end = low.find("\n", end)
            line_end = len(low) if line_end < 0 else line_end
            cosine, name = templates.best(TERM.findall(low[start:line_end]))
            if -cosine > header[0] + 1e-12:
                header = (-cosine, name, start)
        if end < piece_end:
            continue
        if not pieces:
            pieces = _pieces(low, templates.longest)
            starts = [p[0] for p in pieces]
        hit = bisect_right(starts, end) - 1
        if hit < 0:
            continue
        piece_end = starts[hit + 1] if hit + 1 < len(pieces) else len(low)
        for first in range(hit, max(-1, hit - JOINED), -1):
            if pieces[first][1] != pieces[hit][1]:
                break
            terms: list[str] = []
            for last in range(first, min(len(pieces), first + JOINED)):
                terms = terms + pieces[last][2]
                if pieces[last][1] != pieces[hit][1] or len(terms) > templates.longest:
                    break
                if last < hit or (first, last) in seen:
                    continue
                seen.add((first, last))
                cosine, name = templates.best(terms)
                if -cosine > header[0] + 1e-12:
                    header = (-cosine, name, starts[first])
    return header


def _scan(weights: dict[str, float], other: float):
    """Task that compares the headers of every text, and the whole text if it may be a licence file, with the templates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(weights, other, min(HEADER_COSINE, FILE_COSINE))
        finder, full_finder = (ahocorasick.Automaton() for _ in range(2))
        for automaton, keys in ((finder, templates.keys), (full_finder, templates.full_keys)):
            for key in keys:
                automaton.add_word(key, len(key))
            automaton.make_automaton()
        names = ["doc_id", "path", "header", "header_cosine", "header_start", "file", "file_cosine"]
        types = [pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64(), pa.string(), pa.float64()]
        for batch in batches:
            rows = []
            for doc_id, path, text in zip(*(c.to_pylist() for c in batch.columns)):
                whole = (0.0, None)
                low = (text or "").lower()
                header = best_header(low, finder, templates)
                full = next(full_finder.iter(low), None) is not None
                if header[1] or full:
                    terms = TERM.findall(low)
                    cosine, name = templates.best_full(terms) if full else (0.0, None)
                    if -cosine >= FULL_COSINE:
                        whole = (-cosine, name)
                    elif header[1]:
                        cosine, name = templates.best(terms)
                        whole = (-cosine, name)
                head = header if header[0] >= HEADER_COSINE else (header[0], None, None)
                rows.append((doc_id, path, head[1], head[0], head[2], whole[1] if whole[0] >= FILE_COSINE else None, whole[0]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return run


def _folder(path: Column) -> Column:
    """The folder of a path, without its last slash; empty for a path without one."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def scan_licences(docs: DataFrame, path: Column) -> DataFrame:
    """One row per row of ``docs``: doc_id, path, licence, cosine, basis, header_start, licence_path.

    ``basis`` is ``file`` for a text that as a whole is a licence, else ``header`` for one with a line, or up to ten neighbouring sentences
    or lines of a paragraph, that is a licence notice, else
    ``inherited`` if a folder above holds a licence file; the nearest one counts, and in it the best cosine, then the smallest path. All
    lines of a text are compared, not the first ones only. Texts without licence have nulls. A null text is empty; a null path inherits
    nothing; repeated rows are scanned alike; other columns are ignored; an empty table gives no rows.
    """
    weights, other = term_weights(docs)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), path.cast("string").alias("path"), "text")
    schema = "doc_id long, path string, header string, header_cosine double, header_start long, file string, file_cosine double"
    scanned = checkpointed(texts.mapInArrow(_scan(weights, other), schema))

    files = scanned.filter("file is not null and path is not null").select(_folder(F.col("path")).alias("above"), "path", "file", "file_cosine")
    files = files.groupBy("above").agg(F.min_by(F.struct("path", "file", "file_cosine"), F.struct(-F.col("file_cosine"), F.col("path"), F.col("file"))).alias("f"))
    folders = scanned.filter("path is not null").select(_folder(F.col("path")).alias("folder")).distinct()
    parts = F.split("folder", "/")
    above = folders.select("folder", F.posexplode(F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))).alias("depth", "above"))
    above = checkpointed(above.dropDuplicates(["folder", "above"]))
    met = above.groupBy("above").agg(F.count("*").alias("n"))
    holders = checkpointed(files.join(met, "above").select("above", "n", F.col("f.path").alias("licence_path"), F.col("f.file").alias("up"), F.col("f.file_cosine").alias("up_cosine")))
    found = join_hot(above, holders, ["above"], "n", "folder").filter("n is not null")
    heirs = found.groupBy("folder").agg(F.max_by(F.struct("licence_path", "up", "up_cosine"), "depth").alias("heir"))
    rows = scanned.withColumn("folder", _folder(F.col("path")))
    weight = rows.groupBy("folder").agg(F.count("*").alias("files"))
    heirs = checkpointed(heirs.join(weight, "folder").select("folder", "files", "heir.*"))
    joined = join_hot(rows, heirs, ["folder"], "files", "doc_id")
    basis = F.when(F.col("file").isNotNull(), "file").when(F.col("header").isNotNull(), "header").when(F.col("up").isNotNull(), "inherited")
    by = lambda file, header, up: F.when(basis == "file", file).when(basis == "header", header).when(basis == "inherited", up)
    return joined.select(
        "doc_id",
        "path",
        by(F.col("file"), F.col("header"), F.col("up")).alias("licence"),
        F.round(by(F.col("file_cosine"), F.col("header_cosine"), F.col("up_cosine")), 6).alias("cosine"),
        basis.alias("basis"),
        "header_start",
        F.when(basis == "inherited", F.col("licence_path")).alias("licence_path"),
    )
