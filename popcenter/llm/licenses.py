"""License scan: MinHash bands over overlapping text windows retrieve templates, exact shingle
containment verifies them.

A text's words (lower-cased, punctuation and white space between them) give SHINGLE-word
shingles; a template with fewer words is one shingle of all its words, and so are as many words
of a text. For a template of t shingles the text is cut into blocks of L = t rounded up to a
power of two shingles and each two neighbouring blocks form a window, so wherever a copy of the
template stands, one window holds all of it.

Bands: BANDS MinHash values, one a band. A window that holds a share c of a template's shingles
has Jaccard similarity J >= c t / (t + 2 L - c t) with it, at least 0.19 at c = 0.8 and L < 2 t,
so 64 bands miss it with probability (1 - 0.19)^64 < 2e-6 at worst. Windows that share a band
value with a template are verified: the template's shingles in the window are counted, and a
share of at least CONTAINMENT is a match. Every shingle is hashed once a band; the minima of
longer blocks come from those of shorter ones.

Occurrences: a matched window is cut where the template's order falls back, so that notices that follow one another, with or
without other words between them, are findings of their own. A piece that holds less than CONTAINMENT of the
template is joined to the next one, unless that holds enough by itself (a copy may repeat some of its own words); what is
left over at the end counts to the finding before it only where it adds to it. Findings of one occurrence in overlapping
windows overlap in words and are joined.

How it scales: documents are read once and not shuffled; templates (a library of license texts)
are broadcast in blocks of bounded bytes. A task prepares a single block once, several blocks once for
every batch of texts.

Results in special cases: null, empty and short texts have no match; templates without words or
with a null text are skipped; templates of equal words are all reported; a null template_id is
reported as an empty string; repeated rows have the same findings; other columns are ignored.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from popcenter.llm.common import read
from popcenter.llm.decontamination import blocks
from popcenter.llm.text import (Grams, U, buffer, letters, list_array, load, lower, mix, ranges, slices,
                                word_hashes, word_spans)

SHINGLE = 5
BANDS = 64
CONTAINMENT = 0.8
FOUND = "array<struct<template:string,start_word:int,end_word:int,containment:double>>"
#: Notices by which texts state their license, from the licenses' own wording. They are the
#: registered query's library; ``scan_licenses`` takes any other, whole license texts included.
TEMPLATES = (
    ("Apache-2.0-line", "Licensed under the Apache License, Version 2.0."),
    ("MIT-line", "Released under the MIT License."),
    ("GPL-3.0-line", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0-line", "Licensed under CC BY-NC 4.0."),
    ("Apache-2.0-notice", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file "
     "except in compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
     "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
     "either express or implied."),
    ("MIT-permission", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
     "and associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
     "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
     "the Software, and to permit persons to whom the Software is furnished to do so"),
    ("BSD-redistribution", "Redistribution and use in source and binary forms, with or without modification, are "
     "permitted provided that the following conditions are met"),
    ("GPL-or-later-notice", "This program is free software: you can redistribute it and/or modify it under the terms of "
     "the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or "
     "(at your option) any later version."),
    ("ISC-permission", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
     "is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("LGPL-or-later-notice", "This library is free software; you can redistribute it and/or modify it under the terms of the "
     "GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
     "(at your option) any later version."),
    ("AGPL-or-later-notice", "This program is free software: you can redistribute it and/or modify it under the terms of "
     "the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, "
     "or (at your option) any later version."),
    ("EPL-2.0-notice", "This program and the accompanying materials are made available under the terms of the Eclipse Public "
     "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("Unlicense-notice", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
     "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
     "for any purpose, commercial or non-commercial, and by any means."),
    ("CC-BY-4.0-line", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0-line", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0-notice", "To the extent possible under law, the author has waived all copyright and related or neighboring "
     "rights to this work."),
    ("Zlib-notice", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
     "be held liable for any damages arising from the use of this software."),
    ("BSL-1.0-line", "Distributed under the Boost Software License, Version 1.0."),
    ("MPL-2.0-notice", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def shingles(texts_or_bytes: tuple[np.ndarray, np.ndarray]) -> tuple[Grams, np.ndarray]:
    """Word sequences of a slice and the number of each text's first word."""
    buf, offs = texts_or_bytes
    low = lower(buf)
    starts, ends, first = word_spans(low, offs, letters())
    return Grams(word_hashes(low, starts, ends)), first


def minima(h: np.ndarray, begin: np.ndarray, bands: int) -> np.ndarray:
    """MinHash values (bands x runs) of the runs of ``h`` that begin at ``begin`` (none empty)."""
    out = np.empty((bands, len(begin)), U)
    for b in range(bands):
        out[b] = np.minimum.reduceat(mix(h ^ mix(np.array([b + 1], U))), begin)
    return out


def occurrences(places: np.ndarray, found: np.ndarray, steps: list[np.ndarray], size: int, least: float) -> list[tuple[int, int, float]]:
    """(first place, end, share) of each copy of a template of ``size`` shingles, from the places of its shingles
    (``found`` numbers them) in a text and each shingle's places in the template (``steps``)."""
    pieces: list[list[int]] = []
    last = -1
    for k, f in enumerate(found.tolist()):
        ahead = steps[f][np.searchsorted(steps[f], last, "right"):]
        if not len(ahead) or not pieces:  # the template's order falls back: a new copy may begin
            pieces.append([])
            ahead = steps[f]
        last = int(ahead[0])
        pieces[-1].append(k)
    out: list[tuple[list[int], set]] = []
    open_: list[int] = []
    for piece in pieces:
        alone = len(set(found[piece].tolist())) >= least * size
        open_ = piece if alone else open_ + piece
        held = set(found[open_].tolist())
        if len(held) >= least * size:
            out.append((open_, held))
            open_ = []
    if open_ and out and not set(found[open_].tolist()) <= out[-1][1]:
        out[-1] = (out[-1][0] + open_, out[-1][1] | set(found[open_].tolist()))
    return [(int(places[rows[0]]), int(places[rows[-1]]), len(held) / size) for rows, held in out]


class Library:
    """A block of templates, by size class (length of a shingle in words, shingles of a block)."""

    def __init__(self, ids: list[str], texts: list[str], k: int, bands: int):
        grams, first = shingles(buffer(pa.array(texts, pa.large_string())))
        self.ids, self.classes = ids, {}
        for t, n in enumerate(np.diff(first)):
            if n:
                size = int(min(n, k))
                h, where = np.unique(grams.at(np.arange(first[t], first[t + 1] - size + 1), size), return_inverse=True)
                steps = [np.flatnonzero(where == k) for k in range(len(h))]
                block = 1 << int(len(h) - 1).bit_length()
                self.classes.setdefault((size, block), []).append((t, h, steps))
        self.signatures = {c: np.stack([minima(h, np.array([0]), bands)[:, 0] for _, h, _ in members])
                           for c, members in self.classes.items()}


def scanner(library: list, k: int = SHINGLE, bands: int = BANDS, containment: float = CONTAINMENT):
    """A column function: the findings of a text."""

    def scan_size(lib: Library, size: int, grams: Grams, first: np.ndarray, found: list) -> None:
        """Findings of the templates whose shingles have ``size`` words."""
        count = np.maximum(np.diff(first) - size + 1, 0)
        at = ranges(first[:-1], count)
        if not len(at):
            return
        h = grams.at(at, size)
        base = np.cumsum(count) - count
        levels, n_blocks, length = [], count, 1
        for block in sorted(b for n, b in lib.classes if n == size):
            # a block's minimum comes from the blocks of the level below
            inside, below = -(-count // block), np.cumsum(n_blocks) - n_blocks
            index = ranges(np.zeros(len(count), np.int64), inside)
            merged = np.repeat(below, inside) + index * (block // length)
            doc = np.repeat(np.arange(len(count)), inside)
            begin = base[doc] + index * block
            pair = np.append(doc[1:] == doc[:-1], False)  # a window is a block and the next one of its document
            stop = np.minimum(begin + np.where(pair, 2 * block, block), (base + count)[doc])
            share = np.zeros((len(lib.classes[size, block]), len(begin)), bool)
            levels.append((block, merged, doc, begin, pair, stop, share))
            n_blocks, length = inside, block
        for b in range(bands):
            low = mix(h ^ mix(np.array([b + 1], U)))
            for block, merged, _, _, pair, _, share in levels:
                low = np.minimum.reduceat(low, merged) if len(merged) < len(low) else low
                window = np.where(pair, np.minimum(low, np.append(low[1:], low[-1])), low)
                for m, value in enumerate(lib.signatures[size, block][:, b]):
                    share[m] |= window == value
        for block, _, doc, begin, _, stop, share in levels:
            for m, w in zip(*np.nonzero(share)):
                t, own, steps = lib.classes[size, block][m]
                window = h[begin[w]:stop[w]]
                number = np.minimum(np.searchsorted(own, window), len(own) - 1)
                same = own[number] == window
                places = at[begin[w] + np.flatnonzero(same)] - first[doc[w]]
                for lo, hi, held in occurrences(places, number[same], steps, len(own), containment):
                    found.append((int(doc[w]), lib.ids[t], lo, hi + size, held))

    def scanned(text: pa.Array, libs: list | None) -> pa.Array:
        buf, offs = buffer(text)
        rows, counts = [], np.zeros(len(text), np.int64)
        for i, j in slices(offs):
            grams, first = shingles((buf[offs[i]:offs[j]], offs[i:j + 1] - offs[i]))
            found: list = []
            for lib in libs or (Library(*load(b), k, bands) for b in library):
                for size in {n for n, _ in lib.classes}:
                    scan_size(lib, size, grams, first, found)
            joined: list = []
            for d, template, lo, hi, held in sorted(found):
                if joined and joined[-1][:2] == [d, template] and lo < joined[-1][3]:
                    joined[-1][3] = max(joined[-1][3], hi)
                    joined[-1][4] = max(joined[-1][4], held)
                else:
                    joined.append([d, template, lo, hi, held])
            counts[i:j] = np.bincount([x[0] for x in joined], minlength=j - i) if joined else 0
            rows += joined
        values = pa.StructArray.from_arrays(
            [pa.array([x[1] for x in rows], pa.string()), pa.array([x[2] for x in rows], pa.int32()),
             pa.array([x[3] for x in rows], pa.int32()), pa.array([x[4] for x in rows], pa.float64())],
            ["template", "start_word", "end_word", "containment"])
        return list_array(values, counts)

    @arrow_udf(FOUND)
    def scan(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        libs = [Library(*load(b), k, bands) for b in library] if len(library) == 1 else None
        for text in texts:
            yield scanned(text, libs)

    return scan


def default_templates(spark: SparkSession) -> DataFrame:
    quoted = ", ".join("('" + i + "', '" + t.replace("'", "\\'") + "')" for i, t in TEMPLATES)
    return spark.sql(f"SELECT * FROM VALUES {quoted} AS t(template_id, text)")


def scan_licenses(docs: DataFrame, templates: DataFrame, containment: float = CONTAINMENT, k: int = SHINGLE,
                  bands: int = BANDS) -> DataFrame:
    """doc_id, template, start_word, end_word (exclusive) and containment of every finding."""
    library = blocks(templates.select(F.col("template_id").alias("item_id"), "text"))
    found = scanner(library, k, bands, containment)(F.col("text"))
    return docs.select("doc_id", F.explode(found).alias("f")).select("doc_id", "f.*")


def op2_licenses(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(read(spark, sf_dir, "documents"), default_templates(spark)).withColumn(
        "containment", F.round("containment", 9))
