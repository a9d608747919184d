"""License scans: MinHash bands over overlapping windows, then exact containment.

Words are runs of ASCII letters and digits and non-ASCII characters, A-Z
lower-cased; a template is its set of 5-word shingles (with fewer words: the whole
sequence as one).  A text matches a template if one of its windows holds at
least ``containment`` per cent of the template's shingles.  Windows go over the
text's shingles and suit the template's size: with m shingles in the template,
they have 2 * B shingles and begin at every B-th, where B is 1.25 * m, rounded up
(to a power of two above 4, so that templates share windows).  Every stretch of
B shingles lies whole in a window.  A matching window has a Jaccard similarity
of at least J = 0.8 * m / (2 * B + 0.2 * m) with the template; each band is one minimum,
and there are as many bands as make the chance that none collides at most
``MISS``.  Windows that share a band with a template are candidates; their
containment is then counted on the whole shingle sets.

Null texts and texts without words match nothing; a text with fewer than 5
words is compared as its whole sequence.  Very long texts are scanned whole.
Repeated rows each get a row; names of equal templates are all reported.  An empty table
gives no rows; columns other than the two named have no influence, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglens.llm.tables import table
from loglens.llm.text import ALNUM, U, Words, chunks, combine, stream

WIDTH = 5
CONTAINMENT = 80      # per cent
MISS = 1e-5

# Names and notices of common licenses.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
                   "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
                "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above "
            "copyright notice and this permission notice appear in all copies."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
            "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, "
                "You can obtain one at http://mozilla.org/MPL/2.0/."),
]


def sequence(hashes: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The shingles of one text in order; with fewer words the whole sequence as one."""
    return combine(hashes, width) if len(hashes) >= width else combine(hashes, len(hashes)) if len(hashes) else np.empty(0, U)


def block_of(m: int) -> int:
    """The step B of the windows for a template of m shingles."""
    b = math.ceil(1.25 * m)
    return b if b <= 4 else 1 << (b - 1).bit_length()


def plan(templates: list[tuple[str, str]], containment: int = CONTAINMENT, miss: float = MISS, width: int = WIDTH) -> list[dict]:
    """Per window size: B, the bands' permutations, and the templates' sets and minima."""
    w = Words(pa.array([t for _, t in templates], pa.string()), ALNUM)
    sets = [np.unique(sequence(w.hash[w.first[k]:w.first[k + 1]], width)) for k in range(len(templates))]
    out = []
    for b in sorted({block_of(len(s)) for s in sets if len(s)}):
        own = [(name, s) for (name, _), s in zip(templates, sets) if len(s) and block_of(len(s)) == b]
        share = containment / 100
        j = min(share * len(s) / (2 * b + (1 - share) * len(s)) for _, s in own)
        bands = math.ceil(math.log(miss) / math.log(1 - j))
        xor, mul = stream(31, bands), stream(32, bands) | U(1)
        out.append({"block": b, "xor": xor, "mul": mul, "names": [n for n, _ in own], "sets": [s for _, s in own],
                    "least": np.array([[((s ^ x) * m).min() for _, s in own] for x, m in zip(xor, mul)], U)})
    return out


def _scan(flat: np.ndarray, off: np.ndarray, group: dict, containment: int):
    """(row, template, window start, window end, share) of the matching windows of one size; rows are flat[off[r]:off[r + 1]]."""
    b, size = group["block"], np.diff(off)
    steps = -(-size // b)                      # blocks per row
    row = np.repeat(np.arange(len(size)), steps)
    k = np.arange(steps.sum()) - np.repeat(np.cumsum(steps) - steps, steps)
    start = off[:-1][row] + k * b
    if not len(start):
        return
    joined = np.zeros(len(start), bool)        # whether a block has a next one in its row
    joined[:-1] = row[1:] == row[:-1]
    hit = np.zeros((len(group["names"]), len(start)), bool)
    for x, m, least in zip(group["xor"], group["mul"], group["least"]):
        low = np.minimum.reduceat((flat ^ x) * m, start)
        win = low.copy()
        win[:-1][joined[:-1]] = np.minimum(low[:-1], low[1:])[joined[:-1]]
        for t, v in enumerate(least):
            hit[t] |= win == v
    for t, items in enumerate(group["sets"]):
        for i in np.flatnonzero(hit[t]).tolist():
            end = min(int(start[i]) + 2 * b, int(off[row[i] + 1]))
            share = len(np.intersect1d(flat[start[i]:end], items)) / len(items)
            if 100 * share >= containment:
                yield int(row[i]), t, int(start[i] - off[row[i]]), int(end - off[row[i]]), share


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, containment: int = CONTAINMENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, matches) per row: per license its best window, by words, and the share of the template found in it."""
    shared = docs.sparkSession.sparkContext.broadcast(plan(templates or TEMPLATES, containment))

    def run(batches):
        groups = shared.value
        for batch in chunks(batches):
            w = Words(batch.column("text"), ALNUM)
            parts = [sequence(w.hash[a:b]) for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist())]
            off = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
            flat = np.concatenate(parts) if parts else np.empty(0, U)
            best: list[dict] = [{} for _ in parts]
            for group in groups:
                for r, t, a, b, share in _scan(flat, off, group, containment):
                    name, found = group["names"][t], (-share, a, b + WIDTH - 1)
                    best[r][name] = min(best[r].get(name, found), found)
            rows = [[{"license": n, "from_word": x[1], "to_word": min(x[2], int(c)), "share": -x[0]} for n, x in sorted(own.items())] for own, c in zip(best, w.counts)]
            kind = pa.list_(pa.struct([("license", pa.string()), ("from_word", pa.int32()), ("to_word", pa.int32()), ("share", pa.float64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], ["doc_id", "matches"])

    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInArrow(run, f"doc_id {dict(own.dtypes)['doc_id']}, matches array<struct<license: string, from_word: int, to_word: int, share: double>>")


def q_op6(spark, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents", "doc_id", "text"))
    names = F.transform("matches", lambda m: m["license"])
    return found.select("doc_id", F.size("matches").cast("bigint").alias("n_licenses"), F.array_join(names, ",").alias("licenses"),
                        F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("best_share"))
