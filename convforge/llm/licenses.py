"""License notices: MinHash bands over overlapping windows, then exact containment.

Templates are grouped by length class L (a power of two).  A text is cut into
blocks of L words; every two neighbouring blocks are a window, so a passage of
up to L words lies whole in some window.  A window retrieves a template when
they agree in one of ``b`` bands of one MinHash each; ``b`` is set so that a
window that holds the required share of a template is missed with probability
at most ``MISS``.  Retrieved pairs are verified by exact containment of the
template's shingles.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from convforge.llm.common import blocks, bounded_batches, mix64

WORDS = 2  # words per shingle: notices are short
CONTAINMENT = 0.8
MISS = 1e-4

# Public license notices.
NOTICES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
                         "this file except in compliance with the License. You may obtain a copy of the "
                         "License at http://www.apache.org/licenses/LICENSE-2.0",
    "bsd-3-clause": "Redistribution and use in source and binary forms, with or without modification, are "
                    "permitted provided that the following conditions are met",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-3.0-header": "This program is free software: you can redistribute it and/or modify it under the "
                      "terms of the GNU General Public License as published by the Free Software "
                      "Foundation, either version 3 of the License, or (at your option) any later version.",
    "mit": "Released under the MIT License.",
    "mit-header": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
                  "software and associated documentation files (the \"Software\"), to deal in the Software "
                  "without restriction",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

def _seeds(n: int) -> np.ndarray:
    """The first n of an endless row of odd multipliers, one a band."""
    return np.random.default_rng(7).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bands_needed(least_shingles: int, block: int, containment: float = CONTAINMENT, miss: float = MISS) -> int:
    """Bands of one MinHash so that a window of two blocks that holds ``containment``
    of a template with ``least_shingles`` collides with probability 1 - miss."""
    held = containment * least_shingles
    jaccard = held / (2 * block + least_shingles - held)
    return math.ceil(math.log(miss) / math.log1p(-min(jaccard, 0.999)))


def _classes(templates: dict[str, str], containment: float) -> list[dict]:
    names = sorted(templates)
    out: dict[int, dict] = {}
    got = []
    for w in blocks(pa.array([templates[n] for n in names], pa.string()), punctuation=True):
        s, off = w.shingles(WORDS)
        got += [(int(w.offset[r + 1] - w.offset[r]), np.unique(s[off[r]:off[r + 1]])) for r in range(len(w))]
    for name, (n, s) in zip(names, got):
        if len(s):
            size = 1 << max(2, (n - 1).bit_length())
            out.setdefault(size, {"size": size, "names": [], "sets": []})
            out[size]["names"].append(name)
            out[size]["sets"].append(s)
    for c in out.values():
        c["bands"] = bands_needed(min(map(len, c["sets"])), c["size"], containment)
        c["all"] = np.unique(np.concatenate(c["sets"]))
        c["least"] = np.array([[mix64(s * k).min() for k in _seeds(c["bands"])] for s in c["sets"]])
    return [out[k] for k in sorted(out)]


def _scan(w, s: np.ndarray, off: np.ndarray, c: dict, containment: float):
    """(row, name, start, end, containment) of one block of texts and length class.
    ``s``: shingles, ``off``: their row offsets."""
    size = c["size"]
    n = np.diff(off)
    per_row = -(-n // size)
    first = np.concatenate([[0], np.cumsum(per_row)])
    row = np.repeat(np.arange(len(n)), per_row)
    start = off[row] + (np.arange(first[-1]) - first[row]) * size
    if not len(start):
        return
    # Only windows with some template shingle can agree in a band.
    hit = np.isin(s, c["all"])
    some = np.logical_or.reduceat(hit, start)
    follows = np.append(row[1:] == row[:-1], False)  # the next block is of the same text
    window = np.flatnonzero(some | (follows & np.append(some[1:], False)))
    if not len(window):
        return
    used = np.unique(np.concatenate([window, window[follows[window]] + 1]))
    stop = np.append(start[1:], len(s))
    length = stop[used] - start[used]
    begin = np.concatenate([[0], np.cumsum(length)[:-1]])
    part = s[np.repeat(start[used] - begin, length) + np.arange(length.sum())]
    at = np.searchsorted(used, window)
    after = np.where(follows[window], np.searchsorted(used, window + 1), at)
    after = np.minimum(after, len(used) - 1)
    agree = np.zeros((len(window), len(c["sets"])), dtype=bool)
    for k, seed in enumerate(_seeds(c["bands"])):
        low = np.minimum.reduceat(mix64(part * seed), begin)
        agree |= np.minimum(low[at], low[after])[:, None] == c["least"][:, k]
    for i, t in zip(*np.nonzero(agree)):
        b = window[i]
        lo, hi = start[b], stop[b + 1] if follows[b] else stop[b]
        shingles = s[lo:hi]
        held = np.isin(shingles, c["sets"][t])
        share = len(np.unique(shingles[held])) / len(c["sets"][t])
        if share >= containment:
            place = np.flatnonzero(held)
            r = row[b]
            words = int(w.offset[r + 1] - w.offset[r])
            yield (r, c["names"][t], int(lo - off[r] + place[0]),
                   min(words, int(lo - off[r] + place[-1]) + WORDS), share)


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id",
                  text_col: str = "text", containment: float = CONTAINMENT) -> DataFrame:
    """License notices in every whole text.

    Returns one row per passage: the id, ``license``, the passage's words
    [start_word, end_word) (runs of letters, digits and non-ASCII characters) and
    ``containment``.  Of overlapping passages in a text the one with the largest
    containment stays, then the longest.  Null and empty texts have none; repeated rows
    are each reported; a template without words matches nothing.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        _classes(NOTICES if templates is None else templates, containment))
    src = bounded_batches(docs).select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = src.schema["_id"].dataType.simpleString()

    def run(batches):
        classes = shared.value
        for b in batches:
            out = []
            for w in blocks(b.column(1), punctuation=True):
                s, off = w.shingles(WORDS)
                found = [x for c in classes for x in _scan(w, s, off, c, containment)]
                # Best first: containment, then length; then what overlaps none of these.
                taken: dict[int, list] = {}
                for r, name, lo, hi, share in sorted(found, key=lambda x: (-x[4], x[2] - x[3], x)):
                    if all(hi <= a or lo >= e for a, e in taken.setdefault(r, [])):
                        taken[r].append((lo, hi))
                        out.append((w.first + r, name, lo, hi, share))
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(cols[0], pa.int64())), pa.array(cols[1], pa.string()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.float64())],
                names=["_id", "license", "start_word", "end_word", "containment"])

    return (src.mapInArrow(run, f"_id {kind}, license string, start_word bigint, end_word bigint, "
                                "containment double").withColumnRenamed("_id", id_col))
