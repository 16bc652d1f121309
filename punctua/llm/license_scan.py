"""License statements by MinHash bands over overlapping text windows.

Texts are cut into windows of twice a template's length (rounded up to a power of four, in word
shingles) that overlap by half, so that every occurrence of a template lies whole in some window. A band
is one minwise value; a window whose value under any band equals a template's retrieves that
template. As at least a known share of such a window's shingles belongs to the template, the number
of bands follows from the miss probability allowed. Retrieved pairs are verified by exact containment
of the template's shingles in the window.

The templates are a parameter of bounded size and travel with the task; documents need no shuffle.

Defined results: null, empty and short texts have no match; words are compared in lower case (A-Z)
without the punctuation around them; a license found several times is one match with its first place,
one inside a longer match is part of that; a place is the shortest stretch with all that was found, and what adjoins it;
repeated rows are rows of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import pathlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punctua.llm.common import WordHashes, key_bounds, utf8, windows

WORDS = 5
CONTAINMENT = 0.8
MISS = 1e-6
PUNCTUATION = b"\"'`.,;:!?()[]{}<>*#/|"
FOLDER = pathlib.Path(__file__).with_name("licenses")
# Whole standard texts (without the appendix on how to apply them), the notices that
# stand at the head of files, and customary statements of one line.
TEMPLATES = {f"{path.stem}-text": path.read_text() for path in sorted(FOLDER.glob("*.txt"))} | {
    "ISC-text": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without "
                "fee is hereby granted, provided that the above copyright notice and this permission notice appear "
                "in all copies.",
    "AGPL-header": "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "GPL-header": "under the terms of the GNU General Public License as published by the Free Software Foundation",
    "LGPL-header": "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "Apache-2.0-header": "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
                         "http://www.apache.org/licenses/LICENSE-2.0",
    "MPL-2.0-header": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-header": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
    "CC-BY-4.0-notice": "licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA-4.0-notice": "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "CC-BY-NC-4.0-notice": "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "CC0-notice": "has waived all copyright and related or neighboring rights to",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-2.0": "GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL": "under the GNU Lesser General Public License",
    "AGPL": "under the GNU Affero General Public License",
    "MPL-2.0": "under the Mozilla Public License",
    "MIT": "Released under the MIT License.",
    "MIT-distributed": "Distributed under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
}


class BareHashes(WordHashes):
    """Hashes of words without the punctuation around them."""

    def __missing__(self, word: bytes) -> int:
        found = super().__missing__(word.strip(PUNCTUATION))
        self[word] = found
        return found


@dataclass
class Bands:
    """Templates of one window length: per band, their minwise values and which template each is."""

    block: int
    names: list[str]
    sets: list[np.ndarray]
    values: np.ndarray  # bands x templates


def factors(count: int) -> np.ndarray:
    return np.random.default_rng(5).integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingled(text: bytes, hashes: WordHashes) -> np.ndarray:
    return windows(hashes.of(text.lower().split()), WORDS)


def prepared(templates: dict[str, str], containment: float = CONTAINMENT, miss: float = MISS) -> list[Bands]:
    hashes, by_block = BareHashes(), {}
    for name, text in sorted(templates.items()):
        found = np.unique(shingled(text.encode(), hashes))
        if not len(found):
            raise ValueError(f"template {name!r} has fewer than {WORDS} words")
        block = 1
        while block < len(found):
            block *= 4
        by_block.setdefault(block, []).append((name, found))
    out = []
    for block, members in sorted(by_block.items()):
        # A window of 2 * block shingles holds at least this share of a template's.
        least = min(containment * len(found) / (2 * block + (1 - containment) * len(found)) for _, found in members)
        count = math.ceil(math.log(miss) / math.log(1 - least))
        values = np.array([[(found * f).min() for _, found in members] for f in factors(count)], np.uint64)
        out.append(Bands(block, [n for n, _ in members], [s for _, s in members], values))
    return out


def retrieved(shingles: np.ndarray, bands: list[Bands], containment: float) -> list[set[tuple[int, int]]]:
    """Per window length, the ``(window, template)`` pairs that some band retrieves. Only windows with
    as many shingles of templates as the shortest template needs are looked at: others hold none."""
    known = np.unique(np.concatenate([s for band in bands for s in band.sets]))
    first = np.zeros(1 << 20, bool)
    first[known >> np.uint64(44)] = True
    hits = np.flatnonzero(first[shingles >> np.uint64(44)])
    hits = hits[known[np.minimum(np.searchsorted(known, shingles[hits]), len(known) - 1)] == shingles[hits]]
    found: list[set[tuple[int, int]]] = []
    for band in bands:
        pairs: set[tuple[int, int]] = set()
        least = containment * min(map(len, band.sets))
        windows_, counts = np.unique(hits // band.block, return_counts=True)
        held = dict(zip(windows_.tolist(), counts.tolist()))
        for window in sorted({w for at in held for w in (at - 1, at) if w >= 0}):
            if held.get(window, 0) + held.get(window + 1, 0) < least:
                continue
            part = shingles[window * band.block:(window + 2) * band.block]
            for factor, values in zip(factors(len(band.values)), band.values):
                pairs.update((window, int(t)) for t in np.flatnonzero(values == (part * factor).min()))
        found.append(pairs)
    return found


def tightest(hits: np.ndarray, found: np.ndarray) -> tuple[int, int]:
    """The first shortest stretch of positions that holds every distinct shingle found, with hits that
    adjoin it."""
    last: dict[int, int] = {}
    wanted, best = len(np.unique(found)), None
    for at, shingle in zip(hits.tolist(), found.tolist()):
        last.pop(shingle, None)
        last[shingle] = at
        if len(last) == wanted:
            start = next(iter(last.values()))
            if best is None or at - start < best[1] - best[0]:
                best = start, at
    places = set(hits.tolist())
    start, stop = best
    while start - 1 in places:
        start -= 1
    while stop + 1 in places:
        stop += 1
    return start, stop


def matches(shingles: np.ndarray, owner: np.ndarray, bands: list[Bands], containment: float) -> list[tuple[int, str, int, int, float]]:
    """Verified ``(document, license, from word, to word, containment)`` over concatenated documents."""
    out = []
    starts = np.searchsorted(owner, np.arange(owner[-1] + 1)) if len(owner) else []
    for band, pairs in zip(bands, retrieved(shingles, bands, containment)):
        for window, template in sorted(pairs):
            a = window * band.block
            b = min(a + 2 * band.block, len(shingles))
            bounds = key_bounds(owner[a:b]) + a if b > a else []
            for c, d in zip(bounds, bounds[1:]):  # a window may touch several documents
                hits = np.flatnonzero(np.isin(shingles[c:d], band.sets[template])) + c
                share = len(np.unique(shingles[hits])) / len(band.sets[template])
                if share >= containment:
                    first, last = tightest(hits - starts[owner[c]], shingles[hits])
                    out.append((int(owner[c]), band.names[template], first, last + WORDS, share))
    return outermost(out)


def outermost(found: list[tuple[int, str, int, int, float]]) -> list[tuple[int, str, int, int, float]]:
    """Without statements that are part of a longer one, as a whole text that names another license."""
    by_doc: dict[int, list] = {}
    for match in found:
        by_doc.setdefault(match[0], []).append(match)
    return [m for m in found if not any(
        o[1] != m[1] and o[2] <= m[2] and m[3] <= o[3] and o[3] - o[2] > m[3] - m[2] for o in by_doc[m[0]])]


def scan(docs: DataFrame, templates: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """Per row ``doc_id, n_licenses, matches``; a match has ``license, start, stop, containment`` (words)."""
    bands = prepared(templates or TEMPLATES, containment)

    def run(batches) -> Iterator:
        import pyarrow as pa

        hashes = BareHashes()
        kind = pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("stop", pa.int64()),
                                   ("containment", pa.float64())]))
        for batch in batches:
            parts = [shingled(text, hashes) for text in utf8(batch.column("text"))]
            owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            best: list[dict] = [{} for _ in parts]
            every = np.concatenate(parts) if parts else np.empty(0, np.uint64)
            for doc, name, start, stop, share in matches(every, owner, bands, containment) if len(every) else []:
                new = (-share, start, stop)
                best[doc][name] = min(best[doc].get(name, new), new)
            rows = [[{"license": n, "start": b[1], "stop": b[2], "containment": -b[0]} for n, b in sorted(d.items())] for d in best]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(r) for r in rows], pa.int64()), pa.array(rows, kind)],
                names=["doc_id", "n_licenses", "matches"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_licenses long, matches array<struct<license: string, start: long, stop: long, containment: double>>")
