"""License scans: a trained paragraph classifier, confirmed by template comparison.

Paragraphs are the lines of a text.  A line of more words than the longest template is judged in windows of that many
words, each overlapping the next by half; of a window only the stretch from its first to its last template pair counts,
so a notice within a long line is judged like one of its own, however long the line is.  Features are the words and
word pairs that the licence templates hold, scaled by the root of the paragraph's length.  A sparse softmax
regression over the licence families and an unknown class is trained on the templates, on
cuts and variations of them made by a seeded rule, and on whole paragraphs of the corpus, judged units like those scanned,
as unknown ones (at most ``SAMPLE_UNITS`` of the lines of at most ``SAMPLE_DOCS`` documents: labelled rows of
that class, bounded).  The chance is calibrated by a temperature fitted on variations held back.
A paragraph whose most likely family is a licence with at least ``MIN_CHANCE`` is a candidate;
it is confirmed when some template of the family shares enough word pairs with it (of the shorter
of both).  Finds of one family that overlap or nearly touch within a long line are one notice.  A paragraph with fewer
than two words of the templates is unknown without more work.

Defined results: null and empty texts have no paragraphs.  Rows with a null id and rows that
repeat are scanned one by one, each gives its own findings.  Extra columns are ignored.
"""

from __future__ import annotations

import itertools
import random
import re
import zlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import raw_texts, slices

MIN_CHANCE = 0.5
MIN_SIMILARITY = 0.6
#: Documents whose paragraphs stand for the unknown class.
SAMPLE_DOCS = 2_000
SAMPLE_UNITS = 20_000

#: Short notices and opening clauses by licence family.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has dedicated all copyright to the public domain worldwide under CC0 1.0 Universal.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "proprietary": [
        "All rights reserved. No part of this publication may be reproduced without prior written permission.",
        "This software is proprietary and confidential. Unauthorized copying is strictly prohibited.",
    ],
}

_WORD = re.compile(rb"[a-z0-9]+")
#: Words between two finds of one notice, at most.
_GAP = 4
#: The words of the longest template: the size of a window.
_WINDOW = max(len(_WORD.findall(t.lower().encode())) for ts in TEMPLATES.values() for t in ts)


def words_of(raw: bytes) -> list[bytes]:
    return _WORD.findall(raw.lower())


def pairs_of(words: list[bytes]) -> set[tuple[bytes, bytes]]:
    return set(zip([b"", *words], [*words, b""], strict=True)) if words else set()


def template_features(templates: dict[str, list[str]]) -> dict:
    """The words and pairs of all templates, numbered."""
    found: dict = {}
    for ts in templates.values():
        for t in ts:
            words = words_of(t.encode())
            for f in (*words, *sorted(pairs_of(words))):
                found.setdefault(f, len(found))
    return found


def numbered(words: list[bytes], features: dict) -> tuple[list[int], int]:
    """The numbers of the features of a unit, and its words."""
    return sorted({features[f] for f in (*words, *pairs_of(words)) if f in features}), len(words)


def units(words: list[bytes], features: dict, window: int = _WINDOW) -> list[tuple[int, int]]:
    """[first, end) of the words of a line that are judged together: all of a line of up to ``window`` words; else the
    stretches between template pairs in overlapping windows, each once."""
    if len(words) <= window:
        return [(0, len(words))] if words else []
    met = [i for i, pair in enumerate(itertools.pairwise(words)) if pair in features]
    found: list[tuple[int, int]] = []
    for low in range(0, len(words) - window // 2, max(1, window // 2)):
        a, b = bisect_left(met, low), bisect_left(met, low + window - 1)
        if b - a > 0:
            unit = (met[a], met[b - 1] + 2)
            if not found or unit != found[-1]:
                found.append(unit)
    return found


class LicenseModel:
    """Feature numbers, weights and the pairs of each template; made on the driver and broadcast."""

    def __init__(self, families: list[str], features: dict, weights: np.ndarray, temperature: float, templates: dict):
        self.families, self.features, self.weights, self.temperature, self.templates = families, features, weights, temperature, templates
        self.vocabulary = {f for f in features if isinstance(f, bytes)}

    def vector(self, words: list[bytes]) -> tuple[list[int], float]:
        own, n = numbered(words, self.features)
        return own, 1.0 / np.sqrt(n + 1)

    def chances(self, words: list[bytes]) -> np.ndarray:
        own, scale = self.vector(words)
        z = (self.weights[0] + self.weights[1:][own].sum(axis=0) * scale) / self.temperature
        p = np.exp(z - z.max())
        return p / p.sum()

    def similarity(self, words: list[bytes], family: str) -> float:
        """Shared pairs over those of the shorter, the most of all templates of the family."""
        own = pairs_of(words)
        return max(len(own & t) / min(len(own), len(t)) for t in self.templates[family])

    def find(self, words: list[bytes]) -> tuple[str, float, float] | None:
        if sum(w in self.vocabulary for w in words) < 2:
            return None
        p = self.chances(words)
        best = int(p.argmax())
        if best == 0 or p[best] < MIN_CHANCE:
            return None
        return self.families[best], float(p[best]), self.similarity(words, self.families[best])


def _variations(words: list[bytes], rng: random.Random, fill: list[bytes], n: int) -> list[list[bytes]]:
    """Cuts, lost words, wrapped in other words: how notices stand in texts."""
    out = [words]
    for _ in range(n):
        own = [w for w in words if rng.random() > 0.08]
        if len(own) > 8 and rng.random() < 0.5:
            size = rng.randint(6, len(own))
            at = rng.randint(0, len(own) - size)
            own = own[at : at + size]
        if rng.random() < 0.3 and fill:
            extra = [rng.choice(fill) for _ in range(rng.randint(1, 5))]
            own = own + extra if rng.random() < 0.5 else extra + own
        out.append(own or words)
    return out


def train(
    unknown: list[tuple[list[int], int]],
    fill: list[bytes],
    templates: dict[str, list[str]] = TEMPLATES,
    seed: int = 13,
    steps: int = 400,
) -> LicenseModel:
    """Fit on the templates and on units of the corpus, given by (numbers of their features, words); ``fill`` are words
    that notices are wrapped in."""
    rng = random.Random(seed)
    families = ["unknown", *templates]
    features = template_features(templates)
    texts = {f: [words_of(t.encode()) for t in ts] for f, ts in templates.items()}
    known = {f: [pairs_of(t) for t in ts] for f, ts in texts.items()}
    model = LicenseModel(families, features, np.zeros((len(features) + 1, len(families))), 1.0, known)
    made = [(v, k) for k, f in enumerate(families[1:], 1) for t in texts[f] for v in _variations(t, rng, fill, 40)]
    # single words and scrambled words of templates are no licence either
    every = sorted({w for ts in texts.values() for t in ts for w in t})
    made += [([rng.choice(every) for _ in range(rng.randint(1, 12))], 0) for _ in range(400)]
    rows = [(*model.vector(w), k) for w, k in made]
    rows += [(own, 1.0 / np.sqrt(n + 1), 0) for own, n in unknown] + [([], 1.0, 0)]
    rng.shuffle(rows)
    x = np.zeros((len(rows), len(features) + 1), np.float32)
    for i, (own, scale, _) in enumerate(rows):
        x[i, 0] = 1.0
        x[i, [o + 1 for o in own]] = scale
    y = np.zeros((len(rows), len(families)), np.float32)
    y[np.arange(len(rows)), [k for _, _, k in rows]] = 1.0
    held = np.arange(len(rows)) % 5 == 0
    a, b = x[~held], y[~held]
    w, speed = np.zeros((2, x.shape[1], y.shape[1]), np.float32)
    for _ in range(steps):  # gradient descent with momentum
        z = a @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        speed = 0.9 * speed - 4.0 * (a.T @ (p - b) / len(a) + 1e-5 * w)
        w = w + speed
    z = x[held] @ w

    def loss(t: float) -> float:
        q = z / t
        q = q - q.max(axis=1, keepdims=True)
        return float(-(y[held] * (q - np.log(np.exp(q).sum(axis=1, keepdims=True)))).sum())

    model.weights = w
    model.temperature = min((0.3, 0.5, 0.7, 1.0, 1.4, 2.0, 3.0), key=loss)
    return model


def fit_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample_docs: int = SAMPLE_DOCS, sample_units: int = SAMPLE_UNITS) -> LicenseModel:
    """Train with the distinct units of smallest hashes in the documents of smallest hashes as unknown ones; whole texts
    are read, and units that are like a template are left out.  The driver gets feature numbers, no texts."""
    ids = docs.select(F.col(doc_id).alias("doc_id")).where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    body = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).join(F.broadcast(ids), "doc_id")
    features = template_features(TEMPLATES)
    templates = [pairs_of(words_of(t.encode())) for ts in TEMPLATES.values() for t in ts]

    def run(batches):
        for part in slices(batches):
            rows = []
            for raw in raw_texts(part.column(0)):
                for line in set((raw or b"").split(b"\n")):
                    words = words_of(line)
                    for a, b in units(words, features):
                        unit = words[a:b]
                        own = pairs_of(unit)
                        if any(len(own & t) >= MIN_SIMILARITY * min(len(own), len(t)) for t in templates):
                            continue
                        hashed = xxhash.xxh64_intdigest(b" ".join(unit)) - (1 << 63)
                        rows.append((hashed, *numbered(unit, features), min(unit, key=zlib.crc32).decode()))
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.string())
            names = ["hash", "features", "words", "fill"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    found = body.select("text").mapInArrow(run, "hash bigint, features array<int>, words int, fill string")
    chosen = found.dropDuplicates(["hash"]).orderBy("hash").limit(sample_units).collect()
    return train([(list(r["features"]), r["words"]) for r in chosen], sorted({r["fill"].encode() for r in chosen}))


def notices(raw: bytes, model: LicenseModel, held: dict) -> list[tuple[int, int, str, float, float]]:
    """(start, end, family, chance, similarity) of the notices in a text, in code points; ``held`` keeps the finds in short lines."""
    found, at = [], 0
    for line in raw.split(b"\n"):
        own = held.get(line)
        if own is None:
            own = _in_line(line, model)
            if len(line) < 400:  # of longer ones the finds are not kept
                if len(held) > 50_000:
                    held.clear()
                held[line] = own
        if own:
            start = len(raw[:at].decode("utf-8"))
            found += [(start + a, start + b, *rest) for a, b, *rest in own]
        at += len(line) + 1
    return found


def _in_line(line: bytes, model: LicenseModel) -> list[tuple[int, int, str, float, float]]:
    spans = [(m.start(), m.end()) for m in _WORD.finditer(line.lower())]
    words = [line[a:b].lower() for a, b in spans]
    finds: dict[str, list[list]] = {}
    for a, b in units(words, model.features):
        hit = model.find(words[a:b])
        if hit:
            family, chance, similarity = hit
            own = finds.setdefault(family, [])
            if own and a <= own[-1][1] + _GAP:  # the same notice, seen by the window before
                last = own[-1]
                last[1], last[2], last[3] = max(b, last[1]), max(chance, last[2]), max(similarity, last[3])
            else:
                own.append([a, b, chance, similarity])
    kept = [(a, b, family, chance, similarity) for family, own in finds.items() for a, b, chance, similarity in own]
    if len(words) <= _WINDOW:  # the line as it stands
        return [(0, len(line.decode("utf-8")), *rest) for _, _, *rest in kept]
    points = lambda i: len(line[:i].decode("utf-8"))
    return [(points(spans[a][0]), points(spans[b - 1][1]), *rest) for a, b, *rest in sorted(kept)]


def scan_licenses(docs: DataFrame, model: LicenseModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, end, family, chance, similarity, confirmed) of the notices found; code points, end exclusive."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "start", "end", "family", "chance", "similarity", "confirmed"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.bool_()]

    def run(batches):
        held: dict = {}
        for part in slices(batches):
            rows = [
                (own, *n, n[-1] >= MIN_SIMILARITY)
                for own, raw in zip(part.column(0).to_pylist(), raw_texts(part.column(1)), strict=True)
                for n in notices(raw or b"", shared.value, held)
            ]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, start int, end int, family string, chance double, similarity double, confirmed boolean")
