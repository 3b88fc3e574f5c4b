"""License scans: a trained paragraph classifier, confirmed by comparison with templates.

Paragraphs are lines, and runs of lines with words, as notices can be wrapped (long ones in overlapping windows). A softmax regression on sparse word bigrams and trigrams, trained in numpy on templates, their variations and
a bounded sample of other paragraphs, names a license family or "unknown"; its scores are calibrated on variations
that it hasn't learned from. A family counts if its score is high enough and the paragraph shares enough of a template;
besides whole paragraphs, each region that holds enough of a template is decided, so several notices can stand side by side.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import hash_of, pa_type, rows_of, texts

UNKNOWN = "unknown"

# Short notices by which licences are commonly declared.
TEMPLATES = {
    "Apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, without warranties or conditions of any kind",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "BSD": [
        "Released under the 3-Clause BSD License.",
        "Licensed under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the 2-Clause BSD License.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "SPDX-License-Identifier: BSD-3-Clause",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "ISC": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "SPDX-License-Identifier: ISC",
    ],
    "EPL": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
        "Licensed under the Eclipse Public License.",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "Zlib": [
        "Licensed under the zlib License.",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "SPDX-License-Identifier: Zlib",
    ],
    "BSL": [
        "Distributed under the Boost Software License, Version 1.0.",
        "SPDX-License-Identifier: BSL-1.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC0": [
        "Released under CC0 1.0 Universal.",
        "This work has been dedicated to the public domain.",
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "proprietary": [
        "All rights reserved.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
    ],
}


@dataclass(frozen=True)
class Settings:
    """Windows of long paragraphs in words, training effort, bounds of the sample, and what a finding needs."""

    window: int = 64
    stride: int = 48
    bits: int = 20
    variations: int = 60
    sample_rows: int = 1_000
    sample_paragraphs: int = 20
    steps: int = 300
    score: float = 0.5
    shared: float = 0.6
    seed: int = 3


SIGNS = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))


def words_of(paragraph: bytes) -> list[bytes]:
    return paragraph.translate(SIGNS).lower().split()


def paragraphs(body: bytes, s: Settings) -> Iterator[tuple[int, int, list[bytes]]]:
    """Number of the line, first word of the window, words. Windows overlap and cover the whole line."""
    for k, line in enumerate(body.split(b"\n")):
        ws = words_of(line)
        last = max(len(ws) - s.window, 0)
        for at in [*range(0, last, s.stride), last] if ws else ():
            yield k, at, ws[at : at + s.window]


def joined(body: bytes, s: Settings) -> Iterator[tuple[list[int], list[bytes]]]:
    """Numbers of the lines of the words, words: windows of neighbouring lines that hold words, where they cross a line's end."""
    lines, words = [], []
    for k, line in enumerate([*body.split(b"\n"), b""]):
        ws = words_of(line)
        words += ws
        lines += [k] * len(ws)
        if ws and len(words) < 4096:
            continue
        last = max(len(words) - s.window, 0)
        for at in [*range(0, last, s.stride), last]:
            own = lines[at : at + s.window]
            if own and own[0] != own[-1]:
                yield own, words[at : at + s.window]
        # very long runs go on with the last window
        lines, words = (lines[-s.window :], words[-s.window :]) if ws else ([], [])


def gram_codes(codes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed bigrams and trigrams (marked by start and end as words of their own) and the positions they begin at."""
    mix, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - bits)
    two = (codes[:-1] * np.uint64(0x100000001B3) + codes[1:]) * mix
    three = (two[:-1] ^ (codes[2:] * np.uint64(0xC2B2AE3D27D4EB4F))) * mix
    return np.concatenate([two >> shift, three >> shift]).astype(np.int64), np.concatenate([np.arange(len(two)), np.arange(len(three))])


EDGE = 1


def coded(words: list[bytes]) -> np.ndarray:
    """Hashes of the words, an edge before and after."""
    return np.fromiter((EDGE, *map(zlib.crc32, words), EDGE), np.uint64, len(words) + 2)


class Model:
    """Weights by known gram and class (the last one is unknown), temperature, and the templates' grams."""

    def __init__(self, families: list[str], s: Settings):
        self.families, self.s = families, s
        every = [[coded(words_of(t.encode())) for t in TEMPLATES[f]] for f in families]
        # compared without the edges, as a notice can stand inside a paragraph; the edges are features only
        self.templates = [[frozenset(gram_codes(c[1:-1], s.bits)[0].tolist()) for c in own] for own in every]
        self.known = np.array(sorted({g for own in every for c in own for g in gram_codes(c, s.bits)[0].tolist()}), dtype=np.int64)
        self.column = np.full(1 << s.bits, -1, dtype=np.int32)
        self.column[self.known] = np.arange(len(self.known))
        # a wording that families have in common names none of them: grams of one family count in full, of two by a quarter, of more not at all
        holders = np.array([[any(g in t for t in own) for own in self.templates] for g in self.known.tolist()]).sum(axis=1)
        self.naming = dict(zip(self.known.tolist(), np.select([holders == 1, holders == 2], [1.0, 0.25], 0.0).tolist(), strict=True))
        self.whole = [[sum(self.naming[g] for g in t) for t in own] for own in self.templates]
        # by template and known gram: what the gram counts for in it
        self.holds = np.array([np.isin(self.known, list(t)) for own in self.templates for t in own]) * np.array([self.naming[g] for g in self.known.tolist()])
        self.least = s.shared * self.holds.sum(axis=1) - 1e-9
        self.of = [(k, len(words_of(t.encode()))) for k, f in enumerate(families) for t in TEMPLATES[f]]
        self.w = np.zeros((len(self.known), len(families) + 1))
        self.bias = np.zeros(len(families) + 1)
        self.heat = 1.0

    def row(self, words: list[bytes]) -> np.ndarray:
        """Distinct known grams of a paragraph, as columns."""
        column = self.column[gram_codes(coded(words), self.s.bits)[0]]
        return np.unique(column[column >= 0])

    def dense(self, paragraphs: list[list[bytes]]) -> np.ndarray:
        x = np.zeros((len(paragraphs), len(self.known)))
        for out, ws in zip(x, paragraphs, strict=True):
            own = self.row(ws)
            out[own] = 1 / np.sqrt(max(len(own), 1))
        return x

    def holds_template(self, words: list[bytes]) -> bool:
        row = self.row(words)
        own = set(self.known[row].tolist()) if len(row) > 1 else set()
        return bool(own) and any(len(own & t) >= self.s.shared * len(t) for ts in self.templates for t in ts)

    def share(self, own: set[int], k: int) -> list[float]:
        """How much of each template of a family the grams ``own`` hold, by what names the family."""
        return [sum(self.naming[g] for g in own & t) / whole if whole else 0.0 for t, whole in zip(self.templates[k], self.whole[k], strict=True)]

    def chances(self, row: np.ndarray) -> np.ndarray:
        z = (self.w[row].sum(axis=0) / np.sqrt(max(len(row), 1)) + self.bias) / self.heat
        e = np.exp(z - z.max())
        return e / e.sum()

    def decide(self, words: list[bytes]) -> tuple[str, float, float]:
        """Family (or unknown), its calibrated score, and the share of its best template that the paragraph holds."""
        return self._decide(self.row(words))

    def _decide(self, row: np.ndarray) -> tuple[str, float, float]:
        p = self.chances(row)
        k = int(p.argmax())
        if k == len(self.families):
            return UNKNOWN, float(p[k]), 0.0
        own = set(self.known[row].tolist())
        shared = max(self.share(own, k))
        good = p[k] >= self.s.score and shared >= self.s.shared
        return self.families[k] if good else UNKNOWN, float(p[k]), shared

    def regions(self, words: list[bytes]) -> list[tuple[str, float, float, int, int]]:
        """Family, score, share, first word and word after the last one, wherever the words hold enough of what names a template in about its length.

        Each region is decided by itself, so notices beside each other don't share a score. Of regions that lie in each other by more than half
        (families have wordings in common) the one with the largest share of its template stays.
        """
        kept: list[tuple[str, float, float, int, int]] = []
        for r in sorted(self._regions(words), key=lambda r: (-r[2], r[3] - r[4], -r[1], r)):
            if all(2 * (min(r[4], q[4]) - max(r[3], q[3])) <= min(r[4] - r[3], q[4] - q[3]) for q in kept):
                kept.append(r)
        return kept

    def _regions(self, words: list[bytes]) -> Iterator[tuple[str, float, float, int, int]]:
        grams, at = gram_codes(coded(words)[1:-1], self.s.bits)
        column = self.column[grams]
        end = at + np.repeat([2, 3], [max(len(words) - 1, 0), max(len(words) - 2, 0)])
        column, at, end = column[column >= 0], at[column >= 0], end[column >= 0]
        for t in np.flatnonzero(self.holds[:, np.unique(column)].sum(axis=1) >= self.least):
            k, n = self.of[t]
            own = self.holds[t, column] > 0
            order = np.argsort(end[own], kind="stable")
            c, x, y = column[own][order], at[own][order], end[own][order]
            while len(c):
                spans = []  # from each start: what its distinct grams count for, and the end of the last one's first occurrence
                for i in np.unique(x).tolist():
                    m = (x >= i) & (y <= i + n + n // 4 + 2)
                    first_seen = np.unique(c[m], return_index=True)[1]
                    last = int(y[m][first_seen].max(initial=i))
                    spans.append((float(self.holds[t, c[m][first_seen]].sum()), i - last, i, last))
                number, _, first, last = max(spans)
                if number < self.least[t]:
                    break
                family, score, shared = self.decide(words[first:last])
                if family == self.families[k]:
                    yield family, score, shared, first, last
                rest = (y <= first) | (x >= last)
                c, x, y = c[rest], x[rest], y[rest]

    def scan(self, body: bytes) -> list[tuple[str, float, float, int]]:
        """Findings of a text: family, score, share of the template, line (the first one of a wrapped notice). A line can have several families."""
        spans: list[tuple[str, int, int, float, float]] = []
        for line, _, ws in paragraphs(body, self.s):
            row = self.row(ws)
            if len(row) < 2:  # a template has more
                continue
            for family, score, shared, *_ in (self._decide(row), *self.regions(ws)):
                if family != UNKNOWN:
                    spans.append((family, line, line, shared, score))
        wide: list[tuple[str, int, int, float, float]] = []
        for lines, ws in joined(body, self.s):
            if len(self.row(ws)) < 2:
                continue
            wide += [(family, lines[first], lines[last - 1], shared, score) for family, score, shared, first, last in self.regions(ws)]
        if wide:
            # a line that is part of a wrapped notice can read like another family's: the whole notice decides
            part = lambda f, line, shared: any(w[0] != f and w[1] <= line <= w[2] and w[1] < w[2] and w[3] > shared for w in wide) and not any(w[0] == f and w[1] <= line <= w[2] for w in wide)
            spans = [x for x in spans if not part(x[0], x[1], x[3])] + wide
        # the best of those that have lines in common; a wrapped notice is no second finding
        found: list[list] = []
        for family, first, last, shared, score in sorted(spans):
            if found and found[-1][0] == family and first <= found[-1][1]:
                found[-1][1] = max(found[-1][1], last)
                found[-1][2] = max(found[-1][2], (shared, score, -first))
            else:
                found.append([family, last, (shared, score, -first)])
        return sorted(((f, score, shared, -line) for f, _, (shared, score, line) in found), key=lambda r: (r[3], r[0]))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def variations(template: str, n: int, g: np.random.Generator, filler: list[list[bytes]]) -> list[list[bytes]]:
    """The template's words with some left out or strange, and other text around."""
    own, out = words_of(template.encode()), []
    for i in range(n):
        ws = list(own)
        if i:
            keep = g.random(len(ws)) >= 0.08
            ws = [w for w, k in zip(ws, keep, strict=True) if k] or ws[:1]
        if i % 2 and filler:
            extra = filler[g.integers(len(filler))]
            spot = int(g.integers(0, max(len(extra) - 20, 0) + 1))
            extra = extra[spot : spot + int(g.integers(1, 20))]
            ws = extra + ws if g.random() < 0.5 else ws + extra
        out.append(ws)
    return out


def train(others: list[list[bytes]], s: Settings) -> Model:
    """Softmax regression by full gradient steps, then one temperature from held-out variations."""
    g = np.random.default_rng(s.seed)
    model = Model(sorted(TEMPLATES), s)
    unknown = len(model.families)
    # paragraphs that hold a template are no examples of other text
    others = [ws for ws in others if not model.holds_template(ws)]
    xs, ys = [], []
    for k, f in enumerate(model.families):
        for t in TEMPLATES[f]:
            for ws in variations(t, s.variations, g, others):
                xs.append(ws)
                ys.append(k)
    # other text, and fragments of templates too short to name anything
    every = [ws for f in model.families for t in TEMPLATES[f] for ws in [words_of(t.encode())]]
    pieces = [ws[i : i + 3] for ws in every for i in range(0, max(len(ws) - 2, 1), 3) if len(ws) > 8]
    ys += [unknown] * (len(others) + len(pieces) + 1)
    xs += [*others, *pieces, []]
    y = np.array(ys)
    held = g.random(len(y)) < 0.2
    # equal rows are one, with their number: most other text has no known gram at all
    number: dict[tuple, int] = {}
    for ws, k in ((xs[i], ys[i]) for i in np.flatnonzero(~held)):
        row = (k, *model.row(ws).tolist())
        number[row] = number.get(row, 0) + 1
    a = np.zeros((len(number), len(model.known)))
    for out, (_, *own) in zip(a, number, strict=True):
        out[own] = 1 / np.sqrt(max(len(own), 1))
    label = np.array([k for k, *_ in number])
    target, weight = np.eye(unknown + 1)[label], np.array(list(number.values()), dtype=float)
    weight /= np.maximum(np.bincount(label, weights=weight, minlength=unknown + 1), 1)[label]
    weight /= weight.sum()
    for step in range(s.steps):
        d = (softmax(a @ model.w + model.bias) - target) * weight[:, None]
        rate = 30.0 * (1 - 0.9 * step / s.steps)
        model.w -= rate * (a.T @ d + 1e-5 * model.w)
        model.bias -= rate * d.sum(axis=0)
    z, truth = model.dense([xs[i] for i in np.flatnonzero(held)]) @ model.w + model.bias, y[held]
    heats = np.exp(np.linspace(-2, 2, 41))
    loss = [-np.log(softmax(z / h)[np.arange(len(truth)), truth] + 1e-12).mean() for h in heats]
    model.heat = float(heats[int(np.argmin(loss))])
    return model


def fit_licenses(df: DataFrame, settings: Settings | None = None, key: str = "doc_id", text: str = "text") -> Model:
    """Train with at most about ``sample_rows`` rows of ``df``, by hash, and ``sample_paragraphs`` windows of each as other text."""
    s = settings or Settings()
    kind = df.schema[key].dataType.simpleString()
    share = min(1.0, s.sample_rows / max(df.count(), 1))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, bodies in rows_of(batches):
            out = [[b" ".join(p[2]) for p in sorted(paragraphs(b, s), key=lambda p: zlib.crc32(b" ".join(p[2])))[: s.sample_paragraphs]] for b in bodies]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa_type(kind)), pa.array(out, pa.list_(pa.binary()))], ["key", "found"])

    chosen = df.where(hash_of(df[key], F.lit("license")) % (1 << 20) < int(share * (1 << 20)))
    rows = texts(chosen, key, text).mapInArrow(some, f"key {kind}, found array<binary>").groupBy("key").agg(F.min("found").alias("found")).collect()  # one row for each key
    return train(sorted(bytes(p).split(b" ") for r in rows for p in r["found"]), s)


def scan_licenses(df: DataFrame, settings: Settings | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, families, n_found, findings`` for every row.

    findings: (family, score, shared, line) by line; families: their distinct names, comma-joined in order, empty if nothing was found. All
    paragraphs of the whole text are scanned; no shuffle. Null and empty texts have no findings; repeated rows and null keys stay
    as they are; other columns are ignored; an empty table gives no rows.
    """
    kind = df.schema[key].dataType.simpleString()
    held = df.sparkSession.sparkContext.broadcast(fit_licenses(df, settings, key, text))
    names = ("family", "score", "shared", "line")
    finding = pa.list_(pa.struct(list(zip(names, (pa.string(), pa.float64(), pa.float64(), pa.int64()), strict=True))))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, bodies in rows_of(batches):
            out = [[dict(zip(names, f, strict=True)) for f in held.value.scan(b)] for b in bodies]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa_type(kind)), pa.array(out, finding)], ["key", "findings"])

    found = texts(df, key, text).mapInArrow(scan, f"key {kind}, findings array<struct<family: string, score: double, shared: double, line: long>>")
    families = F.array_join(F.array_sort(F.array_distinct(F.col("findings.family"))), ",")
    return found.select(F.col("key").alias(key), families.alias("families"), F.size("findings").cast("long").alias("n_found"), "findings")
