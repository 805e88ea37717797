"""Licence families of paragraphs: a trained classifier, an unknown class, a template check.

Features are the word pairs and triples that occur in the notices below, so they are few and a
paragraph has very few of them. Multinomial logistic regression is fitted to notices with words
dropped, put in between ordinary words or cut, and to at most `sample` ordinary paragraphs (those
with the smallest hashes; such as hold a notice are left out). A third of the examples is held
out: on it the scores are put on the scale of probabilities (one temperature) and the least
probability is chosen at which no more than `error` of the ordinary examples pass. A paragraph
that is more likely some licence than none, but passes for no family or has less than
`template_share` of the pairs of a notice of that family, is `unknown`.

A paragraph is a line; longer ones are read in stretches of `stretch` words that overlap by
half, so that a notice inside a long text weighs as much. All paragraphs of all documents are
read. Nulls and empty texts have no paragraphs. Repeated rows are judged one by one. An empty
table gives an empty result.
"""

from __future__ import annotations

import math
import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import with_columns

# Usual notices by family.
NOTICES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "This project is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "CC-BY": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "CC0": (
        "To the extent possible under law, the author has dedicated all copyright to the public domain worldwide.",
        "Released under the CC0 1.0 Universal public domain dedication.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Released under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
}
FAMILIES = tuple(sorted(NOTICES))
NONE = len(FAMILIES)
_WORD = re.compile(r"[^\W_]+")


@dataclass(frozen=True)
class Settings:
    sample: int = 2000
    copies: int = 60  # altered copies of each notice
    stretch: int = 64
    error: float = 0.001
    template_share: float = 0.6
    seed: int = 0


def grams(words: list[str]) -> set[tuple[str, ...]]:
    """Pairs and triples of neighbours."""
    return {*zip(words, words[1:]), *zip(words, words[1:], words[2:])}


def stretches(text: str | None, length: int) -> list[list[str]]:
    """The words of each paragraph, of long ones in overlapping stretches."""
    out = []
    for line in (text or "").split("\n"):
        words = _WORD.findall(line.lower())
        if len(words) <= length:
            if words:
                out.append(words)
        else:
            out += [words[i : i + length] for i in range(0, len(words) - length // 2, length // 2)]
    return out


class Model:
    """Word pairs and triples, their weights per class, temperature and least probability."""

    def __init__(self, ordinary: list[str], settings: Settings):
        self.settings = settings
        self.notices = [(i, _WORD.findall(t.lower())) for i, f in enumerate(FAMILIES) for t in NOTICES[f]]
        self.pairs = [(i, set(zip(w, w[1:]))) for i, w in self.notices]
        self.index = {g: i for i, g in enumerate(sorted(set().union(*(grams(w) for _, w in self.notices))))}
        self.weights, self.bias = np.zeros((len(self.index), NONE + 1)), np.zeros(NONE + 1)
        self.temperature, self.least = 1.0, 0.5
        self._fit([w for t in ordinary for w in stretches(t, settings.stretch)])

    def _share(self, words: list[str], family: int | None = None) -> float:
        """The largest share of a notice's pairs that the words hold."""
        have = set(zip(words, words[1:]))
        return max(len(p & have) / len(p) for i, p in self.pairs if family is None or i == family)

    def _examples(self, ordinary: list[list[str]]) -> list[tuple[int, list[str]]]:
        draw = random.Random(self.settings.seed)
        plain = [w for w in ordinary if self._share(w) < 0.3][: self.settings.sample]
        around = [w for w in plain if w] or [["a"]]
        out = []
        for family, words in self.notices:
            for _ in range(self.settings.copies):
                kept = [w for w in words if draw.random() > 0.08]
                before, after = draw.choice(around), draw.choice(around)
                pad = draw.randrange(0, 20)
                out.append((family, before[:pad] + kept + after[: draw.randrange(0, 20)]))
            # parts of notices that say nothing on their own
            cut = draw.randrange(1, 3)
            out += [(NONE, words[:cut]), (NONE, ["licensed", "under", "the"]), (NONE, ["version", draw.choice("123")])]
        out += [(NONE, w) for w in plain]
        draw.shuffle(out)
        return out

    def rows(self, words: list[str]) -> list[int]:
        return [i for g in grams(words) if (i := self.index.get(g)) is not None]

    def _matrix(self, examples):
        x = np.zeros((len(examples), len(self.index)))
        for n, (_, words) in enumerate(examples):
            found = self.rows(words)
            x[n, found] = 1 / math.sqrt(len(found) or 1)
        return x, np.array([c for c, _ in examples])

    def _fit(self, ordinary: list[list[str]]) -> None:
        examples = self._examples(ordinary)
        x, y = self._matrix(examples)
        held = np.arange(len(y)) % 3 == 0
        a, b = x[~held], np.eye(NONE + 1)[y[~held]]
        self.bias[NONE] = 2.0
        for _ in range(300):
            wrong = _softmax(a @ self.weights + self.bias) - b
            self.weights -= 4.0 * (a.T @ wrong / len(a) + 1e-4 * self.weights)
            self.bias -= 1.0 * wrong.mean(axis=0)
        scores = x[held] @ self.weights + self.bias
        losses = [
            (-np.log(_softmax(scores / t)[np.arange(held.sum()), y[held]] + 1e-12).mean(), t)
            for t in np.geomspace(0.25, 4, 33)
        ]
        self.temperature = float(min(losses)[1])
        p = _softmax(scores / self.temperature)[:, :NONE].max(axis=1)[y[held] == NONE]
        over = np.sort(p)[::-1]
        self.least = max(0.5, float(over[min(int(self.settings.error * len(over)), len(over) - 1)])) if len(over) else 0.5

    def judge(self, words: list[str]) -> tuple[int, float] | None:
        """Family (or NONE for unknown) and its probability; nothing for ordinary words."""
        found = self.rows(words)
        if not found:
            return None
        scores = self.weights[found].sum(axis=0) / math.sqrt(len(found)) + self.bias
        p = _softmax(scores[None] / self.temperature)[0]
        family = int(p[:NONE].argmax())
        if p[NONE] >= 0.5:
            return None
        sure = p[family] > self.least and self._share(words, family) >= self.settings.template_share
        return (family if sure else NONE), float(p[family])


def _softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def ordinary_paragraphs(docs: DataFrame, settings: Settings) -> list[str]:
    """At most `sample` short paragraphs, those with the smallest hashes, one from a text. Only
    hashes are sorted; then the chosen texts are fetched."""
    lines = docs.select(F.substring(F.substring_index("text", "\n", 1), 1, 400).alias("line")).filter("line <> ''")
    marked = lines.select("line", F.xxhash64(F.lit(settings.seed), "line").alias("hash"))
    edge = marked.select("hash").distinct().orderBy("hash").limit(settings.sample).agg(F.max("hash")).first()[0]
    if edge is None:
        return []
    chosen = marked.filter(F.col("hash") <= edge).distinct().orderBy("hash").limit(settings.sample)
    return [r["line"] for r in chosen.collect()]


def scan(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_paragraphs, families (confirmed, sorted), n_confirmed, n_unknown, probability
    (the highest of a confirmed family) of every document."""
    model = Model(ordinary_paragraphs(docs, settings), settings)
    first = {g[0] for g in model.index}  # no pair without its first word

    def one(batch: pa.RecordBatch) -> dict:
        out = {c: [] for c in ("n_paragraphs", "families", "n_confirmed", "n_unknown", "probability")}
        known: dict[tuple, tuple | None] = {}
        for t in batch.column(batch.schema.get_field_index("text")):
            parts = stretches(t.as_py(), settings.stretch)
            found = []
            for words in parts:
                if first.isdisjoint(words):
                    continue
                key = tuple(words) if len(words) < 20 else None  # notices are repeated often
                if key in known and key is not None:
                    judged = known[key]
                else:
                    judged = model.judge(words)
                    if key is not None and len(known) < 10_000:
                        known[key] = judged
                if judged:
                    found.append(judged)
            sure = [(f, p) for f, p in found if f != NONE]
            out["n_paragraphs"].append(len(parts))
            out["families"].append(sorted({FAMILIES[f] for f, _ in sure}))
            out["n_confirmed"].append(len(sure))
            out["n_unknown"].append(len(found) - len(sure))
            out["probability"].append(round(max((p for _, p in sure), default=0.0), 6) if sure else None)
        return out

    return with_columns(
        docs.select("doc_id", "text"), one,
        "n_paragraphs long, families array<string>, n_confirmed long, n_unknown long, probability double", ("text",),
    )
