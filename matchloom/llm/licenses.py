"""Licence scans: a trained paragraph classifier, confirmed by templates.

Each line with a word is a paragraph. Its word 1- to 3-grams (case and punctuation aside) that the
model knows go through a multinomial logistic regression over licence families and an unknown class,
trained on varied notices and on look-alike text. On held-out paragraphs the probabilities
are calibrated by one temperature, and the least confidence is set at which at most ``false_rate`` of
unknown ones pass. A prediction counts only if one of the family's templates is
contained in the paragraph (or the paragraph in it) to at least ``contained``, by word bigrams; a paragraph of fewer than
three of those must name the family, too.

A paragraph of more than WINDOW words is read in overlapping windows. Beside the likeliest family, a window has every
other one that passes against the unknown class alone (at that test's own least confidence), that a template
confirms and that the window names (NAMES): families share wording, so a template alone doesn't tell them apart.
A family counts once a line, with its greatest probability.

Edge cases: a null or empty text has no findings; a paragraph without any known n-gram is unknown;
repeated rows each get a row; null ids are carried; extra columns are ignored unless kept, and an output column whose
name a kept one has gets underscores; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shingles import _PLACE, U, mix, slices, utf8, word_hashes
from .storage import fresh
from .workers import trimmed

#: Wordings of public licence notices.
TEMPLATES: dict[str, list[str]] = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1",
    ],
    "agpl": [
        "Licensed under the GNU Affero General Public License, version 3",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License",
        "SPDX-License-Identifier: AGPL-3.0",
    ],
    "mpl-2.0": [
        "Licensed under the Mozilla Public License, v. 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License", "https://creativecommons.org/licenses/by/4.0/"],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "https://creativecommons.org/licenses/by-sa/4.0/"],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "https://creativecommons.org/licenses/by-nc/4.0/"],
    "cc0": ["Dedicated to the public domain under CC0 1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0", "https://creativecommons.org/publicdomain/zero/1.0/"],
    "proprietary": ["Copyright 2020. All rights reserved.", "This material may not be reproduced or distributed without prior written permission", "This software is proprietary and confidential. Unauthorized copying is prohibited"],
}
FAMILIES = tuple(TEMPLATES)
UNKNOWN = "unknown"
#: Words, one to three, that only a notice of the family has.
NAMES: dict[str, list[str]] = {
    "apache-2.0": ["apache license", "apache org", "apache 2"],
    "mit": ["mit license", "identifier mit", "permission is hereby", "this permission notice"],
    "bsd": ["bsd", "redistribution and use"],
    "gpl": ["gnu general public", "gpl"],
    "lgpl": ["gnu lesser general", "lgpl"],
    "agpl": ["gnu affero general", "agpl"],
    "mpl-2.0": ["mozilla public license", "mpl"],
    "cc-by": ["cc by 4", "attribution 4", "licenses by 4"],
    "cc-by-sa": ["by sa", "attribution sharealike"],
    "cc-by-nc": ["by nc"],
    "cc0": ["cc0", "publicdomain zero"],
    "proprietary": ["all rights reserved", "prior written permission", "proprietary and confidential"],
}
#: A run of up to WINDOW - STEP + 1 words, more than any template has, is whole in some window.
WINDOW, STEP = 64, 32

#: Letters and digits stay, the rest parts words; bytes of other scripts stay.
_WORDS = np.full(256, 32, np.uint8)
_WORDS[np.r_[48:58, 97:123, 128:256]] = np.r_[48:58, 97:123, 128:256]
_WORDS[65:91] = np.arange(97, 123)
CHUNK_BYTES = 1 << 20


def paragraph_words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes; where each line's begin (one more at the end); each line's row and first byte."""
    breaks = np.flatnonzero(raw == 10) + 1
    starts = np.unique(np.concatenate([offsets[:-1], breaks[breaks < len(raw)]]))
    starts = starts[starts < len(raw)]
    words, at = word_hashes(_WORDS[raw], np.concatenate([starts, [len(raw)]]).astype(np.int64))
    return words, at, np.searchsorted(offsets, starts, "right") - 1, starts


def grams(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all 1- to 3-grams within lines, and each one's line."""
    line = np.repeat(np.arange(len(at) - 1), np.diff(at))
    out, of = [mix(words * _PLACE[10])], [line]
    with np.errstate(over="ignore"):
        for n in (2, 3):
            if len(words) < n:
                break
            h = words[: len(words) - n + 1] * _PLACE[10 + n]
            for j in range(1, n):
                h = h + words[j : len(words) - n + 1 + j] * _PLACE[20 + j]
            whole = line[: len(line) - n + 1] == line[n - 1 :]
            out.append(mix(h)[whole])
            of.append(line[: len(line) - n + 1][whole])
    return np.concatenate(out), np.concatenate(of)


def _of_text(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Grams and distinct bigrams of one paragraph."""
    raw = np.frombuffer(text.encode(), np.uint8)
    words, at, _, _ = paragraph_words(raw, np.array([0, len(raw)], np.int64))
    return np.unique(grams(words, at)[0]), bigrams(words)


def windows(words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of all windows of lines, where each window's begin (one more at the end), and each one's line."""
    n = np.diff(at)
    count = np.where(n > WINDOW, -(-(n - WINDOW) // STEP) + 1, 1)
    line = np.repeat(np.arange(len(n)), count)
    first = at[line] + STEP * (np.arange(len(line)) - np.repeat(np.cumsum(count) - count, count))
    size = np.minimum(WINDOW, at[line + 1] - first)
    begin = np.concatenate([[0], np.cumsum(size)])
    return words[np.repeat(first - begin[:-1], size) + np.arange(begin[-1])], begin, line


def bigrams(words: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.unique(mix(words[:-1] * _PLACE[30] + words[1:] * _PLACE[31])) if len(words) > 1 else mix(words)


def varied_paragraphs(count: int, seed: int) -> list[tuple[str, int]]:
    """Labelled paragraphs: notices cut, joined and embedded, and look-alikes; label len(FAMILIES) is unknown."""
    rng = random.Random(seed)
    syllables = "th er on an re he in ed nd ha at en es or nt ti hi st ou ea is tion ing ble que ment ach lich und ver".split()
    vocabulary = sorted({w for ts in TEMPLATES.values() for t in ts for w in re.findall(r"\w+", t)})

    def words(n: int) -> str:
        return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))

    out = []
    for _ in range(count):
        if rng.random() < 0.5:
            f = rng.randrange(len(FAMILIES))
            t = rng.choice(TEMPLATES[FAMILIES[f]])
            parts = t.split()
            if len(parts) > 10 and rng.random() < 0.3:
                t = " ".join(parts[: rng.randint(8, len(parts))])
            if rng.random() < 0.3:
                t = re.sub(r"\d{4}", str(rng.randint(1990, 2030)), t)
            if rng.random() < 0.2:
                t = t.upper()
            out.append((f"{words(rng.randint(0, 12))} {t} {words(rng.randint(0, 12))}".strip(), f))
        else:
            mixed = [w for w in words(rng.randint(1, 40)).split()]
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                mixed.insert(rng.randint(0, len(mixed)), rng.choice(vocabulary))
            out.append((" ".join(mixed), len(FAMILIES)))
    return out


@dataclass(frozen=True)
class LicenceModel:
    keys: np.ndarray  # sorted hashes of known n-grams
    weights: np.ndarray  # known n-grams x (families + unknown)
    bias: np.ndarray
    temperature: float
    least: float
    least_alone: float  # of a family against the unknown class alone
    templates: tuple[tuple[np.ndarray, ...], ...]
    names: tuple[np.ndarray, ...]


def _alone(z: np.ndarray) -> np.ndarray:
    """Each family's probability against the unknown class alone."""
    return 1 / (1 + np.exp(np.minimum(z[:, -1:] - z[:, :-1], 80)))


def _probabilities(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(1, keepdims=True))
    return z / z.sum(1, keepdims=True)


@functools.lru_cache(maxsize=2)
def train_model(count: int = 4000, false_rate: float = 0.001, seed: int = 9) -> LicenceModel:
    keys = np.unique(np.concatenate([_of_text(t)[0] for ts in TEMPLATES.values() for t in ts]))
    labelled = varied_paragraphs(count, seed)
    x = np.zeros((count, len(keys)), np.float32)
    for i, (t, _) in enumerate(labelled):
        g = _of_text(t)[0]
        x[i, np.searchsorted(keys, g[np.isin(g, keys)])] = 1
    y = np.array([f for _, f in labelled])
    k = len(FAMILIES) + 1
    fit, held = slice(0, count * 7 // 10), slice(count * 7 // 10, count)
    gold = np.eye(k, dtype=np.float32)[y]
    w, b = np.zeros((len(keys), k), np.float32), np.zeros(k, np.float32)
    mw, mb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(250):
        aw, ab = w + 0.9 * mw, b + 0.9 * mb
        g = (_probabilities(x[fit] @ aw + ab) - gold[fit]) / (fit.stop - fit.start)
        nw, nb = aw - 1.0 * (x[fit].T @ g + 1e-4 * aw), ab - 1.0 * g.sum(0)
        mw, mb, w, b = nw - w, nb - b, nw, nb
    z = x[held] @ w + b
    loss = lambda t: -np.log(_probabilities(z / t)[np.arange(len(z)), y[held]] + 1e-12).mean()
    temperature = min(np.geomspace(0.25, 4, 33), key=loss)
    none = _probabilities(z / temperature)[y[held] == k - 1, : k - 1].max(1)
    least = max(0.5, float(np.quantile(none, 1 - false_rate)))
    least_alone = max(0.5, float(np.quantile(_alone(z / temperature)[y[held] == k - 1].max(1), 1 - false_rate)))
    names = tuple(np.array([_gram(t) for t in NAMES[f]]) for f in FAMILIES)
    return LicenceModel(keys, w, b, float(temperature), least, least_alone, tuple(tuple(_of_text(t)[1] for t in ts) for ts in TEMPLATES.values()), names)


def _gram(name: str) -> np.uint64:
    """Hash of a name of up to three words."""
    raw = np.frombuffer(name.encode(), np.uint8)
    words, at, _, _ = paragraph_words(raw, np.array([0, len(raw)], np.int64))
    return grams(words, at)[0][-1]


def scan(raw: np.ndarray, offsets: np.ndarray, model: LicenceModel, contained: float = 0.7) -> list[list[tuple[int, int, float]]]:
    """(family, line number, probability) of each row's licensed paragraphs."""
    found: list[list[tuple[int, int, float]]] = [[] for _ in range(len(offsets) - 1)]
    if not len(raw):
        return found
    words, at, row, starts = paragraph_words(raw, offsets)
    words, at, of_line = windows(words, at)
    g, window = grams(words, at)
    place = np.searchsorted(model.keys, g)
    place[place == len(model.keys)] = 0
    hit = model.keys[place] == g
    # one vote for each distinct known n-gram of a window
    pairs = np.unique(window[hit] * len(model.keys) + place[hit])
    seen, known = pairs // len(model.keys), pairs % len(model.keys)
    if not len(seen):
        return found
    edge = np.concatenate([[0], np.flatnonzero(seen[1:] != seen[:-1]) + 1])
    z = (np.add.reduceat(model.weights[known], edge, 0) + model.bias) / model.temperature
    p, alone = _probabilities(z), _alone(z)
    likeliest = p.argmax(1)
    first_line = np.searchsorted(starts, offsets[:-1])
    best: dict[tuple[int, int], float] = {}  # by line and family
    for i in np.flatnonzero((p[:, :-1].max(1) >= model.least) & (likeliest < len(FAMILIES)) | (alone.max(1) >= model.least_alone)):
        x = int(seen[edge[i]])
        mine = words[at[x] : at[x + 1]]
        own = bigrams(mine)
        said = grams(mine, np.array([0, len(mine)]))[0]
        named = lambda f: bool(np.isin(model.names[f], said).any())  # noqa: B023, E731
        # a line of a few words lies in a template by chance: it must name the family as well
        confirmed = lambda f: (len(own) >= 3 or named(f)) and max(len(np.intersect1d(own, t, assume_unique=True)) / max(1, min(len(own), len(t))) for t in model.templates[f]) >= contained  # noqa: B023, E731
        top = int(likeliest[i])
        got = {}
        if top < len(FAMILIES) and p[i, top] >= model.least and confirmed(top):
            got[top] = float(p[i, top])
        others = [int(f) for f in np.flatnonzero(alone[i] >= model.least_alone) if f not in got]
        if others:
            got |= {f: float(alone[i, f]) for f in others if named(f) and confirmed(f)}
        for f, chance in got.items():
            key = (int(of_line[x]), f)
            best[key] = max(best.get(key, 0.0), chance)
    for (line, f), chance in best.items():
        r = int(row[line])
        found[r].append((f, line - int(first_line[r]), chance))
    return found


def _scan_rows(names: list[str], added: list[str], model: LicenceModel, contained: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8(batch.column("text"))
            found: list[list[tuple[int, int, float]]] = []
            for i, j in slices(offsets, CHUNK_BYTES):
                found += scan(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], model, contained)
            families = pa.array([",".join(sorted({FAMILIES[f] for f, _, _ in x})) for x in found], pa.string())
            where = pa.array([",".join(f"{FAMILIES[f]}:{line}:{p:.4f}" for f, line, p in x) for x in found], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array([len(x) for x in found], pa.int64()), families, where], [*names, *added])

    return run


def scan_licences(df: DataFrame, keep: list[str], model: LicenceModel | None = None, contained: float = 0.7) -> DataFrame:
    """``keep`` columns, the number of licence paragraphs, their families, and family:line:probability of each."""
    kinds = dict(df.dtypes)
    added = [fresh(keep, c) for c in ("n_notices", "families", "findings")]
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), f"`{added[0]}` bigint, `{added[1]}` string, `{added[2]}` string"])
    return df.select(*dict.fromkeys([*keep, "text"])).mapInArrow(trimmed(_scan_rows(keep, added, model or train_model(), contained)), schema)
