"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

A paragraph is a line of text. Sparse features are its words and word pairs; a softmax regression gives
each licence family and the class ``unknown`` a probability. It is trained on varied copies of the
templates and, for ``unknown``, on paragraphs of the corpus and on sentences that only use the same words.
A temperature, fitted on further copies, calibrates the probabilities. A family is reported from
``CONFIDENT`` on, and is confirmed if one of its templates or titles shares at least ``CONFIRMED`` of the
word pairs of the shorter one of the two. Lines of up to ``SHORT`` words must be a template or title as a
whole, or name the family; with a name and another word, one title must have all their words.

A line of more than ``LONG`` words is also looked at in parts (``passages``), by the same classifier and
templates, so that a notice is found within prose, and two licences in one line. A line's family
is reported once, with its surest confirmed finding.

The corpus paragraphs for training are those of about ``SAMPLE_DOCS`` documents, chosen by a hash of
id and text, less those that compare well with any template. All paragraphs of all documents are scored.

Defined results: NULL and empty texts have no paragraphs with words and no findings. A document's
licence is that of its surest confirmed finding, ties going to the alphabetically first family, and
``unknown`` without one. Equal texts get equal results. Over an empty table the model still has the
templates.
"""

from __future__ import annotations

import random
import re
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_udf

UNKNOWN = "unknown"
CONFIDENT = 0.5
CONFIRMED = 0.8
SHORT = 3
LONG = 12  # words of a line from which on its passages are looked at too
GAP = 6  # words between two pairs of templates in one passage, at most
SAMPLE_DOCS = 300
COPIES = 40
SEEN = 3  # examples that have a feature, at least
SEED = 5

# Notices and characteristic sentences of public licences.
TEMPLATES = {
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "Apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC0": [
        "Released under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "ISC": [
        "Released under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL": [
        "Licensed under the Mozilla Public License, version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "Proprietary": [
        "All rights reserved.",
        "Copyright 2020 Example Corporation. All rights reserved.",
        "No part of this publication may be reproduced, distributed, or transmitted in any form without the prior written permission of the publisher.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose.",
    ],
}

# Titles and short forms of the same licences.
TITLES = {
    "AGPL": ["GNU Affero General Public License", "GNU Affero General Public License v3.0", "GNU AGPL", "AGPL License", "AGPLv3", "AGPL v3", "AGPL-3.0", "AGPL-3.0-or-later"],
    "Apache": ["The Apache License", "Apache License Version 2.0, January 2004", "Version 2.0, January 2004", "Apache License 2.0", "Apache 2.0 License", "Apache Software License", "Apache-2.0"],
    "BSD": ["The BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "3-Clause BSD License", "2-Clause BSD License", "New BSD License", "Simplified BSD License", "BSD-3-Clause", "BSD-2-Clause"],
    "CC-BY": ["CC BY", "CC-BY-4.0", "CC BY 3.0", "Creative Commons Attribution 4.0 International", "Creative Commons Attribution License"],
    "CC-BY-NC": ["CC BY-NC", "CC-BY-NC-4.0", "Creative Commons Attribution-NonCommercial 4.0 International", "Creative Commons Attribution-NonCommercial License"],
    "CC-BY-SA": ["CC BY-SA", "CC-BY-SA-4.0", "CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 4.0 International", "Creative Commons Attribution-ShareAlike License"],
    "CC0": ["CC0 License", "CC0-1.0", "CC0 1.0 Universal", "Creative Commons Zero", "Creative Commons CC0", "CC0 1.0 Universal Public Domain Dedication"],
    "GPL": ["GNU General Public License", "GNU General Public License v3.0", "GNU General Public License v2.0", "GNU GPL", "GPL License", "GPLv2", "GPLv3", "GPL v2", "GPL v3", "GPL-2.0", "GPL-3.0", "GPL-3.0-only"],
    "ISC": ["The ISC License", "ISC License", "License: ISC"],
    "LGPL": ["GNU Lesser General Public License", "GNU Lesser General Public License v2.1", "GNU Lesser General Public License v3.0", "GNU Library General Public License", "GNU LGPL", "LGPL License", "LGPLv3", "LGPL v3", "LGPL-2.1", "LGPL-3.0"],
    "MIT": ["The MIT License", "MIT License", "The MIT License (MIT)", "License: MIT", "MIT License (Expat)"],
    "MPL": ["Mozilla Public License", "Mozilla Public License 2.0", "Mozilla Public License Version 2.0", "MPL License", "MPL 2.0", "MPL-2.0"],
    "Proprietary": ["Proprietary License", "Proprietary and confidential", "License: Proprietary"],
    "Unlicense": ["The Unlicense", "Unlicense License", "The Unlicense (Unlicense)"],
}

# Words that name a family.
NAMES = {
    "AGPL": {"agpl", "agplv3", "affero"},
    "Apache": {"apache"},
    "BSD": {"bsd"},
    "CC0": {"cc0"},
    "GPL": {"gpl", "gplv2", "gplv3"},
    "ISC": {"isc"},
    "LGPL": {"lgpl", "lgplv3"},
    "MIT": {"mit"},
    "MPL": {"mpl", "mozilla"},
    "Unlicense": {"unlicense"},
}

# Sentences that use the words of licences without being one.
OTHER_USES = [
    "He lost his driving licence after the second accident.",
    "The restaurant applied for a license to sell beer and wine.",
    "The software was released in version 2.0 last week.",
    "All rights and duties of the tenant follow from the contract.",
    "The public was free to use the library under the new rules.",
    "Permission to build the house was granted by the town.",
    "She wrote about copyright law and the history of the copy.",
    "The Apache helicopter is distributed among several units.",
    "MIT published a study on general education.",
    "The seats were reserved for the members of the foundation.",
    "License",
    "Public license",
    "Version 2.0",
    "January 2004",
    "General public",
    "Creative commons",
    "The Mozilla developers met in January 2004.",
    "She studied at MIT and wrote for the public.",
]

_words = re.compile(r"\w+").findall


def pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:], strict=False))


def _shared(a: set[tuple[str, str]], b: set[tuple[str, str]]) -> float:
    low = min(len(a), len(b))
    return len(a & b) / low if low >= 2 else 0.0


def overlap(words: list[str], template: list[str]) -> float:
    """Share of the smaller set of word pairs that the other one has; 0 for fewer than two pairs."""
    return _shared(pairs(words), pairs(template))


_TEXTS = {f: [_words(t.lower()) for t in TEMPLATES[f] + TITLES[f]] for f in TEMPLATES}
_PAIRS = {f: [pairs(t) for t in _TEXTS[f]] for f in TEMPLATES}


_KNOWN = frozenset().union(*(t for ts in _PAIRS.values() for t in ts))
_NAMED = frozenset().union(*NAMES.values())


def passages(words: list[str]) -> list[list[str]]:
    """The parts of a long line that may be a notice: where pairs of words of templates stand close together,
    with a few words around them, and the nearest words of a licence's name."""
    if len(words) <= LONG:
        return []
    hits = [i for i, p in enumerate(zip(words, words[1:], strict=False)) if p in _KNOWN]
    spans = [(i - 2, i + 3) for i, w in enumerate(words) if w in _NAMED]
    start = 0
    for k in range(1, len(hits) + 1):
        if k == len(hits) or hits[k] - hits[k - 1] > GAP:
            if k - start > 1:
                spans.append((hits[start] - 2, hits[k - 1] + 4))
            start = k
    return [words[max(0, a) : b] for a, b in spans]


def best_overlap(words: list[str], families: list[str]) -> float:
    """With the templates, without the titles."""
    own = pairs(words)
    return max((_shared(own, t) for f in families for t in _PAIRS[f][: len(TEMPLATES[f])]), default=0.0)


def confirmed(words: list[str], family: str) -> bool:
    """A line has the words of one of the family's templates or titles."""
    if words in _TEXTS[family]:
        return True
    if len(words) <= SHORT:
        if NAMES.get(family, set()).isdisjoint(words):
            return False
        # A name alone is a notice only as a title: "mit" is a word of other languages too.
        if len(words) > 1 and any(set(words) <= set(t) for t in _TEXTS[family]):
            return True
    own = pairs(words)
    return max(_shared(own, t) for t in _PAIRS[family]) >= CONFIRMED


class Scanner(NamedTuple):
    families: list[str]  # ``unknown`` is the first
    words: dict[str, int]  # numbers from 1
    word_weights: np.ndarray  # [word, family]; row 0 is zero
    pair_keys: np.ndarray  # sorted: first word's number times the number of words, plus the second's
    pair_weights: np.ndarray  # [pair, family]
    bias: np.ndarray  # [family]
    temperature: float

    def probabilities(self, lines: list[list[str]]) -> np.ndarray:
        """[line, family] for lines of one word at least."""
        sizes = np.array([len(w) for w in lines])
        known = self.words.get
        at = np.array([known(w, 0) for ws in lines for w in ws])
        of_line = np.repeat(np.arange(len(lines)), sizes)
        total = np.add.reduceat(self.word_weights[at], np.cumsum(sizes) - sizes, axis=0)
        both = np.flatnonzero((at[:-1] > 0) & (at[1:] > 0) & (of_line[:-1] == of_line[1:]))
        if len(both) and len(self.pair_keys):
            keys = at[both] * len(self.word_weights) + at[both + 1]
            found = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            hit = self.pair_keys[found] == keys
            np.add.at(total, of_line[both[hit]], self.pair_weights[found[hit]])
        z = (total / np.sqrt(2 * sizes - 1)[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _varied(rng: random.Random, text: str) -> list[str]:
    """A copy with other numbers, some words lost or foreign, and perhaps words around it."""
    words = [w for w in _words(text.lower()) if rng.random() > 0.08] or _words(text.lower())
    words = [str(rng.randint(1, 2030)) if w.isdigit() and rng.random() < 0.3 else w for w in words]
    extra = ["copyright", "c", str(rng.randint(1980, 2030)), f"name{rng.randint(0, 99)}"]
    return extra * (rng.random() < 0.2) + words + [f"name{rng.randint(0, 99)}"] * rng.randint(0, 2)


def _examples(rng: random.Random, others: list[list[str]]) -> tuple[list[list[str]], np.ndarray, list[str]]:
    families = [UNKNOWN, *sorted(TEMPLATES)]
    lines, labels = [], []
    for i, family in enumerate(families[1:], 1):
        for text in TEMPLATES[family] + TITLES[family]:
            lines += [_words(text.lower())] + [_varied(rng, text) for _ in range(COPIES)]
            labels += [i] * (COPIES + 1)
    for text in OTHER_USES:
        lines += [_varied(rng, text) for _ in range(COPIES)]
        labels += [0] * COPIES
    return lines + others, np.array(labels + [0] * len(others)), families


def fit(others: list[list[str]], rounds: int = 60, rate: float = 0.2, damp: float = 1e-4) -> Scanner:
    """Train on varied templates against ``others``, paragraphs of no licence; then calibrate."""
    rng = random.Random(SEED)
    lines, labels, families = _examples(rng, others)
    words: dict[str, int] = {}
    for line in lines:
        for w in line:
            words.setdefault(w, len(words) + 1)
    size = len(words) + 1
    rows, features = [], []
    for i, line in enumerate(lines):
        at = [words[w] for w in line]
        features += at + [a * size + b for a, b in zip(at, at[1:], strict=False)]
        rows += [i] * (2 * len(at) - 1)
    keys, feature, seen = np.unique(np.array(features), return_inverse=True, return_counts=True)
    row = np.array(rows)
    value = 1 / np.sqrt(np.bincount(row, minlength=len(lines)))[row]
    # Rare features, mostly words of single paragraphs, say nothing; one of each row stays for the sums.
    kept = (seen >= SEEN)[feature] | np.concatenate([[True], row[1:] != row[:-1]])
    row, value = row[kept], value[kept]
    used, feature = np.unique(feature[kept], return_inverse=True)
    keys = keys[used]
    weights, bias = np.zeros((len(keys), len(families))), np.zeros(len(families))
    grown, grown_bias = np.full(weights.shape, 1e-8), np.full(bias.shape, 1e-8)
    by_row, by_feature = np.argsort(row, kind="stable"), np.argsort(feature, kind="stable")
    row_starts = np.searchsorted(row[by_row], np.arange(len(lines)))
    feature_starts = np.searchsorted(feature[by_feature], np.arange(len(keys)))
    for _ in range(rounds):
        z = np.add.reduceat((weights[feature] * value[:, None])[by_row], row_starts, axis=0) + bias
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        p[np.arange(len(lines)), labels] -= 1
        slope = np.add.reduceat((p[row] * value[:, None])[by_feature], feature_starts, axis=0) / len(lines) + damp * weights
        grown += slope**2
        weights -= rate * slope / np.sqrt(grown)
        grown_bias += p.mean(axis=0) ** 2
        bias -= rate * p.mean(axis=0) / np.sqrt(grown_bias)
    single = keys < size
    word_weights = np.zeros((size, len(families)))
    word_weights[keys[single]] = weights[single]
    scanner = Scanner(families, words, word_weights, keys[~single], weights[~single], bias, 1.0)
    return scanner._replace(temperature=_temperature(scanner, rng, others))


def _temperature(scanner: Scanner, rng: random.Random, others: list[list[str]]) -> float:
    """The temperature under which further varied copies are likeliest."""
    lines, labels, _ = _examples(rng, [])
    lines, labels = lines + others[::4], np.concatenate([labels, np.zeros(len(others[::4]), dtype=int)])
    losses = {}
    for t in np.geomspace(0.05, 4, 30):
        p = scanner._replace(temperature=float(t)).probabilities(lines)
        losses[float(t)] = -np.log(p[np.arange(len(lines)), labels] + 1e-12).mean()
    return min(losses, key=losses.get)


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Scanner:
    """Fit against paragraphs of a bounded sample of the documents."""
    step = 1 << 30
    share = min(1.0, sample_docs / max(1, docs.count()))
    # By id and text: NULL or equal ids do not come all together.
    picked = docs.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(step)) < int(share * step))
    lines = picked.select(F.explode(F.split("text", "\n")).alias("line")).distinct().toPandas()["line"]
    families = list(TEMPLATES)
    others = [w for w in (_words(x.lower()) for x in sorted(lines)) if w and best_overlap(w, families) < 0.5 and not any(confirmed(w, f) for f in families)]
    return fit(others)


def scan(text: Column, scanner: Scanner) -> Column:
    """Struct of ``paragraphs``, ``license``, ``confidence`` and all ``findings``."""

    def work(texts: list[str]) -> pd.DataFrame:
        whole = [[(i, w) for i, w in enumerate(map(_words, t.lower().split("\n"))) if w] for t in texts]
        split = [[(i, part) for i, w in doc for part in (w, *passages(w))] for doc in whole]
        lines = [w for doc in split for _, w in doc]
        p = scanner.probabilities(lines) if lines else np.empty((0, len(scanner.families)))
        best = p.argmax(axis=1)
        sure = p[np.arange(len(p)), best]
        rows, at = [], 0
        for doc, paragraphs in zip(split, whole, strict=True):
            found: dict[tuple[int, str], tuple[bool, float]] = {}
            for place, words in doc:
                if best[at] and sure[at] >= CONFIDENT:
                    family = scanner.families[best[at]]
                    finding = (confirmed(words, family), float(sure[at]))
                    found[place, family] = max(finding, found.get((place, family), finding))
                at += 1
            findings = [{"paragraph": p, "family": f, "confidence": c, "confirmed": ok} for (p, f), (ok, c) in found.items()]
            top = min((f for f in findings if f["confirmed"]), key=lambda f: (-f["confidence"], f["family"]), default=None)
            rows.append((len(paragraphs), top["family"] if top else UNKNOWN, top["confidence"] if top else 0.0, findings))
        return pd.DataFrame(rows, columns=["paragraphs", "license", "confidence", "findings"])

    found = "array<struct<paragraph:int,family:string,confidence:double,confirmed:boolean>>"
    return text_udf(work, f"paragraphs int, license string, confidence double, findings {found}")(text)


def scan_documents(docs: DataFrame) -> DataFrame:
    """doc_id, paragraphs, license, confidence and findings of every document."""
    return docs.select("doc_id", scan(F.col("text"), train(docs)).alias("_s")).select("doc_id", "_s.*")
