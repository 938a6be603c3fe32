"""Text quality: a generalised additive model with pairwise interactions.

Each text becomes a row of character, word and line statistics. Boosting goes round the features in
cycles; every step fits a shallow tree to one feature's bins and adds it to that feature's lookup
table. What is left is fitted by shallow trees over pairs of features. A score is then the intercept
plus one table entry per feature and pair: vectorised additions.

Defined results: NULL and empty texts have all statistics 0 and get the score of such a row. With no
usable labels, or labels of one kind only, every score is the smoothed share of label 1. Equal texts
get equal scores; other columns pass through.
"""

from __future__ import annotations

import zlib
from collections import Counter
from itertools import combinations
from operator import eq
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_udf
from tidemark.llm.labelled import training_rows

TRAINING_ROWS = 20_000
KEEP_FROM = 0.3

FEATURES = [
    "log_chars",
    "log_words",
    "word_length",
    "upper",
    "digits",
    "stops",
    "symbols",
    "not_ascii",
    "spaces",
    "distinct_words",
    "commonest_word",
    "word_repeats",
    "distinct_lines",
    "words_per_line",
    "zip_ratio",
    "symbol_words",
]

_LOWER, _UPPER, _DIGIT, _STOP, _SYMBOL, _SPACE, _HIGH = range(7)


def _byte_classes() -> np.ndarray:
    kinds = np.full(256, _SYMBOL, dtype=np.int64)
    kinds[:33] = _SPACE
    kinds[128:] = _HIGH
    for chars, kind in ((".,;:?'\"()-", _STOP), ("0123456789", _DIGIT)):
        kinds[[ord(c) for c in chars]] = kind
    kinds[ord("a") : ord("z") + 1] = _LOWER
    kinds[ord("A") : ord("Z") + 1] = _UPPER
    return kinds


_KINDS = _byte_classes()


def _statistics(text: str) -> list[float]:
    data = text.encode()
    if not data:
        return [0.0] * len(FEATURES)
    kinds = np.bincount(_KINDS[np.frombuffer(data, dtype=np.uint8)], minlength=7)
    words, lines = text.split(), text.split("\n")
    counts = Counter(words)
    n, size = max(1, len(words)), len(data)
    letters = max(1, kinds[_LOWER] + kinds[_UPPER])
    odd = sum(c for w, c in counts.items() if not w[-2:].isalnum() and len(w) > 1 and not w[-2].isalnum())
    return [
        np.log1p(size),
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        kinds[_UPPER] / letters,
        kinds[_DIGIT] / size,
        kinds[_STOP] / size,
        kinds[_SYMBOL] / size,
        kinds[_HIGH] / size,
        kinds[_SPACE] / size,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(map(eq, words, words[1:])) / n,
        len(set(lines)) / len(lines),
        np.log1p(len(words) / len(lines)),
        len(zlib.compress(data, 1)) / size,
        odd / n,
    ]


def statistics(texts: list[str]) -> np.ndarray:
    """One row of ``FEATURES`` per text."""
    return np.array([_statistics(t) for t in texts], dtype=float).reshape(len(texts), len(FEATURES))


class Gam(NamedTuple):
    """Cut points and lookup tables; a pair's table is over its features' coarse bins."""

    intercept: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: dict[tuple[int, int], np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cuts, x[:, j], side="right")]
        low = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(self.coarse)]
        for (a, b), table in self.pairs.items():
            total += table[low[a], low[b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray, damp: float) -> np.ndarray:
    return g * g / (h + damp)


def _tree(g: np.ndarray, h: np.ndarray, depth: int, damp: float) -> np.ndarray:
    """Leaf values per bin of the best tree of that depth along one axis."""
    out = np.full(len(g), g.sum() / (h.sum() + damp))
    if depth and len(g) > 1:
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = _gain(left_g, left_h, damp) + _gain(g.sum() - left_g, h.sum() - left_h, damp)
        at = int(np.argmax(gain)) + 1
        if gain[at - 1] > _gain(g.sum(), h.sum(), damp) + 1e-9:
            return np.concatenate([_tree(g[:at], h[:at], depth - 1, damp), _tree(g[at:], h[at:], depth - 1, damp)])
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray, damp: float) -> tuple[np.ndarray, float]:
    """Leaf values of the best two-level tree that cuts each axis once, and what it gains."""
    corner = [np.cumsum(np.cumsum(m, 0), 1) for m in (g, h)]
    parts = []
    for c in corner:
        a, row, column = c[:-1, :-1], c[:-1, -1:], c[-1:, :-1]
        parts.append((a, row - a, column - a, c[-1, -1] - row - column + a))
    gain = sum(_gain(x, y, damp) for x, y in zip(*parts, strict=True))
    if not gain.size:
        return np.zeros_like(g), 0.0
    i, j = np.unravel_index(np.argmax(gain), gain.shape)
    values = [p[0][i, j] / (p[1][i, j] + damp) for p in zip(*parts, strict=True)]
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = values
    return out, float(gain[i, j])


def fit(
    x: np.ndarray,
    y: np.ndarray,
    cycles: int = 120,
    rate: float = 0.15,
    bins: int = 48,
    pair_bins: int = 8,
    pairs: int = 6,
    damp: float = 4.0,
) -> Gam:
    """Fit feature tables first, then the ``pairs`` interactions that explain most of the rest."""
    ones = float(y.sum())
    prior = (ones + 0.5) / (len(y) + 1)
    intercept = float(np.log(prior / (1 - prior)))
    columns = range(x.shape[1])
    if ones in (0.0, float(len(y))):
        none = [np.array([]) for _ in columns]
        return Gam(intercept, none, [np.zeros(1) for _ in columns], none, {})
    cuts, coarse = [_cuts(x[:, j], bins) for j in columns], [_cuts(x[:, j], pair_bins) for j in columns]
    at = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)]
    low = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(coarse)]
    tables = [np.zeros(len(c) + 1) for c in cuts]
    total = np.full(len(y), intercept)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(cycles):
        for j in columns:
            g, h = slope()
            size = len(tables[j])
            step = rate * _tree(np.bincount(at[j], g, size), np.bincount(at[j], h, size), 2, damp)
            tables[j] += step
            total += step[at[j]]

    def grid(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        cell, (g, h) = low[a] * shape[1] + low[b], slope()
        return tuple(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (g, h))

    ranked = sorted(combinations(columns, 2), key=lambda ab: -_pair_tree(*grid(*ab), damp)[1])[:pairs]
    tabled = {ab: np.zeros((len(coarse[ab[0]]) + 1, len(coarse[ab[1]]) + 1)) for ab in ranked}
    for _ in range(cycles // 4):
        for a, b in ranked:
            step = rate * _pair_tree(*grid(a, b), damp)[0]
            tabled[a, b] += step
            total += step[low[a], low[b]]
    return Gam(intercept, cuts, tables, coarse, tabled)


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Gam:
    """Fit on the statistics of a bounded labelled sample; only these numbers reach the driver."""
    run = text_udf(lambda texts: pd.DataFrame({"x": list(statistics(texts))}), "x array<double>")
    sample = training_rows(docs, labels, "quality", rows)
    got = sample.select("doc_id", "label", run("text")["x"].alias("x")).distinct().toPandas().sort_values(["doc_id", "label"])
    x = np.array(got["x"].tolist(), dtype=float).reshape(len(got), len(FEATURES))
    return fit(x, got["label"].to_numpy(dtype=float))


def quality(text: Column, model: Gam, keep_from: float = KEEP_FROM) -> Column:
    """Struct of ``score`` and ``predicted``."""

    def work(texts: list[str]) -> pd.DataFrame:
        score = model.score(statistics(texts))
        return pd.DataFrame({"score": score, "predicted": (score >= keep_from).astype("int32")})

    return text_udf(work, "score double, predicted int")(text)


def keep_good(docs: DataFrame, model: Gam) -> DataFrame:
    """The rows whose text the model accepts, with their columns as they are."""
    scored = docs.select(F.struct("*").alias("row"), quality(F.col("text"), model).alias("quality"))
    return scored.where(F.col("quality.predicted") == 1).select("row.*")
