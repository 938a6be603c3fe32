"""Toxic spans and document scores: a linear-chain conditional random field over words.

The labels are per document, so words get theirs first: over the labelled sample, the words and word
beginnings that occur in far more surroundings in toxic documents than chance allows mark the words of
toxic documents. Surroundings are distinct pairs of neighbours, so copies of a document count once and
do not make its other words suspicious. A two-state chain (clean, toxic) is fitted on these labelled words, with features of the
word, its neighbours and its beginnings. Forward-backward marginals tag spans, and a small logistic
function of the strongest and the summed marginal gives a document's score.

The recursions run over all texts of a batch at once: a prefix product of 2 x 2 matrices per block of
words, then each block from its own start. A document's first word cuts the chain.

Defined results: NULL, empty and wordless texts have no spans and the score of an untagged text.
Without usable labels every score is the smoothed share of label 1. Equal texts get equal results;
other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, text_udf
from tidemark.llm.labelled import training_rows

TRAINING_ROWS = 3_000
TOXIC_FROM = 0.5
SPAN_FROM = 0.5
CHANCE = 1e-6

_word = re.compile(r"\w+")
_BLOCK = 512


def words_of(text: str) -> list[str]:
    """The words in lower case. Only U+0130 would fall apart if it were lower-cased first."""
    if "İ" in text:
        return [w.lower() for w in _word.findall(text)]
    return _word.findall(text.lower())


def word_features(word: str) -> list[str]:
    """The word and its beginnings of three to six characters."""
    return ["=" + word, *[word[:n] for n in range(3, min(6, len(word)) + 1)]]


class Crf(NamedTuple):
    """Weights of the toxic state by the word's features and by its neighbours, and the chain's."""

    own: dict[str, float]
    left: dict[str, float]  # of the word before
    right: dict[str, float]  # of the word after
    bias: float
    start: np.ndarray  # log weights of the first word's state
    step: np.ndarray  # log weights [from, to]
    final: np.ndarray  # intercept, strongest marginal's log odds, log of the summed marginal


# ---- chain recursions --------------------------------------------------------------------------


def _matrices(score: np.ndarray, first: np.ndarray, start: np.ndarray, step: np.ndarray) -> np.ndarray:
    """[word, from, to]: weights of stepping into each word; a first word forgets where it came from."""
    e = np.exp(np.clip(score, -30, 30))
    m = np.empty((len(score), 2, 2))
    s = np.exp(step)
    m[:, 0, 0], m[:, 1, 0], m[:, 0, 1], m[:, 1, 1] = s[0, 0], s[1, 0], s[0, 1] * e, s[1, 1] * e
    f = np.exp(start)
    m[first, :, 0] = f[0]
    m[first, :, 1] = f[1] * e[first, None]
    return m / m.max(axis=(1, 2), keepdims=True)


def forward_backward(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward and backward weights [word, state], each scaled to sum 1. ``m`` is not empty."""
    n = len(m)
    rows = -(-n // _BLOCK)
    blocks = np.empty((rows * _BLOCK, 2, 2))
    blocks[:n], blocks[n:] = m, np.eye(2)
    blocks = np.ascontiguousarray(blocks.reshape(rows, _BLOCK, 2, 2).transpose(1, 2, 3, 0))  # [place, from, to, block]
    product = np.broadcast_to(np.eye(2)[:, :, None], (2, 2, rows)).copy()
    for b in blocks:
        product = np.stack(
            [np.stack([product[i, 0] * b[0, j] + product[i, 1] * b[1, j] for j in (0, 1)]) for i in (0, 1)]
        )
        product /= product.max(axis=(0, 1))
    into, out = np.empty((2, rows)), np.empty((2, rows))
    a, z = np.array([0.5, 0.5]), np.array([0.5, 0.5])
    for r in range(rows):
        into[:, r] = a
        a = a @ product[:, :, r]
        a /= a.sum()
    for r in reversed(range(rows)):
        out[:, r] = z
        z = product[:, :, r] @ z
        z /= z.sum()
    forward, backward = np.empty((_BLOCK, 2, rows)), np.empty((_BLOCK, 2, rows))
    for i in range(_BLOCK):
        b = blocks[i]
        into = np.stack([into[0] * b[0, 0] + into[1] * b[1, 0], into[0] * b[0, 1] + into[1] * b[1, 1]])
        into /= into.sum(axis=0)
        forward[i] = into
    for i in reversed(range(_BLOCK)):
        backward[i] = out
        b = blocks[i]
        out = np.stack([b[0, 0] * out[0] + b[0, 1] * out[1], b[1, 0] * out[0] + b[1, 1] * out[1]])
        out /= out.sum(axis=0)
    return tuple(w.transpose(2, 0, 1).reshape(-1, 2)[:n] for w in (forward, backward))


def marginals(forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    """Probability of the toxic state per word."""
    both = forward * backward
    return both[:, 1] / both.sum(axis=1)


# ---- texts as arrays -----------------------------------------------------------------------------


class _Lookup(dict):
    """Numbers words as they come and keeps their three scores."""

    def __init__(self, model: Crf):
        super().__init__()
        self.model = model
        self.table = np.empty((3, 0))
        self.fresh: list[tuple[float, float, float]] = []

    def __missing__(self, word: str) -> int:
        own, model = self.model.own, self.model
        total = sum([own[f] for f in word_features(word) if f in own])
        self.fresh.append((total, model.left.get(word, 0.0), model.right.get(word, 0.0)))
        self[word] = at = len(self)
        return at

    def scores(self) -> np.ndarray:
        """[which, word]"""
        if self.fresh:
            self.table = np.concatenate([self.table, np.array(self.fresh).T], axis=1)
            self.fresh = []
        return self.table


def _scores(model: Crf, own: np.ndarray, left: np.ndarray, right: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Log odds of the toxic state from a word's features and its neighbours' within the document."""
    total = own + model.bias
    total[1:] += np.where(first[1:], 0, left[:-1])
    total[:-1] += np.where(first[1:], 0, right[1:])
    return total


def tag(texts: list[str], model: Crf) -> Iterator[np.ndarray]:
    """The toxic marginal of every word of each text."""
    lookup = _Lookup(model)
    for a, b in slices(texts):
        words = [words_of(t) for t in texts[a:b]]
        sizes = np.array([len(w) for w in words])
        if not sizes.sum():
            yield from (np.empty(0) for _ in words)
            continue
        at = np.concatenate([np.fromiter(map(lookup.__getitem__, w), np.int64, len(w)) for w in words])
        ends = np.cumsum(sizes)
        first = np.zeros(len(at), dtype=bool)
        first[(ends - sizes)[sizes > 0]] = True
        own, left, right = lookup.scores()[:, at]
        m = _matrices(_scores(model, own, left, right, first), first, model.start, model.step)
        yield from np.split(marginals(*forward_backward(m)), ends[:-1])


def _summary(p: np.ndarray) -> tuple[float, float]:
    """Log odds of the strongest marginal, and the log of one plus their sum."""
    if not len(p):
        return -12.0, 0.0
    top = float(np.clip(p.max(), 1e-6, 1 - 1e-6))
    return float(np.clip(np.log(top / (1 - top)), -12, 12)), float(np.log1p(p.sum()))


def document_score(p: np.ndarray, model: Crf) -> float:
    top, total = _summary(p)
    return float(1 / (1 + np.exp(-np.clip(model.final @ np.array([1.0, top, total]), -30, 30))))


def spans(text: str, p: np.ndarray) -> list[tuple[int, int]]:
    """Offsets (start, end) in code points of runs of words whose marginal is at least ``SPAN_FROM``."""
    found: list[tuple[int, int]] = []
    if not (p >= SPAN_FROM).any():
        return found
    # Lower-casing may change a text's length; offsets are those of the text as it is.
    places = [m.span() for m in _word.finditer(text)]
    joined = False
    for place, hit in zip(places, p >= SPAN_FROM, strict=True):
        if hit and joined:
            found[-1] = (found[-1][0], place[1])
        elif hit:
            found.append(place)
        joined = bool(hit)
    return found


# ---- training ------------------------------------------------------------------------------------


def marked_words(at: np.ndarray, first: np.ndarray, toxic: np.ndarray, features: tuple[np.ndarray, np.ndarray], words: int) -> np.ndarray:
    """Which words have a feature whose share of toxic surroundings chance does not explain.

    ``at`` numbers the words of all texts in a row, ``features`` pairs word numbers with feature
    numbers. The bound is that of Chernoff for a binomial share.
    """
    before, after = np.full(len(at), words), np.full(len(at), words)
    before[1:] = np.where(first[1:], words, at[:-1])
    after[:-1] = np.where(first[1:], words, at[1:])
    around, where = np.unique(before * (words + 1) + after, return_inverse=True)
    del before, after
    seen, marked = np.divmod(np.unique(2 * (at * len(around) + where) + toxic), 2)
    seen, marked = seen // len(around), marked > 0
    of_word, of_feature = features
    a, b = (np.bincount(of_feature, np.bincount(seen[rows], minlength=words)[of_word]) for rows in (marked, ~marked))
    n = np.maximum(a + b, 1)
    prior = float(np.clip(marked.mean(), 1e-6, 1 - 1e-6))
    share = np.clip(a / n, 1e-9, 1 - 1e-9)
    surprise = n * (share * np.log(share / prior) + (1 - share) * np.log((1 - share) / (1 - prior)))
    hit = (surprise > -np.log(CHANCE)) & (share > (1 + prior) / 2)
    return np.bincount(of_word, hit[of_feature], words) > 0


def _chain_weights(
    at: np.ndarray, first: np.ndarray, y: np.ndarray, features: tuple[np.ndarray, np.ndarray], n_own: int, n_words: int, rounds: int, rate: float
) -> list[np.ndarray]:
    """Weights of features, left and right neighbours, bias, start and steps, climbing the likelihood of ``y``."""
    of_word, of_feature = features
    inner = ~first[1:]
    prev, nxt = at[:-1][inner], at[1:][inner]
    cuts = np.cumsum([n_own, n_words, n_words, 1, 2])
    damp = np.repeat([0.1, 1.0, 0.1], [n_own, 2 * n_words, 7])  # neighbours count only if they say much
    theta, m1, m2 = (np.zeros(len(damp)) for _ in range(3))
    theta[cuts[2]] = np.log((y.sum() + 0.5) / (len(y) + 1))
    target_step = np.bincount(2 * y[:-1][inner] + y[1:][inner], minlength=4)
    target_start = np.bincount(y[first].astype(int), minlength=2)
    for t in range(1, rounds + 1):
        own, left, right, bias, start, step = np.split(theta, cuts)
        total = np.bincount(of_word, own[of_feature], n_words)[at] + bias
        total[1:][inner] += left[prev]
        total[:-1][inner] += right[nxt]
        m = _matrices(total, first, start, step.reshape(2, 2))
        f, b = forward_backward(m)
        p = marginals(f, b)
        joint = f[:-1, :, None] * m[1:] * b[1:, None, :]
        joint = joint[inner] / joint[inner].sum(axis=(1, 2), keepdims=True)
        off = y - p
        slope = np.concatenate(
            [
                np.bincount(of_feature, np.bincount(at, off, n_words)[of_word], n_own),
                np.bincount(prev, off[1:][inner], n_words),
                np.bincount(nxt, off[:-1][inner], n_words),
                [off.sum()],
                target_start - np.array([(1 - p[first]).sum(), p[first].sum()]),
                target_step - joint.sum(axis=0).reshape(4),
            ]
        )
        slope -= damp * theta
        m1, m2 = 0.9 * m1 + 0.1 * slope, 0.99 * m2 + 0.01 * slope * slope
        pace = rate * min(1, 2 * (1 - t / (rounds + 1)))
        theta += pace * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-8)
    return np.split(theta, cuts)


def fit(texts: list[str], labels: np.ndarray, rounds: int = 30, rate: float = 0.5) -> Crf:
    """Fit the chain on words of labelled texts, then the document score on the texts' labels.

    The chain sees every toxic text and as many others; the score sees all of them.
    """
    share = (labels.sum() + 0.5) / (len(labels) + 1) if len(labels) else 0.5
    untrained = Crf({}, {}, {}, -6.0, np.zeros(2), np.zeros((2, 2)), np.array([np.log(share / (1 - share)), 0, 0]))
    names: dict[str, int] = {}
    # Numbers, text by text: the words of all texts would take many times their memory.
    numbers = [np.array([names.setdefault(w, len(names)) for w in words_of(t)], dtype=np.int64) for t in texts]
    sizes = np.array([len(x) for x in numbers], dtype=np.int64)
    if not sizes.sum() or len(set(labels > 0)) < 2:
        return untrained
    at = np.concatenate(numbers)
    del numbers
    first = np.zeros(len(at), dtype=bool)
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    index: dict[str, int] = {}
    pairs = [(i, index.setdefault(f, len(index))) for w, i in names.items() for f in word_features(w)]
    of_word, of_feature = np.array(pairs).T
    toxic = np.repeat(labels > 0, sizes)
    y = marked_words(at, first, toxic, (of_word, of_feature), len(names))[at] & toxic
    if not y.any():
        return untrained
    every = max(1, int((labels <= 0).sum()) // max(1, int((labels > 0).sum())))
    chosen = (labels > 0) | (np.cumsum(labels <= 0) % every == 0)
    used = np.repeat(chosen, sizes)
    at, first, y = at[used], first[used], y[used]

    own, left, right, bias, start, step = _chain_weights(at, first, y, (of_word, of_feature), len(index), len(names), rounds, rate)
    del at, first, y, used, toxic

    def table(weights: np.ndarray, keys: dict[str, int]) -> dict[str, float]:
        return {k: float(weights[i]) for k, i in keys.items() if abs(weights[i]) >= 0.02}

    model = Crf(
        table(own, index), table(left, names), table(right, names), float(bias[0]), start, step.reshape(2, 2), np.zeros(3)
    )
    seen = np.array([_summary(p) for p in tag(texts, model)])
    return model._replace(final=_logistic(seen, labels > 0))


def _logistic(x: np.ndarray, y: np.ndarray, damp: float = 1.0) -> np.ndarray:
    """Damped Newton steps of a logistic regression with an intercept."""
    x = np.column_stack([np.ones(len(x)), x])
    w, ridge = np.zeros(x.shape[1]), damp * np.diag([1e-3] + [1.0] * (x.shape[1] - 1))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (y - p) - ridge @ w)
    return w


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Crf:
    """Fit on a bounded labelled sample; its texts are all that reaches the driver."""
    got = training_rows(docs, labels, "toxic", rows).distinct().toPandas().sort_values(["doc_id", "label"])
    return fit([t or "" for t in got["text"]], got["label"].to_numpy(dtype=float))


# ---- columns -------------------------------------------------------------------------------------


def toxicity(text: Column, model: Crf, toxic_from: float = TOXIC_FROM) -> Column:
    """Struct of ``score``, ``predicted`` and the offending ``spans`` (offsets in code points)."""

    def work(texts: list[str]) -> pd.DataFrame:
        rows = []
        for text, p in zip(texts, tag(texts, model), strict=True):
            score = document_score(p, model)
            found = [{"start": a, "end": b} for a, b in spans(text, p)]
            rows.append((score, int(score >= toxic_from), found))
        return pd.DataFrame(rows, columns=["score", "predicted", "spans"])

    return text_udf(work, "score double, predicted int, spans array<struct<start:int,end:int>>")(text)


def keep_clean(docs: DataFrame, model: Crf) -> DataFrame:
    """The rows whose text is not toxic, with their columns as they are."""
    scored = docs.select(F.struct("*").alias("row"), toxicity(F.col("text"), model).alias("toxicity"))
    return scored.where(F.col("toxicity.predicted") == 0).select("row.*")
