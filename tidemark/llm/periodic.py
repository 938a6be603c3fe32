"""Runs: stretches of words that repeat with a period, found through maximal pairs.

Two places of a text form a maximal pair when the same words follow both, other words follow those, and
other words stand before them. A pair at distance ``q`` that shares ``l`` words is the stretch of ``l + q``
words with period ``q`` that no neighbouring word extends, so nothing needs to be extended afterwards.

The suffixes of a text are sorted, and its LCP intervals are visited bottom-up. Each interval keeps its
places in order, together with the places at which the word to the left changes; when two children meet,
the smaller one asks the larger one for places within the allowed distance, and passes over those with the
same word to the left. What is visited is thus a pair that is reported, or leads to one. Of the pairs that
give the same stretch, the smallest distance is its period.

A run has at least ``MIN_LENGTH`` words and ``MIN_POWER`` periods. Both suffixes of such a pair share
at least ``MIN_SHARED`` words, so texts in which nothing of that length comes twice are left out before the
suffixes are sorted, and intervals of fewer words are never opened.

Defined results: a NULL or wordless text has no words and no runs, and collapses to the empty text. Each row
is treated alone, so ties, repeated rows and NULL ids change nothing. An empty table gives an empty one.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices

MIN_LENGTH = 24
MIN_POWER = 3
MIN_SHARED = -(-MIN_LENGTH * (MIN_POWER - 1) // MIN_POWER)
# The largest power of two within MIN_SHARED: what is looked for before suffixes are sorted.
_GRAM = 1 << (MIN_SHARED.bit_length() - 1)

Run = tuple[int, int, int]  # start, length, period


def words_of(text: str) -> list[bytes]:
    """Words between ASCII white space (blank, tab, line feed, vertical tab, form feed, return)."""
    return text.encode().split()


# ---- suffixes ------------------------------------------------------------------------------------


def _numbered(texts: Sequence[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as numbers, equal only within a text, and where each text starts.

    In front of every text and at the very end stands a number that occurs nowhere else.
    """
    numbers: dict[bytes, int] = {}
    known = numbers.setdefault
    fresh = count()
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    flat = np.fromiter((known(w, next(fresh)) for t in texts for w in t), dtype=np.int64, count=int(sizes.sum()))
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]) + 1
    owner = np.repeat(np.arange(len(texts)), sizes)
    ids = np.empty(len(flat) + len(texts) + 1, dtype=np.int64)
    at = np.arange(len(flat)) + owner + 1
    width = len(flat) + 1
    ids[at] = owner * width + flat
    walls = np.append(starts - 1, len(ids) - 1)
    ids[walls] = len(texts) * width + np.arange(len(walls))
    return np.unique(ids, return_inverse=True)[1].astype(np.int64), starts


def _repeated(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose next ``_GRAM`` words come twice at least within their text, ascending, and numbers
    that are equal where those words are."""
    rank, at, size, n = ids, np.arange(len(ids)), 1, len(ids)
    while len(at):
        key = rank[at] if size == 1 else rank[at] * n + rank[at + size // 2]
        _, same, times = np.unique(key, return_inverse=True, return_counts=True)
        keep = times[same] > 1
        if size == _GRAM:
            return at[keep], same[keep]
        rank = np.full(n, -1, dtype=np.int64)
        rank[at[keep]] = same[keep]
        at = at[keep]
        at = at[at + size < n]
        at = at[rank[at + size] >= 0]
        size *= 2
    return at, at


def _suffix_order(ids: np.ndarray) -> np.ndarray:
    """Suffixes of numbered texts in order, by doubling; only ties are sorted again."""
    n = len(ids)
    at, size = np.argsort(ids, kind="stable"), 0
    rank = np.empty(n, dtype=np.int64)
    key, old = ids[at], np.zeros(n, dtype=np.int64)
    while len(at):
        place = np.arange(len(at))
        first = np.append(True, key[1:] != key[:-1])
        opens = np.append(True, old[1:] != old[:-1])
        rank[at] = old + np.maximum.accumulate(np.where(first, place, 0)) - np.maximum.accumulate(np.where(opens, place, 0))
        alone = first & np.append(first[1:], True)
        at, size = at[~alone], max(1, 2 * size)
        key = rank[at] * (n + 1) + np.where(at + size < n, rank[np.minimum(at + size, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        old = rank[at]
    out = np.empty(n, dtype=np.int64)
    out[rank] = np.arange(n)
    return out


def _common(words: list[int], order: list[int], gram: list[int]) -> list[int]:
    """Words that each suffix of ``order`` shares with the one before; 0 where fewer than a gram."""
    before = dict(zip(order[1:], order, strict=False))
    shared: dict[int, int] = {}
    n, last = 0, -2
    for p in sorted(order):
        q = before.get(p)
        if q is None or gram[p] != gram[q]:
            n = 0
        else:
            n = max(n - 1, _GRAM) if p == last + 1 else _GRAM
            while words[p + n] == words[q + n]:
                n += 1
        shared[p], last = n, p
    return [shared[p] for p in order]


# ---- maximal pairs -------------------------------------------------------------------------------


class _Places:
    """Places of an interval in order, and those before which another word stands than before the last."""

    __slots__ = ("all", "turns")

    def __init__(self, place: int):
        self.all, self.turns = [place], [place]

    def unlike(self, low: int, high: int, word: int, left: list[int]) -> Iterator[int]:
        """Places from ``low`` to ``high`` whose left word is not ``word``."""
        places, turns = self.all, self.turns
        i = bisect_left(places, low)
        while i < len(places) and places[i] <= high:
            p = places[i]
            if left[p - 1] != word:
                yield p
                i += 1
            else:
                k = bisect_right(turns, p)
                if k == len(turns):
                    return
                i = bisect_left(places, turns[k], i)

    def add(self, p: int, left: list[int]) -> None:
        places, turns = self.all, self.turns
        i = bisect_left(places, p)
        word = left[p - 1]
        ahead = left[places[i - 1] - 1] if i else None
        if i < len(places):
            after = places[i]
            was, now = ahead is None or left[after - 1] != ahead, left[after - 1] != word
            if now and not was:
                insort(turns, after)
            elif was and not now:
                del turns[bisect_left(turns, after)]
        if ahead is None or ahead != word:
            insort(turns, p)
        places.insert(i, p)


def _met(a: _Places, b: _Places, depth: int, words: list[int], found: dict[tuple[int, int], int]) -> _Places:
    """Two children of an interval of ``depth`` words become one; their maximal pairs go to ``found``."""
    small, large = (a, b) if len(a.all) <= len(b.all) else (b, a)
    near, far = max(1, MIN_LENGTH - depth), depth // (MIN_POWER - 1)
    if near <= far:
        for p in small.all:
            word = words[p - 1]
            for low, high in ((p - far, p - near), (p + near, p + far)):
                for other in large.unlike(low, high, word, words):
                    first, period = (other, p - other) if other < p else (p, other - p)
                    stretch = (first, first + period + depth)
                    if period < found.get(stretch, 1 << 62):
                        found[stretch] = period
    for p in small.all:
        large.add(p, words)
    return large


def _pairs(words: list[int], order: list[int], shared: list[int]) -> dict[tuple[int, int], int]:
    """(start, end) of every run and its period, from sorted suffixes and what neighbours share."""
    found: dict[tuple[int, int], int] = {}
    open_at: list[int] = []
    inside: list[_Places] = []
    leaf = None
    for p, depth in zip([*order, -1], [*shared, 0], strict=True):
        if leaf is not None:
            while open_at and open_at[-1] > depth:
                leaf = _met(inside.pop(), leaf, open_at.pop(), words, found)
            if depth == 0:
                pass
            elif open_at and open_at[-1] == depth:
                inside[-1] = _met(inside[-1], leaf, depth, words, found)
            else:
                open_at.append(depth)
                inside.append(leaf)
        leaf = _Places(p)
    return found


def runs_of(texts: Sequence[list[bytes]]) -> list[list[Run]]:
    """The runs of every text, by start and period."""
    out: list[list[Run]] = [[] for _ in texts]
    ids, starts = _numbered(texts)
    hits, _ = _repeated(ids)
    if not len(hits):
        return out
    chosen = np.unique(np.searchsorted(starts, hits, side="right") - 1)
    ids, starts = _numbered([texts[i] for i in chosen])
    hits, same = _repeated(ids)
    gram = np.full(len(ids), -1, dtype=np.int64)
    gram[hits] = same
    order = _suffix_order(ids)
    order = order[gram[order] >= 0]
    words, places = ids.tolist(), order.tolist()
    found = _pairs(words, places, _common(words, places, gram.tolist()))
    for (start, end), period in found.items():
        i = int(np.searchsorted(starts, start, side="right")) - 1
        out[chosen[i]].append((start - int(starts[i]), end - start, period))
    for runs in out:
        runs.sort(key=lambda r: (r[0], r[2]))
    return out


# ---- columns -------------------------------------------------------------------------------------


def strongest(runs: list[Run]) -> int | None:
    """Place of the run with most periods; ties go to the smaller start, then the smaller period."""
    best = None
    for i, (_, length, period) in enumerate(runs):
        if best is None or length * runs[best][2] > runs[best][1] * period:
            best = i
    return best


def collapsed(words: list[bytes], runs: list[Run]) -> str:
    """The words without what a run repeats: of each run its first period stays."""
    if runs:
        gone = np.zeros(len(words), dtype=bool)
        for start, length, period in runs:
            gone[start + period : start + length] = True
        words = [w for w, x in zip(words, gone.tolist(), strict=True) if not x]
    return b" ".join(words).decode()


def looped(words: list[bytes], turn: int) -> list[bytes]:
    """The words with a stretch to their end made periodic, as ``turn`` says; for tests of detection."""
    n, g = len(words), turn // 10
    if turn % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * -(-(n - a) // p))[: n - a]


def scan(text: Column, turn: Column | None = None) -> Column:
    """A struct of n_words, runs (start, length, period), strongest (place in ``runs``, or NULL), collapsed.

    With ``turn``, a number per row, the words go through ``looped`` before.
    """

    def work(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, turns in batches:
            done = []
            all_texts, all_turns = texts.tolist(), turns.tolist()
            for a, b in slices(all_texts):
                words = [words_of(t) if isinstance(t, str) else [] for t in all_texts[a:b]]
                words = [looped(w, int(t)) for w, t in zip(words, all_turns[a:b], strict=True)]
                done += [
                    (len(w), [r[0] for r in runs], [r[1] for r in runs], [r[2] for r in runs], strongest(runs), collapsed(w, runs))
                    for w, runs in zip(words, runs_of(words), strict=True)
                ]
            out = pd.DataFrame(done, columns=["n_words", "start", "length", "period", "strongest", "collapsed"])
            out["strongest"] = out["strongest"].astype("Int32")
            yield out

    work.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.DataFrame]}
    schema = "n_words long, start array<long>, length array<long>, period array<long>, strongest int, collapsed string"
    return F.pandas_udf(work, schema).asNondeterministic()(text, F.coalesce(turn if turn is not None else F.lit(None), F.lit(1)).cast("long"))


def periodic_runs(docs: DataFrame, turn: Column | None = None) -> DataFrame:
    """doc_id, n_words, runs, best (the strongest run or NULL) and collapsed text of every document."""
    found = docs.select("doc_id", scan(F.col("text"), turn).alias("_found"))
    runs = F.arrays_zip("_found.start", "_found.length", "_found.period")
    return found.select("doc_id", "_found.n_words", runs.alias("runs"), F.get("runs", F.col("_found.strongest")).alias("best"), "_found.collapsed")
