"""Removal of repeated passages: every byte covered by a string of ``LENGTH`` bytes that starts elsewhere too.

Only strings that may repeat are sorted. Every window of ``LENGTH`` bytes has an anchor: of its runs of ``GRAM``
bytes the one with the least hash, the leftmost if several. Equal windows have equal anchors in the same
place, so a window whose anchor's bytes occur nowhere else cannot repeat. Windows in a row that share an
anchor form a region of text, from the first window's start to the last one's end; each window lies in
exactly one region.

1. Anchors are counted over all documents, added up in each task first; hashes alone are shuffled.
2. Regions with an anchor that occurs again are kept as hashes of 64 bits for the anchor and 64 for the bytes.
   Of regions with the same two hashes one stands for all, with their number.
3. Texts meet the regions that stand in them, once for each distinct text, and the regions' bytes are dealt
   out by anchor into groups of bounded size. A group's bytes are one array, sorted by ``suffix_sort``:
   windows with ``LENGTH`` common bytes to a neighbour repeat.
4. What repeats is told to all regions with the same hashes, and by them to their texts.

An anchor with very many distinct regions is split over several groups. Each of them then tells the distinct
windows it saw, by hash, and those that several groups saw repeat in all.

Defined results: a NULL text is empty. A text shorter than ``LENGTH`` loses nothing. Strings are judged on the
input: of equal passages none stays, not in repeated rows either. Rows with equal texts have equal results,
whatever their ids. Matches neither cross documents nor depend on character borders; ``kept`` is bytes.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import settle, slices
from tidemark.llm.suffix_sort import common_prefixes, suffix_order

LENGTH = 200
GRAM = 48
GROUP_BYTES = 400_000  # of regions sorted together, on average: sorting is fastest within the processor's cache
GROUP_REGIONS = 1_024  # of one anchor in a group, at most some more

_SEGMENT = 1 << 17  # windows are looked for so many bytes at a time
_PLACE_BITS = 24

_BASE = 0x9E3779B97F4A7C15
_SEED = 11


def _mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of polynomial hashes evenly."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xA0761D6478BD642F)
    return h ^ (h >> np.uint64(32))


class _Hashes:
    """Hashes of any stretch of a byte array from sums of byte values times powers, modulo 2^64."""

    _values = np.random.default_rng(_SEED).integers(1, 1 << 63, 256).astype(np.uint64)
    _powers = _inverses = np.empty(0, dtype=np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data) + 1
        if len(self._powers) < n:
            size = max(n, _SEGMENT + LENGTH + 1)
            for name, base in (("_powers", _BASE), ("_inverses", pow(_BASE, -1, 1 << 64))):
                table = np.full(size, base, dtype=np.uint64)
                table[0] = 1
                setattr(_Hashes, name, np.cumprod(table, dtype=np.uint64))
        self.sums = np.zeros(n, dtype=np.uint64)
        np.cumsum(self._values[data] * self._powers[: n - 1], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.sums[end] - self.sums[start]) * self._inverses[start]
        return _mixed(h + (end - start).astype(np.uint64))

    def runs(self, size: int) -> np.ndarray:
        """Of every run of ``size`` bytes."""
        n = len(self.sums) - size
        return _mixed((self.sums[size:] - self.sums[:n]) * self._inverses[:n] + np.uint64(size))


def _least(values: np.ndarray, n: int) -> np.ndarray:
    """The smallest of every ``n`` neighbours, by doubling."""
    size = 1
    while 2 * size <= n:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (n - size)], values[n - size :]) if n > size else values


class Regions:
    """Regions of a batch of texts: text number, first window's start, number of windows, hashes."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        ends = np.cumsum([len(t) for t in texts])
        parts = [self._segment(data, i, ends) for i in range(0, max(0, len(data) - LENGTH + 1), _SEGMENT)]
        empty = np.empty(0, dtype=np.int64)
        owner, start, windows, anchor, body = map(np.concatenate, zip(*parts, strict=True)) if parts else [empty] * 5
        self.owner, self.windows = owner, windows
        self.start = start - np.append(0, ends)[owner] if len(owner) else start
        # As Spark's longs.
        self.anchor, self.body = anchor.astype(np.uint64).view(np.int64), body.astype(np.uint64).view(np.int64)

    @staticmethod
    def _segment(data: np.ndarray, base: int, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        hashes = _Hashes(data[base : base + _SEGMENT + LENGTH - 1])
        runs = hashes.runs(GRAM)
        place = np.arange(len(runs), dtype=np.uint64)
        low = np.uint64((1 << _PLACE_BITS) - 1)
        least = _least((runs & ~low) | place, LENGTH - GRAM + 1) & low
        # Windows that leave their text come last in it, so a region ends at the next one or there.
        n = len(least)
        cut = ends[np.searchsorted(ends, base, side="right") :] - base  # where texts end from here on
        cut = cut[: np.searchsorted(cut, n + LENGTH)]
        new = np.append(True, least[1:] != least[:-1])
        new[cut[cut < n]] = True
        leaving = np.zeros(n + 1, dtype=np.int32)
        np.add.at(leaving, np.clip(cut - LENGTH + 1, 0, n), 1)
        np.add.at(leaving, np.minimum(cut, n), -1)
        whole = np.cumsum(leaving[:n]) == 0
        begin = np.flatnonzero(new)
        first = begin[whole[begin]]
        stop = np.append(begin, n)
        last = stop[np.searchsorted(stop, first, side="right")]
        owner = np.searchsorted(ends, first + base, side="right")
        last = np.minimum(last, ends[owner] - base - LENGTH + 1)
        return owner, first + base, last - first, runs[least[first].astype(np.int64)], hashes.of(first, last + LENGTH - 1)


def _batches(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[bytes], Regions]]:
    for batch in batches:
        texts = batch["text"].tolist()
        for a, b in slices(texts):
            raw = [t.encode() for t in texts[a:b]]
            yield batch.iloc[a:b], raw, Regions(raw)


# ---- anchors and regions -------------------------------------------------------------------------


def _anchor_counts(texts: DataFrame) -> DataFrame:
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, _, found in _batches(batches):
            anchor, n = np.unique(found.anchor, return_counts=True)
            yield pd.DataFrame({"anchor": anchor, "n": n})

    return texts.select("text").mapInPandas(work, "anchor long, n long")


def _regions(texts: DataFrame) -> DataFrame:
    """(key, anchor, body, windows, start, more) of every distinct region of a text: where it starts first,
    and its further starts, NULL if there is none."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, _, found in _batches(batches):
            order = np.lexsort((found.start, found.body, found.anchor, found.owner))
            owner, anchor, body = found.owner[order], found.anchor[order], found.body[order]
            new = (owner[1:] != owner[:-1]) | (anchor[1:] != anchor[:-1]) | (body[1:] != body[:-1])
            first = np.flatnonzero(np.append(True, new)) if len(order) else order
            out = pd.DataFrame({"key": batch["key"].to_numpy()[owner[first]], "anchor": anchor[first], "body": body[first], "windows": found.windows[order][first]})
            start = found.start[order]
            times = np.diff(np.append(first, len(order)))
            more = np.full(len(first), None, dtype=object)
            for i in np.flatnonzero(times > 1):
                more[i] = start[first[i] + 1 : first[i] + times[i]]
            out["start"], out["more"] = start[first], more
            yield out

    return texts.select("key", "text").mapInPandas(work, "key binary, anchor long, body long, windows int, start int, more array<int>")


def _beside_texts(texts: DataFrame, lists: DataFrame, schema: str) -> DataFrame:
    """One row (key, raw, notes) for each distinct text, as bytes, that has rows in ``lists`` (key, note).

    Copies of a text are one row before the shuffle already."""
    both = texts.select("key", F.col("text").cast("binary").alias("raw"), F.lit(None).cast(schema).alias("note"))
    both = both.unionByName(lists.select("key", F.lit(None).cast("binary").alias("raw"), "note"))
    met = both.groupBy("key").agg(F.first("raw", ignorenulls=True).alias("raw"), F.collect_list("note").alias("notes"))
    return met.where(F.size("notes") > 0)


def _with_bytes(texts: DataFrame, chosen: DataFrame) -> DataFrame:
    """``chosen`` regions (key, start, windows, ...) with their bytes."""
    told = ["anchor", "body", "copies", "part"]
    note = "struct<anchor:long,body:long,copies:long,part:int,start:int,windows:int>"
    lists = chosen.select("key", F.struct(*told, "start", "windows").alias("note"))
    cut = F.transform(
        "notes", lambda n: F.struct(*[n[c].alias(c) for c in told], F.substring("raw", n["start"] + 1, n["windows"] + LENGTH - 1).alias("bytes"))
    )
    return _beside_texts(texts, lists, note).select(F.inline(cut))


# ---- groups --------------------------------------------------------------------------------------


def repeated_windows(regions: list[bytes], copies: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each window of the regions: its region, its start there, whether its bytes come twice, and a number
    that equal windows share.

    ``copies`` says how often each region occurs."""
    sizes = np.array([len(r) for r in regions], dtype=np.int64)
    data = np.frombuffer(b"".join(regions), dtype=np.uint8)
    begin = np.cumsum(sizes) - sizes
    order = suffix_order(data, LENGTH)
    like = np.cumsum(common_prefixes(data, order, LENGTH) < LENGTH)
    owner = np.repeat(np.arange(len(regions)), sizes)[order]
    start = order - begin[owner]
    whole = start + LENGTH <= sizes[owner]
    like, owner, start = like[whole], owner[whole], start[whole]
    seen = np.bincount(like, weights=copies[owner]) if len(like) else np.empty(0)
    return owner, start, seen[like] > 1, like


def _stretches(owner: np.ndarray, start: np.ndarray) -> pd.DataFrame:
    """Windows as (region, first start, stop) of stretches without gaps."""
    order = np.lexsort((start, owner))
    owner, start = owner[order], start[order]
    first = np.append(True, (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)) if len(order) else order.astype(bool)
    last = np.append(first[1:], True) if len(order) else first
    return pd.DataFrame({"region": owner[first], "low": start[first], "high": start[last] + 1})


def _sort_group(group: pd.DataFrame) -> pd.DataFrame:
    """What repeats in a group's regions: rows (anchor, body, low, high), ``seen`` NULL.

    Regions of split anchors (part >= 0) also tell their windows, one of each kind that repeats here: rows with
    the window's hash in ``seen``, its place in ``low`` and whether it repeats here in ``high``."""
    regions = group["bytes"].tolist()
    owner, start, twice, like = repeated_windows(regions, group["copies"].to_numpy())
    out = _stretches(owner[twice], start[twice])
    out["seen"] = pd.array([pd.NA] * len(out), dtype="Int64")
    split = np.flatnonzero(group["part"].to_numpy() >= 0)
    if len(split):
        told = ~twice
        told[np.unique(like, return_index=True)[1]] = True
        told &= np.isin(owner, split)
        owner, start, twice = owner[told], start[told], twice[told]
        sizes = np.array([len(r) for r in regions])
        at = (np.cumsum(sizes) - sizes)[owner] + start
        hashes = _Hashes(np.frombuffer(b"".join(regions), dtype=np.uint8))
        more = pd.DataFrame({"region": owner, "low": start, "high": twice.astype(int)})
        more["seen"] = pd.array(hashes.of(at, at + LENGTH).view(np.int64), dtype="Int64")
        out = pd.concat([out, more], ignore_index=True)
    for name in ("anchor", "body"):
        out[name] = group[name].to_numpy()[out["region"].to_numpy(np.int64)]
    return out[["anchor", "body", "low", "high", "seen"]]


def _repeats(regions: DataFrame) -> DataFrame:
    """(anchor, body, low, high): stretches of windows that repeat, of regions with bytes."""
    size = regions.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    groups = max(1, -(-size // GROUP_BYTES))
    dealt = regions.withColumn("_group", F.pmod(F.xxhash64("anchor", "part"), F.lit(groups)))
    told = dealt.groupBy("_group").applyInPandas(lambda g: _sort_group(g), "anchor long, body long, low int, high int, seen long")
    told = settle(told, "sorted")
    inside = told.where("seen IS NULL").drop("seen")
    # Windows of split anchors that do not repeat in their group, but stand or repeat in another.
    windows = told.where("seen IS NOT NULL")
    often = windows.groupBy("anchor", "seen").agg(F.count("*").alias("n"), F.max("high").alias("here")).where("n > 1 OR here = 1")
    across = windows.where("high = 0").join(often.select("anchor", "seen"), ["anchor", "seen"])
    return inside.unionByName(across.select("anchor", "body", "low", (F.col("low") + 1).alias("high")))


# ---- documents -----------------------------------------------------------------------------------


def _cut(texts: DataFrame, lists: DataFrame) -> DataFrame:
    """(key, n_removed, n_spans, kept) of the texts that lose something."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, raw, notes in zip(batch["key"], batch["raw"], batch["notes"], strict=True):
                spans = merged(notes)
                kept, at = [], 0
                for low, high in spans:
                    kept.append(raw[at:low])
                    at = high
                out.append((key, sum(b - a for a, b in spans), len(spans), b"".join([*kept, raw[at:]])))
            yield pd.DataFrame(out, columns=["key", "n_removed", "n_spans", "kept"])

    note = "struct<start:int,more:array<int>,low:int,high:int>"
    return _beside_texts(texts, lists.select("key", F.struct("start", "more", "low", "high").alias("note")), note).mapInPandas(work, "key binary, n_removed long, n_spans long, kept binary")


def merged(notes) -> list[tuple[int, int]]:
    """Stretches of windows (a region's starts, low, high) as spans of bytes, joined where they meet."""
    spans: list[tuple[int, int]] = []
    starts = lambda x: [x["start"], *(x["more"] if x["more"] is not None else ())]
    windows = [(at + x["low"], at + x["high"] + LENGTH - 1) for x in notes for at in starts(x)]
    for low, high in sorted(windows):
        if spans and low <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(high, spans[-1][1]))
        else:
            spans.append((low, high))
    return spans


def text_key(text: Column) -> Column:
    return F.substring(F.unhex(F.sha2(text, 256)), 1, 16)


def remove_repeats(docs: DataFrame, digest: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, and ``kept``, the remaining bytes (or, with ``digest``,
    ``kept_sha256``, which spares a join with the texts for documents that lose nothing)."""
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = texts.select(text_key(F.col("text")).alias("key"), "text").where(F.octet_length("text") >= LENGTH)

    again = settle(_anchor_counts(keyed).groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"), "anchors")
    regions = settle(_regions(keyed).join(again, "anchor", "left_semi"), "regions")

    first = F.min(F.struct("key", "start", "windows")).alias("first")
    copies = F.sum(F.coalesce(F.array_size("more"), F.lit(0)) + 1).alias("copies")
    bodies = settle(regions.groupBy("anchor", "body").agg(copies, first), "bodies")
    crowded = bodies.groupBy("anchor").agg(F.count("*").alias("m")).where(F.col("m") > GROUP_REGIONS)
    parts = F.ceil(F.col("m") / GROUP_REGIONS)
    part = F.coalesce(F.pmod(F.col("body"), parts), F.lit(-1)).cast("int").alias("part")
    chosen = bodies.join(crowded, "anchor", "left").select("anchor", "body", "copies", "first.*", part)
    sorted_out = _repeats(settle(_with_bytes(keyed, chosen), "region-bytes"))

    cut = _cut(keyed, regions.join(sorted_out, ["anchor", "body"]))
    if digest:
        cut = cut.select("key", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
    cut = settle(cut, "cut")
    rows = texts.withColumns({"_sha": F.sha2("text", 256), "n_bytes": F.octet_length("text").cast("long")})
    rows = rows.withColumn("key", F.substring(F.unhex("_sha"), 1, 16))
    whole = {"kept_sha256": "_sha"} if digest else {"kept": F.encode("text", "utf-8")}
    rows = rows.select("doc_id", "key", "n_bytes", *[F.col(c).alias("_whole") if isinstance(c, str) else c.alias("_whole") for c in whole.values()])
    name = next(iter(whole))
    return rows.join(cut, "key", "left").select(
        "doc_id",
        "n_bytes",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_removed", "n_spans")],
        F.coalesce(name, "_whole").alias(name),
    )
