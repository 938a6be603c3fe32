"""Suffix sorting in two stages, and what neighbours in the order share.

A suffix is *rising* if it is smaller than its successor, the suffix one byte later. Only rising suffixes are
sorted directly, by their leading bytes, eight at a time, and only ties go on. All others are induced: within
the bucket of a first byte they come before the rising ones, and in the order of their successors, so one scan
over the buckets from small to large puts each of them in its place. The scan takes a bucket at a time: the
suffixes that a bucket induces go to the ends of the other buckets' falling parts, and those with the same
first byte to its own, wave by wave.

The order is exact in the first ``depth`` bytes (a multiple of eight); suffixes that share them stand
together in any order. The end of the text counts as smaller than any byte.
"""

from __future__ import annotations

import numpy as np

_BYTES = 256


def _words(text: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes at every place as one number; zeros follow the end."""
    wide = np.concatenate([text, np.zeros(depth + 8, dtype=np.uint8)]).astype(np.uint64)
    for size in (1, 2, 4):
        wide = (wide[:-size] << np.uint64(8 * size)) | wide[size:]
    return wide


def _rising(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor."""
    change = np.flatnonzero(text[1:] != text[:-1])
    grows = np.append(text[change + 1] > text[change], False)  # the last stretch of a byte is falling
    return np.repeat(grows, np.diff(np.concatenate([[-1], change, [len(text) - 1]])))


def _by_two(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Order by group, then key. Sorting plain numbers twice is faster than by two columns."""
    order = np.argsort(key)
    key = key[order]
    rank = np.empty(len(key), dtype=np.int64)
    rank[order] = np.cumsum(np.append(False, key[1:] != key[:-1]))
    return np.argsort(group * np.int64(len(key) + 1) + rank)


def _direct(places: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """``places`` sorted by the ``depth`` bytes from there on."""
    key = words[places]
    order = np.argsort(key)
    places, key = places[order], key[order]
    same = np.append(False, key[1:] == key[:-1])
    at = np.flatnonzero(same | np.append(same[1:], False))  # where ties stand
    group = np.cumsum(~same)[at]
    for reach in range(8, depth, 8):
        if not len(at):
            break
        mine = places[at]
        key = words[mine + reach]
        first = np.append(True, group[1:] != group[:-1])
        differs = ~first & np.append(False, key[1:] != key[:-1])
        if not differs.any():
            continue
        # Groups in which all go on alike keep their order.
        number = np.cumsum(first) - 1
        mixed = np.zeros(number[-1] + 1, dtype=bool)
        mixed[number[differs]] = True
        todo = np.flatnonzero(mixed[number])
        order = _by_two(number[todo], key[todo])
        mine[todo], key[todo] = mine[todo][order], key[todo][order]
        places[at] = mine
        same = np.append(False, (group[1:] == group[:-1]) & (key[1:] == key[:-1]))
        tied = same | np.append(same[1:], False)
        at, group = at[tied], np.cumsum(~same)[tied]
    return places


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """The places of a byte array, sorted by the ``depth`` bytes that follow."""
    n = len(text)
    if not n:
        return np.empty(0, dtype=np.int64)
    words, rising = _words(text, depth), _rising(text)
    sizes = np.bincount(text, minlength=_BYTES)
    heads = np.cumsum(sizes) - sizes
    direct = _direct(np.flatnonzero(rising), words, depth)
    risen = np.bincount(text[direct], minlength=_BYTES)
    out = np.empty(n, dtype=np.int64)
    start = np.repeat(heads + sizes - risen, risen)  # rising suffixes end their bucket
    out[start + np.arange(len(direct)) - np.repeat(np.cumsum(risen) - risen, risen)] = direct

    ends = heads.copy()  # of the falling suffixes that are in their place

    def induce(scanned: np.ndarray, byte: int, own: bool) -> None:
        """Put the falling suffixes before ``scanned`` behind those of their bucket."""
        before = scanned[scanned > 0] - 1
        first = text[before]
        before = before[(first == byte) if own else (first > byte)]
        first = text[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        count = np.bincount(first, minlength=_BYTES)
        skipped = np.cumsum(count) - count
        out[ends[first] + np.arange(len(before)) - skipped[first]] = before
        ends[:] += count

    out[ends[text[-1]]] = n - 1  # its successor, the empty suffix, comes before all
    ends[text[-1]] += 1
    for byte in np.flatnonzero(sizes):
        done = heads[byte]
        while done < ends[byte]:  # falling suffixes whose successor has the same first byte
            wave = out[done : ends[byte]]
            done = ends[byte]
            induce(wave, byte, own=True)
        induce(out[heads[byte] : heads[byte] + sizes[byte]], byte, own=False)
    return out


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Bytes that each suffix of ``order`` shares with the one before, ``depth`` at most; the first has 0."""
    words = _words(text, depth)
    shared = np.zeros(len(order), dtype=np.int64)
    at = np.arange(1, len(order))
    for reach in range(0, depth, 8):
        if not len(at):
            break
        first, second = order[at - 1], order[at]
        odd = words[first + reach] ^ words[second + reach]
        ended = odd != 0
        equal = (odd[ended].byteswap().view(np.uint8).reshape(-1, 8) != 0).argmax(axis=1)
        shared[at[ended]] = reach + equal
        at = at[~ended]
    shared[at] = depth
    left = len(text) - order
    shared[1:] = np.minimum(shared[1:], np.minimum(left[1:], left[:-1]))
    return shared
