"""BPE encoding by dynamic programming over prefixes, and decoding.

A token sequence is the BPE encoding of its text exactly if every token encodes to itself and every
neighbouring pair encodes to that pair. So each prefix of a word has one last token: the only one
that ends there, whose start is an encoded prefix, and that is compatible with that prefix's last
token. An automaton over the vocabulary finds the tokens that end at each place; one pass stores the
last token of every prefix; following them back from the end gives the ids. Work grows linearly with
a word's length, also for words of 100 000 characters.

Defined results: a NULL or empty text has no ids; ids outside the vocabulary are left out by
``decode``. Rows are independent of each other, so ties and repeated rows need no rule, and other
columns pass through.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import text_udf, vocabulary

END = "\0"  # stands for the end-of-word suffix; the byte alphabet does not contain it
CACHED_WORDS = 200_000
CACHED_CHARS = 64  # longer strings are worked out each time, so that a cache is bounded in characters too
CACHED_PAIRS = 400_000

# Below this code point all tables of letters agree.
_SETTLED = "\u0250"
_PLANES = (0, 1, 2, 3, 14)  # the others have no letters

# Bytes that stand for themselves in a byte-level vocabulary; the others follow from 256.
PLAIN_BYTES = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]


def byte_alphabet() -> dict[int, str]:
    """The printable character that a byte-level vocabulary uses for each byte."""
    other = [b for b in range(256) if b not in set(PLAIN_BYTES)]
    return {b: chr(b) for b in PLAIN_BYTES} | {b: chr(256 + i) for i, b in enumerate(other)}


class Recent(dict):
    """Ids of strings, worked out when first asked for. What was not used for a while goes, and long
    strings are not kept."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, text: str) -> tuple[int, ...]:
        if len(text) > CACHED_CHARS:
            return self.encode(text)
        if len(self) >= CACHED_WORDS:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(text)
        self[text] = ids = self.encode(text) if ids is None else ids
        return ids


class WordBpe:
    """Encoder and decoder of a vocabulary whose words end in a suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        self.inner = {t.replace(suffix, END): i for t, i in model["vocab"].items()}
        self.shown = {i: t for t, i in model["vocab"].items()}
        self.shown |= {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.symbols = {i: t for t, i in self.inner.items()}
        self.merges = {}
        for rank, (a, b) in enumerate(model["merges"]):
            left, right = self.inner[a.replace(suffix, END)], self.inner[b.replace(suffix, END)]
            self.merges[left, right] = (rank, self.inner[(a + b).replace(suffix, END)])
        self.bytes = byte_alphabet()
        self.matcher = ahocorasick.Automaton()
        # Rank and halves of the merge that completes each token; rank -1 for a single symbol.
        self.made = {}
        for token, i in self.inner.items():
            if self.merged(token, steps := [(-1, i, i)]) == [i]:  # else no text ever gives it
                self.matcher.add_word(token, (i, len(token)))
            self.made[i] = steps[-1]
        self.matcher.make_automaton()
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.matches = regex.compile(pattern).findall
        self.splitter = Tokenizer.from_file(path).pre_tokenizer
        self.disputed: frozenset[str] | None = None
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split
        self.normalizer = Tokenizer.from_file(path).normalizer
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words = Recent(lambda w: tuple(self.encode_word(w)))
        self.chunks = Recent(lambda c: tuple(chain.from_iterable(map(self.words.__getitem__, self.pieces(c)))))

    def split(self, chunk: str) -> list[str]:
        """A chunk's pieces as the vocabulary file's own splitter gives them."""
        return [chunk[a:b] for _, (a, b) in self.splitter.pre_tokenize_str(chunk)]

    def pieces(self, chunk: str) -> list[str]:
        """The same by the pattern, which is faster, but knows letters by tables of another age: a chunk with
        a character on which the two differ goes to the splitter. Which those are is found when the first
        character beyond the settled ones comes."""
        if chunk.isascii() or max(chunk) < _SETTLED:
            return self.matches(chunk)
        if self.disputed is None:
            self.disputed = self._disputed()
        return self.matches(chunk) if self.disputed.isdisjoint(chunk) else self.split(chunk)

    def _disputed(self) -> frozenset[str]:
        found: set[str] = set()
        for plane in _PLANES:
            # A letter joins the one before it, a symbol the one after it, a number neither.
            codes = [c for c in range(plane << 16, (plane + 1) << 16) if not 0xD800 <= c < 0xE000]
            probes = [f"a{chr(c)}!" for c in codes]
            text = " ".join(probes)
            starts = np.cumsum([0, *[len(p) + 1 for p in probes[:-1]]])
            cuts = [{a for _, (a, _) in self.splitter.pre_tokenize_str(text)}, {m.start() for m in self.matches.__self__.finditer(text)}]
            differ = np.array(sorted(cuts[0] ^ cuts[1]), dtype=np.int64)
            found.update(chr(codes[i]) for i in np.searchsorted(starts, differ, side="right") - 1)
        return frozenset(found)

    def merged(self, symbols: str, steps: list | None = None) -> list[int]:
        """BPE by its definition: apply the lowest merge, leftmost first, until none applies."""
        ids = [self.inner[s] for s in re.findall(f".{END}?", symbols, re.DOTALL)]
        while len(ids) > 1:
            found = [(self.merges[p], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.merges]
            if not found:
                break
            (rank, new), i = min(found)
            if steps is not None:
                steps.append((rank, ids[i], ids[i + 1]))
            ids[i : i + 2] = [new]
        return ids

    def compatible(self, left: int, right: int) -> bool:
        """Whether the two tokens side by side stay as they are.

        Undo both tokens' merges from the latest back. Two symbols that meet at the border stay
        there until one of them is merged inside its own token (``until``); they join across the
        border if their merge comes earlier, or is the same one and stands further left.
        """
        x, y, until, made = left, right, len(self.merges), self.made
        while True:
            across = self.merges.get((x, y))
            if across is not None and across[0] < until:
                return False
            x_at, _, x_half = made[x]
            y_at, y_half, _ = made[y]
            if x_at < 0 and y_at < 0:
                return True
            if x_at > y_at:
                x, until = x_half, x_at
            else:
                y, until = y_half, y_at + 1

    def encode_word(self, word: str) -> list[int]:
        text = "".join(map(self.bytes.__getitem__, word.encode())) + END
        last = [-1] * (len(text) + 1)
        start = [0] * (len(text) + 1)
        pairs = self.pairs
        for end, (token, n) in self.matcher.iter(text):
            end += 1
            if last[end] >= 0:
                continue
            if n < end:
                before = last[end - n]
                if before < 0:
                    continue
                fits = pairs.get((before, token))
                if fits is None:
                    if len(pairs) >= CACHED_PAIRS:
                        pairs.clear()
                    fits = pairs[before, token] = self.compatible(before, token)
                if not fits:
                    continue
            last[end], start[end] = token, end - n
        ids, at = [], len(text)
        while at:
            ids.append(last[at])
            at = start[at]
        return ids[::-1]

    def normalized(self, text: str) -> str:
        if text.isascii():
            return text.lower() if text.isprintable() or not re.search("[\x1c-\x1f]", text) else self.library(text)
        # Letters up to U+024F have one lower case each (but for U+0130); the rest is the library's.
        if max(text) < "ɐ" and "İ" not in text and not re.search("[\x1c-\x1f\x85]", text):
            return unicodedata.normalize("NFC", text).lower()
        return self.library(text)

    def library(self, text: str) -> str:
        """The vocabulary file's own normalisation; afterwards only the blank is white space."""
        return self.normalizer.normalize_str(text)

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for part in self.split_special(text):
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                plain = self.normalized(part)
                found = plain.split(" ") if re.search("[\x1c-\x1f\x85]", plain) else plain.split()
                ids.extend(chain.from_iterable(map(self.chunks.__getitem__, found)))
        return ids

    def decode(self, ids: Iterable[int]) -> str:
        """The vocabulary has no decoder: its tokens are shown with blanks between them."""
        return " ".join([self.shown[i] for i in ids if i in self.shown])


@lru_cache(maxsize=2)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


def _packed(ids: list[int]) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def encode(text: Column, path: str | None = None) -> Column:
    """Ids as little-endian unsigned 32-bit integers."""
    path = path or vocabulary("word_bpe_49k.json")
    run = text_udf(lambda texts: pd.DataFrame({"ids": [_packed(word_bpe(path).encode(t)) for t in texts]}), "ids binary")
    return run(text)["ids"]


def decode(ids: Column, path: str | None = None) -> Column:
    """The text of ids that ``encode`` packed; NULL decodes to the empty text."""
    path = path or vocabulary("word_bpe_49k.json")

    def decoded(packed: pd.Series) -> pd.Series:
        bpe = word_bpe(path)
        return packed.map(lambda b: bpe.decode(np.frombuffer(b or b"", dtype="<u4").tolist()))

    decoded.__annotations__ = {"packed": pd.Series, "return": pd.Series}
    return F.pandas_udf(decoded, "string")(ids)


def round_trip(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Encode and decode every text in one pass, keeping counts and digests of both results."""
    path = path or vocabulary("word_bpe_49k.json")

    def work(texts: list[str]) -> pd.DataFrame:
        bpe, rows = word_bpe(path), []
        for text in texts:
            ids = bpe.encode(text)
            shown = bpe.decode(ids)
            rows.append((len(ids), hashlib.sha256(_packed(ids)).hexdigest(), hashlib.sha256(shown.encode()).hexdigest()))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    run = text_udf(work, "n_tokens long, ids_sha256 string, decoded_sha256 string")
    return docs.select("doc_id", run("text").alias("_r")).select("doc_id", "_r.*")
