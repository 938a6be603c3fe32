"""Operators that SQL can not express, against the same written out row by row in plain Python."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tests.llm.conftest import SF
from tidemark.llm import lm_score, quality, sharding
from tidemark.llm.queries import op3_quality

# ---- 3: quality


def plain_statistics(text):
    """The sixteen statistics, character by character."""
    data, words = text.encode(), text.split()
    if not data:
        return [0.0] * 16
    kinds = Counter()
    for b in data:
        c = chr(b)
        kinds["high" if b > 127 else "space" if b < 33 else "lower" if c.islower() else "upper" if c.isupper() else "digit" if c.isdigit() else "stop" if c in ".,;:?'\"()-" else "symbol"] += 1
    letters, n = max(1, kinds["lower"] + kinds["upper"]), max(1, len(words))
    counts, lines = Counter(words), text.split("\n")
    odd = sum(k for w, k in counts.items() if len(w) > 1 and not w[-2:].isalnum() and not w[-2].isalnum())
    return [
        math.log(1 + len(data)), math.log(1 + len(words)), sum(len(w) for w in words) / n, kinds["upper"] / letters,
        *[kinds[k] / len(data) for k in ("digit", "stop", "symbol", "high", "space")],
        len(counts) / n, max([0, *counts.values()]) / n, sum(a == b for a, b in zip(words, words[1:], strict=False)) / n,
        len(set(lines)) / len(lines), math.log(1 + len(words) / len(lines)), len(zlib.compress(data, 1)) / len(data), odd / n,
    ]


def test_quality_is_a_sum_of_table_entries(spark, documents, labels):
    model = quality.train(documents, labels)
    got = {r["doc_id"]: r for r in op3_quality(spark, SF).collect()}
    assert len(model.pairs) == 6 and len(model.tables) == 16
    for doc_id, text in documents.select("doc_id", "text").collect():
        x = plain_statistics(text or "")
        total = model.intercept
        for value, cuts, table in zip(x, model.cuts, model.tables, strict=True):
            total += table[sum(bool(c <= value) for c in cuts)]
        for (a, b), table in model.pairs.items():
            total += table[sum(bool(c <= x[a]) for c in model.coarse[a]), sum(bool(c <= x[b]) for c in model.coarse[b])]
        score = 1 / (1 + math.exp(-total))
        r = got[doc_id]
        assert abs(r["score"] - score) < 1e-9 and r["predicted"] == (score >= 0.3)
        assert r["held_out"] == (zlib.crc32(str(doc_id).encode()) % 5 == 0)


# ---- 6: pseudo-likelihood


def test_a_score_written_out(spark, documents, monkeypatch):
    """Each token's probability from its four neighbours: class, member, and a rare word's share of its bucket."""
    docs = documents.where("doc_id < 60")
    counts = Counter(t for r in docs.collect() for t in lm_score._tokens(r["text"].lower()))
    monkeypatch.setattr(lm_score, "settle", lambda df, _: df.cache())
    # With a corpus this small all words have units of their own; with fewer there are buckets too.
    monkeypatch.setattr(lm_score, "unit_count", lambda words: 256)
    monkeypatch.setattr(lm_score, "UNITS", 256)
    units, net = lm_score.train(docs)
    scored = {r["doc_id"]: r for r in docs.select("doc_id", lm_score.pseudo_likelihood(F.col("text"), units, net).alias("s")).collect()}
    first, members = units.first_bucket, net.member_bias.shape[1]
    ordered = [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))]
    known = {w: i + 1 for i, w in enumerate(ordered[: first - 1])}
    number = lambda w: known.get(w, first + zlib.crc32(w.encode()) % (256 // lm_score.BUCKETS))
    in_bucket = Counter()
    for w, n in counts.items():
        in_bucket[number(w)] += n
    assert units == known and any(w not in known for w in counts)
    for doc_id, text in docs.select("doc_id", "text").collect()[:4]:
        words = lm_score._tokens(text.lower())
        ids = [0, 0, *map(number, words), 0, 0]
        total = 0.0
        for i, w in enumerate(words):
            seen = np.concatenate([net.embed[ids[i + 2 + p]] for p in lm_score.PLACES]).astype(float)
            hidden = np.tanh(seen @ net.mix.reshape(-1, lm_score.HIDDEN) + net.mix_bias)
            cls, member = divmod(ids[i + 2], members)
            for logits, at in ((hidden @ net.to_class + net.class_bias, cls), (hidden @ net.to_member[cls] + net.member_bias[cls], member)):
                total += logits[at] - math.log(sum(math.exp(z) for z in logits))
            if w not in known:
                total -= math.log(in_bucket[number(w)])
        s = scored[doc_id]["s"]
        assert s["n_tokens"] == len(words) and abs(s["log_prob"] - total) < 1e-3 * max(1, len(words))
        assert Counter(dict(zip(s["words"], s["times"], strict=True))) == Counter(w for w in words if w not in known)


# ---- 9: the ring


def spark_hash(*values):
    """``xxhash64`` of (value, bytes) pairs: each hash is the seed of the next."""
    seed = 42
    for value, size in values:
        seed = xxhash.xxh64((value % (1 << 8 * size)).to_bytes(size, "little"), seed=seed).intdigest()
    return seed


def test_shards_and_slots_of_a_plain_ring(documents):
    points = {}
    for shard in range(16):
        for replica in range(256):
            place = spark_hash((shard, 4), (replica, 4)) >> 48
            points[place] = min(shard, points.get(place, 99))
    ring = sorted(points.items())
    rows = [(r["doc_id"], len(r["text"].encode()) + 1, zlib.crc32(r["text"].encode())) for r in documents.collect()]
    at_point = defaultdict(list)
    for doc_id, size, crc in rows:
        place = spark_hash((doc_id, 8)) >> 48
        owner = next((i for i, (p, _) in enumerate(ring) if p >= place), 0)
        signed = spark_hash((doc_id, 8), (size, 8), (crc, 8))
        at_point[owner].append((signed % 16, doc_id, size, crc))  # 16 divides 2^64, so the sign does not matter
    room = [len(rows) // 16 + (s < len(rows) % 16) for s in range(16)]
    slots, expected, over = Counter(), {}, defaultdict(list)

    def take(doc_id, shard):
        expected[doc_id] = (shard, slots[shard])
        slots[shard] += 1
        room[shard] -= 1

    for i, (_, shard) in enumerate(ring):
        for _, doc_id, _, _ in sorted(at_point[i]):
            if room[shard]:
                take(doc_id, shard)
            else:
                over[i].append(doc_id)
    carried = []
    for turn in range(2):
        for i, (_, shard) in enumerate(ring):
            carried += over[i] if turn == 0 else []
            while carried and room[shard]:
                take(carried.pop(0), shard)
    got = {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.shard_documents(documents).collect()}
    assert got == expected and len(over) > 0
