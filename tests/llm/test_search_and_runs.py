"""Ranked search against SQL and plain Python, runs against every stretch of every period."""

import hashlib
import random
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from tests.llm.conftest import SF
from tidemark.llm import lexical, periodic
from tidemark.llm.queries import LEXICAL_SQL, op13_periodic

# ---- 13: runs


def every_run(words):
    """All stretches with a period that can not be extended, smallest period first."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(24, 3 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def test_runs_of_random_texts():
    random.seed(7)
    seen = 0
    for _ in range(150):
        texts = []
        for _ in range(random.randint(1, 5)):
            words = [b"%d" % random.randint(0, random.choice([1, 2, 30])) for _ in range(random.randint(0, 160))]
            if words and random.random() < 0.6:
                at, p = random.randrange(len(words)), random.randint(1, 14)
                words[at:at] = (words[at : at + p] * 60)[: random.randint(5, 90)]
            if random.random() < 0.3:
                words = periodic.looped(words, 10 * random.randint(0, 1 << 28))
            if random.random() < 0.2:
                words = words[:20] + words[:20] * 3 + [b"end"] + words[:20] * 4
            texts.append(words)
        got = periodic.runs_of(texts)
        assert got == [every_run(w) for w in texts]
        seen += sum(map(len, got))
    assert seen > 300


@pytest.mark.parametrize("words", [[b"a"] * 300_000, [b"%d" % (i % 777) for i in range(100_000)]], ids=["one word", "long period"])
def test_runs_of_a_long_text(words):
    assert periodic.runs_of([words, [], words[:5]]) == [[(0, len(words), len(set(words)))], [], []]


def test_op13_against_plain_python(spark, documents):
    rows = {r["doc_id"]: r for r in op13_periodic(spark, SF).collect()}
    found = 0
    for doc_id, text in documents.select("doc_id", "text").collect():
        words, h = text.encode().split(), zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            a, n = (h // 10) % len(words), len(words)
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        runs, r = every_run(words), rows[doc_id]
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert r["n_runs"] == len(runs)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None, None, None))
        assert (r["start"], r["length"], r["period"]) == best
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        found += len(runs)
    assert found > 20


# ---- 12: search


def plain_search(docs, items, k=10):
    words = [(i, lexical.terms_of(t or "")) for i, t in docs]
    words = [(i, w) for i, w in words if w]
    n, total = len(words), sum(len(w) for _, w in words)
    counts = [(i, len(w), {t: w.count(t) for t in set(w)}) for i, w in words]
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(lexical.terms_of(text or ""))
    out = []
    for item, terms in asked.items():
        weight = {t: int(np.floor(1000 * np.log((2 * n + 2) / (2 * sum(t in c for *_, c in counts) + 1)))) for t in terms}
        scored = []
        for doc_id, size, c in counts:
            m = 10 + 90 * size * n // total
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if t in c)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        out += [(item, i, d, -s) for i, (s, _, d) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_search_of_random_texts(spark, monkeypatch):
    random.seed(3)
    vocabulary = [f"w{i}" for i in range(90)] + ["É", "ßx", "10"]
    text = lambda n: " ".join(random.choices(vocabulary, weights=[1 + 90 // (i + 1) for i in range(93)], k=n))
    docs = [(i, text(random.randint(1, 60))) for i in range(400)] + [(7, "w1 w2"), (None, "w3 w4"), (None, None), (901, ""), (902, "--"), (5, "W1-w2_W1")]
    docs += docs[:30]
    items = [(i, text(random.choice([2, 20, 90]))) for i in range(12)] + [(20, None), (21, ""), (None, "w5 w6"), (3, "w80 w81"), (22, "nowhere"), (23, "É é İ")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    asked = spark.createDataFrame(items, "item_id long, text string")
    expected = plain_search(docs, items)
    assert rows_of(lexical.search(frame, asked)) == expected
    spread = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    monkeypatch.setattr(lexical, "BLOCK_BYTES", 1500)  # several blocks of items
    monkeypatch.setattr(lexical, "_CHUNK", 3)
    try:
        assert rows_of(lexical.search(frame, asked)) == expected
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", spread)


def test_search_equals_sql(spark, documents):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    sql = LEXICAL_SQL
    for name in ("documents", "benchmark"):
        sql = sql.replace(f"FROM {name}", f"FROM '{SF}/{name}.parquet'")
    expected = duckdb.connect().execute(sql).fetchall()
    assert rows_of(lexical.search(documents, items)) == sorted(expected, key=str) and len(expected) == 400


def test_few_distinct_masks_are_evaluated():
    """Documents whose masks can not reach the tenth score are never scored."""
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 6, 5_000)
    terms = np.concatenate([np.sort(rng.choice(40, n, replace=False)) for n in sizes])
    block = lexical.Block(np.arange(5_000), np.full(5_000, 100), sizes, terms, np.ones(len(terms), np.int64), 40)
    scored = []
    inner = block.scores
    block.scores = lambda docs, *rest: scored.append(len(docs)) or inner(docs, *rest)
    none = (np.empty(0, np.int64), np.empty(0, np.int64))
    scores, _ = block.best(np.arange(12), np.arange(1, 13) * 100, none, 10)
    assert len(scores) == 10 and sum(scored) < 1_000
