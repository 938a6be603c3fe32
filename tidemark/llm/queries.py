"""The operators as queries over a folder of tables. Each is a thin selection of its operator's result."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe,
    fingerprints,
    lexical,
    license_scan,
    lm_score,
    neighbours,
    packing,
    periodic,
    quality,
    repeats,
    sharding,
    simhash,
    toxicity,
)
from tidemark.llm.common import fold_of
from tidemark.session import ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_documents(table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), quality.quality(F.col("text"), model).alias("_q"))
    return scored.select("doc_id", "held_out", "_q.score", "_q.predicted")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex_bits(F.col("bits")).alias("fingerprint"), "component_id")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(table(spark, sf_dir, "documents"))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = neighbours.usable(table(spark, sf_dir, "embeddings"))
    return neighbours.nearest(rows, F.col("vec_id") % 100 == 0)


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_next(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), toxicity.toxicity(F.col("text"), model).alias("_t"))
    return scored.select("doc_id", "held_out", "_t.score", "_t.predicted", "_t.spans")


def op11_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"), digest=True)


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = periodic.periodic_runs(table(spark, sf_dir, "documents"), turn)
    lines = F.transform("runs", lambda r: F.format_string("%d,%d,%d\n", r["start"], r["length"], r["period"]))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}
    return dict(sorted(found.items(), key=lambda item: int(item[0][2:].split("_")[0])))


_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase
LEXICAL_SQL = rf"""
WITH asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{lexical.TERM}')) AS term FROM benchmark
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{lexical.TERM}') AS words FROM documents
), sized AS (
  SELECT r, doc_id, len(words) AS n FROM docs WHERE len(words) > 0
), totals AS (
  SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM sized
), counts AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM docs) GROUP BY r, term
), weights AS (
  SELECT term, floor(1000 * ln((2 * max(big_n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counts, totals GROUP BY term
), scored AS (
  SELECT item_id, doc_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * big_n) // big_l))))::BIGINT AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN sized USING (r), totals
  GROUP BY item_id, doc_id, r
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {lexical.TOP}
"""


def llm_sql() -> dict[str, str]:
    """Queries that SQL can express too; the others are tested against brute force."""
    return {"op12_lexical": LEXICAL_SQL}
