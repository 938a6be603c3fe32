"""Every operator as a query over the test tables; ``oracle.py`` has the same queries as SQL.

The tables stand in for the data of an ingest: ``events`` are items delivered day by day under the
key (user_id, event_type), or an attempt log, or runs; ``documents`` are rows of a keyed table;
``labels`` lists the objects that exist; ``pages`` are items with URLs; ``orders`` are searched.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from tidemark.functions.coerce import run_timestamp
from tidemark.functions.sql import register_functions
from tidemark.functions.keys import KEY_PREFIX, content_type, is_retryable, object_key, payload_size, probe_class, url_extension
from tidemark.operators.audit import RUN_KEY, audit_rows, backlog_drift, latest_runs, run_history, run_identity, run_outcomes
from tidemark.operators.dedupe import dedupe_last, first_n
from tidemark.operators.ordering import By
from tidemark.operators.pending import backlog, pending_batch
from tidemark.operators.reconcile import (
    ALREADY_THERE,
    DOWNLOAD_FAILURE,
    UPLOAD_FAILURE,
    UPLOADED,
    apply_outcomes,
    attempt_outcome,
    due_at,
    publish_metrics,
    publish_outcome,
    reconcile,
    to_upload,
)
from tidemark.operators.search import search_page
from tidemark.operators.upsert import load_metrics, op_counts, upsert
from tidemark.operators.validate import Check, constraint_report, flag_valid, touched_checks, valid_rows
from tidemark.plans.inputs import read_input
from tidemark.plans.publish import RETRY_S, publish_run
from tidemark.schemas import RUN_AUDIT, RUN_COUNTERS, TableSpec
from tidemark.session import new_folder, ship_package
from tidemark.sources.blobs import put_objects, put_tasks, spread, staged_path, write_contents
from tidemark.sources.landing import extract_items, page_metrics, read_pages
from tidemark.sources.buckets import read_bucketed, write_bucketed
from tidemark.sources.folders import make_folder
from tidemark.sources.tables import ensure_table, read_table
from tidemark.streaming.incremental import incremental_run

DAG_ID = "daily_ingest"
OTHER_DAG_ID = "other_ingest"
EVENT_KEY = ["user_id", "event_type"]
ARRIVAL = ["ts", "event_id"]
EVENT_HOST = "events.example.com"
PUBLISHABLE = 50.0
CUT = "2024-01-15"

EVENT_TABLE = TableSpec(
    schema=StructType(
        [
            StructField("user_id", LongType(), False),
            StructField("event_type", StringType(), False),
            StructField("event_id", LongType()),
            StructField("value", DoubleType()),
            StructField("props", StringType()),
            StructField("s3_key", StringType()),
            StructField("created_at", TimestampNTZType(), False),
            StructField("updated_at", TimestampNTZType()),
        ]
    ),
    keys=("user_id", "event_type"),
    update_cols=("event_id", "value", "props"),
    insert_stamps=("created_at",),
    update_stamps=("updated_at",),
    pending_col="s3_key",
)

# The same with the time of the event, by which rows that come late are told.
TIMED_TABLE = TableSpec(
    schema=StructType(
        [
            StructField("user_id", LongType(), False),
            StructField("event_type", StringType(), False),
            StructField("ts", TimestampNTZType()),
            StructField("event_id", LongType()),
            StructField("value", DoubleType()),
            StructField("created_at", TimestampNTZType(), False),
            StructField("updated_at", TimestampNTZType()),
        ]
    ),
    keys=("user_id", "event_type"),
    update_cols=("ts", "event_id", "value"),
    insert_stamps=("created_at",),
    update_stamps=("updated_at",),
)

AUDIT_NTZ = TableSpec(
    schema=StructType(
        [
            StructField(
                f.name,
                TimestampNTZType() if f.dataType.typeName() == "timestamp" else f.dataType,
                f.nullable,
            )
            for f in RUN_AUDIT.schema.fields
        ]
    ),
    keys=RUN_AUDIT.keys,
    update_cols=RUN_AUDIT.update_cols,
    insert_stamps=RUN_AUDIT.insert_stamps,
    update_stamps=RUN_AUDIT.update_stamps,
)


def _at(text: str) -> Column:
    return run_timestamp(text, ntz=True)


def _before_and_after(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All events: those that the table holds, and the batch that comes in. A third of the users is
    only in the table, a third only in the batch, and the rest is cut in time."""
    third = F.col("user_id") % 3
    later = F.when(third == 0, False).when(third == 1, True).otherwise(F.col("ts") >= _at(CUT))
    events = read_input(spark, sf_dir, "events")
    return events.where(~later), events.where(later)


# --- sources ---------------------------------------------------------------------------------


def _search(spark: SparkSession, sf_dir: str, query: str, page: int) -> DataFrame:
    hits = search_page(
        read_input(spark, sf_dir, "orders"),
        query=query,
        text="o_orderpriority",
        purity="O",
        purity_col="o_orderstatus",
        added="o_orderdate",
        key="o_orderkey",
        page=page,
        size=24,
    )
    return hits.select("o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice")


def q_search_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, "High", 2)


def q_search_deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _search(spark, sf_dir, "-", 43)


def q_extract_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.from_json("props", "k BIGINT, label STRING")
    return read_input(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("item_id"),
        F.col("event_type").alias("category"),
        F.col("value").alias("price"),
        item["k"].alias("k"),
        item["label"].alias("label"),
    )


def _land_pages(spark: SparkSession, sf_dir: str) -> str:
    """Write each web page as one response line: three items and mostly something odd behind them (no
    object, or NULL), or no JSON at all for spam."""
    field = lambda value, name: value.cast("string").alias(name)
    item = lambda key, path, size: F.struct(
        field(key, "id"),
        field(path, "path"),
        field(F.parse_url(F.col("url"), F.lit("HOST")), "category"),
        size.alias("file_size"),
        F.lit("not read").alias("uploader"),
    )
    nothing = F.lit(None)
    size = payload_size(F.col("html")).cast("string")
    data = F.array(
        item(F.col("page_id"), F.col("url"), size),
        item(F.concat(F.lit("b"), F.col("page_id")), nothing, F.lit("7.5")),
        item(F.col("page_id"), F.col("url"), size),
    )
    kind = F.col("page_id") % 5
    odd = F.when(kind == 0, ",5]}").when(kind == 1, ',["q"]]}').when(kind == 2, ",null]}").when(kind == 3, ',"no object"]}').otherwise("]}")
    good = F.to_json(F.struct(data.alias("data")))
    good = F.concat(F.substr(good, F.lit(1), F.length(good) - 2), odd)
    line = F.when(F.contains("url", F.lit("spam")), F.lit("<html>502</html>")).otherwise(good)
    folder = new_folder(spark, "landed")
    read_input(spark, sf_dir, "pages").select(line.alias("value")).write.text(folder)
    return folder


def q_landed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_pages(spark, _land_pages(spark, sf_dir), lines=True)
    return extract_items(pages, limit=2).drop("landed", "page", "block", "line").withColumn("pos", F.col("pos").cast("bigint"))


def q_page_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_metrics(read_pages(spark, _land_pages(spark, sf_dir), lines=True))


def q_first_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_input(spark, sf_dir, "conversations")
    first = first_n(turns, ["conv_id"], [F.col("turn").asc()], 3)
    return first.select("conv_id", F.col("pos").cast("bigint").alias("pos"), "role", "text")


# --- validation and upsert -------------------------------------------------------------------


def q_valid_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = read_input(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("item_id"),
        F.regexp_extract("url", r"[^/]+\.html$", 0).alias("url"),
    )
    return valid_rows(flag_valid(items, "item_id", "url"), ["item_id", "url"])


def q_load_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of all events, the second against what the first one left. Errors have no URL."""
    loads, known = [], None
    for name, part in zip(("first", "second"), _before_and_after(spark, sf_dir), strict=True):
        items = part.select(*EVENT_KEY, F.nullif("event_type", F.lit("error")).alias("url"))
        flagged = flag_valid(items, "user_id", "url")
        keys = flagged.where("valid").select(*EVENT_KEY)
        metrics = load_metrics(flagged, keys.limit(0) if known is None else known, EVENT_KEY)
        loads.append(metrics.select(F.lit(name).alias("load"), "*"))
        known = keys
    return loads[0].unionByName(loads[1])


def q_dedupe_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe_last(read_input(spark, sf_dir, "events"), EVENT_KEY, ARRIVAL)


def _upsert_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    before, after = (dedupe_last(part, EVENT_KEY, ARRIVAL) for part in _before_and_after(spark, sf_dir))
    key = F.concat_ws("/", "event_type", "user_id")
    target = before.select(
        *EVENT_KEY,
        *EVENT_TABLE.update_cols,
        F.when(F.col("value") >= PUBLISHABLE, key).alias("s3_key"),
        _at("2024-01-08 00:00:00").alias("created_at"),
        _at("2024-01-08 06:00:00").alias("updated_at"),
    )
    # an incoming NULL has to overwrite
    return target, after.withColumn("props", F.nullif(F.get_json_object("props", "$.k"), F.lit("7")))


def _upserted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(*_upsert_sides(spark, sf_dir), EVENT_TABLE, _at("2024-01-15 00:00:00"))


def q_upsert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _upserted(spark, sf_dir)


def q_bucketed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge against a table that is bucketed by its key: only the batch is moved."""
    target, batch = _upsert_sides(spark, sf_dir)
    folder, buckets = new_folder(spark, "bucketed"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    write_bucketed(target, folder, EVENT_KEY, buckets)
    table = read_bucketed(spark, folder, target.schema, EVENT_KEY, buckets)
    return upsert(table, batch, EVENT_TABLE, _at("2024-01-15 00:00:00"))


def q_upsert_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op_counts(_upserted(spark, sf_dir))


def _guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the events came late: they are the batch, whatever their time."""
    events, late = read_input(spark, sf_dir, "events"), F.col("event_id") % 3 == 0
    target = dedupe_last(events.where(~late), EVENT_KEY, ARRIVAL).withColumns(
        {"created_at": _at("2024-02-01 00:00:00"), "updated_at": F.lit(None).cast("timestamp_ntz")}
    )
    # events of one user without a time: never newer than what has one
    batch = dedupe_last(events.where(late), EVENT_KEY, ARRIVAL)
    batch = batch.withColumn("ts", F.when(F.col("user_id") % 7 != 0, F.col("ts")))
    rows = target.select(*TIMED_TABLE.columns)
    return upsert(rows, batch, TIMED_TABLE, _at("2024-02-02 00:00:00"), newer_by="ts")


def q_guarded_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _guarded(spark, sf_dir)


def q_guarded_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op_counts(_guarded(spark, sf_dir))


def q_rerun_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batch a second time: the same rows, and all that the batch has count as updated."""
    target, batch = _upsert_sides(spark, sf_dir)
    first = upsert(target, batch, EVENT_TABLE, _at("2024-01-15 00:00:00")).drop("op")
    return upsert(first, batch, EVENT_TABLE, _at("2024-01-16 00:00:00"))


def q_empty_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches without items, and without valid ones, against all keys of the events."""
    events = read_input(spark, sf_dir, "events")
    items = events.select(*EVENT_KEY, F.nullif("event_type", F.col("event_type")).alias("url"))
    flagged, known = flag_valid(items, "user_id", "url"), events.select(*EVENT_KEY)
    kinds = {"none": flagged.where("user_id < 0"), "invalid": flagged}
    loads = [load_metrics(f, known, EVENT_KEY).select(F.lit(n).alias("load"), "*") for n, f in kinds.items()]
    return loads[0].unionByName(loads[1])


def q_constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = {
        "region": (["r_regionkey", "r_name"], ["r_regionkey"]),
        "nation": (["n_nationkey", "n_name", "n_regionkey"], ["n_nationkey"]),
        "customer": (["c_custkey", "c_name"], ["c_custkey"]),
        "supplier": (["s_suppkey", "s_name"], ["s_suppkey"]),
        "part": (["p_partkey", "p_name"], ["p_partkey"]),
        "orders": (["o_orderkey", "o_custkey"], ["o_orderkey"]),
        "lineitem": (["l_orderkey", "l_linenumber"], ["l_orderkey", "l_linenumber"]),
        "events": (["event_id", "ts"], ["event_id"]),
        "documents": (["doc_id", "text"], ["doc_id"]),
        "labels": (["doc_id"], ["doc_id"]),
        "pages": (["page_id", "url"], ["page_id"]),
        "benchmark": (["item_id"], ["item_id"]),
        "conversations": (["conv_id", "turn"], ["conv_id", "turn"]),
        "embeddings": (["vec_id"], ["vec_id"]),
    }
    # a nullable column: documents without a label
    labelled = _documents(spark, sf_dir).select("doc_id", "quality")
    return constraint_report(
        *[Check(read_input(spark, sf_dir, name), name, *check) for name, check in checks.items()],
        Check(labelled, "documents_with_labels", ["quality"], ["doc_id"]),
    )


def q_touched_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge gone wrong: some rows have lost their stamp, some keys come twice, among kept rows too, which
    only a look at the whole table would find."""
    rows = _upserted(spark, sf_dir)
    no_stamp = F.when(F.col("user_id") % 11 != 5, F.col("created_at"))
    twice = F.when(F.col("user_id") % 13 == 4, 2).otherwise(1)
    broken = rows.withColumn("created_at", no_stamp).withColumn("_n", F.explode(F.sequence(F.lit(1), twice))).drop("_n")
    _, after = _before_and_after(spark, sf_dir)
    keys = after.select(*EVENT_KEY).distinct()
    return constraint_report(*touched_checks(broken, keys, "events", EVENT_TABLE))


# --- pending rows, keys, publishing ----------------------------------------------------------


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = read_input(spark, sf_dir, "labels").select("doc_id", "quality")
    return read_input(spark, sf_dir, "documents").join(labels, "doc_id", "left")


def q_pending_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending_batch(
        _documents(spark, sf_dir), 5, ["doc_id", "lang", "source"], "doc_id", pending_col="quality"
    )


def q_fair_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label wait, the errors of the user of the same number are their failed tries.
    The batch is large enough for tries to matter at every size."""
    waiting = _documents(spark, sf_dir).where("quality IS NULL")
    created = _at("2024-01-01 00:00:00") + F.make_dt_interval(days=(F.col("doc_id") % 40).cast("int"))
    errors = read_input(spark, sf_dir, "events").where("event_type = 'error'").groupBy(F.col("user_id").alias("doc_id"))
    tried = waiting.join(errors.agg(F.count("*").alias("failed"), F.max("ts").alias("tried")), "doc_id", "left")
    due = due_at(created, F.col("failed"), F.col("tried"), RETRY_S)
    order = [By("due"), By("created")]
    rows = tried.withColumns({"created": created, "due": due})
    return pending_batch(rows, 300, ["doc_id", "failed", "created", "due"], "doc_id", pending_col=None, order_by=order)


def q_backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog(_documents(spark, sf_dir), "quality")


def q_object_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    url, key = F.col("url"), F.col("page_id").cast("string")
    return read_input(spark, sf_dir, "pages").select(
        "page_id", url_extension(url).alias("extension"), object_key(key, url).alias("s3_key")
    )


def q_content_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    derived = read_input(spark, sf_dir, "pages").select(
        object_key(F.col("page_id").cast("string"), F.col("url")).alias("s3_key")
    )
    size = F.col("p_size")
    suffix = (
        F.when(size <= 10, ".PNG").when(size <= 20, ".webp").when(size <= 30, ".jpeg").when(size <= 40, ".JPG")
    ).otherwise(".gif")
    made = read_input(spark, sf_dir, "part").select(
        F.concat(F.lit("parts/"), F.col("p_partkey").cast("string"), suffix).alias("s3_key")
    )
    keys = derived.unionByName(made)
    return keys.select("s3_key", content_type(F.col("s3_key")).alias("content_type"))


def q_sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules as SQL functions, in one statement over web pages."""
    register_functions(spark)
    pages = read_input(spark, sf_dir, "pages")
    return spark.sql(
        """
        SELECT page_id, url_extension(url) AS extension, object_key(string(page_id), url) AS s3_key,
               content_type(object_key(string(page_id), url)) AS content_type,
               is_retryable(int(page_id % 10 + 495)) AS retryable, probe_class(string(page_id % 10 + 400)) AS probe,
               run_name(nullif(string(page_id % 3), '0'), '') AS run
        FROM {pages}
        WHERE is_valid_item(string(page_id), url) AND NOT matches_search(url, 'SPAM')
        """,
        pages=pages,
    )


def q_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_input(spark, sf_dir, "documents").select("doc_id", "source")
    return reconcile(documents, read_input(spark, sf_dir, "labels"), "doc_id")


def q_to_upload(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_input(spark, sf_dir, "documents").select("doc_id", "source")
    return to_upload(documents, read_input(spark, sf_dir, "labels"), "doc_id")


def q_attempt_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = read_input(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    ok = F.col("event_type") != "error"
    outcome = attempt_outcome(log, ["user_id", "day"], ARRIVAL, ok)
    return outcome.withColumn("day", F.col("day").cast("string"))


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as pending rows.

    The content is what follows the first line, the manifest is the labelled documents, and the
    put of a document is the event of the same number.
    """
    text, url = F.col("text"), F.concat(
        F.lit("https://"), F.col("source"), F.lit(".example.com/"), F.col("doc_id").cast("string"),
        F.lit("."), F.col("lang"),
    )
    rows = read_input(spark, sf_dir, "documents").select(
        "doc_id",
        "source",
        object_key(F.col("doc_id").cast("string"), url).alias("s3_key"),
        F.when(F.contains(text, F.lit("\n")), F.expr("octet_length(substr(text, instr(text, '\n') + 1))"))
        .cast("bigint")
        .alias("content_size"),
    )
    puts = read_input(spark, sf_dir, "events").select(
        F.col("event_id").alias("doc_id"), (F.col("event_type") != "error").alias("put_ok")
    )
    joined = reconcile(rows, read_input(spark, sf_dir, "labels"), "doc_id").join(puts, "doc_id", "left")
    decided = publish_outcome(F.col("content_size"), F.col("object_exists"), F.col("put_ok"))
    return joined.select("doc_id", "source", "s3_key", "content_size", decided.alias("outcome"))


def q_publish_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcomes(spark, sf_dir)


def q_publish_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish_metrics(_outcomes(spark, sf_dir), ["source"])


def q_put_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Put every document's text: some have no staged content, some are in the store already."""
    ship_package(spark)
    base = new_folder(spark, "put")
    kind, name = F.col("doc_id") % 10, F.col("doc_id").cast("string")
    documents = read_input(spark, sf_dir, "documents")
    rows = documents.select(
        "doc_id",
        "text",
        kind.alias("kind"),
        F.concat(F.lit("texts/"), name, F.lit(".webp")).alias("s3_key"),
        F.concat(F.lit(f"{base}/staged/"), spread(name), F.lit("/"), name).alias("content_path"),
    )
    object_path = F.concat(F.lit(f"{base}/objects/"), F.col("s3_key"))
    staged = rows.where(kind != 3).select(F.col("content_path").alias("path"), "text")
    there = rows.where(kind == 4).select(object_path.alias("path"), F.lit("old").alias("text"))
    tasks = put_tasks(spark, documents.count())
    files = staged.unionByName(there).repartition(tasks, "path")  # however the input lies in its files
    write_contents(files).agg(F.sum("bytes")).collect()  # one number
    asked = rows.select(
        "doc_id", "s3_key", content_type(F.col("s3_key")).alias("content_type"), "content_path",
        F.lit(None).cast("boolean").alias("object_exists"),
    )
    return put_objects(asked, f"{base}/objects", ["doc_id"], tasks)


def q_apply_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source has been published before; the others wait."""
    published = F.col("source") == "src3"
    key = F.concat(F.lit("wallpapers/old-"), F.col("doc_id").cast("string"))
    table = read_input(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        F.when(published, key).alias("s3_key"),
        F.when(published, _at("2024-01-31 00:00:00")).alias("updated_at"),
    )
    outcomes = _outcomes(spark, sf_dir).where(~published)
    return apply_outcomes(table, outcomes, ["doc_id"], _at("2024-02-01 00:00:00"))


def q_code_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed, k = F.col("event_type") == "error", F.get_json_object("props", "$.k").cast("int")
    codes = (
        read_input(spark, sf_dir, "events")
        .select("event_id", "event_type", (k + F.when(failed, 500).otherwise(400)).alias("status"))
        .select(
            "event_id",
            "status",
            F.when(F.col("event_type") == "signup", "NoSuchKey")
            .when(F.col("event_type") == "view", "NotFound")
            .otherwise(F.col("status").cast("string"))
            .alias("code"),
        )
    )
    return codes.select(
        "event_id",
        "code",
        probe_class(F.col("code")).alias("probe"),
        is_retryable(F.col("status")).alias("retryable"),
    )


# --- runs ------------------------------------------------------------------------------------

def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the DAG and the run they belong to: two DAGs share the names of their runs."""
    dag = F.when(F.col("user_id") % 2 == 0, DAG_ID).otherwise(OTHER_DAG_ID)
    named = F.concat(F.lit("scheduled__"), F.to_date("ts").cast("string"))
    return read_input(spark, sf_dir, "events").withColumns({"dag_id": dag, "run_id": named})


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per DAG and day. It has a start if the day has a large event, an end unless it ends
    with an error."""
    ts, failed = F.col("ts"), F.col("event_type") == "error"
    last_ok, last_failed = F.max(F.when(~failed, ts)), F.max(F.when(failed, ts))
    days = (
        _days(spark, sf_dir)
        .groupBy("dag_id", "run_id", F.to_date("ts").alias("date"))
        .agg(
            F.min(F.when(F.col("value") >= 200, ts)).alias("started"),
            F.when(F.coalesce(last_ok > last_failed, last_failed.isNull()), last_ok).alias("ended"),
        )
    )
    return run_identity(
        days,
        [F.lit(""), F.col("dag_id")],
        [F.lit(None).cast("string"), F.col("run_id")],
        F.col("date").cast("timestamp_ntz"),
        F.col("started"),
        F.col("ended"),
    )


def q_run_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs(spark, sf_dir).select("dag_id", "run_id", "started_at", "ended_at", "duration_seconds")


def q_run_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_input(spark, sf_dir, "events").select(*EVENT_KEY, "value", F.to_date("ts").alias("day"))
    history = run_history(events, "day", EVENT_KEY, F.col("value") >= PUBLISHABLE)
    return history.withColumn("day", F.col("day").cast("string"))


def _audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load counters, backlog and publish counters of every run follow from the same rule."""
    events = _days(spark, sf_dir).select("dag_id", "run_id", *EVENT_KEY, "value")
    publishes, kind = F.col("value") >= PUBLISHABLE, F.col("event_type")
    history = run_history(events, "run_id", EVENT_KEY, publishes, by=["dag_id"])
    outcomes = run_outcomes(
        events,
        "run_id",
        EVENT_KEY,
        publishes,
        success=F.when(kind == "view", ALREADY_THERE).otherwise(UPLOADED),
        failure=F.when(kind == "error", DOWNLOAD_FAILURE).otherwise(UPLOAD_FAILURE),
        by=["dag_id"],
    )
    return audit_rows(
        _runs(spark, sf_dir),
        history.select(*RUN_KEY, "inserted", "updated", F.col("backlog").alias("pending")),
        publish_metrics(outcomes, RUN_KEY),
    )


def q_audit_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audit(spark, sf_dir)


def _audit_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit table after all runs, and then a second run of the days 10 to 20."""
    folder = new_folder(spark, "audit")
    _audit(spark, sf_dir).write.parquet(folder)  # one row per run, read twice
    first = spark.read.parquet(folder)
    created = _at("2024-02-01 00:00:00")
    target = first.select(
        *[
            {"notes": F.lit(None).cast("string"), "created_at": created, "updated_at": created}
            .get(c, F.col(c))
            .alias(c)
            for c in AUDIT_NTZ.columns
        ]
    )
    day = F.col("logical_date")
    again = first.where((day >= _at("2024-01-10")) & (day <= _at("2024-01-20")))
    # a second run finds everything in place
    again = again.withColumn("metadata_updated", F.col("metadata_inserted") + F.col("metadata_updated"))
    again = again.withColumn("metadata_inserted", F.lit(0).cast("bigint"))
    return upsert(target, again, AUDIT_NTZ, _at("2024-02-02 00:00:00"))


def q_audit_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _audit_table(spark, sf_dir)


def q_backlog_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every seventh day have failed and left no record."""
    recorded = _audit(spark, sf_dir).where(F.dayofmonth("logical_date") % 7 != 3)
    return backlog_drift(recorded)


def q_latest_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_runs(_audit_table(spark, sf_dir), 5)


# --- scheduled runs over a stream ------------------------------------------------------------


def _weeks(spark: SparkSession, sf_dir: str) -> list[date]:
    """The first day of every week from the first event to the last."""
    first, last = read_input(spark, sf_dir, "events").agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    return [first + timedelta(days=d) for d in range(0, (last - first).days + 1, 7)] if first else []


def _event_url(name: Column) -> Column:
    return F.concat(F.lit(f"https://{EVENT_HOST}/"), spread(name), F.lit("/"), name, F.lit(".png"))


def _stage_contents(events: DataFrame, name: Column, base: str) -> None:
    """Contents of the events' keys: a fourth of the users has none, and for another the objects are there."""
    kind = F.col("user_id") % 4
    keys = events.select(*EVENT_KEY).distinct().select(kind.alias("kind"), name.alias("name"))
    content = staged_path(f"{base}/contents", _event_url(F.col("name")))
    key = F.concat(F.lit(f"{base}/objects/{KEY_PREFIX}/"), "name", F.lit(".png"))
    staged = keys.where("kind <> 0").select(content.alias("path"), F.col("name").alias("text"))
    there = keys.where("kind = 1").select(key.alias("path"), F.lit("old").alias("text"))
    files = staged.unionByName(there).repartition(put_tasks(events.sparkSession, 0), "path")
    write_contents(files).agg(F.sum("bytes")).collect()  # one number


def _replay(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Deliver the events week by week to a stream, with one scheduled run per week that loads what came,
    publishes what waits, and records both."""
    ship_package(spark)
    base = new_folder(spark, "replay")
    events = read_input(spark, sf_dir, "events")
    make_folder(spark, f"{base}/landing")
    ensure_table(spark, f"{base}/table", EVENT_TABLE)
    ensure_table(spark, f"{base}/audit", AUDIT_NTZ)
    items = spark.readStream.schema(events.schema).parquet(f"{base}/landing")
    day, name = F.to_date("ts"), F.concat_ws("-", "event_type", "user_id")
    _stage_contents(events, name, base)
    weeks = _weeks(spark, sf_dir)
    for week in weeks:
        here = (day >= F.lit(week)) & (day < F.lit(week + timedelta(days=7)))
        delivered = events.where(here | day.isNull() if week == weeks[0] else here)
        delivered.write.mode("append").parquet(f"{base}/landing")
        run_ts = _at(f"{week} 00:00:10.900")
        incremental_run(
            items,
            EVENT_TABLE,
            f"{base}/table",
            f"{base}/audit",
            f"{base}/state",
            dag_id=DAG_ID,
            run_id=f"scheduled__{week}",
            started_at=_at(f"{week} 00:00:00.950"),
            run_ts=run_ts,
            order_by=ARRIVAL,
            key="user_id",
            url="event_type",
            audit_spec=AUDIT_NTZ,
            publish=lambda week=week, run_ts=run_ts: publish_run(
                f"{base}/table",
                f"{base}/contents",
                f"{base}/objects",
                f"publish-{week}",
                run_ts,
                limit=2_000_000_000,  # everything that waits
                spec=EVENT_TABLE,
                spark=spark,
                name=name,
                url=_event_url(name),
            ),
        )
    return f"{base}/table", f"{base}/audit"


def q_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    table, _ = _replay(spark, sf_dir)
    return read_table(spark, table, EVENT_TABLE)


def q_incremental_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, audit = _replay(spark, sf_dir)
    return read_table(spark, audit, AUDIT_NTZ).select(
        "dag_id", "run_id", "duration_seconds", *RUN_COUNTERS, "created_at", "updated_at"
    )


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("q_")}
