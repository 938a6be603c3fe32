"""The queries of ``queries.py`` as SQL over the same tables."""

_LAST = """
    SELECT * FROM events WHERE {part}
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
"""
_AFTER = "CASE user_id % 3 WHEN 0 THEN FALSE WHEN 1 THEN TRUE ELSE ts >= TIMESTAMP '2024-01-15' END"
_BEFORE = f"NOT {_AFTER}"

_LANDED = """
    SELECT page_id, url, strlen(html) AS size,
           regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host
    FROM pages WHERE NOT contains(url, 'spam')
"""

_EXTENSION = """
    lower(split_part(CASE WHEN contains(url, '.') THEN list_last(string_split(url, '.')) ELSE 'jpg' END, '?', 1))
"""

_UPSERTED = f"""
    WITH t AS ({_LAST.format(part=_BEFORE)}), b AS ({_LAST.format(part=_AFTER)})
    SELECT coalesce(t.user_id, b.user_id) AS user_id,
           coalesce(t.event_type, b.event_type) AS event_type,
           CASE WHEN b.user_id IS NULL THEN t.event_id ELSE b.event_id END AS event_id,
           CASE WHEN b.user_id IS NULL THEN t.value ELSE b.value END AS value,
           CASE WHEN b.user_id IS NULL THEN t.props ELSE nullif(b.props->>'k', '7') END AS props,
           CASE WHEN t.value >= 50 THEN t.event_type || '/' || t.user_id END AS s3_key,
           CASE WHEN t.user_id IS NULL THEN TIMESTAMP '2024-01-15' ELSE TIMESTAMP '2024-01-08' END AS created_at,
           CASE WHEN t.user_id IS NULL THEN NULL
                WHEN b.user_id IS NULL THEN TIMESTAMP '2024-01-08 06:00:00'
                ELSE TIMESTAMP '2024-01-15' END AS updated_at,
           CASE WHEN t.user_id IS NULL THEN 'insert' WHEN b.user_id IS NULL THEN 'keep' ELSE 'update' END AS op
    FROM t FULL JOIN b ON t.user_id = b.user_id AND t.event_type = b.event_type
"""

_OUTCOMES = """
    WITH d AS (
        SELECT doc_id, source, 'wallpapers/' || doc_id || '.' || lower(lang) AS s3_key,
               CASE WHEN contains(text, chr(10)) THEN strlen(substr(text, strpos(text, chr(10)) + 1)) END AS content_size
        FROM documents
    )
    SELECT d.doc_id, d.source, d.s3_key, CAST(d.content_size AS BIGINT) AS content_size,
           CASE WHEN coalesce(d.content_size, 0) = 0 THEN 'download_failure'
                WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) THEN 'already_there'
                WHEN e.event_type <> 'error' THEN 'uploaded'
                ELSE 'upload_failure' END AS outcome
    FROM d LEFT JOIN events e ON e.event_id = d.doc_id
"""

_HISTORY = """
    WITH e AS (SELECT *, strftime(ts, '%Y-%m-%d') AS day FROM events),
    born AS (
        SELECT user_id, event_type, min(day) AS first_day, min(day) FILTER (WHERE value >= 50) AS done_day
        FROM e GROUP BY ALL
    ),
    per_day AS (
        SELECT day, count(*) AS extracted, count(DISTINCT (user_id, event_type)) AS distinct_keys
        FROM e GROUP BY day
    ),
    ins AS (SELECT first_day AS day, count(*) AS n FROM born GROUP BY 1),
    pub AS (SELECT done_day AS day, count(*) AS n FROM born WHERE done_day IS NOT NULL GROUP BY 1)
    SELECT p.day, p.extracted, p.distinct_keys,
           coalesce(ins.n, 0) AS inserted,
           p.distinct_keys - coalesce(ins.n, 0) AS updated,
           coalesce(pub.n, 0) AS published,
           CAST(sum(coalesce(ins.n, 0) - coalesce(pub.n, 0)) OVER (ORDER BY p.day) AS BIGINT) AS backlog
    FROM per_day p LEFT JOIN ins ON ins.day = p.day LEFT JOIN pub ON pub.day = p.day
"""

_DAYS = """
    SELECT *, CASE WHEN user_id % 2 = 0 THEN 'daily_ingest' ELSE 'other_ingest' END AS dag_id,
           'scheduled__' || strftime(ts, '%Y-%m-%d') AS run_id
    FROM events
"""

_RUNS = f"""
    SELECT dag_id, run_id, logical_date, started_at, ended_at,
           CAST((epoch_us(ended_at) - epoch_us(started_at)) // 1000000 AS BIGINT) AS duration_seconds
    FROM (
        SELECT dag_id, run_id, CAST(min(date_trunc('day', ts)) AS TIMESTAMP) AS logical_date,
               min(ts) FILTER (WHERE value >= 200) AS started_at,
               CASE WHEN max(ts) > max(CASE WHEN event_type = 'error' THEN ts ELSE TIMESTAMP '1970-01-01' END)
                    THEN max(ts) END AS ended_at
        FROM ({_DAYS}) GROUP BY dag_id, run_id
    )
"""

_AUDIT = f"""
    WITH k AS (
        SELECT dag_id, run_id, user_id, event_type, bool_or(value >= 50) AS ok FROM ({_DAYS}) GROUP BY ALL
    ), w AS (
        SELECT *, min(run_id) OVER key AS born, min(CASE WHEN ok THEN run_id END) OVER key AS done
        FROM k WINDOW key AS (PARTITION BY dag_id, user_id, event_type)
    ), c AS (
        SELECT dag_id, run_id, count(*) FILTER (WHERE run_id = born) AS ins, count(*) FILTER (WHERE run_id > born) AS upd,
               count(*) FILTER (WHERE run_id = done) AS up,
               count(*) FILTER (WHERE (done IS NULL OR run_id < done) AND event_type = 'error') AS dl,
               count(*) FILTER (WHERE (done IS NULL OR run_id < done) AND event_type <> 'error') AS ul
        FROM w GROUP BY dag_id, run_id
    )
    SELECT r.*, c.ins AS metadata_inserted, c.upd AS metadata_updated, c.up AS images_uploaded,
           c.dl AS download_failures, c.ul AS upload_failures,
           CAST(sum(c.ins - c.up) OVER (PARTITION BY c.dag_id ORDER BY c.run_id) AS BIGINT) AS missing_s3_after_run
    FROM ({_RUNS}) r JOIN c ON c.dag_id = r.dag_id AND c.run_id = r.run_id
"""

_AUDIT_TABLE = f"""
    WITH a AS (
        SELECT *, logical_date BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20' AS again FROM ({_AUDIT})
    )
    SELECT dag_id, run_id, logical_date, started_at, ended_at, duration_seconds,
           CASE WHEN again THEN 0 ELSE metadata_inserted END AS metadata_inserted,
           CASE WHEN again THEN metadata_inserted + metadata_updated ELSE metadata_updated END AS metadata_updated,
           images_uploaded, download_failures, upload_failures, missing_s3_after_run,
           CAST(NULL AS VARCHAR) AS notes, TIMESTAMP '2024-02-01' AS created_at,
           CASE WHEN again THEN TIMESTAMP '2024-02-02' ELSE TIMESTAMP '2024-02-01' END AS updated_at,
           CASE WHEN again THEN 'update' ELSE 'keep' END AS op
    FROM a
"""

# week number of an event, and the run timestamp of a week
_FIRST = "(SELECT CAST(min(date_trunc('day', ts)) AS TIMESTAMP) FROM events)"
_WEEK = f"coalesce(CAST(floor(date_diff('day', {_FIRST}, date_trunc('day', ts)) / 7) AS INTEGER), 0)"
_RUN_TS = _FIRST + " + INTERVAL '10.9' SECOND + to_days(7 * {week})"

# a key is published in the week that brings it, if there is content for its user
_REPLAY = f"""
    SELECT user_id, event_type, arg_max(event_id, (ts, event_id)) AS event_id,
           arg_max(value, (ts, event_id)) AS value, arg_max(props, (ts, event_id)) AS props,
           CASE WHEN user_id % 4 <> 0 THEN 'wallpapers/' || event_type || '-' || user_id || '.png' END AS s3_key,
           {_RUN_TS.format(week="min(week)")} AS created_at,
           CASE WHEN user_id % 4 <> 0 OR max(week) > min(week) THEN {_RUN_TS.format(week="max(week)")} END AS updated_at
    FROM (SELECT *, {_WEEK} AS week FROM events) GROUP BY user_id, event_type
"""

_REPLAY_AUDIT = f"""
    WITH e AS (SELECT DISTINCT user_id, event_type, {_WEEK} AS week FROM events),
    f AS (SELECT *, min(week) OVER (PARTITION BY user_id, event_type) AS first_week, user_id % 4 = 0 AS none FROM e),
    w AS (
        SELECT week, count(*) FILTER (WHERE week = first_week) AS ins, count(*) FILTER (WHERE week > first_week) AS upd,
               count(*) FILTER (WHERE week = first_week AND NOT none) AS up, count(*) FILTER (WHERE week = first_week AND none) AS bad
        FROM f GROUP BY week
    )
    SELECT 'daily_ingest' AS dag_id,
           'scheduled__' || strftime({_FIRST} + to_days(7 * week), '%Y-%m-%d') AS run_id,
           CAST(9 AS BIGINT) AS duration_seconds, ins AS metadata_inserted, upd AS metadata_updated,
           up AS images_uploaded, CAST(sum(bad) OVER (ORDER BY week) AS BIGINT) AS download_failures,
           CAST(0 AS BIGINT) AS upload_failures,
           CAST(sum(bad) OVER (ORDER BY week) AS BIGINT) AS missing_s3_after_run,
           {_RUN_TS.format(week="week")} AS created_at,
           {_RUN_TS.format(week="week")} AS updated_at
    FROM w
"""

_GUARDED = f"""
    WITH t AS ({_LAST.format(part="event_id % 3 <> 0")}), l AS ({_LAST.format(part="event_id % 3 = 0")}),
    b AS (SELECT user_id, event_type, CASE WHEN user_id % 7 <> 0 THEN ts END AS ts, event_id, value FROM l),
    j AS (
        SELECT coalesce(t.user_id, b.user_id) AS user_id, coalesce(t.event_type, b.event_type) AS event_type,
               CASE WHEN t.user_id IS NULL THEN 'insert' WHEN b.user_id IS NULL THEN 'keep'
                    WHEN b.ts >= t.ts THEN 'update' ELSE 'stale' END AS op,
               t.ts AS tts, b.ts AS bts, t.event_id AS tid, b.event_id AS bid, t.value AS tv, b.value AS bv
        FROM t FULL JOIN b ON t.user_id = b.user_id AND t.event_type = b.event_type
    )
    SELECT user_id, event_type, CASE WHEN op IN ('insert', 'update') THEN bts ELSE tts END AS ts,
           CASE WHEN op IN ('insert', 'update') THEN bid ELSE tid END AS event_id,
           CASE WHEN op IN ('insert', 'update') THEN bv ELSE tv END AS value,
           CASE WHEN op = 'insert' THEN TIMESTAMP '2024-02-02' ELSE TIMESTAMP '2024-02-01' END AS created_at,
           CASE WHEN op = 'update' THEN TIMESTAMP '2024-02-02' END AS updated_at, op
    FROM j
"""

_CHECKS = {
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


def _constraints() -> str:
    parts = []
    for table, (required, key) in _CHECKS.items():
        for c in required:
            parts.append(
                f"SELECT '{table}' AS table_name, 'not_null' AS check_name, '{c}' AS column_name, "
                f"count(*) FILTER (WHERE {c} IS NULL) AS violations FROM {table}"
            )
        parts.append(
            f"SELECT '{table}', 'unique', '{','.join(key)}', "
            f"count(*) - count(DISTINCT ({', '.join(key)})) FROM {table}"
        )
    labelled = "(SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"
    parts.append(
        "SELECT 'documents_with_labels', 'not_null', 'quality', "
        f"count(*) FILTER (WHERE quality IS NULL) FROM {labelled}"
    )
    parts.append(
        f"SELECT 'documents_with_labels', 'unique', 'doc_id', count(*) - count(DISTINCT doc_id) FROM {labelled}"
    )
    return " UNION ALL ".join(parts)


def all_sql() -> dict[str, str]:
    return {
        "q_search_page": """
            SELECT o_orderkey, o_orderdate, o_orderpriority, o_totalprice FROM orders
            WHERE o_orderstatus = 'O' AND contains(lower(o_orderpriority), 'high')
            ORDER BY o_orderdate DESC, o_orderkey LIMIT 24 OFFSET 24""",
        "q_search_deep_page": """
            SELECT o_orderkey, o_orderdate, o_orderpriority, o_totalprice FROM orders
            WHERE o_orderstatus = 'O' AND contains(lower(o_orderpriority), '-')
            ORDER BY o_orderdate DESC, o_orderkey LIMIT 24 OFFSET 1008""",
        "q_put_objects": """
            WITH d AS (SELECT *, CASE WHEN doc_id % 10 = 3 OR coalesce(text, '') = '' THEN 'download_failure'
                                      WHEN doc_id % 10 = 4 THEN 'already_there' ELSE 'uploaded' END AS outcome
                       FROM documents)
            SELECT doc_id, 'texts/' || doc_id || '.webp' AS s3_key, 'image/webp' AS content_type, outcome,
                   CAST(CASE WHEN outcome = 'uploaded' THEN 1 ELSE 0 END AS BIGINT) AS attempts,
                   CAST(CASE WHEN outcome = 'uploaded' THEN strlen(text) ELSE 0 END AS BIGINT) AS bytes
            FROM d""",
        "q_extract_fields": """
            SELECT CAST(event_id AS VARCHAR) AS item_id, event_type AS category, value AS price,
                   CAST(props->>'k' AS BIGINT) AS k, props->>'label' AS label
            FROM events""",
        "q_landed_items": f"""
            WITH p AS ({_LANDED})
            SELECT CAST(0 AS BIGINT) AS pos, CAST(page_id AS VARCHAR) AS wallhaven_id, url,
                   CAST(NULL AS VARCHAR) AS resolution, host AS category,
                   CAST(NULL AS VARCHAR) AS purity, CAST(size AS BIGINT) AS file_size FROM p
            UNION ALL
            SELECT 1, 'b' || page_id, NULL, NULL, host, NULL, NULL FROM p""",
        "q_page_metrics": """
            SELECT count(*) AS pages, count(*) FILTER (WHERE contains(url, 'spam')) AS bad_pages,
                   count(*) FILTER (WHERE NOT contains(url, 'spam') AND page_id % 5 = 2)
                   + 3 * count(*) FILTER (WHERE NOT contains(url, 'spam')) AS items,
                   count(*) FILTER (WHERE NOT contains(url, 'spam')) AS bad_sizes,
                   count(*) FILTER (WHERE NOT contains(url, 'spam') AND page_id % 5 IN (0, 1, 3)) AS bad_items
            FROM pages""",
        "q_first_n": """
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS pos, role, text
            FROM conversations QUALIFY pos <= 3""",
        "q_valid_items": r"""
            SELECT CAST(page_id AS VARCHAR) AS item_id, regexp_extract(url, '[^/]+\.html$', 0) AS url
            FROM pages WHERE coalesce(regexp_extract(url, '[^/]+\.html$', 0), '') <> ''""",
        "q_load_metrics": f"""
            WITH e AS (SELECT user_id, event_type, {_AFTER} AS later, event_type <> 'error' AS good FROM events),
            t AS (SELECT DISTINCT user_id, event_type FROM e WHERE good AND NOT later),
            b AS (
                SELECT e.user_id, e.event_type, later, good, later AND t.user_id IS NOT NULL AS known, count(*) AS n
                FROM e LEFT JOIN t ON t.user_id = e.user_id AND t.event_type = e.event_type GROUP BY ALL
            )
            SELECT CASE WHEN later THEN 'second' ELSE 'first' END AS load, CAST(sum(n) AS BIGINT) AS extracted,
                   CAST(coalesce(sum(n) FILTER (WHERE NOT good), 0) AS BIGINT) AS invalid,
                   CAST(coalesce(sum(n - 1) FILTER (WHERE good), 0) AS BIGINT) AS duplicates,
                   count(*) FILTER (WHERE good AND NOT known) AS inserted,
                   count(*) FILTER (WHERE good AND known) AS updated
            FROM b GROUP BY later""",
        "q_dedupe_last": _LAST.format(part="TRUE"),
        "q_upsert_rows": _UPSERTED,
        "q_bucketed_upsert": _UPSERTED,
        "q_upsert_ops": f"SELECT op, count(*) AS n FROM ({_UPSERTED}) GROUP BY op",
        "q_rerun_ops": f"""
            SELECT * REPLACE (CASE WHEN op = 'keep' THEN 'keep' ELSE 'update' END AS op,
                              CASE WHEN op = 'keep' THEN updated_at ELSE TIMESTAMP '2024-01-16' END AS updated_at)
            FROM ({_UPSERTED})""",
        "q_empty_loads": """
            SELECT 'none' AS load, CAST(0 AS BIGINT) AS extracted, CAST(0 AS BIGINT) AS invalid, CAST(0 AS BIGINT) AS duplicates,
                   CAST(0 AS BIGINT) AS inserted, CAST(0 AS BIGINT) AS updated
            UNION ALL SELECT 'invalid', count(*), count(*), 0, 0, 0 FROM events""",
        "q_constraint_report": _constraints(),
        "q_pending_batch": """
            SELECT d.doc_id, lang, source FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
            WHERE l.quality IS NULL ORDER BY d.doc_id LIMIT 5""",
        "q_fair_batch": """
            WITH e AS (SELECT user_id, count(*) AS failed, max(ts) AS tried FROM events WHERE event_type = 'error' GROUP BY user_id),
            w AS (
                SELECT d.doc_id, e.failed, TIMESTAMP '2024-01-01' + to_days(CAST(d.doc_id % 40 AS INTEGER)) AS created, e.tried
                FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id LEFT JOIN e ON e.user_id = d.doc_id
                WHERE l.quality IS NULL
            )
            SELECT doc_id, failed, created,
                   CASE WHEN failed > 0 THEN tried + to_days(CAST(pow(2, least(failed - 1, 6)) AS INTEGER)) ELSE created END AS due
            FROM w ORDER BY due, created, doc_id LIMIT 300""",
        "q_guarded_upsert": _GUARDED,
        "q_guarded_ops": f"SELECT op, count(*) AS n FROM ({_GUARDED}) GROUP BY op",
        "q_backlog": """
            SELECT count(*) AS total, count(*) FILTER (WHERE l.quality IS NULL) AS pending
            FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
        "q_object_key": f"""
            SELECT page_id, {_EXTENSION} AS extension, 'wallpapers/' || page_id || '.' || {_EXTENSION} AS s3_key
            FROM pages""",
        "q_content_type": f"""
            WITH k AS (
                SELECT 'wallpapers/' || page_id || '.' || {_EXTENSION} AS s3_key FROM pages
                UNION ALL
                SELECT 'parts/' || p_partkey || CASE WHEN p_size <= 10 THEN '.PNG' WHEN p_size <= 20 THEN '.webp'
                       WHEN p_size <= 30 THEN '.jpeg' WHEN p_size <= 40 THEN '.JPG' ELSE '.gif' END FROM part
            )
            SELECT s3_key, CASE WHEN lower(s3_key) LIKE '%.png' THEN 'image/png'
                                WHEN lower(s3_key) LIKE '%.webp' THEN 'image/webp'
                                WHEN lower(s3_key) LIKE '%.jpeg' OR lower(s3_key) LIKE '%.jpg' THEN 'image/jpeg'
                                ELSE 'application/octet-stream' END AS content_type
            FROM k""",
        "q_sql_functions": f"""
            WITH k AS (SELECT *, 'wallpapers/' || page_id || '.' || {_EXTENSION} AS s3_key FROM pages
                       WHERE coalesce(url, '') <> '' AND page_id IS NOT NULL AND NOT contains(lower(url), 'spam'))
            SELECT page_id, {_EXTENSION} AS extension, s3_key,
                   CASE WHEN lower(s3_key) LIKE '%.png' THEN 'image/png' WHEN lower(s3_key) LIKE '%.webp' THEN 'image/webp'
                        WHEN lower(s3_key) LIKE '%.jpeg' OR lower(s3_key) LIKE '%.jpg' THEN 'image/jpeg'
                        ELSE 'application/octet-stream' END AS content_type,
                   page_id % 10 + 495 IN (429, 500, 502, 503, 504) AS retryable,
                   CASE WHEN page_id % 10 + 400 = 404 THEN 'missing' ELSE 'unknown' END AS probe,
                   CASE WHEN page_id % 3 = 0 THEN 'unknown_run' ELSE CAST(page_id % 3 AS VARCHAR) END AS run
            FROM k""",
        "q_reconcile": """
            SELECT doc_id, source, doc_id IN (SELECT doc_id FROM labels) AS object_exists FROM documents""",
        "q_to_upload": """
            SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
        "q_attempt_outcome": """
            WITH a AS (
                SELECT user_id, strftime(ts, '%Y-%m-%d') AS day, ts, event_type <> 'error' AS good,
                       row_number() OVER (PARTITION BY user_id, strftime(ts, '%Y-%m-%d') ORDER BY ts, event_id) AS n
                FROM events
            )
            SELECT user_id, day, bool_or(good) AS ok,
                   coalesce(min(n) FILTER (WHERE good), max(n)) AS attempts,
                   min(ts) FILTER (WHERE good) AS succeeded_at
            FROM a WHERE n <= 4 GROUP BY user_id, day""",
        "q_publish_outcome": _OUTCOMES,
        "q_publish_metrics": f"""
            SELECT source, count(*) FILTER (WHERE outcome IN ('uploaded', 'already_there')) AS images_uploaded,
                   count(*) FILTER (WHERE outcome = 'download_failure') AS download_failures,
                   count(*) FILTER (WHERE outcome = 'upload_failure') AS upload_failures
            FROM ({_OUTCOMES}) GROUP BY source""",
        "q_apply_outcomes": f"""
            SELECT d.doc_id, d.lang,
                   CASE WHEN d.source = 'src3' THEN 'wallpapers/old-' || d.doc_id ELSE o.s3_key END AS s3_key,
                   CASE WHEN d.source = 'src3' THEN TIMESTAMP '2024-01-31'
                        WHEN o.s3_key IS NOT NULL THEN TIMESTAMP '2024-02-01' END AS updated_at,
                   CASE WHEN o.s3_key IS NOT NULL THEN 'update' ELSE 'keep' END AS op
            FROM documents d LEFT JOIN (
                SELECT doc_id, s3_key FROM ({_OUTCOMES}) WHERE outcome IN ('uploaded', 'already_there') AND source <> 'src3'
            ) o ON o.doc_id = d.doc_id""",
        "q_code_class": """
            WITH s AS (
                SELECT event_id, event_type, CAST(props->>'k' AS INTEGER)
                       + CASE WHEN event_type = 'error' THEN 500 ELSE 400 END AS status FROM events
            ), c AS (
                SELECT *, CASE event_type WHEN 'signup' THEN 'NoSuchKey' WHEN 'view' THEN 'NotFound'
                          ELSE CAST(status AS VARCHAR) END AS code FROM s
            )
            SELECT event_id, code,
                   CASE WHEN code IN ('404', 'NoSuchKey', 'NotFound') THEN 'missing' ELSE 'unknown' END AS probe,
                   status IN (429, 500, 502, 503, 504) AS retryable
            FROM c""",
        "q_run_duration": f"SELECT dag_id, run_id, started_at, ended_at, duration_seconds FROM ({_RUNS})",
        "q_run_history": _HISTORY,
        "q_audit_row": _AUDIT,
        "q_audit_upsert": _AUDIT_TABLE,
        "q_backlog_drift": f"""
            WITH a AS (SELECT * FROM ({_AUDIT}) WHERE day(logical_date) % 7 <> 3), e AS (
                SELECT dag_id, run_id, missing_s3_after_run, lag(missing_s3_after_run)
                       OVER (PARTITION BY dag_id ORDER BY run_id) + metadata_inserted - images_uploaded AS expected_backlog
                FROM a
            )
            SELECT *, missing_s3_after_run - expected_backlog AS backlog_drift FROM e""",
        "q_touched_report": f"""
            WITH u AS ({_UPSERTED}), r AS (
                SELECT * REPLACE (CASE WHEN user_id % 11 <> 5 THEN created_at END AS created_at) FROM u
                UNION ALL
                SELECT * REPLACE (CASE WHEN user_id % 11 <> 5 THEN created_at END AS created_at) FROM u WHERE user_id % 13 = 4
            ), touched AS (SELECT * FROM r WHERE op <> 'keep')
            SELECT 'events' AS table_name, 'not_null' AS check_name, 'user_id' AS column_name, count(*) FILTER (WHERE user_id IS NULL) AS violations FROM touched
            UNION ALL SELECT 'events', 'not_null', 'event_type', count(*) FILTER (WHERE event_type IS NULL) FROM touched
            UNION ALL SELECT 'events', 'not_null', 'created_at', count(*) FILTER (WHERE created_at IS NULL) FROM touched
            UNION ALL SELECT 'events', 'unique', 'user_id,event_type', count(*) - count(DISTINCT (user_id, event_type)) FROM touched""",
        "q_latest_runs": f"""
            SELECT dag_id, run_id, metadata_inserted, metadata_updated, images_uploaded, download_failures,
                   upload_failures, missing_s3_after_run, duration_seconds, ended_at
            FROM ({_AUDIT_TABLE}) ORDER BY ended_at DESC NULLS FIRST, run_id, dag_id LIMIT 5""",
        "q_incremental": _REPLAY,
        "q_incremental_audit": _REPLAY_AUDIT,
    }
