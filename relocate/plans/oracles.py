"""DuckDB SQL for the registered queries, written from what each result means."""

from __future__ import annotations

from relocate import fixed
from relocate.plans.inputs import CANDIDATES, RESIDUE_PREFIX, with_views

# Hash helpers shared by several texts.
ORDER_TEXT = """concat_ws('|',
    COALESCE(CAST(o_custkey AS VARCHAR), '~'),
    COALESCE(CAST(epoch_us(o_orderdate) AS VARCHAR), '~'),
    COALESCE(CAST(o_orderkey AS VARCHAR), '~'),
    COALESCE(length(o_orderpriority) || ':' || o_orderpriority, '~'),
    COALESCE(length(o_orderstatus) || ':' || o_orderstatus, '~'),
    COALESCE(CAST(o_totalprice AS VARCHAR), '~'))"""
ORDER_KEY_HASH = (
    "CAST(('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS BIGINT)"
)

ORDER_DIFF = """
    SELECT COALESCE(s.o_orderkey, t.o_orderkey) AS o_orderkey,
      CASE WHEN t.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra'
           ELSE 'changed' END AS difference,
      CASE WHEN s.o_orderkey IS NULL THEN 0 ELSE 1 END AS rows_missing,
      CASE WHEN t.o_orderkey IS NULL THEN 0 ELSE 1 END AS rows_extra
    FROM orders s FULL JOIN {orders_target} t ON s.o_orderkey = t.o_orderkey
    WHERE s.o_orderkey IS NULL OR t.o_orderkey IS NULL
       OR s.o_custkey <> t.o_custkey OR s.o_orderstatus <> t.o_orderstatus
       OR s.o_orderdate <> t.o_orderdate OR s.o_orderpriority <> t.o_orderpriority
       OR s.o_totalprice <> t.o_totalprice"""

# What a change log leaves behind, step by step: the newest change decides.
APPLIED = """
    newest AS (
      SELECT c_custkey, op, c_name, c_nationkey, c_acctbal, c_mktsegment
      FROM {changes} QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY seq DESC) = 1),
    moved AS (
      SELECT COALESCE(n.c_custkey, s.c_custkey) AS c_custkey,
        CASE WHEN n.op IS NULL THEN s.c_name ELSE n.c_name END AS c_name,
        CASE WHEN n.op IS NULL THEN s.c_nationkey ELSE n.c_nationkey END AS c_nationkey,
        CASE WHEN n.op IS NULL THEN s.c_acctbal ELSE n.c_acctbal END AS c_acctbal,
        CASE WHEN n.op IS NULL THEN s.c_mktsegment ELSE n.c_mktsegment END AS c_mktsegment
      FROM {snapshot} s FULL JOIN newest n ON n.c_custkey = s.c_custkey
      WHERE n.op IS NULL OR n.op <> 'D')"""


def _fingerprint(table: str, columns: list[str]) -> str:
    text = ", ".join(f"COALESCE({c}, '~')" for c in columns)
    return f"""
    SELECT '{table}' AS table_name, count(*) AS rows, CAST(sum(
      CAST(('0x' || substr(md5(concat_ws('|', {text})), 1, 8)) AS BIGINT)) AS VARCHAR) AS fingerprint
    FROM {table}"""


def _s(column: str) -> str:
    return f"length({column}) || ':' || {column}"


def _n(column: str) -> str:
    return f"CAST({column} AS VARCHAR)"


def _t(column: str) -> str:
    return f"CAST(epoch_us({column}) AS VARCHAR)"


SNAPSHOT_COPY = "\nUNION ALL\n".join(
    [
        _fingerprint("region", [_s("r_name"), _n("r_regionkey")]),
        _fingerprint("nation", [_s("n_name"), _n("n_nationkey"), _n("n_regionkey")]),
        _fingerprint(
            "customer",
            [_n("c_acctbal"), _n("c_custkey"), _s("c_mktsegment"), _s("c_name"), _n("c_nationkey")],
        ),
        _fingerprint(
            "supplier", [_n("s_acctbal"), _s("s_name"), _n("s_nationkey"), _n("s_suppkey")]
        ),
        _fingerprint(
            "part",
            [_s("p_brand"), _s("p_name"), _n("p_partkey"), _n("p_retailprice"), _n("p_size"),
             _s("p_type")],
        ),
        _fingerprint(
            "orders",
            [_n("o_custkey"), _t("o_orderdate"), _n("o_orderkey"), _s("o_orderpriority"),
             _s("o_orderstatus"), _n("o_totalprice")],
        ),
        _fingerprint(
            "lineitem",
            [_n("l_discount"), _n("l_extendedprice"), _n("l_linenumber"), _s("l_linestatus"),
             _n("l_orderkey"), _n("l_partkey"), _n("l_quantity"), _s("l_returnflag"),
             _t("l_shipdate"), _n("l_suppkey"), _n("l_tax")],
        ),
    ]
)

# Health rules per look.
HEALTH = """
    h AS (
      SELECT *, last_good_us IS NOT NULL
                AND (obs_us - last_good_us) < 121000000 AS recent_good FROM looks),
    judged AS (
      SELECT *, CASE
          WHEN recent_good THEN true
          WHEN last_error IS NOT NULL THEN false
          ELSE state IN ('good', 'applying_changes') END AS replication_ok FROM h)"""

# The same over looks of any phase, with or without a status.
JUDGED = """
    h AS (
      SELECT *, last_good_us IS NOT NULL AND (obs_us - last_good_us) < 121000000 AS recent_good,
        phase IS NOT NULL AND phase IN ('copying', 'replicating') AS live FROM looks),
    judged AS (
      SELECT *, CASE WHEN NOT status_seen THEN false WHEN recent_good THEN true
          WHEN last_error IS NOT NULL THEN false
          ELSE state IN ('good', 'applying_changes') END AS replication_ok FROM h),
    blocked AS (
      SELECT *, CASE WHEN NOT live THEN '' WHEN NOT status_seen THEN 'STATUS_UNAVAILABLE'
          WHEN copy_phase <> 'finished' THEN 'initial_copy_not_finished' ELSE '' END AS hard_blockers,
        CASE WHEN live AND status_seen AND NOT replication_ok THEN 'replication_not_healthy' ELSE '' END
          AS soft_blockers FROM judged),
    ready AS (
      SELECT *, CASE WHEN NOT live AND (phase IS NULL OR phase <> 'switched') THEN 'not_ready'
          WHEN hard_blockers <> '' THEN 'blocked' WHEN soft_blockers <> '' THEN 'warning'
          ELSE 'ready' END AS readiness FROM blocked)""".replace("STATUS_UNAVAILABLE", fixed.STATUS_UNAVAILABLE)

# Progress per look, with plain windows per run.
COPIED = """
    seen AS (
      SELECT *, COALESCE(max(raw_copied_bytes) OVER (PARTITION BY run_id ORDER BY tick
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS high FROM looks),
    copied AS (
      SELECT * EXCLUDE (high),
        CASE WHEN copy_phase = 'in-progress' THEN greatest(raw_copied_bytes, high)
             ELSE raw_copied_bytes END AS copied_bytes,
        CASE WHEN copy_phase = 'in-progress' AND raw_copied_bytes < high
              AND raw_mode = 'target_size_estimate'
             THEN 'target_size_estimate_monotonic' ELSE raw_mode END AS estimate_mode,
        CASE WHEN total_bytes > 0 THEN round(CAST(
          CASE WHEN copy_phase = 'in-progress' THEN greatest(raw_copied_bytes, high)
               ELSE raw_copied_bytes END AS DOUBLE) / total_bytes * 100, 1) ELSE 0.0 END AS percent
      FROM seen)"""

MOVED_ON = """
    steps AS (
      SELECT *, row_number() OVER w AS nth, lag(copied_bytes) OVER w AS b0,
        lag(tables_completed) OVER w AS t0, lag(last_good_us) OVER w AS g0
      FROM copied WINDOW w AS (PARTITION BY run_id ORDER BY tick)),
    flagged AS (
      SELECT *, nth > 1 AND (copied_bytes > b0 OR tables_completed > t0
                             OR last_good_us IS DISTINCT FROM g0) AS advanced FROM steps),
    progressed AS (
      SELECT *, last_value(CASE WHEN advanced OR nth = 1 THEN obs_us END IGNORE NULLS) OVER (
          PARTITION BY run_id ORDER BY tick) AS last_progress_us FROM flagged),
    stalls AS (
      SELECT *, floor((CAST(floor(abs(obs_us - last_progress_us) / 1000000.0) AS BIGINT)
            * CASE WHEN obs_us < last_progress_us THEN -1 ELSE 1 END + 3) / 6.0) / 10.0
          AS no_progress_minutes FROM progressed)"""

TREND = """
    lists AS (
      SELECT run_id, tick, list_filter(list(rows_changed) OVER (
          PARTITION BY run_id ORDER BY tick ROWS BETWEEN 5 PRECEDING AND CURRENT ROW),
          lambda x: x IS NOT NULL) AS p FROM looks),
    trends AS (
      SELECT run_id, tick, CASE WHEN len(p) < 3 THEN 'unknown'
        WHEN p[1] < p[-1] AND p = list_sort(p) THEN 'growing'
        WHEN p[1] > p[-1] AND p = list_reverse_sort(p) THEN 'shrinking'
        ELSE 'stable' END AS backlog_trend FROM lists)"""

RATE = """
    ends AS (
      SELECT *, first_value(copied_bytes) OVER w AS b0, first_value(obs_us) OVER w AS us0
      FROM copied WINDOW w AS (PARTITION BY run_id ORDER BY tick
                               ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)),
    gains AS (
      SELECT *, copied_bytes - b0 AS db,
        CAST(floor(obs_us / 1000000.0) AS BIGINT) - CAST(floor(us0 / 1000000.0) AS BIGINT) AS ds
      FROM ends),
    rates AS (
      SELECT *, CASE WHEN db > 0 AND ds > 0 AND total_bytes > 0
                     THEN CAST(db AS DOUBLE) / ds * 60 END AS rate FROM gains)"""

LOOKS = "looks AS (SELECT * FROM {ticks})"

GENERATED = """
        WITH firsts AS (
          SELECT db_id, replace(schema_name || '.' || table_name, 'public.', '') AS table_name,
            column_name, min(pos) AS pos
          FROM {cat_columns} WHERE is_generated GROUP BY ALL)
        SELECT db_id, table_name, string_agg(column_name, ',' ORDER BY pos) AS columns
        FROM firsts GROUP BY ALL"""

GATE = """
        SELECT t.db_id, count(*) AS tables,
          count(*) FILTER (NOT keyed) AS tables_without_key,
          count(*) FILTER (generated) AS tables_with_generated_columns,
          bool_and(keyed) AS all_tables_valid
        FROM (SELECT db_id, table_name, EXISTS (SELECT 1 FROM {cat_indexes} i
                 WHERE i.db_id = c.db_id AND i.schema_name = c.schema_name
                   AND i.table_name = c.table_name AND (is_primary OR is_unique)) AS keyed,
               EXISTS (SELECT 1 FROM {cat_columns} k WHERE k.db_id = c.db_id
                 AND k.schema_name = c.schema_name AND k.table_name = c.table_name
                 AND is_generated) AS generated
              FROM {cat_tables} c) t
        GROUP BY 1"""

CURRENT_TABLE = """
        WITH named AS (
          SELECT user_id AS run_id, 't' || (event_id % 13) AS table_name,
            min({'pattern': event_id % 3, 'line': event_id}) AS place
          FROM events WHERE event_type = 'click' AND user_id % 7 <> 2 GROUP BY ALL),
        direct AS (
          SELECT run_id, arg_max(table_name, place) AS t FROM named
          WHERE (run_id, table_name) IN (SELECT (run_id, table_name) FROM KNOWN)
            OR run_id NOT IN (SELECT run_id FROM KNOWN)
          GROUP BY 1),
        tail AS (
          SELECT user_id AS run_id, 't' || (max(event_id) % 13) AS t FROM events
          WHERE event_type = 'error'
            OR event_type = 'click' AND user_id % 7 <> 2 AND event_id % 3 = 1 GROUP BY 1)
        SELECT r.run_id, COALESCE(d.t, CASE WHEN (r.run_id, f.t) IN (
            SELECT (run_id, table_name) FROM KNOWN)
            OR r.run_id NOT IN (SELECT run_id FROM KNOWN) THEN f.t END) AS current_table
        FROM (SELECT DISTINCT user_id AS run_id FROM events) r
        LEFT JOIN direct d USING (run_id) LEFT JOIN tail f USING (run_id)"""

TABLES_DONE = """
        SELECT run_id, COALESCE(s.n, 0) AS total_tables,
          CASE WHEN copy_phase = 'finished' THEN COALESCE(s.n, 0)
            ELSE least(COALESCE(s.n, 0), greatest(COALESCE(d.n, 0),
            CASE WHEN tables_in_sync <= s.n THEN tables_in_sync ELSE 0 END)) END AS tables_completed
        FROM (SELECT run_id, count(*) AS n FROM {table_sizes} GROUP BY 1) s
        FULL JOIN {run_status} USING (run_id)
        LEFT JOIN (SELECT run_id, count(DISTINCT table_name) AS n FROM DONE_TABLES GROUP BY 1) d
          USING (run_id)"""

BYTES_DONE = """
        WITH t AS (
          SELECT s.run_id, sum(source_bytes) AS total, count(*) AS n,
            count(r.table_name) AS done,
            COALESCE(sum(source_bytes) FILTER (r.table_name IS NOT NULL), 0) AS finished,
            COALESCE(sum(least(source_bytes, target_bytes)) FILTER (source_bytes > 0), 0) AS landed
          FROM {table_sizes} s LEFT JOIN DONE_TABLES r
            ON r.run_id = s.run_id AND r.table_name = s.table_name GROUP BY 1),
        u AS (
          SELECT run_id, COALESCE(total, 0) AS total, COALESCE(n, 0) AS n,
            COALESCE(finished, 0) AS finished, COALESCE(landed, 0) AS landed, copy_phase,
            CASE WHEN copy_phase = 'finished' THEN COALESCE(n, 0)
              WHEN tables_in_sync <= n THEN greatest(every, tables_in_sync) ELSE every END AS complete
          FROM (SELECT t.*, least(n, COALESCE(d.m, 0)) AS every FROM t LEFT JOIN (
              SELECT run_id, count(DISTINCT table_name) AS m FROM DONE_TABLES GROUP BY 1) d
            USING (run_id)) t
          FULL JOIN {run_status} USING (run_id)),
        v AS (
          SELECT *, CASE WHEN copy_phase = 'in-progress' AND landed > finished
                         THEN 'target_size_estimate'
                         WHEN finished = 0 AND complete > 0 AND total > 0
                         THEN 'table_ratio_estimate' ELSE 'completed_tables' END AS estimate_mode
          FROM u),
        w AS (
          SELECT *, CAST(CASE estimate_mode WHEN 'target_size_estimate' THEN landed
              WHEN 'table_ratio_estimate' THEN round(CAST(complete AS DOUBLE) / n * total)
              ELSE finished END AS BIGINT) AS copied_bytes FROM v)
        SELECT run_id, copied_bytes, CAST(total AS BIGINT) AS total_bytes,
          CASE WHEN total > 0 THEN round(CAST(copied_bytes AS DOUBLE) / total * 100, 1)
               ELSE 0.0 END AS percent, estimate_mode
        FROM w"""

DONE_ANYWHERE = """
    done AS (
      SELECT run_id, table_name FROM {remembered}
      UNION
      SELECT user_id, 't' || (event_id % 13) FROM events WHERE event_type = 'purchase'
        AND ((user_id, 't' || (event_id % 13)) IN (SELECT (run_id, table_name) FROM {table_sizes})
             OR user_id NOT IN (SELECT run_id FROM {table_sizes})))"""

RECORD = f"""        WITH looks AS (SELECT * REPLACE (
            CAST(floor(last_good_us / 1000000.0) AS BIGINT) * 1000000 AS last_good_us)
          FROM {{ticks}}), {HEALTH}, {COPIED}, {MOVED_ON}, {TREND}, {RATE},
        stored AS (
          SELECT * REPLACE (CASE WHEN tick % 5 = 1 AND phase = 'replicating' THEN 'copying'
              WHEN tick % 11 = 3 THEN 'switched' WHEN tick % 11 = 5 THEN 'ready_to_copy'
              ELSE phase END AS phase) FROM judged),
        begun AS (
          SELECT *, phase = 'ready_to_copy' AND copy_phase = 'in-progress'
              AND state <> 'not-yet-started' AS began FROM stored),
        moved AS (
          SELECT * REPLACE (CASE WHEN began THEN 'copying'
              WHEN phase = 'copying' AND copy_phase = 'finished' AND replication_ok
              THEN 'replicating' ELSE phase END AS phase),
            CASE WHEN began THEN 'initial_copy' WHEN phase = 'copying' AND copy_phase = 'finished'
              THEN CASE WHEN replication_ok THEN 'running' ELSE 'copy_health_check_failed' END
              END AS run_state FROM begun),
        r AS (
          SELECT *, phase IN ('copying', 'replicating') AS live,
            phase IN ('replicating', 'switched') AS landed,
            CASE WHEN phase = 'ready_to_copy' THEN 'not_ready' WHEN phase = 'switched' THEN 'ready'
              WHEN copy_phase <> 'finished' THEN 'blocked' WHEN NOT replication_ok THEN 'warning'
              ELSE 'ready' END AS readiness FROM moved),
        record AS (
        SELECT r.run_id, r.tick, r.phase, r.run_state AS state, r.tick * 2 AS started_us, r.total_bytes,
          r.state AS reported_state, r.rows_changed * 1234 AS rows_changed, r.last_error,
          r.readiness, r.tables_completed, s.copied_bytes, s.percent, s.estimate_mode,
          CAST(floor((r.obs_us - r.last_good_us) / 1000000.0) AS BIGINT)
            AS seconds_since_last_good,
          t.backlog_trend,
          CASE WHEN NOT replication_ok THEN 'blocked' WHEN recent_good THEN 'healthy'
               ELSE 'degraded' END AS health_state,
          CASE WHEN live AND r.copy_phase <> 'finished' THEN 'initial_copy_not_finished'
               WHEN NOT replication_ok THEN 'replication_not_healthy' END AS blocker_reason,
          CAST(round(rate) AS BIGINT) AS bytes_per_min,
          live AND s.no_progress_minutes >= 10 AS stalled,
          'complete,complete,' || CASE WHEN r.copy_phase = 'in-progress' THEN 'current,'
               WHEN landed THEN 'complete,' ELSE 'pending,' END
            || CASE WHEN r.copy_phase = 'finished' OR landed THEN 'complete,' ELSE 'pending,' END
            || CASE WHEN replication_ok AND recent_good THEN 'complete'
                    WHEN landed THEN 'current' ELSE 'pending' END AS steps,
          CAST((length(steps) - length(replace(steps, 'complete', ''))) / 8 AS BIGINT) AS completed
        FROM r JOIN stalls s USING (run_id, tick) JOIN trends t USING (run_id, tick)
          JOIN rates g USING (run_id, tick))
        """

ORACLES = {
    "scan_source": """
        SELECT l_linestatus, count(*) AS rows,
          CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS price_cents
        FROM lineitem WHERE l_quantity >= 25 AND l_returnflag = 'R' GROUP BY 1""",
    "snapshot_copy": SNAPSHOT_COPY,
    "generated_recompute": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
          CAST(round(l_extendedprice * 100) AS BIGINT)
            * (100 - CAST(round(l_discount * 100) AS BIGINT)) AS net_cents,
          l_orderkey || '-' || l_linenumber AS l_code
        FROM lineitem""",
    "copy_column_list": """
        SELECT db_id, schema_name, table_name,
          string_agg(CASE WHEN column_name = lower(column_name) THEN column_name
                          ELSE '"' || column_name || '"' END, ', '
                     ORDER BY pos, column_name) FILTER (NOT is_generated) AS columns,
          bool_and(is_generated) AS skipped
        FROM {cat_columns} GROUP BY ALL HAVING bool_or(is_generated)""",
    "cdc_apply": f"WITH {APPLIED} SELECT * FROM moved",
    "cdc_apply_counts": """
        WITH newest AS (
          SELECT c_custkey, arg_max(op, seq) AS op FROM {changes} GROUP BY 1)
        SELECT count(*) AS keys_changed,
          count(*) FILTER (c_custkey IN (SELECT c_custkey FROM {snapshot})) AS rows_deleted,
          count(*) FILTER (op <> 'D') AS rows_inserted,
          count(*) FILTER (op <> 'D' AND c_custkey NOT IN (SELECT c_custkey FROM {snapshot}))
            AS rows_new
        FROM newest""",
    "sequence_high_water": """
        SELECT 'customer' AS table_name, (SELECT max(c_custkey) FROM customer) AS source_last,
          (SELECT max(c_custkey) FROM {snapshot}) AS target_last,
          greatest((SELECT max(c_custkey) FROM customer),
                   (SELECT max(c_custkey) FROM {snapshot})) + 1 AS next_value
        UNION ALL
        SELECT 'orders', (SELECT max(o_orderkey) FROM orders),
          (SELECT max(o_orderkey) FROM {orders_target}),
          greatest((SELECT max(o_orderkey) FROM orders),
                   (SELECT max(o_orderkey) FROM {orders_target})) + 1
        UNION ALL
        SELECT 'events', (SELECT max(event_id) FROM events), NULL,
          (SELECT max(event_id) FROM events) + 1""",
    "cdc_resume_from_snapshot": f"WITH {APPLIED} SELECT * FROM moved",
    "cdc_resume_from_log": f"WITH {APPLIED} SELECT * FROM moved",
    "pending_backlog": """
        SELECT c.run_id, count(*) AS pending,
          count(*) FILTER (op = 'D') AS pending_deletes,
          min(seq) AS first_seq, max(seq) AS last_seq
        FROM {changes} c WHERE seq > (SELECT a.last_seq FROM {applied} a WHERE a.run_id = c.run_id)
        GROUP BY 1""",
    "write_fence_split": """
        SELECT run_id, seq, commit_us, c_custkey, op, EXISTS (
            SELECT 1 FROM {fences} f WHERE f.run_id = c.run_id AND c.commit_us >= f.from_us
              AND (f.to_us IS NULL OR c.commit_us < f.to_us)) AS quarantined
        FROM {changes} c""",
    "cleanup_residue": f"""
        SELECT *, triggers_left + schemas_left = 0 AS clean FROM (SELECT db_id,
          (SELECT count(*) FROM {{triggers}} t WHERE t.db_id = d.db_id
             AND trigger_name LIKE '{RESIDUE_PREFIX}%') AS triggers_left,
          (SELECT count(*) FROM {{db_schemas}} s WHERE s.db_id = d.db_id
             AND schema_name = 'audit') AS schemas_left
        FROM {{databases}} d)""",
    "tables_without_key": """
        SELECT db_id, schema_name, table_name FROM {cat_tables} t
        WHERE NOT EXISTS (SELECT 1 FROM {cat_indexes} i WHERE i.db_id = t.db_id
          AND i.schema_name = t.schema_name AND i.table_name = t.table_name
          AND (is_primary OR is_unique))""",
    "tables_without_key_public": """
        SELECT db_id, schema_name, table_name FROM {cat_tables} t
        WHERE schema_name = 'public' AND (db_id, table_name) NOT IN (
          SELECT (db_id, table_name) FROM {cat_indexes}
          WHERE schema_name = 'public' AND (is_primary OR is_unique))""",
    "key_violations": "\nUNION ALL\n".join(
        f"""
        SELECT '{name}' AS table_name, '{key}' AS key, CAST(sum(n) AS BIGINT) AS rows,
          count(*) FILTER (n > 1) AS duplicate_groups,
          CAST(COALESCE(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicate_rows,
          CAST(0 AS BIGINT) AS null_key_rows
        FROM (SELECT count(*) AS n FROM {name} GROUP BY {key})"""
        for name, key in [
            ("lineitem", "l_orderkey,l_linenumber"),
            ("lineitem", "l_orderkey,l_linenumber,l_partkey,l_suppkey"),
            ("orders", "o_orderkey"),
            ("orders", "o_custkey"),
            ("conversations", "conv_id,turn"),
            ("documents", "doc_id"),
        ]
    ),
    "candidate_keys": "\nUNION ALL\n".join(
        f"""
        SELECT '{name}' AS table_name, '{key}' AS key, CAST(sum(n) AS BIGINT) AS rows,
          CAST(coalesce(sum(n) FILTER ({' OR '.join(f'{k} IS NULL' for k in key.split(','))}), 0) AS BIGINT) AS null_key_rows,
          count(*) FILTER (n > 1 AND {' AND '.join(f'{k} IS NOT NULL' for k in key.split(','))}) = 0 AS "unique"
        FROM (SELECT {key}, count(*) AS n FROM {name} GROUP BY {key})"""
        for name, keys in CANDIDATES.items()
        for key in keys
    ),
    "preflight_gate": GATE,
    "generated_columns": GENERATED,
    "relation_size": """
        WITH sizes AS (
          SELECT 'customer' AS table_name, count(*) AS rows,
            sum(8 + strlen(c_name) + 4 + 8 + strlen(c_mktsegment)) AS bytes FROM customer
          UNION ALL SELECT 'orders', count(*),
            sum(8 + 8 + strlen(o_orderstatus) + 8 + 8 + strlen(o_orderpriority)) FROM orders
          UNION ALL SELECT 'lineitem', count(*),
            sum(24 + 4 + 32 + strlen(l_returnflag) + strlen(l_linestatus) + 8) FROM lineitem
          UNION ALL SELECT 'events', count(*),
            sum(8 + 8 + 8 + strlen(event_type) + 8 + strlen(props)) FROM events
          UNION ALL SELECT 'documents', count(*),
            sum(8 + strlen(text) + strlen(lang) + strlen(source) + 8) FROM documents
          UNION ALL SELECT 'embeddings', count(*), sum(8 + 4 * len(embedding) + 4) FROM embeddings)
        SELECT table_name, CAST(rows AS BIGINT) AS rows, CAST(bytes AS BIGINT) AS bytes FROM sizes
        UNION ALL SELECT NULL, CAST(sum(rows) AS BIGINT), CAST(sum(bytes) AS BIGINT) FROM sizes""",
    "object_diff": """
        SELECT COALESCE(s.db_id, t.db_id) AS db_id, COALESCE(s.kind, t.kind) AS kind,
          COALESCE(s.schema_name, t.schema_name) AS schema_name, COALESCE(s.name, t.name) AS name,
          CASE WHEN t.name IS NULL THEN 'only_source' WHEN s.name IS NULL THEN 'only_target'
               ELSE 'both' END AS side
        FROM {objects_source} s FULL JOIN {objects_target} t
          ON s.db_id = t.db_id AND s.kind = t.kind AND s.schema_name = t.schema_name
            AND s.name = t.name""",
    "invalid_encoding": """
        SELECT 'documents' AS table_name, 'text' AS column_name,
          count(*) FILTER (doc_id % 97 = 0) AS bad_rows,
          CAST(min(doc_id) FILTER (doc_id % 97 = 0) AS VARCHAR) AS first_key FROM documents
        UNION ALL SELECT 'pages', 'url', 0, NULL
        UNION ALL SELECT 'pages', 'html', 0, NULL""",
    "normalize_names": """
        SELECT o_orderkey AS row_id, CASE
          WHEN o_orderkey % 7 IN (0, 3) THEN 't' || o_orderkey
          WHEN o_orderkey % 7 = 1 THEN 'T' || o_orderkey
          WHEN o_orderkey % 7 = 2 THEN 'audit.t' || o_orderkey
          WHEN o_orderkey % 7 = 5 THEN 'public' || o_orderkey END AS table_name
        FROM orders""",
    "parse_status": """
        WITH told AS (SELECT *, tick % 23 <> 0 AS seen, tick % 23 <> 0 AND tick % 31 <> 0 AS counted
                      FROM {ticks})
        SELECT run_id, tick, seen AS status_seen, CASE WHEN seen THEN 'Active' END AS active,
          CASE WHEN seen THEN state_raw END AS state_raw, CASE WHEN seen THEN state END AS state,
          CASE WHEN NOT seen THEN NULL WHEN tick % 29 = 0 THEN 'Maybe'
               WHEN copy_phase = 'finished' THEN 'No' ELSE 'Yes' END AS copy_phase_raw,
          CASE WHEN NOT seen THEN NULL WHEN tick % 29 = 0 THEN 'unknown' ELSE copy_phase END
            AS copy_phase,
          CASE WHEN counted THEN rows_deleted * 1234 END AS rows_deleted,
          CASE WHEN counted THEN rows_inserted * 1234 END AS rows_inserted,
          CASE WHEN counted THEN rows_changed * 1234 END AS rows_changed,
          CASE WHEN seen THEN CAST(floor(last_good_us / 1000000.0) AS BIGINT) * 1000000 END
            AS last_good_us,
          CASE WHEN seen THEN last_error END AS last_error,
          CASE WHEN seen THEN tables_completed END AS tables_in_sync
        FROM told""",
    "normalize_state": "SELECT run_id, tick, state FROM {ticks}",
    "rows_changed": """
        SELECT run_id, tick, CASE WHEN counted THEN rows_deleted * 1234 END AS deleted,
          CASE WHEN counted THEN rows_inserted * 1234 END AS inserted,
          CASE WHEN counted THEN (rows_deleted + rows_inserted) * 1234 END AS changed
        FROM (SELECT *, tick % 23 <> 0 AND tick % 31 <> 0 AS counted FROM {ticks})""",
    "last_error_clean": "SELECT run_id, tick, last_error FROM {ticks}",
    "safe_time": """
        SELECT event_id, CASE WHEN event_id % 4 < 2
          THEN CAST(epoch(date_trunc('second', ts)) AS BIGINT) END AS epoch_s FROM events""",
    "log_completed_tables": """
        SELECT user_id AS run_id, 't' || (event_id % 13) AS table_name,
          CAST(min(event_id % 2) AS INTEGER) AS pattern_no,
          COALESCE(min(event_id) FILTER (event_id % 2 = 0), min(event_id)) AS line_no
        FROM events e WHERE event_type = 'purchase' AND (
          (user_id, table_name) IN (SELECT (run_id, table_name) FROM {known_tables})
          OR user_id NOT IN (SELECT run_id FROM {known_tables}))
        GROUP BY ALL""",
    "log_current_table": CURRENT_TABLE.replace("KNOWN", "{known_tables}"),
    "log_current_table_fallback": """
        WITH tail AS (
          SELECT user_id AS run_id, max(event_id) FILTER (event_type = 'error') AS last
          FROM events GROUP BY 1)
        SELECT t.run_id, CASE WHEN k.table_name IS NOT NULL
            OR t.run_id NOT IN (SELECT run_id FROM {known_tables}) THEN 't' || (t.last % 13)
          END AS current_table
        FROM tail t
        LEFT JOIN {known_tables} k ON k.run_id = t.run_id AND k.table_name = 't' || (t.last % 13)""",
    "filter_warnings": """
        SELECT run_id, line_no, line FROM {log_lines} WHERE line NOT LIKE 'WARNING:%'""",
    "error_digest": """
        SELECT run_id, left(array_to_string(list_reverse(max(line_parts)), ' '), 500) AS digest
        FROM (SELECT run_id, list(line ORDER BY line_no DESC)[1:20] AS line_parts
              FROM {log_lines} GROUP BY 1) GROUP BY run_id""",
    "log_tail": """
        SELECT run_id, line_no, line FROM {log_lines}
        QUALIFY rank() OVER (PARTITION BY run_id ORDER BY line_no DESC) <= 20""",
    "tables_completed": TABLES_DONE.replace("DONE_TABLES", "{remembered}"),
    "byte_progress": BYTES_DONE.replace("DONE_TABLES", "{remembered}"),
    "monotonic_progress": f"""
        WITH {LOOKS}, {COPIED}
        SELECT run_id, tick, copied_bytes, estimate_mode, percent FROM copied""",
    "history_retention": """
        SELECT run_id, tick, obs_us, raw_copied_bytes FROM {ticks}
        QUALIFY rank() OVER (PARTITION BY run_id ORDER BY tick DESC) <= 240""",
    "last_progress": f"""
        WITH {LOOKS}, {COPIED}, {MOVED_ON}
        SELECT run_id, tick, advanced, last_progress_us FROM stalls""",
    "backlog_trend": f"""
        WITH {LOOKS}, {TREND} SELECT run_id, tick, backlog_trend FROM trends""",
    "throughput_eta": f"""
        WITH {LOOKS}, {COPIED}, {RATE}
        SELECT run_id, tick, CAST(round(rate) AS BIGINT) AS bytes_per_min,
          round(rate / 1048576, 2) AS mb_per_min,
          CAST(round(greatest(total_bytes - copied_bytes, 0) / rate * CAST(0.7 AS DOUBLE))
               AS BIGINT) AS eta_min_minutes,
          CAST(round(greatest(total_bytes - copied_bytes, 0) / rate * CAST(1.3 AS DOUBLE))
               AS BIGINT) AS eta_max_minutes
        FROM rates""",
    "stall_detection": f"""
        WITH {LOOKS}, {COPIED}, {MOVED_ON}
        SELECT run_id, tick, CAST(no_progress_minutes AS DOUBLE) AS no_progress_minutes,
          no_progress_minutes >= 10 AS stalled FROM stalls""",
    "replication_delay": """
        SELECT run_id, tick,
          CAST(floor((obs_us - last_good_us) / 1000000.0) AS BIGINT) AS seconds_since_last_good,
          COALESCE(obs_us - last_good_us >= 61000000, false) AS delayed FROM {ticks}""",
    "replication_health": f"""
        WITH looks AS (SELECT * FROM {{all_looks}}), {JUDGED}
        SELECT run_id, tick, recent_good, replication_ok,
          CASE WHEN NOT replication_ok THEN 'blocked' WHEN recent_good THEN 'healthy'
               ELSE 'degraded' END AS health,
          CASE WHEN hard_blockers <> '' THEN hard_blockers
               WHEN NOT replication_ok THEN 'replication_not_healthy' END AS blocker
        FROM ready""",
    "cutover_readiness": f"""
        WITH looks AS (SELECT * FROM {{all_looks}}), {JUDGED}
        SELECT run_id, tick, readiness, readiness IN ('warning', 'ready') AS can_force,
          hard_blockers, soft_blockers FROM ready""",
    "preflight_findings": f"""
        WITH named AS ({GENERATED})
        SELECT db_id, 'generated_columns' AS finding, table_name, columns FROM named
        UNION ALL
        SELECT db_id, 'no_key', replace(schema_name || '.' || table_name, 'public.', ''), NULL
        FROM {{cat_tables}} t
        WHERE NOT EXISTS (SELECT 1 FROM {{cat_indexes}} i
          WHERE i.db_id = t.db_id AND i.schema_name = t.schema_name
            AND i.table_name = t.table_name AND (is_primary OR is_unique))""",
    "observation": f"""
        WITH {DONE_ANYWHERE},
        counted AS ({TABLES_DONE.replace("DONE_TABLES", "done")}),
        bytes AS ({BYTES_DONE.replace("DONE_TABLES", "done")}),
        current AS ({CURRENT_TABLE.replace("KNOWN", "{table_sizes}")})
        SELECT r.run_id, r.tables_in_sync, r.copy_phase, total_tables, tables_completed, total_bytes,
          copied_bytes AS raw_copied_bytes, estimate_mode AS raw_mode, current_table
        FROM {{run_status}} r LEFT JOIN counted USING (run_id) LEFT JOIN bytes USING (run_id)
          LEFT JOIN current USING (run_id)""",
    "status_record": RECORD + "SELECT * EXCLUDE (total_bytes) FROM record",
    "status_document": RECORD
    + """
        SELECT run_id, tick, phase, state, started_us, reported_state, rows_changed, last_error, readiness, percent,
          blocker_reason, bytes_per_min, stalled, split_part(steps, ',', 5) AS last_step,
          '{"copied_bytes":' || copied_bytes || ',"estimate_mode":"' || estimate_mode || '","percent":'
            || regexp_replace(CAST(percent AS VARCHAR), '\\.0$', '') || ',"total_bytes":' || total_bytes || '}' AS byte_weighted
        FROM record""",
    "progress_signals_split": f"""
        WITH {LOOKS}, {COPIED}, {MOVED_ON}, {TREND}, {RATE}
        SELECT s.run_id, s.tick, s.copied_bytes, s.estimate_mode, s.percent, s.advanced,
          s.last_progress_us, t.backlog_trend, CAST(round(rate) AS BIGINT) AS bytes_per_min,
          CAST(s.no_progress_minutes AS DOUBLE) AS no_progress_minutes,
          s.no_progress_minutes >= 10 AS stalled
        FROM stalls s JOIN trends t USING (run_id, tick) JOIN rates g USING (run_id, tick)""",
    "state_upsert": """
        WITH edges AS (SELECT run_id, min(seq) AS first_seq, max(seq) AS seq FROM {phase_log}
                       GROUP BY 1)
        SELECT e.run_id, e.first_seq, a.at_us AS started_us, e.seq, z.at_us AS updated_us,
          z.phase, z.switched_us, z.completed_us, COALESCE(z.error, '') AS error
        FROM edges e JOIN {phase_log} a ON a.run_id = e.run_id AND a.seq = e.first_seq
          JOIN {phase_log} z ON z.run_id = e.run_id AND z.seq = e.seq""",
    "auto_transition": f"""
        WITH looks AS (SELECT * FROM {{moves}}), {HEALTH},
        begun AS (
          SELECT *, phase IN ('ready_to_copy', 'starting') AND copy_phase = 'in-progress'
              AND state <> 'not-yet-started' AND persisted_phase <> 'replicating' AS began
          FROM judged)
        SELECT run_id, tick,
          CASE WHEN began THEN 'copying'
               WHEN phase = 'copying' AND copy_phase = 'finished' AND replication_ok
               THEN 'replicating' ELSE phase END AS next_phase,
          CASE WHEN began THEN 'initial_copy'
               WHEN phase = 'copying' AND copy_phase = 'finished' THEN
                 CASE WHEN replication_ok THEN 'running' ELSE 'copy_health_check_failed' END
               WHEN phase = 'copying' AND copy_phase = 'unknown' THEN 'copy_status_ambiguous'
               END AS next_state
        FROM begun""",
    "action_guard": f"""
        WITH gate AS ({GATE}), log AS (
          SELECT run_id, seq, action, COALESCE(lag(phase) OVER (PARTITION BY run_id ORDER BY seq),
            'unknown') AS phase FROM {{action_log}})
        SELECT *, CASE WHEN action = 'start' THEN phase IN ('waiting', 'unknown')
            AND run_id IN (SELECT db_id FROM gate WHERE all_tables_valid)
          ELSE (action, phase) IN (('start-copy', 'ready_to_copy'), ('switch', 'replicating'), ('retry', 'error'),
          ('abort', 'ready_to_copy'), ('abort', 'copying'), ('abort', 'replicating'),
          ('abort', 'error')) OR action = 'pause' END AS accepted FROM log""",
    "milestones": """
        WITH log AS (
          SELECT *, lag(phase) OVER (PARTITION BY run_id ORDER BY seq) AS before FROM {phase_log})
        SELECT run_id, seq, at_us, phase AS milestone, CASE phase
            WHEN 'error' THEN COALESCE(left(error, 200), 'Unknown error')
            WHEN 'ready_to_copy' THEN tables_in_sync || ' tables' END AS detail FROM log
        WHERE phase IS DISTINCT FROM before AND (phase <> 'starting' OR before IS NULL)""",
    "switch_gate": f"""
        WITH looks AS (SELECT * FROM {{requests}}), {JUDGED},
        decided AS (
          SELECT run_id, tick, CASE WHEN phase IS NULL OR phase <> 'replicating' THEN 'phase_not_allowed'
            WHEN readiness = 'blocked' THEN 'cutover_blocked'
            WHEN readiness = 'warning' AND tick % 4 IN (2, 3) THEN 'cutover_override_required'
            ELSE 'allowed' END AS decision FROM ready)
        SELECT *, CAST(CASE decision WHEN 'allowed' THEN 200 ELSE 409 END AS BIGINT) AS http_status
        FROM decided""",
    "reconcile_counts": """
        WITH n AS (
          SELECT 'customer' AS table_name, (SELECT count(*) FROM customer) AS source_rows,
            (SELECT count(*) FROM {snapshot}) AS target_rows
          UNION ALL SELECT 'orders', (SELECT count(*) FROM orders),
            (SELECT count(*) FROM {orders_target})
          UNION ALL SELECT 'lineitem', (SELECT count(*) FROM lineitem), NULL
          UNION ALL SELECT 'events', NULL, (SELECT count(*) FROM events))
        SELECT *, COALESCE(target_rows, 0) - COALESCE(source_rows, 0) AS delta FROM n""",
    "reconcile_sample": f"""
        SELECT * REPLACE (CAST(rows_missing AS BIGINT) AS rows_missing,
                          CAST(rows_extra AS BIGINT) AS rows_extra)
        FROM ({ORDER_DIFF}) WHERE {ORDER_KEY_HASH} % 4 = 0""",
    "reconcile_diff": f"""
        SELECT * REPLACE (CAST(rows_missing AS BIGINT) AS rows_missing,
                          CAST(rows_extra AS BIGINT) AS rows_extra)
        FROM ({ORDER_DIFF})""",
    "reconcile_rows": f"""
        SELECT * REPLACE (CAST(rows_missing AS BIGINT) AS rows_missing,
                          CAST(rows_extra AS BIGINT) AS rows_extra)
        FROM ({ORDER_DIFF})""",
    "reconcile_tree": f"""
        SELECT * REPLACE (CAST(rows_missing AS BIGINT) AS rows_missing,
                          CAST(rows_extra AS BIGINT) AS rows_extra)
        FROM ({ORDER_DIFF})""",
    "reconcile_fingerprint": f"""
        WITH sides AS (
          SELECT 's' AS side, {ORDER_KEY_HASH} % 256 AS bucket,
            CAST(('0x' || substr(md5({ORDER_TEXT}), 1, 12)) AS BIGINT) AS v FROM orders
          UNION ALL
          SELECT 't', {ORDER_KEY_HASH} % 256,
            CAST(('0x' || substr(md5({ORDER_TEXT}), 1, 12)) AS BIGINT) FROM {{orders_target}})
        SELECT bucket, nullif(count(*) FILTER (side = 's'), 0) AS source_rows,
          CAST(sum(v) FILTER (side = 's') AS VARCHAR) AS source_print,
          nullif(count(*) FILTER (side = 't'), 0) AS target_rows,
          CAST(sum(v) FILTER (side = 't') AS VARCHAR) AS target_print,
          source_rows IS NOT DISTINCT FROM target_rows
            AND source_print IS NOT DISTINCT FROM target_print AS equal
        FROM sides GROUP BY bucket""",
    "reconcile_after_apply": f"""
        WITH {APPLIED}
        SELECT COALESCE(c.c_custkey, m.c_custkey) AS c_custkey,
          CASE WHEN m.c_custkey IS NULL THEN 'missing' ELSE 'changed' END AS difference,
          CAST(1 AS BIGINT) AS rows_missing,
          CAST(CASE WHEN m.c_custkey IS NULL THEN 0 ELSE 1 END AS BIGINT) AS rows_extra
        FROM customer c LEFT JOIN moved m ON m.c_custkey = c.c_custkey
        WHERE m.c_custkey IS NULL OR c.c_name <> m.c_name OR c.c_nationkey <> m.c_nationkey
          OR c.c_acctbal <> m.c_acctbal
          OR c.c_mktsegment <> m.c_mktsegment""",
    "capacity_plan": """
        SELECT db_id, size_kb, size_kb * 2 AS storage_kb,
          round(size_kb / CAST(104857600 AS DOUBLE), 2) AS copy_hours,
          size_kb > 1073741824 AS needs_steady_host,
          CASE WHEN size_kb > 104857600 THEN '14 GB' WHEN size_kb >= 52428800 THEN '2.5 GB'
               WHEN row_count < 1000000 AND table_count < 20 THEN '512 MB' ELSE '1 GB' END
            AS app_tier,
          CASE WHEN size_kb < 104857600 THEN 'xlarge' WHEN size_kb <= 524288000 THEN '2xlarge'
               WHEN size_kb <= 1048576000 THEN '4xlarge' ELSE '8xlarge' END AS instance_tier
        FROM {fleet}""",
    "capacity_totals": """
        SELECT CASE WHEN size_kb > 104857600 THEN '14 GB' WHEN size_kb >= 52428800 THEN '2.5 GB'
               WHEN row_count < 1000000 AND table_count < 20 THEN '512 MB' ELSE '1 GB' END
            AS app_tier,
          CASE WHEN size_kb < 104857600 THEN 'xlarge' WHEN size_kb <= 524288000 THEN '2xlarge'
               WHEN size_kb <= 1048576000 THEN '4xlarge' ELSE '8xlarge' END AS instance_tier,
          size_kb > 1073741824 AS needs_steady_host, count(*) AS databases,
          CAST(sum(size_kb) AS BIGINT) AS size_kb, CAST(sum(size_kb * 2) AS BIGINT) AS storage_kb
        FROM {fleet} GROUP BY 1, 2, 3""",
    "balance_after_move": f"""
        WITH {APPLIED}
        SELECT n_name, count(*) AS customers,
          CAST(sum(CAST(round(c_acctbal * 100) AS BIGINT)) AS BIGINT) AS balance_cents
        FROM moved JOIN nation ON n_nationkey = c_nationkey GROUP BY n_name""",
}


def oracles() -> dict[str, str]:
    return {name: with_views(sql) for name, sql in ORACLES.items()}
