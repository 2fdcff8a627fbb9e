"""Inputs of the registered queries, derived from the driver's tables.

Each derived view is one SQL text that both engines run. ``us(x)`` stands for epoch micros
of a timestamp. Views that only Spark renders (status text, broken bytes) are functions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relocate.sources.tables import zoned

BASE = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

RESIDUE_PREFIX = "syncer_"

#: Columns, joined by commas, that may identify the rows of a table.
CANDIDATES = {
    "lineitem": ["l_orderkey", "l_partkey", "l_orderkey,l_linenumber", "l_partkey,l_suppkey", "l_orderkey,l_partkey"],
    "orders": ["o_orderkey", "o_custkey", "o_custkey,o_orderdate", "o_totalprice"],
    "events": ["event_id", "user_id", "ts", "user_id,ts"],
}

VIEWS = {
    # The target as first copied; missing keys make later inserts real.
    "snapshot": "SELECT * FROM {customer} WHERE c_custkey % 7 <> 0",
    # A change log with full row images.
    "changes": """
        SELECT e.event_id AS seq, us(e.ts) AS commit_us, e.user_id % 10 AS run_id,
               e.user_id AS c_custkey, c.c_name, c.c_nationkey, e.value AS c_acctbal,
               c.c_mktsegment,
               CASE e.event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END AS op
        FROM {events} e JOIN {customer} c ON c.c_custkey = e.user_id""",
    # One observation per run and hour: few rows, however many events they come from.
    "ticks": """
        WITH a AS (
          SELECT user_id AS run_id, date_trunc('hour', ts) AS h, max(event_id) AS last_id,
            max(us(ts)) AS max_us,
            max(CASE WHEN event_type <> 'error' THEN us(ts) END) AS last_good_us,
            sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS rows_deleted,
            sum(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) AS rows_inserted,
            sum(CAST(round(value * 100) AS BIGINT)) * 1000 AS step
          FROM {events} GROUP BY 1, 2),
        b AS (SELECT *, sum(step) OVER (PARTITION BY run_id ORDER BY max_us) AS cum,
                     sum(step) OVER (PARTITION BY run_id) AS total FROM a)
        SELECT run_id, CAST(last_id AS BIGINT) AS tick,
          max_us + (last_id % 300) * 1000000 AS obs_us, last_good_us,
          CAST(rows_deleted AS BIGINT) AS rows_deleted,
          CAST(rows_inserted AS BIGINT) AS rows_inserted,
          CAST(rows_deleted + rows_inserted AS BIGINT) AS rows_changed,
          CAST(total AS BIGINT) AS total_bytes,
          CAST(CASE WHEN last_id % 6 = 0 AND cum > 2 * step THEN cum - 2 * step ELSE cum END
               AS BIGINT) AS raw_copied_bytes,
          CASE WHEN 2 * cum < total AND last_id % 4 <> 0 THEN 'target_size_estimate'
               ELSE 'completed_tables' END AS raw_mode,
          CASE WHEN 2 * cum < total THEN 'in-progress' ELSE 'finished' END AS copy_phase,
          CASE WHEN 2 * cum < total THEN 'copying' ELSE 'replicating' END AS phase,
          CASE last_id % 5 WHEN 0 THEN 'Good' WHEN 1 THEN 'Bad' WHEN 2 THEN 'No records found'
                           WHEN 3 THEN 'insert public.t1' ELSE 'Syncing' END AS state_raw,
          CASE last_id % 5 WHEN 0 THEN 'good' WHEN 1 THEN 'bad' WHEN 2 THEN 'not-yet-started'
                           WHEN 3 THEN 'applying_changes' ELSE 'unknown' END AS state,
          CASE WHEN rows_deleted > 0
               THEN concat('Ended (CTL ', CAST(last_id AS STRING), ')') END AS last_error,
          CAST(floor(cum * 12.0 / total) AS BIGINT) AS tables_completed,
          CAST(12 AS BIGINT) AS total_tables,
          TRUE AS status_seen
        FROM b""",
    # Log text in every form that names a table; t0 to t11 are known, t12 is not. Some runs only
    # name tables in errors.
    "log_lines": """
        SELECT user_id AS run_id, event_id AS line_no, CASE event_type
          WHEN 'click' THEN CASE
            WHEN user_id % 7 = 2 THEN 'copying goes on'
            WHEN event_id % 3 = 0
            THEN concat('copying table "public.t', CAST(event_id % 13 AS STRING), '" now')
            WHEN event_id % 3 = 1
            THEN concat('table "t', CAST(event_id % 13 AS STRING), '" copy started')
            ELSE concat('onetimecopy: at t', CAST(event_id % 13 AS STRING), '"rows') END
          WHEN 'purchase' THEN CASE WHEN event_id % 2 = 0
            THEN concat('finished table "t', CAST(event_id % 13 AS STRING), '" ok')
            ELSE concat('table "t', CAST(event_id % 13 AS STRING), '" done') END
          WHEN 'view' THEN 'onetimecopy: waiting'
          WHEN 'signup' THEN 'WARNING:  no privileges could be revoked for "x"'
          ELSE concat('ERROR: copy failed for table t', CAST(event_id % 13 AS STRING)) END AS line
        FROM {events}""",
    # Whole logs in which no line names a table outright, for the fallback rule.
    "vague_lines": """
        SELECT run_id, line_no, CASE WHEN line LIKE 'ERROR%' OR line LIKE 'WARNING%' THEN line
            ELSE 'copying goes on' END AS line
        FROM {log_lines}""",
    "known_tables": """
        SELECT DISTINCT user_id AS run_id, concat('t', CAST(event_id % 12 AS STRING)) AS table_name
        FROM {events} WHERE user_id % 17 <> 4""",
    "phase_log": """
        SELECT user_id AS run_id, event_id AS seq, us(ts) AS at_us,
          CASE event_type WHEN 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'starting'
                 ELSE 'ready_to_copy' END
               WHEN 'view' THEN 'copying' WHEN 'click' THEN 'replicating'
               WHEN 'purchase' THEN 'switched' ELSE 'error' END AS phase,
          CASE WHEN event_id % 3 > 0 THEN event_id % 40 END AS tables_in_sync,
          CAST(NULL AS BIGINT) AS started_us,
          CASE WHEN event_type = 'purchase' THEN us(ts) END AS switched_us,
          CASE WHEN event_type = 'error' THEN us(ts) END AS completed_us,
          CASE WHEN event_type = 'error' AND event_id % 4 > 0
               THEN concat(props, ' ', repeat('x', 250)) END AS error
        FROM {events}""",
    "action_log": """
        SELECT user_id AS run_id, event_id AS seq, us(ts) AS at_us,
          CASE event_id % 6 WHEN 0 THEN 'start' WHEN 1 THEN 'start-copy' WHEN 2 THEN 'switch'
               WHEN 3 THEN 'retry' WHEN 4 THEN 'abort' ELSE 'pause' END AS action,
          CASE event_type WHEN 'signup' THEN 'ready_to_copy' WHEN 'view' THEN 'copying'
               WHEN 'click' THEN 'replicating' WHEN 'purchase' THEN 'waiting'
               ELSE 'error' END AS phase
        FROM {events}""",
    # Write fences: every ten days per run, some overlapping, some still up.
    "fences": """
        WITH w AS (
          SELECT user_id % 10 AS run_id, CAST(floor(us(ts) / 864000000000.0) AS BIGINT) AS part,
                 min(us(ts)) + 21600000000 AS from_us
          FROM {events} GROUP BY 1, 2)
        SELECT run_id, from_us,
          CASE WHEN run_id % 5 = 0 AND part % 4 = 3 THEN NULL
               WHEN run_id % 3 = 0 THEN from_us + 1036800000000
               ELSE from_us + 172800000000 END AS to_us
        FROM w""",
    "applied": """
        SELECT run_id, CAST(floor(max(seq) * 0.8) AS BIGINT) AS last_seq FROM {changes}
        GROUP BY run_id""",
    "orders_target": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
          CASE WHEN o_orderkey % 53 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
          o_orderdate, o_orderpriority FROM {orders} WHERE o_orderkey % 101 <> 0
        UNION ALL
        SELECT o_orderkey + 10000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
          o_orderpriority FROM {orders} WHERE o_orderkey % 211 = 0""",
    "fleet": """
        SELECT o_custkey AS db_id,
          CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) * 2 AS size_kb,
          count(*) * 100000 AS row_count, count(*) AS table_count
        FROM {orders} GROUP BY 1""",
    "table_sizes": """
        SELECT user_id AS run_id, concat('t', CAST(event_id % 12 AS STRING)) AS table_name,
          CAST(sum(CAST(round(value * 100) AS BIGINT)) * 1000 AS BIGINT) AS source_bytes,
          CAST(sum(CASE WHEN event_id % 5 <> 0 AND user_id % 11 <> 3
                   THEN CAST(round(value * 100) AS BIGINT)
                        * (CASE WHEN event_id % 2 = 0 THEN 2 ELSE 1 END)
                   ELSE 0 END) * 1000 AS BIGINT) AS target_bytes
        FROM {events} WHERE user_id % 13 <> 5 GROUP BY 1, 2""",
    # What the last status of each run said; some runs have none, others no sizes or no list.
    "run_status": """
        SELECT user_id AS run_id, CAST(user_id % 15 AS BIGINT) AS tables_in_sync,
          CASE user_id % 3 WHEN 0 THEN 'finished' WHEN 1 THEN 'in-progress'
               ELSE 'unknown' END AS copy_phase
        FROM {events} WHERE user_id % 19 <> 6 GROUP BY user_id""",
    # Tables remembered as done; some runs remember none.
    "remembered": """
        SELECT DISTINCT user_id AS run_id, concat('t', CAST(event_id % 12 AS STRING)) AS table_name
        FROM {events} WHERE event_type = 'purchase' AND user_id % 11 <> 3""",
    # One table per order; some public ones have a twin of the same name in another schema.
    "cat_tables": """
        SELECT o_custkey AS db_id,
          CASE WHEN o_orderkey % 11 = 0 THEN 'audit' ELSE 'public' END AS schema_name,
          concat('t', CAST(o_orderkey AS STRING)) AS table_name FROM {orders}
        UNION ALL
        SELECT o_custkey, 'audit', concat('t', CAST(o_orderkey AS STRING)) FROM {orders}
        WHERE o_orderkey % 5 = 0 AND o_orderkey % 11 <> 0""",
    # Often only one of two twins has a key.
    "cat_indexes": """
        SELECT o_custkey AS db_id,
          CASE WHEN o_orderkey % 11 = 0 THEN 'audit' ELSE 'public' END AS schema_name,
          concat('t', CAST(o_orderkey AS STRING)) AS table_name,
          o_orderstatus = 'F' AS is_primary, o_orderstatus IN ('F', 'O') AS is_unique
        FROM {orders} WHERE o_orderkey % 3 <> 0
        UNION ALL
        SELECT o_custkey, 'audit', concat('t', CAST(o_orderkey AS STRING)), true, true FROM {orders}
        WHERE o_orderkey % 5 = 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 2 = 0""",
    "cat_columns": """
        SELECT o.o_custkey AS db_id,
          CASE WHEN o.o_orderkey % 11 = 0 THEN 'audit' ELSE 'public' END AS schema_name,
          concat('t', CAST(l.l_orderkey AS STRING)) AS table_name,
          l.l_linenumber * CAST(1000000000 AS BIGINT) + l.l_partkey AS pos,
          concat(CASE WHEN l.l_partkey % 10 = 0 THEN 'C' ELSE 'c' END,
                 CAST(l.l_partkey AS STRING)) AS column_name,
          l.l_returnflag = 'A' AND l.l_linestatus = 'F' AS is_generated
        FROM {lineitem} l JOIN {orders} o ON o.o_orderkey = l.l_orderkey""",
    "objects_source": """
        SELECT o_custkey AS db_id, CASE o_orderkey % 5 WHEN 0 THEN 'function' WHEN 1 THEN 'view'
            WHEN 2 THEN 'sequence' WHEN 3 THEN 'generated_column' ELSE 'extension' END AS kind,
          CASE WHEN o_orderkey % 11 = 0 THEN 'audit' ELSE 'public' END AS schema_name,
          concat('o', CAST(o_orderkey AS STRING)) AS name FROM {orders}""",
    "objects_target": """
        SELECT * FROM {objects_source} WHERE CAST(substr(name, 2) AS BIGINT) % 13 <> 0
        UNION ALL
        SELECT db_id, kind, schema_name, concat('x', substr(name, 2)) FROM {objects_source}
        WHERE CAST(substr(name, 2) AS BIGINT) % 17 = 0
        UNION ALL
        SELECT db_id, kind, 'staging', name FROM {objects_source}
        WHERE CAST(substr(name, 2) AS BIGINT) % 13 = 0""",
    "triggers": f"""
        SELECT o_custkey AS db_id,
          concat(CASE o_orderkey % 5 WHEN 0 THEN '{RESIDUE_PREFIX}'
                 WHEN 1 THEN '{RESIDUE_PREFIX[:-1]}X' ELSE 'app_' END,
                 CAST(o_orderkey AS STRING)) AS trigger_name
        FROM {{orders}}""",
    "databases": "SELECT c_custkey AS db_id FROM {customer}",
    "db_schemas": """
        SELECT o_custkey AS db_id, CASE WHEN o_orderkey % 11 = 0 THEN 'audit' ELSE 'public' END
          AS schema_name FROM {orders} GROUP BY 1, 2""",
    "raw_names": """
        SELECT o_orderkey AS row_id, CASE o_orderkey % 7
          WHEN 0 THEN concat('"public.t', CAST(o_orderkey AS STRING), '"')
          WHEN 1 THEN concat('  PUBLIC.T', CAST(o_orderkey AS STRING), ' ')
          WHEN 2 THEN concat('audit.t', CAST(o_orderkey AS STRING))
          WHEN 3 THEN concat('""t', CAST(o_orderkey AS STRING), '"')
          WHEN 4 THEN '""'
          WHEN 5 THEN concat('public', CAST(o_orderkey AS STRING))
          END AS raw_name
        FROM {orders}""",
    # Looks in every phase, some without a status, some with a copy that runs on while replicating.
    "all_looks": """
        SELECT run_id, tick, obs_us, tick % 7 <> 3 AS status_seen,
          CASE WHEN tick % 7 <> 3 THEN state END AS state,
          CASE WHEN tick % 7 <> 3 THEN CASE WHEN tick % 13 = 5 THEN 'in-progress'
               WHEN tick % 17 = 4 THEN 'unknown' ELSE copy_phase END END AS copy_phase,
          CASE WHEN tick % 7 <> 3 THEN last_good_us END AS last_good_us,
          CASE WHEN tick % 7 <> 3 THEN last_error END AS last_error,
          CASE WHEN tick % 101 = 7 THEN NULL WHEN tick % 9 = 1 THEN 'waiting'
               WHEN tick % 9 = 2 THEN 'switched' WHEN tick % 9 = 3 THEN 'error'
               WHEN tick % 9 = 4 AND tick % 2 = 0 THEN 'completed' WHEN tick % 9 = 5 THEN 'copying'
               ELSE phase END AS phase
        FROM {ticks}""",
    "requests": """
        SELECT *, CASE tick % 4 WHEN 0 THEN '1' WHEN 1 THEN 'YES' WHEN 2 THEN 'no' END AS force
        FROM {all_looks}""",
    "moves": """
        SELECT run_id, tick, obs_us, state, status_seen, last_good_us, last_error,
          CASE WHEN tick % 17 = 0 THEN 'unknown' ELSE copy_phase END AS copy_phase,
          CASE tick % 4 WHEN 0 THEN 'ready_to_copy' WHEN 1 THEN 'starting' WHEN 2 THEN 'copying'
               ELSE phase END AS phase,
          CASE WHEN tick % 7 = 0 THEN 'replicating' ELSE 'configuring' END AS persisted_phase
        FROM {ticks}""",
}


def references(sql: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", sql)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return zoned(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table or a derived view as a DataFrame."""
    if name in BASE:
        return table(spark, sf_dir, name)
    sql = re.sub(r"\bus\(([\w.]+)\)", r"unix_micros(\1)", VIEWS[name])
    return spark.sql(sql, **{r: view(spark, sf_dir, r) for r in references(sql)})


def with_views(sql: str) -> str:
    """DuckDB text of a query over views written as ``{name}``."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in references(text):
            if name not in BASE and name not in ordered:
                visit(VIEWS[name])
                ordered.append(name)

    visit(sql)
    body = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in ordered)
    own = sql.lstrip()
    if not ordered:
        whole = own
    elif own.startswith("WITH"):
        whole = f"WITH {body},\n{own.removeprefix('WITH').lstrip()}"
    else:
        whole = f"WITH {body}\n{own}"
    whole = re.sub(r"\bus\(([\w.]+)\)", r"epoch_us(\1)", whole)
    return re.sub(r"\{(\w+)\}", r"\1", whole)


def status_text(ticks: DataFrame, odd: bool = False) -> DataFrame:
    """Each tick as the text block a sync prints; rows come times 1,234 to need separators.

    With ``odd`` some looks got no text, some an unknown copy phase and some no rows line.
    """
    micros = F.timestamp_micros("last_good_us")
    good = F.concat(
        F.lit("Last good                : "),
        F.date_format(micros, "MMM dd, yyyy HH:mm:ss"),
        F.lit(" (time to run: 2s)"),
    )

    def thousand(name: str):
        return F.format_number(F.col(name) * 1234, 0)

    block = F.concat_ws(
        "\n",
        F.lit("=" * 70),
        F.lit("Sync name                : main"),
        F.concat(F.lit("Current state            : "), "state_raw"),
        F.lit("Source relgroup/database : main / source"),
        F.concat(F.lit("Tables in sync           : "), F.col("tables_completed").cast("string")),
        F.lit("Status                   : Active"),
        F.concat(
            F.lit("Onetimecopy              : "),
            F.when(F.lit(odd) & (F.col("tick") % 29 == 0), "Maybe")
            .when(F.col("copy_phase") == "in-progress", "Yes")
            .otherwise("No"),
        ),
        F.when(
            ~(F.lit(odd) & (F.col("tick") % 31 == 0)),
            F.concat(
                F.lit("Rows deleted/inserted    : "),
                thousand("rows_deleted"),
                F.lit(" / "),
                thousand("rows_inserted"),
            ),
        ),
        good,
        F.concat(F.lit("Last error:              : "), F.coalesce("last_error", F.lit(""))),
        F.lit("=" * 70),
    )
    kept = ["run_id", "tick", "obs_us", "phase", "raw_copied_bytes", "raw_mode", "total_bytes",
            "total_tables", "tables_completed"]
    if odd:
        block = F.when(F.col("tick") % 23 == 0, F.when(F.col("tick") % 2 == 0, " \n")).otherwise(block)
    return ticks.select(*kept, block.alias("block"))


def broken_text(documents: DataFrame) -> DataFrame:
    """Documents as bytes, some ending in a stray lead byte."""
    raw = F.col("text").cast("binary")
    broken = F.when(F.col("doc_id") % 97 == 0, F.concat(raw, F.lit(b"\xe9"))).otherwise(raw)
    return documents.select("doc_id", broken.alias("text"))
