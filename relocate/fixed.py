"""Formats, word lists, patterns and limits that results depend on.

They are part of the text formats and rules this library reads and applies, so they
are stated here as they are and nowhere else.
"""

# Status block: labels and values.
LABEL_ACTIVE = "Status"
LABEL_STATE = "Current state"
LABEL_COPY = "Onetimecopy"
LABEL_ROWS = "Rows deleted/inserted"
LABEL_LAST_GOOD = "Last good"
LABEL_LAST_ERROR = "Last error"
LABEL_TABLES = "Tables in sync"

STATE_NAMES = {"No records found": "not-yet-started", "Good": "good", "Bad": "bad"}
APPLYING_WORDS = [
    "insert", "update", "delete", "truncate", "copy", "delta_check", "begin txn", "counting",
]
COPY_PHASES = {"Yes": "in-progress", "No": "finished"}

STATE_APPLYING = "applying_changes"
UNKNOWN = "unknown"
COPY_RUNNING = "in-progress"
COPY_DONE = "finished"
STATE_NOT_STARTED = "not-yet-started"

# Words and codes in results.
MODE_TABLES = "completed_tables"
MODE_SIZES = "target_size_estimate"
MODE_SIZES_HELD = "target_size_estimate_monotonic"
MODE_RATIO = "table_ratio_estimate"
TREND_UNKNOWN = "unknown"
TREND_GROWING = "growing"
TREND_SHRINKING = "shrinking"
TREND_STABLE = "stable"
HEALTHY = "healthy"
DEGRADED = "degraded"
BLOCKED = "blocked"
NOT_READY = "not_ready"
READY = "ready"
WARNING = "warning"
STATUS_UNAVAILABLE = "status_unavailable"
COPY_NOT_FINISHED = "initial_copy_not_finished"
NOT_HEALTHY = "replication_not_healthy"
STEPS = [
    "schema_copied",
    "replication_configured",
    "initial_copy_running",
    "initial_copy_complete",
    "replication_healthy",
]
STEP_COMPLETE = "complete"
STEP_CURRENT = "current"
STEP_PENDING = "pending"
STATE_INITIAL_COPY = "initial_copy"
STATE_RUNNING = "running"
STATE_CHECK_FAILED = "copy_health_check_failed"
STATE_AMBIGUOUS = "copy_status_ambiguous"
SWITCH_BLOCKED = "cutover_blocked"
SWITCH_NEEDS_OVERRIDE = "cutover_override_required"
SWITCH_WRONG_PHASE = "phase_not_allowed"
SWITCH_ALLOWED = "allowed"
HTTP_OK = 200
HTTP_CONFLICT = 409

# Log lines that name a table. The closing quote is required.
COMPLETED_PATTERNS = [
    r'(?:finished|completed|done with|copied)\s+table\s+("?[\w.]+")',
    r'table\s+("?[\w.]+")\s+(?:done|finished|completed)',
]
CURRENT_PATTERNS = [
    r'copy(?:ing)?\s+table\s+("?[\w.]+")',
    r'table\s+("?[\w.]+")\s+copy\s+started',
    r'onetimecopy.*\b("?[\w.]+")\b',
]
ANY_NAME_PATTERN = r'"?([\w.]+)"?'
HARMLESS_WARNING = r"\AWARNING:\s+no privileges (?:could be revoked|were granted) for"

# Limits.
RECENT_SYNC_SECONDS = 120
DELAY_NOTE_SECONDS = 60
STALL_MINUTES = 10
TREND_POINTS = 6
THROUGHPUT_POINTS = 20
HISTORY_POINTS = 240
ETA_LOW = 0.7
ETA_HIGH = 1.3
LOG_LINES_DEFAULT = 100
DIGEST_CHARS = 500
MILESTONE_CHARS = 200
NO_ERROR_TEXT = "Unknown error"

# Migration phases.
PHASES_BEFORE_COPY = ["starting", "configuring", "ready_to_copy"]
PHASES_AFTER_COPY = ["replicating", "switched", "cleaning_up", "completed"]
PHASES_AFTER_SCHEMA = [
    "ready_to_copy", "copying", "replicating", "switched", "cleaning_up", "completed",
]
PHASES_WITH_READINESS = ["copying", "replicating", "switched"]
# Phases in which a run that makes no progress is stalled.
LIVE_PHASES = ["copying", "replicating"]
MILESTONE_PHASES = [
    "starting", "configuring", "ready_to_copy", "copying", "replicating", "switched",
    "cleaning_up", "completed", "error",
]
# Phases in which each action is accepted; actions not named here are always accepted.
ACTION_PHASES = {
    "start": ["waiting", "unknown"],
    "start-copy": ["ready_to_copy"],
    "switch": ["replicating"],
    "retry": ["error"],
    "abort": ["configuring", "ready_to_copy", "copying", "replicating", "error"],
}
ACTION_START = "start"
FORCE_VALUES = ["1", "true", "yes"]

# Sizing.
COPY_GB_PER_HOUR = 100
STORAGE_FACTOR = 2
RESTART_LIMIT_GB = 1024
RESTART_LIMIT_HOURS = 18
APP_TIERS = [("512 MB", None), ("1 GB", 50), ("2.5 GB", 100), ("14 GB", None)]
SMALLEST_TIER_ROWS = 1_000_000
SMALLEST_TIER_TABLES = 20
INSTANCE_TIERS = [("xlarge", 100), ("2xlarge", 500), ("4xlarge", 1000), ("8xlarge", None)]

# Key words that quoting of identifiers must quote (reserved, type and column-name words).
SQL_KEYWORDS = """
all analyse analyze and any array as asc asymmetric authorization between bigint binary bit
boolean both case cast char character check coalesce collate collation column concurrently
constraint create cross current_catalog current_date current_role current_schema current_time
current_timestamp current_user dec decimal default deferrable desc distinct do else end except
exists extract false fetch float for foreign freeze from full grant greatest group grouping
having ilike in initially inner inout int integer intersect interval into is isnull join json
json_array json_arrayagg json_exists json_object json_objectagg json_query json_scalar
json_serialize json_table json_value lateral leading least left like limit localtime
localtimestamp merge_action national natural nchar none normalize not notnull null nullif numeric
offset on only or order out outer overlaps overlay placing position precision primary real
references returning right row select session_user setof similar smallint some substring
symmetric system_user table tablesample then time timestamp to trailing treat trim true union
unique user using values varchar variadic verbose when where window with xmlattributes xmlconcat
xmlelement xmlexists xmlforest xmlnamespaces xmlparse xmlpi xmlroot xmlserialize xmltable
""".split()
