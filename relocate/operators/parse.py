"""Sync status text and logs as typed rows.

A status block is read in place with regular expressions: one output row per block and no
shuffle. Logs are read line by line, once for all that is asked of them; per run and table only
the first mention survives each task, so a run with most of the lines costs no more than its tables.
"""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relocate import fixed
from relocate.functions import text as tx
from relocate.operators.ordered import latest_rows


def _label(name: str) -> str:
    return rf"(?d)^{name}[^\S\n]+:[^\S\n]+"


_COUNTS = _label(fixed.LABEL_ROWS) + r"([\d,]+)[^\S\n]+/[^\S\n]+([\d,]+)"
_ERROR = rf"(?d)^{fixed.LABEL_LAST_ERROR}[^\S\n]*:[^\S\n]*([^\n]*)$"


def _labelled(block: Column, labels: list[str]) -> Column:
    """The lines of a block that begin with one of the labels, in order: one pass over the text."""
    return _every(block, rf"(?md)^(?:{'|'.join(labels)})[^\S\n]*:[^\n]*", 0)


def _every(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _last(lines: Column, label: str, pattern: str) -> Column:
    """Of the lines that say what the pattern asks for under a label, the last."""
    start = re.split(r"[^\w /]", label)[0]  # a plain look at the start spares most lines the pattern
    return F.try_element_at(F.filter(lines, lambda x: F.startswith(x, F.lit(start)) & x.rlike(pattern)), F.lit(-1))


def _cut(line: Column, pattern: str, group: int = 1) -> Column:
    """What a group of the pattern caught; null without a line."""
    return F.when(line.isNotNull(), F.regexp_extract(line, pattern, group))


def rows_changed(block: Column) -> Column:
    """Struct ``deleted, inserted, changed`` of the last rows line; null without one."""
    line = F.try_element_at(_every(block, "(?m)" + _COUNTS, 0), F.lit(-1))
    # Bound once: a column that is used several times would be matched several times.
    rows = F.transform(F.array(line), lambda x: rows_of(_cut(x, _COUNTS, 1), _cut(x, _COUNTS, 2)))
    return F.get(rows, F.lit(0))


def rows_of(deleted_text: Column, inserted_text: Column) -> Column:
    deleted = F.coalesce(tx.count_with_commas(deleted_text), F.lit(0).cast("bigint"))
    inserted = F.coalesce(tx.count_with_commas(inserted_text), F.lit(0).cast("bigint"))
    return F.when(
        deleted_text.isNotNull(),
        F.struct(
            deleted.alias("deleted"),
            inserted.alias("inserted"),
            (deleted + inserted).alias("changed"),
        ),
    )


def last_error(lines: Column) -> Column:
    """The last error line that holds an error, of the labelled lines of a block."""
    errors = F.transform(
        F.filter(lines, lambda x: F.startswith(x, F.lit("Last error")) & x.rlike(_ERROR)),
        lambda x: tx.last_error_clean(F.regexp_extract(x, _ERROR, 1)),
    )
    return F.try_element_at(F.filter(errors, lambda e: e.isNotNull()), F.lit(-1))


def parse_status(blocks: DataFrame, block: str = "block") -> DataFrame:
    """Replace the text column by ``status_seen`` and the parsed fields.

    Blank text gives null fields. Of a repeated label the last line counts. One pass cuts the
    labelled lines out of a block; the values are read from the last line of each label, each
    projection using what the one before it found.
    """
    others = [c for c in blocks.columns if c != block]
    plain = {
        "active": fixed.LABEL_ACTIVE,
        "state_raw": fixed.LABEL_STATE,
        "copy_phase_raw": fixed.LABEL_COPY,
        "last_good_text": fixed.LABEL_LAST_GOOD,
    }
    value = r"([^\n]+)"
    count = _label(fixed.LABEL_TABLES) + r"(\d+)"
    labels = [*plain.values(), fixed.LABEL_ROWS, fixed.LABEL_LAST_ERROR, fixed.LABEL_TABLES]
    full = F.when(tx.strip(F.col(block)) != "", F.col(block))
    lines = F.col("_lines")
    cut = (
        blocks.select(*others, full.alias("_block"))
        .select(*others, F.col("_block").isNotNull().alias("status_seen"), _labelled(F.col("_block"), labels).alias("_lines"))
        .select(
            *others,
            "status_seen",
            *[_last(lines, label, _label(label) + value).alias(name) for name, label in plain.items()],
            _last(lines, fixed.LABEL_ROWS, _COUNTS).alias("_rows"),
            _last(lines, fixed.LABEL_TABLES, count).alias("_tables"),
            last_error(lines).alias("last_error"),
        )
        .select(
            *others,
            "status_seen",
            *[tx.strip(_cut(F.col(name), _label(label) + value)).alias(name) for name, label in plain.items()],
            rows_of(_cut(F.col("_rows"), _COUNTS, 1), _cut(F.col("_rows"), _COUNTS, 2)).alias("_rows"),
            _cut(F.col("_tables"), count).alias("_tables"),
            "last_error",
        )
    )
    return cut.select(
        *others,
        "status_seen",
        "active",
        "state_raw",
        tx.normalize_state(F.col("state_raw")).alias("state"),
        "copy_phase_raw",
        tx.copy_phase(F.col("copy_phase_raw")).alias("copy_phase"),
        F.col("_rows.deleted").alias("rows_deleted"),
        F.col("_rows.inserted").alias("rows_inserted"),
        F.col("_rows.changed").alias("rows_changed"),
        "last_good_text",
        F.unix_micros(tx.safe_time(F.col("last_good_text"))).alias("last_good_us"),
        "last_error",
        F.col("_tables").try_cast("bigint").alias("tables_in_sync"),
    )


# --- logs --------------------------------------------------------------------------

#: What a mention says: the table is done, it is being copied, or a word of a line that hints at it.
DONE, CURRENT, HINT = 0, 1, 2
#: A place is one number, so that folding hashes it: pattern, then line, then match.
_PLACE = "decimal(38,0)"
_PATTERN, _LINE = Decimal(10**30), Decimal(10**10)


def _packed(pattern_no: int, match_no: Column) -> Column:
    line = F.col("line_no").cast("decimal(19,0)") * F.lit(_LINE)
    return (F.lit(pattern_no * _PATTERN) + line + match_no.cast("decimal(11,0)")).cast(_PLACE)


def _mentions(kind: int, patterns: list[str]) -> Column:
    """Tables a line names, each with its place."""

    def found(number: int, pattern: str) -> Column:
        return F.transform(
            _every(F.col("line"), "(?id)" + pattern),
            lambda name, i: F.struct(
                F.lit(kind).alias("kind"),
                tx.normalize_table_name(name).alias("table_name"),
                _packed(number, i).alias("place"),
            ),
        )

    every = F.flatten(F.array(*[found(n, p) for n, p in enumerate(patterns)]))
    return F.filter(every, lambda m: m["table_name"].isNotNull())


def _hints() -> Column:
    """Words of a line that has both "table" and "copy", and one nameless entry for the line itself.

    Their places count down, so that the least one is on the last line, and on it the first one of
    a word that comes again.
    """
    line = F.col("line")
    both = line.rlike(r"(?i)\btable\b") & line.rlike(r"(?i)\bcopy\b")

    def entry(name: Column, i: Column) -> Column:
        place = (i.cast("decimal(11,0)") - _packed(0, F.lit(0))).cast(_PLACE)
        return F.struct(F.lit(HINT).alias("kind"), name.alias("table_name"), place.alias("place"))

    names = F.transform(
        _every(line, fixed.ANY_NAME_PATTERN), lambda name, i: entry(tx.normalize_table_name(name), i)
    )
    named = F.filter(names, lambda m: m["table_name"].isNotNull())
    nameless = F.array(entry(F.lit(None).cast("string"), F.lit(int(_LINE) - 1)))
    return F.when(both, F.concat(nameless, named)).otherwise(F.slice(nameless, 1, 0))


def fold_log(lines: DataFrame, done: bool = True, current: bool = True, every_run: bool = False) -> DataFrame:
    """First mentions of a log in one pass: ``run_id, kind, table_name, place``, the least place of each.

    Only lines that mention something become rows; with ``every_run`` the others become one row of
    no kind, and each run keeps one. Rows are folded in each task by hashing.
    """
    parts = ([_mentions(DONE, fixed.COMPLETED_PATTERNS)] if done else []) + (
        [_mentions(CURRENT, fixed.CURRENT_PATTERNS), _hints()] if current else []
    )
    said = F.concat(*parts)
    mentions = F.explode_outer(said) if every_run else F.explode(said)
    rows = lines.select("run_id", mentions.alias("_m"))
    return rows.groupBy(
        "run_id", F.col("_m.kind").alias("kind"), F.col("_m.table_name").alias("table_name")
    ).agg(F.min("_m.place").alias("place"))


def _unpacked(place: Column, patterns: int) -> dict[str, Column]:
    """Pattern, line and match of a place, in whole numbers."""
    pattern = sum(((place >= F.lit(k * _PATTERN)).cast("int") for k in range(1, patterns)), F.lit(0))
    rest = (place - pattern.cast("decimal(2,0)") * F.lit(_PATTERN)).cast(_PLACE)
    return {"pattern_no": pattern, "line_no": _whole_lines(rest), "match_no": (rest % F.lit(_LINE)).cast("int")}


def _whole_lines(place: Column) -> Column:
    return ((place - place % F.lit(_LINE)) / F.lit(_LINE)).cast("bigint")


def _of_known(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Add ``_counts``: the table is on its run's list, or the run has no list."""
    names = known.select("run_id", "table_name").distinct().withColumn("_known", F.lit(True))
    runs = known.select("run_id").distinct().withColumn("_list", F.lit(True))
    marked = rows.join(names, ["run_id", "table_name"], "left").join(runs, "run_id", "left")
    counts = F.col("table_name").isNotNull() & (F.col("_known").isNotNull() | F.col("_list").isNull())
    return marked.withColumn("_counts", counts).drop("_known", "_list")


def completed_of(folded: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Tables that a folded log reports as copied, once each, with the place that orders them."""
    firsts = folded.filter(F.col("kind") == DONE)
    if known is not None:
        firsts = _of_known(firsts, known).filter("_counts")
    places = [c.alias(n) for n, c in _unpacked(F.col("place"), len(fixed.COMPLETED_PATTERNS)).items()]
    return firsts.select("run_id", "table_name", *places)


def current_of(folded: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The table each run of a folded log is copying, or null.

    The last table in the order of first mentions; failing that, the last known word of the last
    line that has both words "table" and "copy".
    """
    rows = folded.withColumn("_counts", F.col("table_name").isNotNull())
    if known is not None:
        rows = _of_known(folded, known)
    # Rows of a run: its tables and the words of its hinting lines, not the lines.
    line = _whole_lines(F.lit(_LINE) - 1 - F.col("place"))
    newest_hint = F.max(F.when(F.col("kind") == HINT, line)).over(Window.partitionBy("run_id"))
    on_it = F.col("_counts") & (F.col("kind") == HINT) & (line == newest_hint)
    word = (F.col("place") + line.cast("decimal(19,0)") * F.lit(_LINE)).cast(_PLACE)
    rank = F.when(F.col("_counts") & (F.col("kind") == CURRENT), (F.col("place") + F.lit(_LINE)).cast(_PLACE))
    rank = rank.when(on_it, word)
    last = Window.partitionBy("run_id").orderBy(F.col("_rank").desc_nulls_last())
    ranked = rows.withColumn("_rank", rank).withColumn("_n", F.row_number().over(last))
    chosen = F.when(F.col("_rank").isNotNull(), F.col("table_name")).alias("current_table")
    return ranked.filter("_n = 1").select("run_id", chosen)


def log_completed_tables(lines: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Tables a log reports as copied, once each, with the place that orders them.

    With ``known`` (``run_id, table_name``), only those tables count, in runs that have a list.
    """
    return completed_of(fold_log(lines, current=False), known)


def log_current_table(lines: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """The table each run is copying, or null: one row per run in the log; see :func:`current_of`."""
    return current_of(fold_log(lines, done=False, every_run=True), known)


def filter_warnings(lines: DataFrame) -> DataFrame:
    return lines.filter(~tx.is_harmless_warning(F.col("line")))


def log_tail(lines: DataFrame, n: int = fixed.LOG_LINES_DEFAULT) -> DataFrame:
    """The last ``n`` lines of each run."""
    return latest_rows(lines, ["run_id"], "line_no", n)


def error_digest(
    lines: DataFrame, k: int = 5, max_chars: int | None = fixed.DIGEST_CHARS
) -> DataFrame:
    """The last ``k`` lines of each run joined by blanks, cut to ``max_chars`` unless None."""
    last = latest_rows(lines, ["run_id"], "line_no", k)
    in_order = F.sort_array(F.collect_list(F.struct("line_no", "line")))["line"]
    text = F.array_join(in_order, " ")
    digest = text if max_chars is None else F.substring(text, 1, max_chars)
    return last.groupBy("run_id").agg(digest.alias("digest"))
