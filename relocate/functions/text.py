"""Cleaning and reading of names, states, counts and times held in text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from relocate import fixed

BLANKS = "\t\n\u000b\f\r \u0000"


def strip(text: Column) -> Column:
    """Drop blanks, tabs and line ends at both ends."""
    return F.btrim(text, F.lit(BLANKS))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def normalize_table_name(name: Column) -> Column:
    """Bare table name: no outer quotes, no leading ``public.``; null when nothing is left."""
    bare = F.regexp_replace(strip(name), r'\A"+|"+\z', "")
    return blank_to_null(F.regexp_replace(bare, r"(?i)\Apublic\.", ""))


def quote_ident(name: Column) -> Column:
    """An identifier as SQL text, quoted unless it is plain lower case and no key word."""
    quoted = F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))
    plain = name.rlike(r"\A[a-z_][a-z0-9_]*\z") & ~name.isin(fixed.SQL_KEYWORDS)
    return F.when(plain, name).otherwise(quoted)


def is_user_schema(schema: Column, replicator_schema: str | None = None) -> Column:
    """Not a system schema, nor the one a replicator keeps for itself."""
    user = (schema != "information_schema") & ~schema.startswith("pg_")
    return user & (schema != replicator_schema) if replicator_schema else user


def normalize_state(raw: Column) -> Column:
    """One word for the state a sync reports."""
    applying = F.lower(raw).rlike(r"\A(" + "|".join(fixed.APPLYING_WORDS) + r")\b")
    chain = F.when(raw.isNull(), F.lit(None).cast("string"))
    for reported, state in fixed.STATE_NAMES.items():
        chain = chain.when(raw == reported, state)
    return chain.when(applying, fixed.STATE_APPLYING).otherwise(fixed.UNKNOWN)


def copy_phase(raw: Column) -> Column:
    """Initial copy phase: in-progress, finished or unknown."""
    chain = F.when(raw.isNull(), F.lit(None).cast("string"))
    for reported, phase in fixed.COPY_PHASES.items():
        chain = chain.when(raw == reported, phase)
    return chain.otherwise(fixed.UNKNOWN)


def count_with_commas(text: Column) -> Column:
    return F.replace(text, F.lit(",")).try_cast("bigint")


def last_error_clean(raw: Column) -> Column:
    """Error text without the placeholder colons; null when there is no error."""
    return blank_to_null(strip(F.regexp_replace(strip(raw), r"\A:+\s*", "")))


def safe_time(text: Column) -> Column:
    """``Jan 01, 2025 00:00:00 …`` or an ISO date-time as a timestamp; anything else is null."""
    value = strip(text)
    named = F.regexp_extract(value, r"\A([A-Za-z]{3} \d{1,2}, \d{4} \d{2}:\d{2}:\d{2})", 1)
    iso = F.when(value.rlike(r"\A\d{4}-\d{1,2}-\d{1,2}"), value)
    return F.coalesce(
        F.try_to_timestamp(blank_to_null(named), F.lit("MMM d, yyyy HH:mm:ss")),
        F.try_to_timestamp(iso),
    )


def is_harmless_warning(line: Column) -> Column:
    return line.rlike(fixed.HARMLESS_WARNING)
