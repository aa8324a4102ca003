"""Times: parsing of mixed spellings, whole days, ISO weeks, dates in prose."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse(text: Column) -> Column:
    """ISO time with any offset, in UTC where it has none; null for anything else. Needs a session in UTC."""
    return F.trim(text).try_cast("timestamp")


# Fields that may tell when a record was, in order; those that hold no times are asked too and never tell any.
TIME_FIELDS = (
    "last_seen_at", "updated_at", "fetched_at", "collected_at", "generated_at", "first_seen_at", "detail_fetch_status", "last_detail_attempt_at", "last_detail_success_at", "last_detail_error_type", "current_run_data_reused",
    "detail_parse_method", "semantic_content_hash", "extraction_change_status", "change_reason",
)


def record_time(columns: list[str]) -> Column:
    """The time of a record: the first of ``TIME_FIELDS`` that can be read, of those that the table has."""
    return first_parsable(*[F.col(c).cast("string") for c in TIME_FIELDS if c in columns], F.lit(None).cast("string"))


def first_parsable(*texts: Column) -> Column:
    return F.coalesce(*[parse(t) for t in texts])


def days_between(start: Column, end: Column) -> Column:
    """Whole days that have passed, at least 0; 0 if either time is missing (not calendar days)."""
    passed = F.floor((F.unix_timestamp(end) - F.unix_timestamp(start)) / 86_400)
    return F.greatest(F.lit(0), F.coalesce(passed, F.lit(0))).cast("long")


def iso_week(time: Column) -> Column:
    return F.concat(F.extract(F.lit("YEAROFWEEK"), time).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(time).cast("string"), 2, "0"))


MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"


def date_in_prose(text: Column) -> Column:
    """The first ``Month d, yyyy`` of a text as a date; null if there is none or it isn't in the calendar."""
    found = F.regexp_extract(F.coalesce(text, F.lit("")), rf"\b((?:{MONTHS}) \d{{1,2}}, \d{{4}})\b", 1)
    return F.to_date(F.try_to_timestamp(F.nullif(found, F.lit("")), F.lit("MMMM d, yyyy")))
