"""What a summary is told of its sources, what is kept of each generation, and the checks of counts and of what may be shown."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from recordwatch.functions.text import has_secret
from recordwatch.functions.times import iso_week
from recordwatch.operators.aggregates import change_reading
from recordwatch.operators.rules import row_rules

# States of a generation in which the service was asked, and the kind of error that others stand for.
CALLED = ("generated", "validation_failed", "api_error")
ERROR_OF = {"sdk_missing": "ImportError", "validation_failed": "validation_failed", "skipped_invalid_provider": "invalid_provider"}
# Names of columns that may not leave the engine, of items and of usage.
FORBIDDEN_ITEM, FORBIDDEN_USAGE = ("html", "raw_html", "api_key", "smtp_password", "token"), ("api_key", "openai_api_key", "smtp_password", "prompt", "response", "cost")
COUNTS = ("new_items", "changed_items", "baseline_items", "unchanged_items")
REFERENCES = ("invalid_record_ids_removed", "invalid_urls_removed", "missing_record_ids_repaired", "missing_urls_repaired", "key_points_removed_without_sources")
USAGE = (
    "generated_at", "week_id", "enabled", "api_called", "provider", "model", "status", "validation_status", "input_records_before_dedup", "input_records_after_dedup", "duplicate_records_removed", "unique_source_urls",
    "raw_candidate_records", "records_after_url_dedup", "final_core_input_records", "final_core_unique_urls", "reused_historical_records", *REFERENCES, "reference_alignment_status", "prompt_tokens", "completion_tokens",
    "total_tokens", "latency_ms", "error_type",
)


def _filled(*values: Column) -> Column:
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in values])


def context(status: DataFrame, quality: DataFrame, records: DataFrame) -> DataFrame:
    """One row for each source that any of three tables knows: its name, page, counts, level and quality, and what its counts mean.

    ``status`` and ``quality`` have a row for each ``source_id``; of ``records`` (with ``pos``) the first of a source fills what both lack.
    """
    told = {c: F.first(c).alias(f"r_{c}") for c in ("source_name", "extracted_level", "source_quality")}
    first = records.filter(F.coalesce("source_id", F.lit("")) != "").groupBy("source_id").agg(F.min_by(F.struct(*told), "pos").alias("r"))
    s = status.select("source_id", F.struct(*[c for c in status.columns if c != "source_id"]).alias("s"))
    q = quality.select("source_id", F.struct(*[c for c in quality.columns if c != "source_id"]).alias("q"))
    all_of = s.join(q, "source_id", "full_outer").join(first, "source_id", "full_outer")
    of = lambda side, c: F.col(f"{side}.{c}") if c in {"s": status, "q": quality}[side].columns else F.lit(None).cast("string")
    counts = {c: F.coalesce(of("s", c).cast("long"), F.lit(0)) for c in COUNTS}
    page = _filled(of("s", "change_status"), of("q", "change_status"), F.lit("unknown"))
    reading = change_reading(counts["new_items"], counts["changed_items"], counts["baseline_items"], page == "changed", (page == "unchanged").cast("int"))
    pick = lambda c, r: _filled(of("s", c), of("q", c), F.col(f"r.{r}"), F.lit("unknown"))
    return all_of.select(
        "source_id", _filled(of("s", "source_name"), of("q", "source_name"), F.col("r.source_name"), F.col("source_id")).alias("source_name"), _filled(of("s", "health_status"), of("q", "health_status"), F.lit("unknown")).alias("page_status"),
        page.alias("page_change_status"), *[c.alias(k) for k, c in counts.items()], pick("dominant_extracted_level", "extracted_level").alias("extracted_level"), pick("dominant_source_quality", "source_quality").alias("source_quality"), reading.alias("reading"),
    )


def audit(runs: DataFrame) -> DataFrame:
    """Generations with what follows from their state: whether the service was asked, the kind of error, and counts that default to the records put in.

    ``runs``: ``run_id, generated_at, status, input_records, errors`` and whichever of the other columns of ``USAGE`` there are.
    """
    has, given = set(runs.columns), F.col("input_records").cast("long")
    own = lambda c, kind="long": (F.col(c) if c in has else F.lit(None)).cast(kind)
    before, after = F.coalesce(own("input_records_before_dedup"), given), F.coalesce(own("input_records_after_dedup"), given)
    error = F.when(F.col("status") == "api_error", F.get("errors", F.lit(0))).otherwise(reduce(lambda out, x: F.when(F.col("status") == x[0], x[1]).otherwise(out), ERROR_OF.items(), F.lit(None).cast("string")))
    counts = {
        "input_records_before_dedup": before, "input_records_after_dedup": after, "duplicate_records_removed": F.coalesce(own("duplicate_records_removed"), before - after), "raw_candidate_records": F.coalesce(own("raw_candidate_records"), before),
        "records_after_url_dedup": F.coalesce(own("records_after_url_dedup"), after), "final_core_input_records": F.coalesce(own("final_core_input_records"), given), "final_core_unique_urls": F.coalesce(own("final_core_unique_urls"), given),
        "unique_source_urls": F.coalesce(own("unique_source_urls"), given), "reused_historical_records": F.coalesce(own("reused_historical_records"), F.lit(0)), **{c: F.coalesce(own(c), F.lit(0)) for c in REFERENCES},
    }
    more = {c: own(c, "string") for c in ("provider", "model", "validation_status")} | {c: own(c) for c in ("prompt_tokens", "completion_tokens", "latency_ms")} | {"enabled": own("enabled", "boolean"), "reference_alignment_status": F.coalesce(own("reference_alignment_status", "string"), F.lit("not_run"))}
    total = F.coalesce(own("total_tokens"), own("prompt_tokens") + own("completion_tokens"))
    return runs.withColumns(counts | more | {"total_tokens": total, "api_called": F.coalesce(F.col("status").isin(*CALLED), F.lit(False)), "error_type": error, "week_id": iso_week(F.col("generated_at"))})


def usage_rows(audits: DataFrame, keep: int = 200) -> DataFrame:
    """The last ``keep`` generations as rows of the usage log."""
    return audits.orderBy(F.desc("generated_at"), F.desc("run_id")).limit(keep).select("run_id", *USAGE)


def count_rules(details: DataFrame, audits: DataFrame) -> DataFrame:
    """Counts that don't add up: of sources' details and of the records put into generations."""
    whole = ("candidate_count", "render_attempted", "render_success", "final_success", "final_failed")
    negative = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) < 0, F.lit(True)) for c in whole])
    of_details = row_rules(
        details, detail_counts_not_negative=negative, details_within_candidates=F.col("final_success") + F.col("final_failed") > F.col("candidate_count"), rendered_within_attempted=F.col("render_success") > F.col("render_attempted"),
        success_rate_within_one=F.coalesce((F.col("success_rate") < 0) | (F.col("success_rate") > 1), F.lit(False)),
    )
    b, a, r = (F.col(c) for c in ("input_records_before_dedup", "input_records_after_dedup", "duplicate_records_removed"))
    of_audits = row_rules(
        audits, dedup_counts_valid=F.coalesce((a < 0) | (a > b) | (r < 0) | (r != b - a), F.lit(True)), core_within_deduplicated=F.coalesce((F.col("final_core_input_records") < 0) | (F.col("final_core_input_records") > F.col("records_after_url_dedup")), F.lit(True)),
        total_of_tokens=F.coalesce(F.col("total_tokens") < F.col("prompt_tokens"), F.lit(False)),
    )
    return of_details.unionByName(of_audits)


def safety_rules(df: DataFrame, name: str, forbidden: tuple[str, ...]) -> DataFrame:
    """Columns that may not be shown (their number), and rows whose texts, also nested ones, hold a page's HTML or the shape of a key."""
    named = sum(c.lower() in forbidden for c in df.columns)
    texts = [F.col(c) if isinstance(f.dataType, StringType) else F.to_json(F.struct(F.col(c))) for c, f in zip(df.columns, df.schema.fields)]
    joined = F.concat_ws("\n", *texts)
    rules = row_rules(df, **{f"{name}_without_html": F.contains(F.lower(joined), F.lit("<html")), f"{name}_without_secrets": has_secret(joined)})
    told = df.sparkSession.createDataFrame([(f"{name}_without_forbidden_columns", named)], "rule string, violations long")
    return rules.unionByName(told)
