"""Queries over what summaries are told, what is kept of generations, and the checks of counts and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordwatch.operators import monitoring as M
from recordwatch.operators import rules as Q
from recordwatch.plans.catalog import query, table

_AUDIT_SQL = """
    a AS (SELECT o_orderkey AS run_id, o_orderdate::TIMESTAMP AS made, o_orderkey % 50 AS n, CASE o_orderkey % 7 WHEN 0 THEN 'generated' WHEN 1 THEN 'validation_failed' WHEN 2 THEN 'api_error' WHEN 3 THEN 'sdk_missing' WHEN 4 THEN 'skipped_invalid_provider' ELSE 'skipped_disabled' END AS status,
                 CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 50 + 5 END AS b, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 50 + o_orderkey % 4 END AS k, CASE WHEN o_orderkey % 11 = 0 THEN 1 END AS removed, CASE WHEN o_orderkey % 7 < 2 THEN o_orderkey % 100 END AS p, CASE WHEN o_orderkey % 7 < 2 AND o_orderkey % 5 > 0 THEN o_orderkey % 40 END AS c, CASE WHEN o_orderkey % 13 = 0 THEN 50 END AS t FROM orders),
    u AS (SELECT *, coalesce(b, n) AS before, coalesce(k, n) AS after, coalesce(removed, coalesce(b, n) - coalesce(k, n)) AS gone, coalesce(t, p + c) AS total FROM a)
"""


def _audits(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, w = F.col("o_orderkey"), F.col("o_orderkey") % 7
    status = F.when(w == 0, "generated").when(w == 1, "validation_failed").when(w == 2, "api_error").when(w == 3, "sdk_missing").when(w == 4, "skipped_invalid_provider").otherwise("skipped_disabled")
    runs = table(spark, sf_dir, "orders").select(
        k.alias("run_id"), F.col("o_orderdate").cast("timestamp").alias("generated_at"), status.alias("status"), (k % 50).alias("input_records"), F.array(F.lit("timeout"), F.lit("second")).alias("errors"), F.lit("m").alias("model"),
        F.when(k % 3 == 0, k % 50 + 5).alias("input_records_before_dedup"), F.when(k % 3 == 0, k % 50 + k % 4).alias("input_records_after_dedup"), F.when(k % 11 == 0, 1).alias("duplicate_records_removed"), F.when(w < 2, k % 100).alias("prompt_tokens"),
        F.when((w < 2) & (k % 5 > 0), k % 40).alias("completion_tokens"), F.when(k % 13 == 0, 50).alias("total_tokens"),
    )
    return M.audit(runs)


@query(f"""WITH {_AUDIT_SQL}
    SELECT run_id, strftime(made, '%G-W%V') AS week_id, status, status IN ('generated', 'validation_failed', 'api_error') AS api_called, CASE status WHEN 'api_error' THEN 'timeout' WHEN 'sdk_missing' THEN 'ImportError' WHEN 'validation_failed' THEN 'validation_failed' WHEN 'skipped_invalid_provider' THEN 'invalid_provider' END AS error_type,
           before AS input_records_before_dedup, after AS input_records_after_dedup, gone AS duplicate_records_removed, after AS records_after_url_dedup, n AS final_core_input_records, p AS prompt_tokens, total AS total_tokens, 'not_run' AS reference_alignment_status FROM u ORDER BY made DESC, run_id DESC LIMIT 200""")
def usage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generations as rows of the usage log, the last two hundred."""
    rows = M.usage_rows(_audits(spark, sf_dir))
    return rows.select("run_id", "week_id", "status", "api_called", "error_type", "input_records_before_dedup", "input_records_after_dedup", "duplicate_records_removed", "records_after_url_dedup", "final_core_input_records", "prompt_tokens", "total_tokens", "reference_alignment_status")


@query("""
    WITH d AS (SELECT source, doc_id, lang, text FROM documents),
    s AS (SELECT source, count(*) FILTER (WHERE doc_id % 97 = 0) AS n_new, count(*) FILTER (WHERE doc_id % 89 = 0) AS n_changed, count(*) FILTER (WHERE doc_id % 3 = 0) AS n_baseline, substr(source, 4)::INT AS n FROM d GROUP BY source),
    x AS (SELECT source AS id, CASE WHEN n % 4 > 0 THEN 'S ' || source END AS s_name, CASE WHEN n % 3 = 0 THEN '' ELSE 'ok' END AS s_health, CASE n % 5 WHEN 0 THEN 'changed' WHEN 1 THEN 'unchanged' WHEN 2 THEN '' END AS s_change, n_new * (n % 2) AS a, n_changed * (n % 2) AS b, n_baseline * (n % 6 // 5) AS c, n FROM s WHERE n % 7 <> 6),
    q AS (SELECT source AS id, CASE WHEN n % 2 = 0 THEN 'unchanged' END AS q_change, CASE WHEN n % 2 = 0 THEN 'item_level' END AS q_level, n FROM s WHERE n % 5 <> 4),
    r AS (SELECT source AS id, arg_min(lang, doc_id) AS level FROM d WHERE substr(source, 4)::INT % 3 = 0 GROUP BY 1),
    j AS (SELECT coalesce(x.id, q.id, r.id) AS source_id, * EXCLUDE (id, n) FROM x FULL JOIN q ON x.id = q.id FULL JOIN r ON r.id = coalesce(x.id, q.id)),
    y AS (SELECT *, coalesce(nullif(s_change, ''), q_change, 'unknown') AS page FROM j)
    SELECT source_id, coalesce(s_name, source_id) AS source_name, coalesce(nullif(s_health, ''), 'unknown') AS page_status, page AS page_change_status, coalesce(a, 0)::BIGINT AS new_items, coalesce(b, 0)::BIGINT AS changed_items, coalesce(c, 0)::BIGINT AS baseline_items, coalesce(q_level, level, 'unknown') AS extracted_level,
           CASE WHEN coalesce(a, 0) > 0 OR coalesce(b, 0) > 0 THEN 'items_changed' WHEN coalesce(c, 0) > 0 THEN 'baseline' WHEN page = 'changed' THEN 'page_changed_only' WHEN page = 'unchanged' THEN 'unchanged' ELSE 'unclear' END AS reading FROM y
""")
def monitoring_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a summary is told of each source that its state, its quality or a record knows."""
    d = table(spark, sf_dir, "documents")
    k, n = F.col("doc_id"), F.substring("source", 4, 9).cast("int")
    sums = d.groupBy(F.col("source").alias("source_id"), n.alias("n")).agg(F.count_if(k % 97 == 0).alias("a"), F.count_if(k % 89 == 0).alias("b"), F.count_if(k % 3 == 0).alias("c"))
    m = F.col("n")
    status = sums.filter(m % 7 != 6).select("source_id", F.when(m % 4 > 0, F.concat(F.lit("S "), "source_id")).alias("source_name"), F.when(m % 3 == 0, "").otherwise("ok").alias("health_status"), F.when(m % 5 == 0, "changed").when(m % 5 == 1, "unchanged").when(m % 5 == 2, "").alias("change_status"),
                                            (F.col("a") * (m % 2)).alias("new_items"), (F.col("b") * (m % 2)).alias("changed_items"), F.when(m % 6 == 5, F.col("c")).otherwise(0).alias("baseline_items"))
    quality = sums.filter(m % 5 != 4).select("source_id", F.when(m % 2 == 0, "unchanged").alias("change_status"), F.when(m % 2 == 0, "item_level").alias("dominant_extracted_level"))
    records = d.filter(n % 3 == 0).select(F.col("source").alias("source_id"), k.alias("pos"), F.lit(None).cast("string").alias("source_name"), F.col("lang").alias("extracted_level"), F.lit("").alias("source_quality"))
    return M.context(status, quality, records).select("source_id", "source_name", "page_status", "page_change_status", "new_items", "changed_items", "baseline_items", "extracted_level", "reading")


@query(rf"""WITH {_AUDIT_SQL},
    d AS (SELECT l_orderkey AS k, count(*) AS n, count(*) FILTER (WHERE l_quantity > 25) AS s, count(*) FILTER (WHERE l_quantity < 10) AS f, count(*) FILTER (WHERE l_discount > 0.05) AS ra, count(*) FILTER (WHERE l_tax > 0.04) AS rs FROM lineitem GROUP BY 1),
    t AS (SELECT text || CASE WHEN doc_id % 101 = 0 THEN ' sk-ABCDEFGHIJKLMNOPQRSTUVWX' ELSE '' END AS text, doc_id % 103 = 0 AS page FROM documents),
    v AS (SELECT 'detail_counts_not_negative' AS rule, 0 AS violations UNION ALL SELECT 'details_within_candidates', count(*) FILTER (WHERE s + f > n - k % 2) FROM d UNION ALL SELECT 'rendered_within_attempted', count(*) FILTER (WHERE rs > ra) FROM d
          UNION ALL SELECT 'success_rate_within_one', count(*) FILTER (WHERE k % 50 = 0) FROM d UNION ALL SELECT 'dedup_counts_valid', count(*) FILTER (WHERE after > before OR gone < 0 OR gone <> before - after) FROM u
          UNION ALL SELECT 'core_within_deduplicated', count(*) FILTER (WHERE n > after) FROM u UNION ALL SELECT 'total_of_tokens', count(*) FILTER (WHERE total < p) FROM u
          UNION ALL SELECT 'documents_without_html', count(*) FILTER (WHERE page OR contains(lower(text), '<html')) FROM t UNION ALL SELECT 'documents_without_secrets', count(*) FILTER (WHERE regexp_matches(text, 'sk-[A-Za-z0-9_\-]{{20,}}|ghp_[A-Za-z0-9]{{20,}}|github_pat_[A-Za-z0-9_]{{20,}}')) FROM t
          UNION ALL SELECT 'documents_without_forbidden_columns', 1)
    SELECT rule, violations = 0 AS passed, violations::BIGINT AS violations FROM v""")
def count_and_safety_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5, Q9: counts that don't add up, texts that hold pages or keys, also within structures, and columns that may not be shown."""
    k = F.col("l_orderkey")
    n = lambda on: F.count_if(on)
    details = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg((F.count(F.lit(1)) - F.first(k % 2)).alias("candidate_count"), n(F.col("l_quantity") > 25).alias("final_success"), n(F.col("l_quantity") < 10).alias("final_failed"), n(F.col("l_discount") > 0.05).alias("render_attempted"), n(F.col("l_tax") > 0.04).alias("render_success"))
    details = details.withColumn("success_rate", F.when(k % 50 == 0, 1.5).when(k % 3 == 0, 0.5))
    i = F.col("doc_id")
    shown = table(spark, sf_dir, "documents").select("doc_id", F.concat("text", F.when(i % 101 == 0, " sk-ABCDEFGHIJKLMNOPQRSTUVWX").otherwise("")).alias("text"), F.struct(F.when(i % 103 == 0, F.array(F.lit("<HTML lang='x'>"))).alias("parts")).alias("nested"), F.lit(1).alias("Token"))
    return Q.report(M.count_rules(details, _audits(spark, sf_dir)), M.safety_rules(shown, "documents", M.FORBIDDEN_ITEM))
