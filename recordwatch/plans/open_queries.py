"""Queries over open objects and generated summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordwatch.functions import open_objects as O
from recordwatch.operators import generated as G
from recordwatch.plans.catalog import query, table

# Each event's props within an object whose keys depend on the event.
_OPEN_SQL = """
    o AS (SELECT event_id, event_type AS t, user_id AS u, json_extract_string(props, '$.k') AS k, event_id % 3 AS m, event_id % 4 = 0 AS bare FROM events)
"""


def _open(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    inner = F.when(k % 4 == 0, "{}").otherwise(F.concat(F.lit('{"v": "'), F.col("user_id"), F.lit('", "’n": null, "more": {"f": 1.50}}')))
    raw = F.concat(F.lit('{"props": '), "props", F.lit(', "list": [1, '), k % 3, F.lit(', {"z": 1, "a": 2}], "deep": {"'), "event_type", F.lit('": '), inner, F.lit("}}"))
    return table(spark, sf_dir, "events").select("event_id", raw.alias("raw"))


@query(f"""WITH {_OPEN_SQL}
    SELECT event_id, 'props.k' AS path, k AS text FROM o
    UNION ALL SELECT event_id, 'list', '[1,' || m || ',{{"a":2,"z":1}}]' FROM o
    UNION ALL SELECT event_id, 'deep.' || t, '{{}}' FROM o WHERE bare
    UNION ALL SELECT event_id, 'deep.' || t || '.v', u::VARCHAR FROM o WHERE NOT bare
    UNION ALL SELECT event_id, 'deep.' || t || '.’n', NULL FROM o WHERE NOT bare
    UNION ALL SELECT event_id, 'deep.' || t || '.more.f', '1.5' FROM o WHERE NOT bare""")
def open_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """objects of any shape as paths and texts, empty objects, lists and nulls among them."""
    rows = _open(spark, sf_dir).select("event_id", F.try_parse_json("raw").alias("v"))
    return O.leaves(rows, "v", ["event_id"])


@query(f"""WITH {_OPEN_SQL}
    SELECT event_id, '{{"deep":{{"' || t || '":' || CASE WHEN bare THEN '{{}}' ELSE '{{"more":{{"f":1.5}},"v":"' || u || '","’n":null}}' END || '}},"list":[1,' || m || ',{{"a":2,"z":1}}],"props":{{"k":' || k || '}}}}' AS canonical FROM o""")
def canonical_open_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the same objects written canonically, keys in order at every depth."""
    return _open(spark, sf_dir).select("event_id", O.canonical_json(F.col("raw")).alias("canonical"))


_PHRASES = G.Phrases(this_week=("out this week",), first_this_week=("first seen this week",), nothing_new="no change this week", expanded=("became a fact",), updated=("was updated",), removed=("was removed",), outage=("is down",), restored=("is back",), republished=("again",), confirmed=("confirmed",))
# Conversations as summaries of three records each, turns as their points; some refer to what isn't there, twice, or crosswise, and some aren't JSON.
_GENERATED_SQL = """
    c AS (SELECT DISTINCT conv_id AS o, CASE WHEN conv_id % 17 = 0 THEN 'no' WHEN conv_id % 19 = 0 THEN 'list' ELSE 'yes' END AS json FROM conversations),
    r AS (SELECT o, k, 'r' || k AS id, 'https://a.invalid/' || o || '/' || k AS url, ['unchanged', 'new', 'changed'][(o // 2 + k * (o % 2)) % 3 + 1] AS status, k <> 1 AS dated FROM c, (SELECT unnest(range(3)) AS k)),
    about AS (SELECT o, bool_or(status IN ('new', 'changed')) AS any_change, bool_or(status = 'new' AND NOT dated) AS undated FROM r GROUP BY o),
    p AS (SELECT conv_id AS o, turn AS t, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n, CASE WHEN turn % 7 = 6 THEN '' WHEN turn % 3 = 0 THEN 'out this week' ELSE 'plain' END AS text,
                 ['r' || turn % 4] || CASE WHEN turn % 6 = 5 THEN ['r' || turn % 4] ELSE [] END AS ids, ['https://a.invalid/' || conv_id || '/' || CASE WHEN turn % 5 = 4 THEN (turn + 1) % 3 ELSE turn % 4 END] || CASE WHEN turn % 6 = 5 THEN ['https://a.invalid/' || conv_id || '/2'] ELSE [] END AS urls
          FROM conversations JOIN c ON c.o = conv_id WHERE json = 'yes'),
    f AS (SELECT o, n, unnest(ids) AS id, unnest(urls) AS url FROM p),
    j AS (SELECT f.o, f.n, bool_or(a.id IS NULL) AS unknown_id, bool_or(b.url IS NULL) AS unknown_url, bool_or(x.id IS NULL) AS unpaired, min(a.status) AS lo, max(a.status) AS hi, bool_or(a.status = 'new' AND NOT a.dated) AS undated
          FROM f LEFT JOIN r a ON a.o = f.o AND a.id = f.id LEFT JOIN r b ON b.o = f.o AND b.url = f.url LEFT JOIN r x ON x.o = f.o AND x.id = f.id AND x.url = f.url GROUP BY ALL),
    q AS (SELECT p.*, j.* EXCLUDE (o, n), contains(text, 'out this week') AS timed FROM p JOIN j USING (o, n)),
    s AS (SELECT c.o, any_change, about.undated, c.o % 5 = 0 AS said, bool_or(timed) AS timed, bool_or(unknown_url) AS foreign_url FROM c JOIN about USING (o) JOIN q USING (o) GROUP BY ALL)
"""


@query(f"""WITH {_GENERATED_SQL}, b AS (
        SELECT o, '' AS path, CASE json WHEN 'no' THEN 'not_json' ELSE 'not_object' END AS rule FROM c WHERE json <> 'yes'
        UNION ALL SELECT o, '', unnest(list_filter([CASE WHEN NOT any_change AND NOT said THEN 'silent_about_no_change' END, CASE WHEN undated AND timed THEN 'undated_told_as_new' END, CASE WHEN NOT any_change AND timed THEN 'time_told_without_change' END, CASE WHEN foreign_url THEN 'foreign_url' END], lambda x: x IS NOT NULL)) FROM s
        UNION ALL SELECT o, 'key_points[' || n || ']', unnest(list_filter([CASE WHEN text = '' THEN 'point_without_text' END, CASE WHEN unknown_id THEN 'unknown_record' END, CASE WHEN unknown_url THEN 'unknown_url' END, CASE WHEN len(list_distinct(ids)) < len(ids) THEN 'repeated_record' END,
            CASE WHEN len(list_distinct(urls)) < len(urls) THEN 'repeated_url' END, CASE WHEN unpaired THEN 'unpaired_reference' END, CASE WHEN lo = 'unchanged' AND hi = 'unchanged' AND timed THEN 'unchanged_told_as_new' END,
            CASE WHEN lo = 'changed' AND hi = 'changed' AND timed THEN 'change_told_as_publication' END, CASE WHEN undated AND timed THEN 'undated_point_told_as_new' END], lambda x: x IS NOT NULL)) FROM q)
    SELECT o AS output_id, path, rule FROM b""")
def generated_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated summaries against the records they were made from, every broken rule with its path."""
    o, t = F.col("conv_id"), F.col("turn")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn")
    url = lambda k: F.concat(F.lit("https://a.invalid/"), o, F.lit("/"), k)
    listed = lambda one, two: F.when(t % 6 == 5, F.array(one, two)).otherwise(F.array(one))
    own = F.concat(F.lit("r"), t % 4)
    text: Column = F.when(t % 7 == 6, "").when(t % 3 == 0, "out this week").otherwise("plain")
    point = F.struct("turn", F.struct(text.alias("point"), listed(own, own).alias("source_record_ids"), listed(url(F.when(t % 5 == 4, (t + 1) % 3).otherwise(t % 4)), url(F.lit(2))).alias("source_urls"), F.lit("none").alias("caveat")).alias("p"))
    points = turns.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(point)), lambda x: x["p"]).alias("key_points"))
    whole = F.to_json(F.struct(F.lit(G.VERSION).alias("llm_summary_version"), F.when(o % 5 == 0, "no change this week").otherwise("a summary").alias("overall_summary"), "key_points"))
    outputs = points.select(o.alias("output_id"), F.when(o % 17 == 0, F.concat(F.lit("Here it is: "), whole)).when(o % 19 == 0, F.concat(F.lit("["), whole, F.lit("]"))).otherwise(whole).alias("raw"))
    k = F.explode(F.array(*map(F.lit, range(3))))
    records = turns.select("conv_id").distinct().select("conv_id", k.alias("k"))
    status = F.element_at(F.array(F.lit("unchanged"), F.lit("new"), F.lit("changed")), ((F.floor(o / 2) + F.col("k") * (o % 2)) % 3 + 1).cast("int"))
    records = records.select(o.alias("output_id"), F.concat(F.lit("r"), "k").alias("id"), url(F.col("k")).alias("canonical_url"), status.alias("change_status"), F.when(F.col("k") != 1, "2026-01-01").alias("published_at"))
    return G.broken_rules(outputs, records, G.Shape(phrases=_PHRASES))
