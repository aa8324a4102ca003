"""Queries over what lasts from run to run: alerts with their counters, record versions, streams, stored pages."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordwatch.operators import alert_state as AS
from recordwatch.operators import lifecycle as L
from recordwatch.operators import record_versions as RV
from recordwatch.plans.catalog import _LOG_SQL, _POLICY, query, table
from recordwatch.sources.shared import settled
from recordwatch.streaming import record_lives as RL

# Evaluations are batches of forty events; every fifth is repeated by its run, and some runs start too early to count.
_READINGS_SQL = """
    e AS (SELECT event_id, event_id // 40 AS seq, user_id % 12 AS s, user_id % 30 AS rec, event_type AS t, floor(value)::BIGINT AS v FROM events),
    runs AS (SELECT seq, seq - (seq % 5 = 1)::INT AS run FROM (SELECT DISTINCT seq FROM e)),
    starts AS (SELECT seq, run, TIMESTAMP '2026-01-01' + to_hours(CASE WHEN run % 11 = 0 THEN run * 7 - 72 ELSE run * 7 END) AS began FROM runs),
    gate AS (SELECT *, coalesce(began < max(began) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS late FROM starts),
    timely AS (SELECT seq, 'r' || run AS run, began, coalesce(seq > min(seq) OVER (PARTITION BY run), false) AS repeated FROM gate WHERE NOT late),
    src AS (SELECT seq, s, count(*) FILTER (WHERE t = 'error') = 0 AS reachable, count(*) FILTER (WHERE t = 'signup') = 0 AS complete, sum(v) AS n FROM e GROUP BY ALL),
    med AS (SELECT *, CASE WHEN count(CASE WHEN complete THEN n END) OVER w >= 3 THEN median(CASE WHEN complete THEN n::DOUBLE END) OVER w END AS m FROM src
            WINDOW w AS (PARTITION BY s ORDER BY seq ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)),
    tot AS (SELECT seq, count(*) FILTER (WHERE t = 'purchase') % 4 AS ok, count(*) FILTER (WHERE t = 'error') AS bad, count(*) FILTER (WHERE t = 'click') % 3 AS model, count(*) FILTER (WHERE t = 'view') % 4 AS mail, count(*) FILTER (WHERE t = 'signup') % 3 AS audit FROM e GROUP BY seq),
    rec AS (SELECT seq, rec, arg_max(t, event_id) AS t, count(*) AS streak FROM e GROUP BY ALL),
    readings AS (
        SELECT seq, 'source_unreachable' AS kind, 's' || s AS source, NULL::VARCHAR AS record, NOT reachable AS met, NULL::BIGINT AS given, 1 AS low, 2 AS high, 1 AS open_at, 2::INT AS high_at, true AS high_if, true AS by_key FROM src
        UNION ALL SELECT seq, 'candidate_discovery_degraded', 's' || s, NULL, CASE WHEN reachable AND complete THEN coalesce(m > 0 AND n < m * 0.75, false) END, NULL, 1, 2, 2, NULL, true, false FROM med
        UNION ALL SELECT seq, 'detail_success_rate_degraded', NULL, NULL, ok / (ok + bad) < 0.5, NULL, 1, 2, 2, 3, ok = 0, false FROM tot WHERE ok + bad > 0
        UNION ALL SELECT seq, 'llm_validation_failed', NULL, NULL, model = 0, NULL, 1, 2, 1, 3, true, true FROM tot WHERE model < 2
        UNION ALL SELECT seq, 'email_delivery_failed', NULL, NULL, mail <> 0, (mail <> 0)::BIGINT, 1, 2, 1, NULL, true, true FROM tot WHERE mail <> 2
        UNION ALL SELECT seq, 'project_audit_failed', NULL, NULL, audit = 0, (audit = 0)::BIGINT, 3, 2, 1, NULL, true, true FROM tot
        UNION ALL SELECT seq, 'stale_run_ignored', NULL, NULL, seq % 7 = 0, (seq % 7 = 0)::BIGINT, 1, 2, 1, NULL, true, true FROM tot
        UNION ALL SELECT seq, k.kind, 's' || rec % 12, 'u' || rec, t = k.word, CASE WHEN t = k.word THEN streak ELSE 0 END, CASE WHEN k.kind = 'long_absent' OR (k.kind = 'detail_fetch_failed' AND streak >= 3) THEN 2 ELSE 1 END, 2, 1, NULL, true, true
        FROM rec, (VALUES ('temporarily_missing', 'signup'), ('long_absent', 'click'), ('detail_fetch_failed', 'error')) k(kind, word)
    ),
    keyed AS (SELECT kind || '|' || coalesce(source, 'global') || '|' || coalesce(record, 'global') AS k, r.*, t.run, t.began, t.repeated FROM readings r JOIN timely t USING (seq)),
    turns AS (SELECT kind, seq, lead(seq) OVER (PARTITION BY kind ORDER BY seq) AS after FROM (SELECT DISTINCT kind, seq FROM keyed)),
    silent AS (SELECT k, o.kind, o.source, o.record, t.after AS seq FROM (SELECT *, lead(seq) OVER (PARTITION BY k ORDER BY seq) AS own FROM keyed) o JOIN turns t USING (kind, seq) WHERE t.after IS NOT NULL AND (own IS NULL OR own > t.after)),
    n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq) AS i FROM (SELECT * FROM keyed UNION ALL BY NAME SELECT s.*, t.run, t.began, t.repeated FROM silent s JOIN timely t USING (seq))),
    m AS (
        SELECT k, 0::BIGINT AS i, NULL::BIGINT AS seq, NULL::VARCHAR AS run, NULL::TIMESTAMP AS began, NULL::VARCHAR AS action, NULL::INT AS told_rank, NULL::BIGINT AS told_streak, NULL::BIGINT AS told_times,
               0::BIGINT AS count, NULL::INT AS rank, NULL::TIMESTAMP AS until, NULL::VARCHAR AS last_run, NULL::BIGINT AS times, NULL::BIGINT AS streak FROM (SELECT DISTINCT k FROM n)
        UNION ALL
        SELECT k, i, seq, run, began, action, CASE WHEN now IS NULL THEN rank ELSE now END, CASE WHEN now IS NULL THEN streak ELSE c END, CASE WHEN now IS NULL THEN times ELSE t END,
               CASE WHEN action = 'resolve' THEN 0 WHEN given IS NULL AND met IS NOT NULL THEN c ELSE count END, now, CASE WHEN action IN ('open', 'escalate', 'update') THEN began + INTERVAL 24 HOUR WHEN now IS NOT NULL THEN until END,
               CASE WHEN now IS NOT NULL THEN run END, CASE WHEN now IS NOT NULL THEN t END, CASE WHEN now IS NOT NULL THEN c END
        FROM (
            SELECT *, CASE WHEN rank IS NULL AND now IS NOT NULL THEN 'open' WHEN rank IS NOT NULL AND now IS NULL THEN 'resolve' WHEN now > rank THEN 'escalate' WHEN now IS NOT NULL AND NOT same THEN CASE WHEN until <= began THEN 'update' ELSE 'suppress' END END AS action,
                   CASE WHEN rank IS NULL THEN 1 ELSE times + (NOT same)::INT END AS t
            FROM (
                SELECT *, CASE WHEN met AND c >= open_at THEN CASE WHEN high_at IS NOT NULL AND high_if AND c >= high_at THEN high ELSE low END END AS now
                FROM (
                    SELECT *, CASE WHEN given IS NOT NULL THEN given WHEN met THEN count + (NOT CASE WHEN by_key THEN same ELSE repeated END)::INT WHEN NOT met THEN 0 END AS c
                    FROM (
                        SELECT n.*, m.count, m.rank, m.until, m.last_run, m.times, m.streak, m.rank IS NOT NULL AND m.last_run = n.run AS same FROM m JOIN n ON n.k = m.k AND n.i = m.i + 1
                    )
                )
            )
        )
    )
"""


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.floor(F.col("event_id") / 40).alias("seq"), (F.col("user_id") % 12).alias("s"), (F.col("user_id") % 30).alias("rec"), F.col("event_type").alias("t"), F.floor("value").alias("v"))
    run = F.col("seq") - (F.col("seq") % 5 == 1).cast("long")
    started = F.lit(datetime(2026, 1, 1)).cast("timestamp") + F.make_interval(hours=(F.when(run % 11 == 0, run * 7 - 72).otherwise(run * 7)).cast("int"))
    timed = lambda rows: rows.withColumns({"run_id": F.concat(F.lit("r"), run), "started_at": started})
    n = lambda t: F.count_if(F.col("t") == t)
    sources = timed(e.groupBy("seq", "s").agg((n("error") == 0).alias("reachable"), (n("signup") == 0).alias("complete"), F.sum("v").alias("candidate_count"))).withColumn("source_id", F.concat(F.lit("s"), "s"))
    runs = timed(e.groupBy("seq").agg((n("purchase") % 4).alias("success"), n("error").alias("failed"), (n("click") % 3).alias("model"), (n("view") % 4).alias("mail"), (n("signup") % 3).alias("audit")))
    models = runs.withColumn("model_status", F.when(F.col("model") == 0, "validation_failed").when(F.col("model") == 1, "generated").otherwise("skipped_disabled")).withColumn("validation_status", F.when(F.col("model") == 1, "passed"))
    mail = F.when(F.col("mail") == 0, "Passed").when(F.col("mail") == 1, "ERROR").when(F.col("mail") == 2, "skipped").otherwise("canceled")
    outcomes = F.explode(F.array(F.struct(F.lit("email_delivery_failed").alias("alert_type"), mail.alias("status")), F.struct(F.lit("project_audit_failed").alias("alert_type"), F.when(F.col("audit") == 0, "failure").otherwise("success").alias("status"))))
    last = F.max_by("t", "event_id")
    state = F.when(F.col("t") == "signup", "temporarily_missing").when(F.col("t") == "click", "long_absent").when(F.col("t") == "error", "fetch_failed").otherwise("active")
    states = timed(e.groupBy("seq", "rec").agg(last.alias("t"), F.count(F.lit(1)).alias("streak"))).select("seq", "run_id", "started_at", F.concat(F.lit("s"), F.col("rec") % 12).alias("source_id"), F.concat(F.lit("u"), "rec").alias("record_id"), state.alias("state"), "streak")
    parts = [
        AS.unreachable(sources), AS.collapsed(sources, _ALERTS), AS.success_rate(runs), AS.validation(models), AS.steps(runs.select("seq", "run_id", "started_at", outcomes.alias("o")).select("seq", "run_id", "started_at", "o.*")),
        AS.late_runs(runs.withColumn("stale", F.col("seq") % 7 == 0)), AS.records(states),
    ]
    all_of = parts[0]
    for part in parts[1:]:
        all_of = all_of.unionByName(part)
    return all_of


_ALERTS = AS.Policy(collapse_ratio=0.75)
_TOLD = """SELECT substr(sha256(run || '|' || k || '|' || action || '|'), 1, 20) AS alert_event_id, seq, k AS alert_key, action, told_rank AS severity_rank, told_streak AS consecutive, told_times AS occurrence_count FROM m WHERE action IS NOT NULL"""


@query(f"WITH RECURSIVE {_READINGS_SQL} {_TOLD}")
def alert_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters and alerts of every key as one state, over runs that are repeated, late or silent."""
    return AS.evaluate(_readings(spark, sf_dir), policy=_ALERTS).events.select("alert_event_id", "seq", "alert_key", "action", "severity_rank", "consecutive", "occurrence_count")


@query(f"""WITH RECURSIVE {_READINGS_SQL}
    SELECT k AS alert_key, count, rank AS severity_rank, last_run AS last_run_id, times AS occurrence_count, streak AS consecutive, strftime(until, '%Y-%m-%d %H') AS cooldown_until
    FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY i DESC) AS last FROM m) WHERE last = 1 AND (rank IS NOT NULL OR count > 0)""")
def alert_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open conditions and counters after all runs, handed over once on the way: the second part starts from the table of the first."""
    readings = settled(_readings(spark, sf_dir))
    half = F.lit(50)
    before, after = readings.filter(F.col("seq") <= half), readings.filter(F.col("seq") > half)
    handed = settled(AS.evaluate(before, policy=_ALERTS, stored=True).states)
    last = AS.in_time(before).filter(~F.col("late")).agg(F.max_by("run_id", "seq"), F.max_by("started_at", "seq")).first()
    states = AS.evaluate(after, handed, None if last[0] is None else (last[0], last[1]), _ALERTS, stored=True).states
    return states.select("alert_key", "count", "severity_rank", "last_run_id", "occurrence_count", "consecutive", F.date_format("cooldown_until", "yyyy-MM-dd HH").alias("cooldown_until"))


# Readings of users as records: facts and evidence are maps whose keys come and go, texts that grow, quality and confidence.
_VERSIONS_SQL = """
    log AS (SELECT event_id AS seq, event_id AS run_id, ts AS started_at, user_id AS record_id, event_type <> 'signup' AS seen, event_type = 'error' AS failed,
                   MAP {'title': CASE WHEN event_id % 7 = 0 THEN 'second' ELSE 'first' END, 'summary': CASE event_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'Short' ELSE 'a short text' END, 'evidence': 'seen ' || event_id % 3,
                        'fields.' || CASE WHEN event_id % 5 = 0 THEN 'price' ELSE 'date' END: CASE WHEN event_id % 6 = 0 THEN NULL ELSE 'x' END} AS facts,
                   MAP {'title': CASE WHEN event_id % 3 = 0 THEN '' ELSE 'h1' END, 'date' || event_id % 2: 'time'} AS evidence, ['unknown', 'low', 'medium', 'high'][event_id % 4 + 1] AS quality, round((event_id % 9) / 9.0::DOUBLE, 4) AS confidence FROM events),
    k1 AS (SELECT *, CASE WHEN seen AND NOT failed THEN 'ok' WHEN seen THEN 'fail' ELSE 'missing' END AS k, max(seen::INT) OVER (PARTITION BY record_id ORDER BY started_at, seq) AS known FROM log),
    k2 AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY started_at, seq) AS n FROM k1 WHERE known = 1),
    k3 AS (SELECT * REPLACE (CASE WHEN n = 1 THEN 'ok' ELSE k END AS k) FROM k2),
    k4 AS (SELECT *, last_value(CASE WHEN k = 'ok' THEN struct_pack(f := facts, e := evidence, q := quality, c := confidence) END IGNORE NULLS) OVER (PARTITION BY record_id ORDER BY started_at, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was FROM k3 ),
    g AS (SELECT *, list_sort(list_distinct(map_keys(was.f) || map_keys(facts))) AS keys FROM k4 WHERE k = 'ok' AND was IS NOT NULL),
    d AS (SELECT *, list_transform(keys, lambda x: struct_pack(key := x, a := coalesce(was.f[x], ''), b := coalesce(facts[x], ''))) AS pairs FROM g),
    p AS (SELECT *, list_transform(pairs, lambda x: struct_pack(key := x.key, how := CASE WHEN x.a = x.b THEN '' WHEN x.a = '' THEN 'improved' WHEN x.b = '' THEN 'degraded'
                        WHEN x.key IN ('summary', 'evidence') AND contains(lower(x.b), lower(x.a)) AND lower(x.a) <> lower(x.b) THEN 'improved' ELSE 'changed' END, a := x.a, b := x.b)) AS hows FROM d),
    r AS (SELECT *, list_filter(hows, lambda x: x.how = 'changed') AS ch,
                 list_transform(list_filter(hows, lambda x: x.how = 'improved'), lambda x: x.key)
                     || list_transform(list_filter(map_keys(evidence), lambda x: evidence[x] <> '' AND coalesce(was.e[x], '') = ''), lambda x: 'field_evidence.' || x)
                     || CASE WHEN list_position(['unknown', 'low', 'medium', 'high'], quality) > list_position(['unknown', 'low', 'medium', 'high'], was.q) THEN ['source_quality'] ELSE [] END || CASE WHEN confidence > was.c THEN ['extraction_confidence'] ELSE [] END AS better,
                 list_transform(list_filter(hows, lambda x: x.how = 'degraded'), lambda x: x.key)
                     || list_transform(list_filter(map_keys(was.e), lambda x: was.e[x] <> '' AND coalesce(evidence[x], '') = ''), lambda x: 'field_evidence.' || x)
                     || CASE WHEN list_position(['unknown', 'low', 'medium', 'high'], quality) < list_position(['unknown', 'low', 'medium', 'high'], was.q) THEN ['source_quality'] ELSE [] END || CASE WHEN confidence < was.c THEN ['extraction_confidence'] ELSE [] END AS worse FROM p),
    c AS (SELECT k4.*, coalesce(len(ch), 0) > 0 AS changed, coalesce(len(better), 0) > 0 AS improved, coalesce(len(better), 0) = 0 AND coalesce(len(worse), 0) > 0 AS degraded, ch, list_sort(better) AS better, list_sort(list_filter(worse, lambda x: NOT list_contains(better, x))) AS worse
          FROM k4 LEFT JOIN r USING (seq)),
    t AS (SELECT *, 1 + sum(changed::INT) OVER (PARTITION BY record_id ORDER BY started_at, seq)::BIGINT AS semantic_version, 1 + sum(improved::INT) OVER (PARTITION BY record_id ORDER BY started_at, seq)::BIGINT AS extraction_revision,
                 list_sort(list_transform(list_filter(map_entries(facts), lambda x: coalesce(x.value, '') <> ''), lambda x: '"' || x.key || '":"' || x.value || '"')) AS held,
                 list_sort(list_transform(list_filter(map_entries(evidence), lambda x: coalesce(x.value, '') <> ''), lambda x: '"' || x.key || '":"' || x.value || '"')) AS proof FROM c),
    h AS (SELECT *, CASE WHEN k = 'ok' THEN substr(sha256('{' || array_to_string(held, ',') || '}'), 1, 16) END AS semantic_hash,
                 CASE WHEN k = 'ok' THEN substr(sha256('{' || array_to_string(proof, ',') || '}|' || quality || '|' || confidence::VARCHAR), 1, 16) END AS extraction_hash FROM t)
"""


def _whole_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, t = F.col("event_id"), F.col("event_type")
    facts = F.create_map(
        F.lit("title"), F.when(k % 7 == 0, "second").otherwise("first"), F.lit("summary"), F.when(k % 4 == 0, "").when(k % 4 == 1, "Short").otherwise("a short text"), F.lit("evidence"), F.concat(F.lit("seen "), k % 3),
        F.when(k % 5 == 0, "fields.price").otherwise("fields.date"), F.when(k % 6 != 0, "x"),
    )
    evidence = F.create_map(F.lit("title"), F.when(k % 3 == 0, "").otherwise("h1"), F.concat(F.lit("date"), k % 2), F.lit("time"))
    quality = F.element_at(F.array(*[F.lit(q) for q in ("unknown", "low", "medium", "high")]), (k % 4 + 1).cast("int"))
    return table(spark, sf_dir, "events").select(
        k.alias("seq"), k.alias("run_id"), F.col("ts").cast("timestamp").alias("started_at"), F.col("user_id").alias("record_id"), (t != "signup").alias("seen"), F.lit(True).alias("complete"), (t == "error").alias("failed"),
        facts.alias("facts"), evidence.alias("evidence"), quality.alias("quality"), F.round((k % 9) / 9, 4).alias("confidence"),
    )


@query(f"""WITH {_VERSIONS_SQL} SELECT seq, semantic_version, extraction_revision, coalesce(array_to_string(list_transform(ch, lambda x: x.key), ','), '') AS changed_fields, coalesce(array_to_string(better, ','), '') AS improved, coalesce(array_to_string(worse, ','), '') AS degraded,
    coalesce(array_to_string(list_transform(ch, lambda x: x.key || ': ' || x.a || ' > ' || x.b), ','), '') AS texts, semantic_hash FROM h""")
def reading_diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each reading of a record against its last good one, over maps of facts and evidence, quality and confidence."""
    timed = RV.timeline(_whole_readings(spark, sf_dir))
    texts = F.array_join(F.transform(F.array_sort(F.map_entries("change_evidence")), lambda e: F.concat(e["key"], F.lit(": "), e["value"]["before_excerpt"], F.lit(" > "), e["value"]["after_excerpt"])), ",")
    joined = lambda c: F.coalesce(F.array_join(c, ","), F.lit(""))
    return timed.select("seq", "semantic_version", "extraction_revision", joined("changed_fields").alias("changed_fields"), joined("improved_reasons").alias("improved"), joined("degraded_reasons").alias("degraded"), F.coalesce(texts, F.lit("")).alias("texts"), "semantic_hash")


@query(f"""WITH {_VERSIONS_SQL},
    v AS (SELECT *, substr(sha256(record_id || '|' || semantic_hash || '|' || extraction_hash), 1, 20) AS version_id, CASE WHEN n = 1 THEN 'new_item' WHEN changed THEN 'semantic_change' ELSE 'extraction_improvement' END AS version_kind FROM h WHERE n = 1 OR changed OR improved),
    u AS (SELECT version_id, any_value(record_id) AS record_id, arg_max(seq, struct_pack(p := started_at, q := seq)) AS seq, arg_max(version_kind, struct_pack(p := started_at, q := seq)) AS version_kind, arg_max(semantic_version, struct_pack(p := started_at, q := seq)) AS semantic_version, min(struct_pack(p := started_at, q := seq)) AS first FROM v GROUP BY version_id)
    SELECT version_id, record_id, seq, version_kind, semantic_version FROM u QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY first DESC) <= 6""")
def version_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of records by their ids; facts that come back replace their version in place; of each record the last six."""
    # Written once: both parts are made of it, and each would work out the whole timeline.
    found = settled(RV.versions(RV.timeline(_whole_readings(spark, sf_dir)))).withColumn("pos", F.struct("observed_at", "seq"))
    half = F.lit("2024-01-15").cast("timestamp")
    merged = RV.merged_versions(found.filter(F.col("observed_at") < half), found.filter(F.col("observed_at") >= half), 6)
    return merged.select("version_id", "record_id", "seq", "version_kind", "semantic_version")


# Forty events are a run, which sees the users in them, some several times; some runs start too early to count.
_STREAM_SQL = f"""
    seen_by AS (SELECT DISTINCT event_id // 40 AS run, user_id AS u FROM events),
    starts AS (SELECT run, TIMESTAMP '2026-01-01' + to_hours(CASE WHEN run % 13 = 4 THEN run * 9 - 60 ELSE run * 9 END) AS began FROM (SELECT DISTINCT run FROM seen_by)),
    passed AS (SELECT * FROM starts QUALIFY coalesce(began > max(began) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true)),
    log AS (SELECT run AS seq, 'r' || run AS run_id, began AS started_at, u AS record_id, (u * 7 + run) % 5 > 1 AS seen, true AS complete, (u * 3 + run) % 6 = 0 AS failed, ((u + run // 30) % 3)::VARCHAR AS facts, (run * u) % 4 AS detail FROM seen_by JOIN passed USING (run)),
    {_LOG_SQL[_LOG_SQL.index("k0 AS"):]}
"""


@query(f"WITH {_STREAM_SQL} SELECT record_id::VARCHAR AS record_id, run_id, unnest(events) AS event_type, prev AS previous_state, state, streak, semantic_version::BIGINT AS semantic_version, extraction_revision::BIGINT AS extraction_revision FROM tl")
def lifecycle_as_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The life of records as a stream of what is there: late runs left out by a gate, repeated observations told once, one state a record."""
    path = f"{sf_dir}/events.parquet"
    k, u = F.floor(F.col("event_id") / 40), F.col("user_id")
    e = spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{path}*")  # a pattern, as a stream's path may not be one file
    began = F.lit(datetime(2026, 1, 1)).cast("timestamp") + F.make_interval(hours=F.when(k % 13 == 4, k * 9 - 60).otherwise(k * 9).cast("int"))
    log = e.select(
        "event_id", k.alias("run_seq"), F.concat(F.lit("r"), k).alias("run_id"), began.alias("started_at"), u.alias("record_id"), ((u * 7 + k) % 5 > 1).alias("seen"), F.lit(True).alias("complete"), ((u * 3 + k) % 6 == 0).alias("failed"),
        ((u + F.floor(k / 30)) % 3).cast("string").alias("facts"), ((k * u) % 4).cast("double").alias("detail"),
    ).withColumnRenamed("event_id", "seq")
    events = RL.run_to_end(RL.record_lives(log, _POLICY, delay="3650 days"), timers=False)
    return events.select("record_id", "run_id", "event_type", "previous_state", "state", "streak", "semantic_version", "extraction_revision")
