"""Every query of the engine's own operators over the driver tables, with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordwatch.functions import classify as C
from recordwatch.functions import html as HT
from recordwatch.functions import ids as I
from recordwatch.functions import nested as N
from recordwatch.functions import text as T
from recordwatch.functions import times as TM
from recordwatch.functions import urls as U
from recordwatch.operators import aggregates as A
from recordwatch.operators import alerts as AL
from recordwatch.operators import conditions as CN
from recordwatch.operators import diff as D
from recordwatch.operators import health as H
from recordwatch.operators import keyed as K
from recordwatch.operators import lifecycle as L
from recordwatch.operators import references as R
from recordwatch.operators import records as RC
from recordwatch.operators import report as RP
from recordwatch.operators import rules as Q
from recordwatch.operators import selection as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a query under its function's name, with the SQL that must give the same rows."""

    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("""
    SELECT user_id, event_type, event_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC NULLS LAST, event_id DESC) AS n FROM events
    ) WHERE n = 1
""")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest event of each user and type."""
    return K.latest_per_key(table(spark, sf_dir, "events"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "event_id", "value")


@query("""
    WITH e AS (SELECT user_id, event_id, ts, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS v,
                      CASE WHEN event_id % 7 = 0 THEN 0 ELSE 1 END AS n FROM events),
    best AS (SELECT user_id, arg_max(v, event_id) FILTER (v IS NOT NULL) AS fill FROM e GROUP BY 1)
    SELECT e.event_id, coalesce(e.v, b.fill) AS value FROM e JOIN best b USING (user_id)
""")
def fill_from_siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing values filled from the user's latest complete event."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"))
    return K.fill_from_siblings(e, ["user_id"], ["value"], T.completeness(F.col("value")), F.col("event_id")).select("event_id", "value")


@query("""
    WITH e AS (SELECT user_id, event_id, ts, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS v FROM events)
    SELECT user_id, max(event_id) AS event_id, coalesce((arg_max(struct_pack(v := v), event_id)).v, arg_max(v, event_id) FILTER (v IS NOT NULL)) AS value FROM e GROUP BY user_id
""")
def summary_input_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1: the latest row of each key with gaps filled from its siblings, in one aggregation."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("value"))
    return K.latest_and_filled(e, ["user_id"], ["value"], T.completeness(F.col("value")), [F.col("event_id")])


@query("SELECT user_id, event_id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events) WHERE n <= 5")
def keep_last_n_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last five events of each user."""
    return K.first_n(table(spark, sf_dir, "events"), ["user_id"], [F.desc("event_id")], 5).select("user_id", "event_id")


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n <= 3")
def top_n_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three largest orders of each customer."""
    return K.first_n(table(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3).select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events ORDER BY events.ts DESC, event_id DESC LIMIT 100")
def keep_last_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last hundred rows of all."""
    return K.keep_last(table(spark, sf_dir, "events"), [F.desc("ts"), F.desc("event_id")], 100).select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


# Addresses taken apart and put together; those of the pages need no decoding.
_NORMALIZED = r"""
    x AS (SELECT page_id, u, lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.\-]*)://', 1)) AS s,
                 regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1) AS a,
                 regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)', 1) AS pt,
                 regexp_extract(u, '^[^?#]*\?([^#]*)', 1) AS q FROM p),
    k AS (SELECT *, list_sort(list_transform(list_filter(string_split(q, '&'), lambda v: v <> '' AND NOT list_contains(
              ['utm_source','utm_medium','utm_campaign','utm_term','utm_content','fbclid','gclid'], lower(split_part(v, '=', 1)))),
              lambda v: struct_pack(k := split_part(v, '=', 1), v := CASE WHEN contains(v, '=') THEN substr(v, strpos(v, '=') + 1) ELSE '' END))) AS kept FROM x),
    n AS (SELECT *, CASE WHEN pt = '/' THEN '/' ELSE regexp_replace(pt, '/+$', '') END AS place,
                 CASE WHEN len(kept) > 0 THEN '?' || array_to_string(list_transform(kept, lambda v: v.k || '=' || v.v), '&') ELSE '' END AS asked FROM k)
"""


@query(f"WITH p AS (SELECT page_id, trim(url) AS u FROM pages), {_NORMALIZED} SELECT page_id, s || '://' || lower(a) || place || asked AS url_norm FROM n")
def url_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one spelling per address."""
    return table(spark, sf_dir, "pages").select("page_id", U.normalize(F.col("url")).alias("url_norm"))


@query(r"""
    SELECT page_id, regexp_extract(lower(regexp_extract(trim(url), '^([A-Za-z]+://[^/?#]*)', 1)), '.*') ||
           regexp_replace(regexp_extract(trim(url), '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS url_bare FROM pages
""")
def url_strip_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """addresses without query and fragment."""
    return table(spark, sf_dir, "pages").select("page_id", U.strip_query(F.col("url")).alias("url_bare"))


@query(r"""
    WITH x AS (SELECT page_id, regexp_replace(lower(regexp_extract(trim(url), '^[A-Za-z]+://([^/?#:]*)', 1)), '^www\.', '') AS h,
                      regexp_replace(regexp_extract(trim(url), '^[A-Za-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS p FROM pages)
    SELECT page_id, h AS host_root, h = 'example.com' OR h LIKE '%.example.com' AS official, list_contains(string_split(lower(p), '/'), 'fr') AS excluded, h = 'blog.tionsh.example.net' AND starts_with(p, '/en/') AS allowed FROM x
""")
def url_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """host roots, hosts below an official one, excluded parts of paths, and rules of a site for absolute addresses."""
    url = F.trim("url")
    allowed = U.allowed(url, ["blog.tionsh.example.net"], ["/en/"], ["/en"])
    return table(spark, sf_dir, "pages").select("page_id", U.host_root(U.host(url)).alias("host_root"), U.under_host(url, "example.com").alias("official"), U.excluded(url, ["fr"]).alias("excluded"), allowed.alias("allowed"))


@query(f"WITH p AS (SELECT page_id, trim(url) AS u FROM pages), {_NORMALIZED} SELECT count(DISTINCT s || '://' || lower(a) || place || asked) AS n_urls, count(*) AS n_rows FROM n")
def unique_normalized_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many addresses there really are."""
    return table(spark, sf_dir, "pages").agg(F.countDistinct(U.normalize(F.col("url"))).alias("n_urls"), F.count(F.lit(1)).alias("n_rows"))


@query(rf"""
    WITH h AS (SELECT page_id, CASE WHEN page_id % 20 = 7 THEN 'mailto:x@y' WHEN page_id % 4 = 3 THEN url WHEN page_id % 4 = 0 THEN regexp_replace(url, '^https?://[^/]*', 'HTTPS://WWW.Example.com')
                       WHEN page_id % 4 = 1 THEN regexp_replace(url, '^https?://[^/]*', '') ELSE '../x/./..' || regexp_replace(url, '^https?://[^/]*', '') END AS href FROM pages),
    p AS (SELECT page_id, CASE WHEN starts_with(href, '..') THEN 'https://www.example.com' || substr(href, 10) WHEN starts_with(href, '/') THEN 'https://www.example.com' || href ELSE href END AS u FROM h), {_NORMALIZED}
    SELECT page_id, CASE WHEN regexp_matches(lower(a), '^(www\.)?example\.com$') AND starts_with(lower(place), '/en/')
        AND NOT regexp_matches(lower(place), '\.(avif|css|gif|ico|jpeg|jpg|js|json|m3u8|mov|mp3|mp4|pdf|png|svg|webm|webp)$') THEN s || '://example.com' || place || asked END AS candidate FROM n
""")
def candidate_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """links resolved against the page they stand on and held against the rules of a site."""
    k, bare = F.col("page_id"), F.regexp_replace("url", "^https?://[^/]*", "")
    href = F.when(k % 20 == 7, "mailto:x@y").when(k % 4 == 3, F.col("url")).when(k % 4 == 0, F.concat(F.lit("HTTPS://WWW.Example.com"), bare)).when(k % 4 == 1, bare).otherwise(F.concat(F.lit("../x/./.."), bare))
    found = U.candidate_url(href, "https://www.example.com/updates/index", "example.com", "/en/", "example.com")
    return table(spark, sf_dir, "pages").select("page_id", found.alias("candidate"))


@query("SELECT doc_id, substr(sha256(source || '|' || doc_id), 1, 16) AS record_id, substr(sha256('run-1|' || doc_id || '|seen'), 1, 20) AS event_id FROM documents")
def stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ids of records and events."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", I.record_id(F.col("source"), F.col("doc_id")).alias("record_id"), I.event_id(F.lit("run-1"), F.col("doc_id"), F.lit("seen")).alias("event_id"))


@query("SELECT content_hash, count(*) AS n, min(doc_id) AS first_id FROM (SELECT substr(sha256(text), 1, 16) AS content_hash, doc_id FROM documents) GROUP BY 1 HAVING count(*) > 1")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U8: rows that share their content."""
    d = table(spark, sf_dir, "documents").select("doc_id", I.digest(F.col("text"), 16).alias("content_hash"))
    return d.groupBy("content_hash").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id")).filter("n > 1")


@query("""
    SELECT n_nationkey, substr(sha256('{"key":"' || n_nationkey || '","name":"' || n_name || '","region":"' || n_regionkey || '"}'), 1, 16) AS hash FROM nation
""")
def canonical_json_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """hash of a canonical JSON text."""
    n = table(spark, sf_dir, "nation")
    return n.select("n_nationkey", I.content_hash(region=F.col("n_regionkey").cast("string"), name=F.col("n_name"), key=F.col("n_nationkey").cast("string")).alias("hash"))


@query("""
    SELECT strftime(ts, '%G-W%V') AS week, event_type, count(*) AS n, sum(floor(value * 100)::BIGINT)::BIGINT AS cents, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS latest
    FROM events GROUP BY 1, 2
""")
def iso_week_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums by ISO week."""
    e = table(spark, sf_dir, "events").withColumn("week", TM.iso_week(F.col("ts")))
    return e.groupBy("week", "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.floor(F.col("value") * 100)).alias("cents"), F.date_format(F.max("ts"), "yyyy-MM-dd HH:mm:ss").alias("latest"))


@query("""
    SELECT doc_id, list_sort(list_filter(['and', 'heit', 'ment', 'que', 'tion'], lambda k: contains(lower(text), k))) AS keywords FROM documents
""")
def keyword_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F8: keywords of each text."""
    return table(spark, sf_dir, "documents").select("doc_id", T.matched_keywords(F.col("text"), ["tion", "que", "heit", "ment", "and"]).alias("keywords"))


@query(r"""
    SELECT doc_id, CASE WHEN length(text) > 240 THEN rtrim(substr(text, 1, 239), ' ') || '…' ELSE text END AS excerpt,
           rtrim(substr(trim(regexp_replace(text, '\s+', ' ', 'g'), ' '), 1, 100), ' ') AS clean FROM documents
""")
def text_excerpts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """excerpts and cleaned beginnings."""
    return table(spark, sf_dir, "documents").select("doc_id", T.excerpt(F.col("text"), 240).alias("excerpt"), T.clean_text(F.col("text"), 100).alias("clean"))


@query(r"""SELECT page_id, CASE WHEN page_id % 2 = 0 THEN trim(regexp_replace(translate(url || ' -- ' || url, '‘’“”–—', chr(39) || chr(39) || chr(34) || chr(34) || '--'), '\s+', ' ', 'g'), ' ')
    ELSE 'A&B ' || url || ' fine Wide 1⁄2 "q" it' || chr(39) || 's - <b>' END AS facts FROM pages""")
def semantic_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """semantic normal form; plain texts stay in the JVM, those with entities or other letters don't."""
    text = F.when(F.col("page_id") % 2 == 0, F.concat("url", F.lit("  --\t"), "url")).otherwise(F.concat(F.lit("A&amp;B "), "url", F.lit(" ﬁne Ｗide  ½ “q” it’s – &lt;b&gt;")))
    return table(spark, sf_dir, "pages").select("page_id", T.semantic_text(text).alias("facts"))


@query("""
    SELECT user_id, arg_max(event_type, struct_pack(n := n, r := CASE event_type WHEN 'purchase' THEN 4 WHEN 'signup' THEN 3 WHEN 'click' THEN 2 WHEN 'view' THEN 1 ELSE 0 END, v := event_type)) AS mode
    FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1
""")
def mode_with_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: dominant event of each user, ties by rank."""
    return A.mode_ranked(table(spark, sf_dir, "events"), ["user_id"], "event_type", C.rank(F.col("v"), ("error", "view", "click", "signup", "purchase")))


@query("""
    SELECT user_id, arg_max(event_type, struct_pack(n := n, f := -first)) AS mode
    FROM (SELECT user_id, event_type, count(*) AS n, min(event_id) AS first FROM events GROUP BY 1, 2) GROUP BY 1
""")
def mode_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dominant event of each user, ties by which came first."""
    return A.mode_first_seen(table(spark, sf_dir, "events"), ["user_id"], "event_type", "event_id")


@query("""
    SELECT source, count(*) AS items, sum(coalesce(quality, 0)) / count(*)::DOUBLE AS average_confidence, sum(n_chars)::BIGINT AS links,
           count(*) FILTER (WHERE quality IS NOT NULL AND n_chars > 500) / nullif(count(*) FILTER (WHERE quality IS NOT NULL), 0)::DOUBLE AS long_ratio
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1
""")
def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: quality of each source."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return A.quality_summary(d, "source", F.col("quality").cast("double"), F.col("n_chars"), {"long": F.col("n_chars") > 500}, F.col("quality").isNotNull())


@query("""
    WITH e AS (SELECT user_id, event_id, event_type = 'error' AS failed, CASE WHEN event_type <> 'error' THEN md5((event_id % 3)::VARCHAR) END AS h FROM events),
    l AS (SELECT *, lag(h) OVER (PARTITION BY user_id ORDER BY event_id) AS p FROM e)
    SELECT event_id, CASE WHEN failed THEN 'failed' WHEN p IS NULL THEN 'new' WHEN p = h THEN 'unchanged' ELSE 'changed' END AS change_status FROM l
""")
def page_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each observation of a page against the one before."""
    e = table(spark, sf_dir, "events").select("user_id", "event_id", (F.col("event_type") == "error").alias("failed"), F.md5((F.col("event_id") % 3).cast("string")).alias("h"))
    return D.page_change(e, "user_id", ["event_id"], "h", "failed").select("event_id", "change_status")


_SNAPSHOTS = """
    a AS (SELECT o_orderkey AS id, o_orderstatus AS status, o_orderpriority AS summary, floor(o_totalprice)::BIGINT::VARCHAR AS price FROM orders WHERE o_orderkey % 10 <> 0),
    b AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 1 THEN 'X' WHEN o_orderkey % 11 = 2 THEN '' ELSE o_orderstatus END AS status,
                 CASE WHEN o_orderkey % 13 = 3 THEN o_orderpriority || ' more' ELSE o_orderpriority END AS summary,
                 CASE WHEN o_orderkey % 17 = 4 THEN NULL ELSE floor(o_totalprice)::BIGINT::VARCHAR END AS price FROM orders WHERE o_orderkey % 10 <> 1)
"""


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    o = table(spark, sf_dir, "orders")
    k, price = F.col("o_orderkey"), F.floor("o_totalprice").cast("string")
    a = o.filter(k % 10 != 0).select(k.alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("summary"), price.alias("price"))
    b = o.filter(k % 10 != 1).select(
        k.alias("id"), F.when(k % 7 == 1, "X").when(k % 11 == 2, "").otherwise(F.col("o_orderstatus")).alias("status"),
        F.when(k % 13 == 3, F.concat("o_orderpriority", F.lit(" more"))).otherwise(F.col("o_orderpriority")).alias("summary"), F.when(k % 17 != 4, price).alias("price"),
    )
    return a, b


@query(f"""
    WITH {_SNAPSHOTS},
    d AS (SELECT coalesce(b.id, a.id) AS id, a.id IS NULL AS is_new, b.id IS NULL AS gone,
                 CASE WHEN a.price = b.price THEN NULL WHEN b.price IS NULL THEN 'degraded' ELSE 'changed' END AS p,
                 CASE WHEN a.status = b.status THEN NULL WHEN b.status = '' THEN 'degraded' ELSE 'changed' END AS s,
                 CASE WHEN a.summary = b.summary THEN NULL ELSE 'improved' END AS m FROM a FULL JOIN b ON a.id = b.id)
    SELECT id, CASE WHEN is_new THEN 'new' WHEN gone THEN 'missing' WHEN p IS NOT NULL OR s IS NOT NULL OR m IS NOT NULL THEN 'changed' ELSE 'unchanged' END AS change_status,
           CASE WHEN is_new OR gone THEN [] ELSE list_filter([CASE WHEN p = 'changed' THEN 'price' END, CASE WHEN s = 'changed' THEN 'status' END], lambda x: x IS NOT NULL) END AS changed_fields,
           CASE WHEN is_new OR gone THEN [] ELSE list_filter([CASE WHEN m = 'improved' THEN 'summary' END], lambda x: x IS NOT NULL) END AS improved_fields,
           CASE WHEN is_new OR gone THEN [] ELSE list_filter([CASE WHEN p = 'degraded' THEN 'price' END, CASE WHEN s = 'degraded' THEN 'status' END], lambda x: x IS NOT NULL) END AS degraded_fields
    FROM d
""")
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots compared field by field."""
    return D.snapshot_diff(*_snapshots(spark, sf_dir), "id", ["price", "status", "summary"])


@query(f"""
    WITH {_SNAPSHOTS},
    x AS (SELECT b.id, a.id IS NULL AS fresh, a.status = b.status AND a.summary = b.summary AS same FROM b LEFT JOIN a USING (id))
    SELECT id, CASE WHEN fresh THEN 'new' WHEN same THEN 'unchanged' ELSE 'changed' END AS change_status, CASE WHEN fresh THEN 2 ELSE 1 END AS first_seen_at,
           CASE WHEN fresh OR NOT same THEN 2 ELSE 1 END AS last_changed_at FROM x
""")
def change_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change status by content hash, with times carried over."""
    a, b = _snapshots(spark, sf_dir)
    h = I.digest(I.joined(F.col("status"), F.col("summary")), 16)
    existing = a.select("id", h.alias("content_hash"), F.lit(1).alias("first_seen_at"), F.lit(1).alias("last_changed_at"))
    current = b.select("id", h.alias("content_hash"), F.lit(2).alias("observed_at"))
    return D.change_metadata(current, existing).select("id", "change_status", "first_seen_at", "last_changed_at")


@query(f"""
    WITH {_SNAPSHOTS}
    SELECT coalesce(b.id, a.id) AS id, CASE WHEN b.id IS NOT NULL THEN b.status ELSE a.status END AS status, a.summary AS summary,
           CASE WHEN b.id IS NOT NULL THEN b.price ELSE a.price END AS price, CASE WHEN b.id IS NOT NULL THEN 'run-2' END AS run
    FROM a FULL JOIN b ON a.id = b.id
""")
def keyed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upsert by column."""
    a, b = _snapshots(spark, sf_dir)
    return K.upsert(a, b.drop("summary").withColumn("run", F.lit("run-2")), "id")


@query("SELECT event_id, event_type FROM events e WHERE event_id % 2 = 1 AND NOT EXISTS (SELECT 1 FROM events x WHERE x.event_id % 3 = 0 AND x.event_id = e.event_id)")
def anti_join_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that aren't stored yet."""
    e = table(spark, sf_dir, "events")
    return K.not_yet_stored(e.filter("event_id % 2 = 1"), e.filter("event_id % 3 = 0"), "event_id").select("event_id", "event_type")


@query("""
    WITH u AS (SELECT 0 AS part, event_id AS pos, user_id % 100 AS k, value FROM events WHERE event_id % 2 = 0
               UNION ALL SELECT 1, event_id, user_id % 130, value * 2 FROM events WHERE event_id % 2 = 1)
    SELECT k, arg_max(value, struct_pack(p := part, q := pos)) AS value, (min(struct_pack(p := part, q := pos))).p::BIGINT AS part, (min(struct_pack(p := part, q := pos))).q AS pos FROM u GROUP BY k
""")
def union_dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last value at the first place."""
    e = table(spark, sf_dir, "events")
    a = e.filter("event_id % 2 = 0").select((F.col("user_id") % 100).alias("k"), "value", F.col("event_id").alias("pos"))
    b = e.filter("event_id % 2 = 1").select((F.col("user_id") % 130).alias("k"), (F.col("value") * 2).alias("value"), F.col("event_id").alias("pos"))
    return K.union_last_value([a, b], "k").select("k", "value", F.col("position.part").cast("long").alias("part"), F.col("position.pos").alias("pos"))


@query("""
    SELECT user_id, list_distinct_in_order AS types FROM (
        SELECT user_id, list(event_type ORDER BY first) AS list_distinct_in_order FROM (SELECT user_id, event_type, min(event_id) AS first FROM events GROUP BY 1, 2) GROUP BY 1)
""")
def ordered_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different values in the order of their first occurrence."""
    e = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("first"))
    listed = e.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("first", "event_type"))).alias("x"))
    return listed.select("user_id", K.ordered_unique(F.col("x.event_type")).alias("types"))


@query(r"""
    WITH c AS (SELECT page_id AS pos, regexp_extract(trim(url), '^[A-Za-z]+://([^/?#]*)', 1) AS host, url AS evidence, CASE WHEN page_id % 3 = 0 THEN ' ' ELSE 'T' || page_id END AS title,
                      CASE page_id % 4 WHEN 0 THEN 'json_ld' WHEN 1 THEN 'embedded_json' ELSE 'anchor' END AS origin, ['all', 'k' || page_id % 5] AS keywords FROM pages),
    w AS (SELECT host, list(DISTINCT w ORDER BY w) AS keywords FROM (SELECT host, unnest(keywords) AS w FROM c) GROUP BY 1)
    SELECT host, arg_max(evidence, struct_pack(n := length(evidence), p := -pos)) AS evidence, coalesce(arg_min(title, pos) FILTER (trim(title) <> ''), '') AS title,
           coalesce(arg_min(origin, pos) FILTER (origin <> 'anchor'), 'anchor') AS origin, min(pos) AS pos, any_value(w.keywords) AS keywords FROM c JOIN w USING (host) GROUP BY host
""")
def candidate_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of one key merged: first title, longest evidence, first origin but anchors, all keywords."""
    k = F.col("page_id")
    p = table(spark, sf_dir, "pages").select(
        U.authority(F.trim("url")).alias("host"), k.alias("pos"), F.col("url").alias("evidence"), F.when(k % 3 == 0, " ").otherwise(F.concat(F.lit("T"), k)).alias("title"),
        F.when(k % 4 == 0, "json_ld").when(k % 4 == 1, "embedded_json").otherwise("anchor").alias("origin"), F.array(F.lit("all"), F.concat(F.lit("k"), k % 5)).alias("keywords"),
    )
    return K.merge_candidates(p, ["host"]).select("host", "evidence", "title", "origin", "pos", "keywords")


_LOG_SQL_FOR = """
    log AS (SELECT event_id AS seq, event_id AS run_id, ts AS started_at, user_id AS record_id, event_type <> 'signup' AS seen, true AS complete, event_type = 'error' AS failed,
                   (event_id % 3)::VARCHAR AS facts, floor(value / 50)::BIGINT AS detail FROM events),
    k0 AS (SELECT *, CASE WHEN seen AND NOT failed THEN 'ok' WHEN seen THEN 'fail' ELSE 'missing' END AS k FROM log),
    k1 AS (SELECT *, max(seen::INT) OVER (PARTITION BY record_id ORDER BY started_at, seq) AS known FROM k0),
    k2 AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY started_at, seq) AS n FROM k1 WHERE known = 1),
    k3 AS (SELECT * REPLACE (CASE WHEN n = 1 THEN 'ok' ELSE k END AS k) FROM k2),
    k4 AS (SELECT *, CASE WHEN k = lag(k) OVER (PARTITION BY record_id ORDER BY started_at, seq) THEN 0 ELSE 1 END AS turned FROM k3),
    k5 AS (SELECT *, sum(turned) OVER (PARTITION BY record_id ORDER BY started_at, seq) AS island FROM k4),
    k6 AS (SELECT *, row_number() OVER (PARTITION BY record_id, island ORDER BY started_at, seq) AS streak, min(started_at) OVER (PARTITION BY record_id, island) AS since FROM k5),
    k7 AS (SELECT *, CASE WHEN k = 'ok' THEN 'active' WHEN k = 'fail' THEN 'fetch_failed'
                          WHEN streak >= ABSENT_N AND floor((epoch(started_at) - epoch(since)) / 86400) >= ABSENT_DAYS THEN 'long_absent' ELSE 'temporarily_missing' END AS state,
                  last_value(CASE WHEN k = 'ok' THEN struct_pack(f := facts, d := detail) END IGNORE NULLS) OVER (PARTITION BY record_id ORDER BY started_at, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS was FROM k6),
    k8 AS (SELECT *, lag(state) OVER (PARTITION BY record_id ORDER BY started_at, seq) AS prev,
                  k = 'ok' AND was IS NOT NULL AND facts <> was.f AS changed, k = 'ok' AND was IS NOT NULL AND detail > was.d AS improved, k = 'ok' AND was IS NOT NULL AND detail < was.d AS degraded FROM k7),
    tl AS (SELECT *, 1 + sum(changed::INT) OVER (PARTITION BY record_id ORDER BY started_at, seq) AS semantic_version, 1 + sum(improved::INT) OVER (PARTITION BY record_id ORDER BY started_at, seq) AS extraction_revision,
                  k = 'fail' AND streak >= FAILURES AS attention, list_filter([
                      CASE WHEN prev IS NULL THEN 'item_discovered' END,
                      CASE WHEN k IN ('ok', 'fail') AND prev IN ('temporarily_missing', 'long_absent') THEN 'reappeared' END,
                      CASE WHEN k = 'fail' THEN 'detail_fetch_failed' END,
                      CASE WHEN k = 'ok' AND prev = 'fetch_failed' THEN 'detail_fetch_recovered' END,
                      CASE WHEN changed THEN 'semantic_content_changed' END, CASE WHEN improved THEN 'extraction_improved' END, CASE WHEN degraded THEN 'extraction_degraded' END,
                      CASE WHEN state = 'temporarily_missing' AND prev NOT IN ('temporarily_missing', 'long_absent') THEN 'temporarily_missing' END,
                      CASE WHEN state = 'long_absent' AND prev <> 'long_absent' THEN 'long_absence_reached' END], lambda x: x IS NOT NULL) AS events FROM k8)
"""


def _log_sql(absent_observations: int, absent_days: int, failures: int) -> str:
    return _LOG_SQL_FOR.replace("ABSENT_N", str(absent_observations)).replace("ABSENT_DAYS", str(absent_days)).replace("FAILURES", str(failures))


_LOG_SQL = _log_sql(2, 2, 3)
_EAGER_SQL = _log_sql(1, 0, 1)


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as observations: each its own run; signup is an absence, error a failure."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), F.col("event_id").alias("run_id"), F.col("ts").alias("started_at"), F.col("user_id").alias("record_id"), (F.col("event_type") != "signup").alias("seen"),
        F.lit(True).alias("complete"), (F.col("event_type") == "error").alias("failed"), (F.col("event_id") % 3).cast("string").alias("facts"), F.floor(F.col("value") / 50).alias("detail"),
    )


_POLICY = L.Policy(absent_observations=2, absent_days=2)
_EAGER = L.Policy(absent_observations=1, absent_days=0, failures_for_attention=1)


@query(f"WITH {_LOG_SQL} SELECT seq, state, streak, semantic_version::BIGINT AS semantic_version, extraction_revision::BIGINT AS extraction_revision, attention, array_to_string(events, ',') AS events FROM tl")
def lifecycle_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole life of every record."""
    t = L.timeline(_log(spark, sf_dir), _POLICY)
    return t.select("seq", "state", "streak", "semantic_version", "extraction_revision", "attention", F.array_join("events", ",").alias("events"))


@query(f"""WITH {_LOG_SQL}, e AS (SELECT *, unnest(events) AS event_type FROM tl)
    SELECT seq, record_id, event_type, substr(sha256(run_id || '|' || record_id || '|' || event_type), 1, 20) AS event_id, attention OR event_type = 'semantic_content_changed' AS attention
    FROM e WHERE event_type NOT IN ('lifecycle_initialized', 'unchanged_observation')""")
def lifecycle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, with ids."""
    e = L.events(L.timeline(_log(spark, sf_dir), _POLICY))
    return e.filter(~F.col("event_type").isin("lifecycle_initialized", "unchanged_observation")).select("seq", "record_id", "event_type", "event_id", "attention")


@query(f"""WITH {_LOG_SQL} SELECT record_id, seq AS run_id, semantic_version::BIGINT AS semantic_version, extraction_revision::BIGINT AS extraction_revision,
    CASE WHEN prev IS NULL THEN 'new_item' WHEN changed THEN 'semantic_change' ELSE 'extraction_improvement' END AS version_kind FROM tl WHERE prev IS NULL OR changed OR improved""")
def lifecycle_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of each record."""
    return L.versions(L.timeline(_log(spark, sf_dir), _POLICY)).select("record_id", "run_id", "semantic_version", "extraction_revision", "version_kind")


@query(f"""WITH {_LOG_SQL} SELECT record_id, state, streak, semantic_version::BIGINT AS semantic_version, extraction_revision::BIGINT AS extraction_revision, attention FROM (
    SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY started_at DESC, seq DESC) AS r FROM tl) WHERE r = 1""")
def lifecycle_final_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last state of each record."""
    return L.final_states(L.timeline(_log(spark, sf_dir), _POLICY))


@query(f"""WITH {_LOG_SQL}, e AS (SELECT unnest(events) AS t FROM tl)
    SELECT count(*) FILTER (WHERE t = 'item_discovered') AS item_discovered, count(*) FILTER (WHERE t = 'reappeared') AS reappeared, count(*) FILTER (WHERE t = 'detail_fetch_failed') AS detail_fetch_failed, count(*) FILTER (WHERE t = 'semantic_content_changed') AS semantic_content_changed FROM e""")
def lifecycle_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1: events by type."""
    return L.totals(L.events(L.timeline(_log(spark, sf_dir), _POLICY)), ["item_discovered", "reappeared", "detail_fetch_failed", "semantic_content_changed"])


@query(f"""WITH {_LOG_SQL}, f AS (SELECT record_id % 7 AS source, state FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY started_at DESC, seq DESC) AS r FROM tl) WHERE r = 1),
    s AS (SELECT source, count(*) FILTER (WHERE state = 'active') AS active, count(*) FILTER (WHERE state = 'fetch_failed') AS fetch_failed, count(*) FILTER (WHERE state IN ('temporarily_missing', 'long_absent')) AS absent FROM f GROUP BY 1),
    e AS (SELECT record_id % 7 AS source, count(*) AS events, count(*) FILTER (WHERE attention OR t = 'semantic_content_changed') AS needs_attention FROM (SELECT record_id, attention, unnest(events) AS t FROM tl) GROUP BY 1)
    SELECT source, coalesce(active, 0) AS active, coalesce(fetch_failed, 0) AS fetch_failed, coalesce(absent, 0) AS absent, coalesce(events, 0) AS events, coalesce(needs_attention, 0) AS needs_attention FROM s FULL JOIN e USING (source)""")
def lifecycle_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: states and events by source."""
    t = L.timeline(_log(spark, sf_dir), _POLICY)
    of = lambda df: df.withColumn("src", F.col("record_id") % 7)
    return L.by_source(of(L.final_states(t)), of(L.events(t)), "src")


@query(f"WITH {_EAGER_SQL} SELECT record_id, state, streak FROM (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY started_at DESC, seq DESC) AS r FROM tl) WHERE r = 1 AND (attention OR state = 'long_absent')")
def attention_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that need a look, by a policy that waits for nothing."""
    return L.final_states(L.timeline(_log(spark, sf_dir), _EAGER)).filter("attention or state = 'long_absent'").select("record_id", "state", "streak")


@query("""
    WITH r AS (SELECT event_id AS run_id, (event_id * 7919) % 10007 AS seq, event_id * 1000 + (event_id * 31) % 977 AS started FROM events),
    m AS (SELECT *, max(started) OVER (ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM (SELECT seq, arg_min(run_id, run_id) AS run_id, min(started) AS started FROM r GROUP BY seq))
    SELECT run_id, seq FROM m WHERE before IS NULL OR started > before
""")
def stale_run_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs that aren't later than an earlier one are ignored."""
    k = F.col("event_id")
    r = table(spark, sf_dir, "events").select(k.alias("run_id"), ((k * 7919) % 10007).alias("seq"), (k * 1000 + (k * 31) % 977).alias("started"))
    r = r.groupBy("seq").agg(F.min_by("run_id", "run_id").alias("run_id"), F.min("started").alias("started"))
    return K.running_max_before(r, "seq", "started").filter("max_before is null or started > max_before").select("run_id", "seq")


_DAILY_SQL = """
    d AS (SELECT event_type, ts::DATE AS day, count(*) AS n, count(*) FILTER (WHERE value > 20) > 0 AS usable FROM events GROUP BY 1, 2),
    m AS (SELECT *, CASE WHEN count(CASE WHEN usable THEN n END) OVER w >= 3 THEN median(CASE WHEN usable THEN n END::DOUBLE) OVER w END AS median_before FROM d
          WINDOW w AS (PARTITION BY event_type ORDER BY day ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING))
"""


@query(f"""WITH {_DAILY_SQL}, f AS (SELECT *, coalesce(median_before > 0 AND n < median_before * 0.9, false) AS collapsed, row_number() OVER (PARTITION BY event_type ORDER BY day) AS rn FROM m)
    SELECT event_type, day::VARCHAR AS day, n, median_before, collapsed, rn - coalesce(max(CASE WHEN NOT collapsed THEN rn END) OVER (PARTITION BY event_type ORDER BY day), 0) AS collapse_streak FROM f""")
def rolling_median_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts that fall below the rolling median."""
    d = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"), (F.count_if(F.col("value") > 20) > 0).alias("usable"))
    m = H.rolling_median(d, ["event_type"], ["day"], "n", "usable", 8)
    return H.collapse_streak(m, ["event_type"], ["day"], "n", 0.9).select("event_type", F.col("day").cast("string").alias("day"), "n", "median_before", "collapsed", "collapse_streak")


@query("SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') AS success, count(*) FILTER (WHERE event_type = 'error') AS failed, CASE WHEN count(*) FILTER (WHERE event_type IN ('purchase', 'error')) > 0 THEN count(*) FILTER (WHERE event_type = 'purchase') / count(*) FILTER (WHERE event_type IN ('purchase', 'error'))::DOUBLE END AS rate FROM events GROUP BY 1")
def success_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of successes."""
    g = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("success"), F.count_if(F.col("event_type") == "error").alias("failed"))
    return g.withColumn("rate", H.success_rate(F.col("success"), F.col("failed")))


@query("SELECT o_orderstatus, o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1, 2")
def failure_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by source and kind."""
    return A.histogram(table(spark, sf_dir, "orders"), ["o_orderstatus"], "o_orderpriority")


@query("""
    WITH s AS (SELECT user_id, CASE event_type WHEN 'purchase' THEN 'success' WHEN 'error' THEN 'failure' WHEN 'signup' THEN 'cancelled' WHEN 'click' THEN 'skipped' ELSE 'unknown' END AS o, event_id % 5 = 0 AS critical FROM events),
    h AS (SELECT user_id, CASE WHEN o IN ('failure', 'cancelled') THEN CASE WHEN critical THEN 2 ELSE 1 END WHEN o = 'unknown' THEN 1 ELSE 0 END AS r FROM s)
    SELECT user_id, CASE max(r) WHEN 2 THEN 'unhealthy' WHEN 1 THEN 'degraded' ELSE 'healthy' END AS overall_health FROM h GROUP BY 1
""")
def worst_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The worst component of each run."""
    e = table(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "purchase", " Passed").when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "signup", "canceled").when(F.col("event_type") == "click", "disabled")
    parts = e.select("user_id", C.component_health(C.step_outcome(status), F.col("event_id") % 5 == 0).alias("status"))
    return H.overall(parts, ["user_id"])


@query("""
    SELECT source, arg_min(q, struct_pack(r := r, q := q)) AS worst FROM (
        SELECT source, CASE WHEN n_chars < 500 THEN 'low' WHEN n_chars < 3000 THEN 'medium' ELSE 'high' END AS q, CASE WHEN n_chars < 500 THEN 1 WHEN n_chars < 3000 THEN 2 ELSE 3 END AS r FROM documents) GROUP BY 1
""")
def worst_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The least quality of each source."""
    q = F.when(F.col("n_chars") < 500, "low").when(F.col("n_chars") < 3000, "medium").otherwise("high")
    d = table(spark, sf_dir, "documents").select("source", q.alias("q"))
    return d.groupBy("source").agg(A.worst_label("q", F.struct(C.rank(F.col("q"), C.QUALITY).alias("r"), F.col("q").alias("q"))).alias("worst"))


@query("SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types FROM events GROUP BY 1")
def sorted_distinct_concat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statuses of a group as one text."""
    return table(spark, sf_dir, "events").groupBy("user_id").agg(A.sorted_distinct_text(F.col("event_type")).alias("types"))


@query("SELECT count(*) AS before, count(DISTINCT text) AS after, count(*) - count(DISTINCT text) AS removed FROM documents")
def dedup_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows before and after."""
    d = table(spark, sf_dir, "documents")
    return A.dedup_statistics(d, d.select("text").distinct())


@query("""
    WITH c AS (SELECT user_id, hour(ts)::BIGINT AS hour, count(*) FILTER (WHERE event_type = 'signup') AS n, count(*) FILTER (WHERE event_type = 'purchase') AS c, count(*) FILTER (WHERE event_type = 'click' AND value > 20) AS b, count(*) FILTER (WHERE event_type = 'error') > 0 AS p, count(*) FILTER (WHERE event_type = 'view') AS u FROM events GROUP BY ALL)
    SELECT user_id, hour, CASE WHEN n > 0 OR c > 0 THEN 'items_changed' WHEN b > 0 THEN 'baseline' WHEN p THEN 'page_changed_only' WHEN u > 0 THEN 'unchanged' ELSE 'unclear' END AS reading FROM c
""")
def change_reading(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One word for the counts of a source in an hour of the day."""
    n = lambda t: F.count_if(F.col("event_type") == t)
    g = table(spark, sf_dir, "events").groupBy("user_id", F.hour("ts").cast("long").alias("hour")).agg(
        n("signup").alias("n"), n("purchase").alias("c"), F.count_if((F.col("event_type") == "click") & (F.col("value") > 20)).alias("b"), (n("error") > 0).alias("p"), n("view").alias("u")
    )
    return g.select("user_id", "hour", A.change_reading(F.col("n"), F.col("c"), F.col("b"), F.col("p"), F.col("u")).alias("reading"))


@query("""
    WITH p AS (SELECT d.doc_id, d.source, n_chars, CASE WHEN quality = 0 THEN 'changed' WHEN toxic = 1 THEN 'new' WHEN quality = 1 THEN 'unchanged' ELSE 'baseline' END AS c FROM documents d LEFT JOIN labels l USING (doc_id))
    SELECT doc_id, CASE c WHEN 'new' THEN 0 WHEN 'changed' THEN 1 WHEN 'baseline' THEN 5 ELSE 7 END AS priority FROM p ORDER BY priority, n_chars DESC, doc_id DESC LIMIT 200
""")
def priority_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most important records first."""
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    change = F.when(F.col("quality") == 0, "changed").when(F.col("toxic") == 1, "new").when(F.col("quality") == 1, "unchanged").otherwise("baseline")
    ranked = d.withColumn("priority", S.priority(change, F.array().cast("array<string>"), F.lit(False), F.lit("unchanged")))
    return S.top(ranked, [F.col("priority"), F.desc("n_chars"), F.desc("doc_id")], 200).select("doc_id", "priority")


@query("""
    WITH d AS (SELECT doc_id, source || '-' || doc_id % 500 AS site, source IN ('src3', 'src13') AS restricted, lang = 'en' AS direct, l.doc_id IS NOT NULL AS is_item, doc_id % 9 <> 4 AS seen FROM documents LEFT JOIN labels l USING (doc_id)),
    v AS (SELECT *, bool_or(is_item) OVER (PARTITION BY site) AS has_items FROM d WHERE seen)
    SELECT doc_id FROM v WHERE (is_item OR NOT has_items) AND NOT (restricted AND is_item AND NOT direct)
""")
def core_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in view, item rows before page rows, items of restricted sites only where direct; sites with pages only and with indirect items only are among them."""
    k, l = F.col("doc_id"), table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("is_item"))  # noqa: E741
    d = table(spark, sf_dir, "documents").join(l, "doc_id", "left").withColumn("site", F.concat_ws("-", "source", k % 500))
    return S.core_records(d, k % 9 != 4, F.coalesce("is_item", F.lit(False)), "site", F.col("source").isin("src3", "src13"), F.col("lang") == "en").select("doc_id")


@query("SELECT user_id, event_id, n > 8 AS overflow FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r, count(*) OVER (PARTITION BY user_id) AS n FROM events) WHERE r <= 8")
def candidate_truncation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first candidates, and whether there were more."""
    return S.truncated(table(spark, sf_dir, "events"), ["user_id"], [F.col("event_id")], 8).select("user_id", "event_id", "overflow")


@query("""
    WITH l AS (SELECT *, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) IS NULL AND conv_id % 2 = 0 AS cut FROM conversations),
    r AS (SELECT conv_id, turn, 'd' || (turn * 37 + conv_id) % 1200 AS id, CASE WHEN NOT cut THEN 'u' || CASE WHEN turn % 3 = 0 THEN (turn * 37 + conv_id) % 1200 WHEN turn % 3 = 1 THEN conv_id % 50 ELSE 5000 END END AS url FROM l),
    p AS (SELECT 'd' || doc_id AS ref_id, 'u' || doc_id AS ref_url FROM documents),
    a AS (SELECT r.*, i.ref_url AS ui, u.ref_id AS iu FROM r LEFT JOIN p i ON r.id = i.ref_id LEFT JOIN p u ON r.url = u.ref_url),
    s AS (SELECT conv_id, CASE WHEN ui = url THEN 'valid' WHEN ui IS NOT NULL THEN 'url_repaired' WHEN iu IS NOT NULL THEN 'id_repaired' ELSE 'invalid' END AS status, CASE WHEN ui IS NOT NULL THEN id ELSE iu END AS rid FROM a)
    SELECT conv_id, count(*) AS n_refs, count(*) FILTER (WHERE status = 'valid') AS n_valid, count(*) FILTER (WHERE status = 'url_repaired') AS n_url_repaired, count(*) FILTER (WHERE status = 'id_repaired') AS n_id_repaired, count(*) FILTER (WHERE status = 'invalid') AS n_invalid,
           count(rid) - count(DISTINCT rid) AS n_repeated,
           CASE WHEN count(rid) = 0 THEN 'failed' WHEN count(*) FILTER (WHERE status <> 'valid') + count(rid) - count(DISTINCT rid) > 0 THEN 'repaired' ELSE 'passed' END AS verdict FROM s GROUP BY 1
""")
def reference_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of references, every other one without its last address, checked and repaired from either half."""
    k = (F.col("turn") * 37 + F.col("conv_id")) % 1200
    url = F.when(F.col("turn") % 3 == 0, k).when(F.col("turn") % 3 == 1, F.col("conv_id") % 50).otherwise(5000)
    c = table(spark, sf_dir, "conversations").select("conv_id", F.struct("turn", F.concat(F.lit("d"), k.cast("string")).alias("id"), F.concat(F.lit("u"), url.cast("string")).alias("url")).alias("x"))
    listed = c.groupBy("conv_id").agg(F.array_sort(F.collect_list("x")).alias("x"))
    n = F.size("x") - F.when(F.col("conv_id") % 2 == 0, 1).otherwise(0)
    points = listed.select("conv_id", F.col("x.id").alias("ids"), F.slice("x.url", F.lit(1), n).alias("urls"))
    d = table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.concat(F.lit("u"), F.col("doc_id").cast("string")).alias("url"))
    return R.alignment_counts(R.align(R.references(points, "conv_id", "ids", "urls"), R.allowed_pairs(d, "id", "url")), ["conv_id"])


@query("""
    WITH s AS (SELECT conv_id AS point, min(CASE WHEN conv_id % 3 = 0 OR turn % 2 = 0 THEN 'unchanged' ELSE 'new' END) AS lo, max(CASE WHEN conv_id % 3 = 0 OR turn % 2 = 0 THEN 'unchanged' ELSE 'new' END) AS hi FROM conversations GROUP BY 1),
    t AS (SELECT conv_id AS point, text FROM conversations)
    SELECT point, lo AS change_status, list_filter([CASE WHEN contains(lower(text), 'the') THEN 'the' END, CASE WHEN contains(lower(text), 'ment') THEN 'ment' END], lambda x: x IS NOT NULL) AS phrases
    FROM s JOIN t USING (point) WHERE lo = hi AND lo = 'unchanged' AND (contains(lower(text), 'the') OR contains(lower(text), 'ment'))
""")
def wording_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases that the referenced statuses don't bear out; every turn is a reference and a text."""
    c = table(spark, sf_dir, "conversations")
    statuses = c.select(F.col("conv_id").alias("point"), F.when((F.col("conv_id") % 3 == 0) | (F.col("turn") % 2 == 0), "unchanged").otherwise("new").alias("change_status"))
    return R.wording_violations(c.select(F.col("conv_id").alias("point"), "text"), statuses, {"unchanged": ["the", "ment"]})


@query("""
    SELECT * FROM (
        SELECT 'order_price_positive' AS rule, count(*) FILTER (WHERE o_totalprice <= 0) = 0 AS passed, count(*) FILTER (WHERE o_totalprice <= 0) AS violations FROM orders
        UNION ALL SELECT 'order_status_known', count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) = 0, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) FROM orders
        UNION ALL SELECT 'order_key_unique', count(*) = count(DISTINCT o_orderkey), count(*) - count(DISTINCT o_orderkey) FROM orders
        UNION ALL SELECT 'line_unique', count(*) = count(DISTINCT (l_orderkey, l_linenumber)), count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem
        UNION ALL SELECT 'line_has_order', count(*) = 0, count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
        UNION ALL SELECT 'labels_have_documents', count(*) = 0, count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)
        UNION ALL SELECT 'same_ids', count(*) = 0, count(*) FROM ((SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels) UNION ALL (SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM documents))
        UNION ALL SELECT 'chars_counted', count(*) FILTER (WHERE n_chars <> length(text)) = 0, count(*) FILTER (WHERE n_chars <> length(text)) FROM documents)
""")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q3, Q5, Q6, Q11: rules over several tables as one report."""
    o, li, d, l = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "documents", "labels"))  # noqa: E741
    return Q.report(
        Q.row_rules(o, order_price_positive=F.col("o_totalprice") <= 0, order_status_known=~F.col("o_orderstatus").isin("F", "O")),
        Q.unique(o, "order_key_unique", "o_orderkey"), Q.unique(li, "line_unique", "l_orderkey", "l_linenumber"), Q.refers(li, "line_has_order", "l_orderkey", o, "o_orderkey"),
        Q.refers(l, "labels_have_documents", "doc_id", d, "doc_id"), Q.same_set(d.select("doc_id"), l.select("doc_id"), "same_ids"), Q.row_rules(d, chars_counted=F.col("n_chars") != F.char_length("text")),
    )


@query(f"""WITH {_LOG_SQL}, m AS (SELECT *, lag(semantic_version) OVER (PARTITION BY record_id ORDER BY started_at, seq) AS version_before FROM tl),
    v AS (SELECT count(*) FILTER (WHERE list_contains(events, 'detail_fetch_recovered') AND coalesce(prev, '') <> 'fetch_failed') AS a, count(*) FILTER (WHERE list_contains(events, 'reappeared') AND coalesce(prev, '') NOT IN ('temporarily_missing', 'long_absent')) AS b,
                 count(*) FILTER (WHERE list_contains(events, 'temporarily_missing') AND k <> 'missing') AS c, count(*) FILTER (WHERE semantic_version < 1 OR extraction_revision < 1) AS d,
                 count(*) FILTER (WHERE semantic_version < version_before) AS e, count(*) FILTER (WHERE NOT list_contains(events, 'detail_fetch_failed') AND k = 'fail') AS f, count(*) FILTER (WHERE len(events) = 0) AS g FROM m),
    r AS (SELECT unnest([struct_pack(rule := 'recovered_after_failure', violations := a), struct_pack(rule := 'reappeared_after_absence', violations := b), struct_pack(rule := 'missing_only_if_not_seen', violations := c),
                         struct_pack(rule := 'versions_from_one', violations := d), struct_pack(rule := 'versions_never_fall', violations := e), struct_pack(rule := 'failures_are_told', violations := f), struct_pack(rule := 'every_run_is_an_event', violations := g)], recursive := true) FROM v)
    SELECT rule, violations = 0 AS passed, violations FROM r""")
def transition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legality of timelines, and one rule that they do not obey."""
    t = L.timeline(_log(spark, sf_dir), _POLICY)
    more = Q.row_rules(t, failures_are_told=(F.col("kind") == "fail") & ~F.array_contains("events", "detail_fetch_failed"), every_run_is_an_event=F.size("events") == 0)
    return Q.report(Q.transition_rules(t), Q.monotone(t, "versions_never_fall", "record_id", ["started_at", "seq"], "semantic_version"), more)


@query(r"""
    SELECT doc_id, regexp_matches(text, 'sk-[A-Za-z0-9_\-]{20,}|ghp_[A-Za-z0-9]{20,}|github_pat_[A-Za-z0-9_]{20,}') AS has_secret, len(regexp_extract_all(text, 'https?://[^\s<>"'')]+'))::BIGINT AS n_urls FROM documents
""")
def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F32, Q9: shapes of keys and addresses."""
    return table(spark, sf_dir, "documents").select("doc_id", T.has_secret(F.col("text")).alias("has_secret"), F.size(T.urls_in(F.col("text"))).cast("long").alias("n_urls"))


@query(r"SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\s+', ' ', 'g')) AS title FROM pages")
def page_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H2: titles without leaving the JVM."""
    return table(spark, sf_dir, "pages").select("page_id", HT.title_native(F.col("html")).alias("title"))


@query()
def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3: text blocks of every page."""
    return HT.page_rows(table(spark, sf_dir, "pages"), "page_id", "blocks").select("page_id", "pos", F.col("a").alias("block"))


@query()
def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1: main text of every page."""
    return table(spark, sf_dir, "pages").select("page_id", HT.main_text(F.col("html")).alias("text"))


@query()
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of every page with the text around them, and the candidates among them by the rules of a site."""
    rows = HT.page_rows(table(spark, sf_dir, "pages"), "page_id", "links")
    candidate = U.candidate_url(F.col("a"), "https://example.com/index", "example.com", "/t", "example.com")
    return rows.select("page_id", "pos", U.strip_query(F.col("a"), "https://example.invalid").alias("url"), F.col("b").alias("title"), F.col("c").alias("context"), candidate.alias("candidate"))


@query()
def html_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record of every page with the source of each field, its quality, and what its blocks say."""
    f = HT.page_features(table(spark, sf_dir, "pages"), "page_id")
    traced = ~T.is_empty(F.col("title")) & ~T.is_empty(F.col("evidence"))
    quality, confidence = C.parser_quality(traced, F.size("sources"), F.col("published_at").isNotNull(), F.char_length("evidence"), F.col("unparsed_date").cast("int"))
    status, sentence = C.step_status(F.col("blocks"), "tion", "ment", ("que",))
    about = C.relevance(F.col("title"), F.col("blocks"), "tion", ("anti", "enti"), "the .{0,80}tion")
    return f.select("page_id", "title", "published_at", "summary", "sources", "error", "text_hash", "n_links", "n_blocks", quality.alias("quality"), confidence.alias("confidence"), status.alias("status"), sentence.alias("status_evidence"), about.alias("relevance"))


@query()
def extraction_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index page for each of three sites, its candidates' pages read, with a second reading of some, and items assembled, reused or left at page level."""
    from recordwatch.plans import extraction as X

    pages = table(spark, sf_dir, "pages").withColumn("place", F.concat(F.lit("/items/"), F.col("page_id")))
    sources = [X.Source(f"site{k}", f"https://www.site{k}.invalid/items", f"site{k}.invalid", "/items/", f"site{k}.invalid", HT.Site(("item",)), *(("tion", ("anti",), "the .{0,80}tion") if k else ())) for k in range(3)]
    name = F.concat(F.lit("site"), F.col("page_id") % 2)
    links = F.concat(F.lit('<li>about <a href="'), F.col("place"), F.lit('?utm_source=x">Item '), F.col("page_id"), F.lit("</a></li>"))
    index = pages.groupBy(name.alias("source_id")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_id", links.alias("x")))), lambda x: x["x"]), "").alias("html"))
    index = index.unionByName(spark.createDataFrame([("site2", "<p>nothing here</p>")], "source_id string, html string"))
    k = F.col("page_id")
    details = pages.select(
        F.concat(F.lit("https://"), name, F.lit(".invalid"), "place").alias("url"), F.when(k % 11 == 0, '<div id="root"></div><script>x</script>').otherwise(F.col("html")).alias("html"),
        F.when(k % 11 == 0, F.col("html")).alias("rendered_html"), F.when(k % 13 == 0, 404).otherwise(200).alias("http_status"), F.lit("text/html").alias("content_type"),
    )
    catalog = spark.createDataFrame([(f"site{k}", f"Site {k}", "official", "a", "en") for k in range(3)], "source_id string, name string, source_type string, reliability_tier string, language string")
    stored = pages.filter(k % 13 == 0).select(I.record_id(name, F.concat(F.lit("https://"), name, F.lit(".invalid"), "place")).alias("id"), name.alias("source_id"), F.lit("as it was").alias("title"))
    found = X.extract(index, details, sources, catalog, stored, F.lit("2026-01-01"), most=10_000)
    return found["items"].groupBy("source_id", "record_scope", "detail_fetch_status", "source_quality", "relevance").agg(F.count(F.lit(1)).alias("n"))


_ALERT_LOG = """
    o AS (SELECT event_id AS run, ts, user_id % 40 AS k, CASE event_type WHEN 'error' THEN 2 WHEN 'signup' THEN 1 WHEN 'click' THEN 3 END AS r FROM events),
    n AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY ts, run) AS i FROM o)
"""


@query(f"""
    WITH RECURSIVE {_ALERT_LOG},
    m AS (SELECT k, i, run, ts, r, CASE WHEN r IS NOT NULL THEN ts + INTERVAL 24 HOUR END AS until, CASE WHEN r IS NOT NULL THEN 'open' END AS action, r AS told FROM n WHERE i = 1
          UNION ALL
          SELECT n.k, n.i, n.run, n.ts, n.r,
                 CASE WHEN n.r IS NOT NULL AND (m.r IS NULL OR n.r > m.r OR m.until <= n.ts) THEN n.ts + INTERVAL 24 HOUR ELSE m.until END,
                 CASE WHEN m.r IS NULL AND n.r IS NOT NULL THEN 'open' WHEN m.r IS NOT NULL AND n.r IS NULL THEN 'resolve' WHEN m.r IS NULL THEN NULL
                      WHEN n.r > m.r THEN 'escalate' WHEN m.until <= n.ts THEN 'update' ELSE 'suppress' END, coalesce(n.r, m.r)
          FROM m JOIN n ON n.k = m.k AND n.i = m.i + 1)
    SELECT 'condition|global|' || k AS alert_key, run::VARCHAR AS run_id, action, told::BIGINT AS severity_rank FROM m WHERE action IS NOT NULL
""")
def alert_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The alert machine over conditions seen by runs."""
    e = table(spark, sf_dir, "events")
    rank = F.when(F.col("event_type") == "error", 2).when(F.col("event_type") == "signup", 1).when(F.col("event_type") == "click", 3)
    seen = e.select(I.alert_key(F.lit("condition"), F.lit(None), F.col("user_id") % 40).alias("alert_key"), F.col("ts").cast("timestamp").alias("started_at"), F.col("event_id").alias("run_id"), rank.alias("severity_rank"))
    return AL.machine(seen).select("alert_key", "run_id", "action", "severity_rank")


@query(f"""WITH {_LOG_SQL}, f AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY started_at DESC, seq DESC) AS r FROM tl)
    SELECT CASE state WHEN 'fetch_failed' THEN 'detail_fetch_failed' ELSE state END || '|' || record_id % 7 || '|' || record_id AS alert_key,
           CASE WHEN state = 'long_absent' OR (state = 'fetch_failed' AND streak >= 3) THEN 'high' ELSE 'warning' END AS severity FROM f WHERE r = 1 AND state <> 'active'""")
def alert_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions of the records' states."""
    states = L.final_states(L.timeline(_log(spark, sf_dir), _POLICY))
    return AL.lifecycle_conditions(states.withColumn("source_id", F.col("record_id") % 7)).select("alert_key", "severity")


@query(f"""WITH {_LOG_SQL}, e AS (SELECT seq, substr(sha256(run_id || '|' || record_id || '|' || t), 1, 20) AS event_id, t FROM (SELECT seq, run_id, record_id, unnest(events) AS t FROM tl))
    SELECT event_id, CASE t WHEN 'semantic_content_changed' THEN 'warning' ELSE 'info' END AS severity, CASE t WHEN 'semantic_content_changed' THEN 'content_review' WHEN 'extraction_improved' THEN 'extraction' ELSE 'collection' END AS category
    FROM e WHERE seq % 2 = 1 AND t IN ('semantic_content_changed', 'item_discovered', 'reappeared', 'detail_fetch_recovered', 'extraction_improved')""")
def alert_notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that notify once; those of even runs were processed by the silent first evaluation."""
    e = L.events(L.timeline(_log(spark, sf_dir), _POLICY))
    first = e.filter("seq % 2 = 0")
    told = AL.notifications(first, first.limit(0), initialized=False)
    processed = AL.processed_after(first, first.limit(0))
    both = told.unionByName(AL.notifications(e, processed))
    return both.select("event_id", "severity", "category")


@query("""
    SELECT s.source, coalesce(q.quality, s.status, 'unknown') AS quality FROM (SELECT source, max(lang) AS status FROM documents GROUP BY 1) s
    LEFT JOIN (SELECT source, CASE WHEN avg(quality) > 0.85 THEN 'high' END AS quality FROM documents JOIN labels USING (doc_id) GROUP BY 1) q USING (source)
""")
def status_with_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status joined with quality, with fallbacks."""
    d = table(spark, sf_dir, "documents")
    s = d.groupBy("source").agg(F.max("lang").alias("status"))
    q = d.join(table(spark, sf_dir, "labels"), "doc_id").groupBy("source").agg(F.when(F.avg("quality") > 0.85, "high").alias("quality"))
    return s.join(q, "source", "left").select("source", T.first_filled(F.col("quality"), F.col("status"), F.lit("unknown")).alias("quality"))


@query("""
    WITH a AS (SELECT n_nationkey AS k, n_name AS x FROM nation WHERE n_nationkey % 2 = 0), b AS (SELECT n_nationkey AS k, n_regionkey AS y FROM nation WHERE n_nationkey % 3 = 0),
         c AS (SELECT s_nationkey AS k, count(*) AS z FROM supplier GROUP BY 1)
    SELECT k, x, y, z FROM a FULL JOIN b USING (k) FULL JOIN c USING (k)
""")
def three_way_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of any of three tables."""
    n = table(spark, sf_dir, "nation")
    a, b = n.filter("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("x")), n.filter("n_nationkey % 3 = 0").select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("y"))
    c = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("z"))
    return A.with_sources(a, b, c, "k")


@query("""
    WITH v AS (SELECT l_orderkey, max(l_linenumber) AS n, arg_max(l_returnflag, struct_pack(a := l_linenumber, b := l_partkey, c := l_suppkey, d := l_returnflag)) AS flag FROM lineitem WHERE l_quantity > 30 GROUP BY 1)
    SELECT o_orderkey, coalesce(flag, o_orderstatus) AS title FROM orders LEFT JOIN v ON o_orderkey = l_orderkey
""")
def latest_version_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A title from the last matching version."""
    v = K.latest_per_key(table(spark, sf_dir, "lineitem").filter("l_quantity > 30").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"), ["l_orderkey"], [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")])
    o = table(spark, sf_dir, "orders")
    return o.join(v, o.o_orderkey == v.l_orderkey, "left").select("o_orderkey", F.coalesce("l_returnflag", "o_orderstatus").alias("title"))


@query(f"""
    WITH {_SNAPSHOTS}, x AS (SELECT coalesce(a.id, b.id) AS id, a.id % 3 AS ra, b.id % 5 AS rb, nullif(a.status, '') AS sa, nullif(b.status, '') AS sb, a.price AS pa, b.price AS pb FROM a FULL JOIN b ON a.id = b.id)
    SELECT id, CASE WHEN sa IS NULL THEN coalesce(sb, CASE WHEN id % 10 <> 1 AND id % 11 = 2 AND id % 7 <> 1 THEN '' END) WHEN sb IS NULL THEN sa WHEN coalesce(rb, -1) > coalesce(ra, -1) THEN sb ELSE sa END AS status,
           CASE WHEN pa IS NULL THEN pb WHEN pb IS NULL THEN pa WHEN coalesce(rb, -1) > coalesce(ra, -1) THEN pb ELSE pa END AS price,
           list_filter([CASE WHEN sa <> sb THEN 'status' END, CASE WHEN pa <> pb THEN 'price' END], lambda v: v IS NOT NULL) AS conflicts FROM x
""")
def static_rendered_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two readings of a record merged by field."""
    a, b = _snapshots(spark, sf_dir)
    return D.merge_by_rank(a.withColumn("r", F.col("id") % 3), b.withColumn("r", F.col("id") % 5), "id", ["status", "price"], "r", "r")


@query("""
    SELECT event_id, CASE WHEN event_id % 101 = 0 THEN 'invalid_candidate_url' WHEN event_id % 103 = 0 THEN 'request_timeout' WHEN event_id % 107 = 0 THEN 'request_error' WHEN event_id % 97 = 0 THEN 'redirect_to_index_page' WHEN event_id % 89 = 0 THEN 'redirect_outside_allowed_domain'
        WHEN event_id % 600 BETWEEN 400 AND 499 THEN 'http_4xx' WHEN event_id % 600 >= 500 THEN 'http_5xx'
        WHEN event_type = 'view' THEN 'invalid_content_type' WHEN value > 90 THEN 'response_too_large' WHEN value < 1 THEN 'empty_response' END AS error FROM events
""")
def fetch_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong with a fetched page, first things first."""
    k = F.col("event_id")
    kind = F.when(F.col("event_type") == "view", "image/png").otherwise("application/xHTML+xml; charset=utf-8")
    size = F.when(F.col("value") > 90, 91).otherwise(50)
    failure, landed = F.when(k % 103 == 0, "timeout").when(k % 107 == 0, "refused"), F.when(k % 97 == 0, "index").when(k % 89 == 0, "outside").otherwise("inside")
    return table(spark, sf_dir, "events").select("event_id", C.fetch_error(k % 101 != 0, failure, landed, k % 600, kind, size, F.col("value") < 1, 90).alias("error"))


@query("""
    WITH d AS (SELECT *, CASE doc_id % 4 WHEN 0 THEN 'json_ld' WHEN 1 THEN 'next_data' WHEN 2 THEN 'embedded_json' ELSE 'anchor' END AS origin, CASE doc_id % 3 WHEN 0 THEN 'auto' WHEN 1 THEN 'never' ELSE 'always' END AS mode,
                      CASE doc_id % 5 WHEN 1 THEN 'missing_title' WHEN 2 THEN 'http_4xx' WHEN 3 THEN 'javascript_shell' WHEN 4 THEN 'http_5xx' END AS error FROM documents),
    l AS (SELECT *, CASE WHEN origin IN ('json_ld', 'next_data') AND lang <> 'fr' AND length(text) >= 60 THEN 'item_level' ELSE 'link_level' END AS level FROM d)
    SELECT doc_id, level, CASE level WHEN 'item_level' THEN 0.82 ELSE 0.62 END::DOUBLE AS confidence, CASE level WHEN 'item_level' THEN 'high' ELSE 'medium' END AS quality,
           mode <> 'never' AND coalesce(error, '') <> 'http_4xx' AND (mode = 'always' OR (doc_id % 2 = 0 AND coalesce(error, '') IN ('missing_title', 'javascript_shell'))) AS render,
           CASE doc_id % 3 WHEN 0 THEN 'unparsed_date' WHEN 1 THEN 'field_conflict:title' ELSE 'parser_warning' END AS warning FROM l
""")
def level_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """levels of candidates with quality and confidence, classes of warnings, and decisions to render."""
    k = F.col("doc_id")
    origin = F.when(k % 4 == 0, "json_ld").when(k % 4 == 1, "next_data").when(k % 4 == 2, "embedded_json").otherwise("anchor")
    mode, error = F.when(k % 3 == 0, "auto").when(k % 3 == 1, "never").otherwise("always"), F.when(k % 5 == 1, "missing_title").when(k % 5 == 2, "http_4xx").when(k % 5 == 3, "javascript_shell").when(k % 5 == 4, "http_5xx")
    d = table(spark, sf_dir, "documents").withColumn("level", C.candidate_level(origin, F.col("lang") == "fr", F.col("source"), F.col("text")))
    warning = F.when(k % 3 == 0, "No DATE given").when(k % 3 == 1, "Field_Conflict:title").otherwise("odd")
    return d.select("doc_id", "level", C.level_confidence(F.col("level")).alias("confidence"), C.level_quality(F.col("level")).alias("quality"), C.render_decision(mode, error, k % 2 != 0).alias("render"), F.get(C.warning_categories(F.array(warning, warning)), F.lit(0)).alias("warning"))


@query("""
    SELECT o_orderkey, greatest(0, floor((epoch(TIMESTAMP '1998-08-02 12:00:00') - epoch(o_orderdate)) / 86400))::BIGINT AS days,
           epoch(try_cast(CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+02:00' WHEN o_orderkey % 3 = 1 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS TIMESTAMPTZ))::BIGINT AS parsed FROM orders
""")
def time_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed times and whole days."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    text = F.when(k % 3 == 0, F.concat(F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))).when(k % 3 == 1, "soon").otherwise(F.date_format(d, "yyyy-MM-dd"))
    return table(spark, sf_dir, "orders").select("o_orderkey", TM.days_between(d.cast("timestamp"), F.lit("1998-08-02 12:00:00").cast("timestamp")).alias("days"), F.unix_timestamp(TM.parse(text)).alias("parsed"))


@query("SELECT strftime(ts, '%G-W%V') AS week, count(*) AS n, sum(count(*)) OVER (ORDER BY strftime(ts, '%G-W%V') DESC ROWS 3 PRECEDING)::BIGINT AS trend FROM events GROUP BY 1")
def week_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weeks, latest first, with a trend over four."""
    from pyspark.sql import Window

    g = table(spark, sf_dir, "events").groupBy(TM.iso_week(F.col("ts")).alias("week")).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("trend", F.sum("n").over(Window.orderBy(F.desc("week")).rowsBetween(-3, 0)))


@query("""
    SELECT '| r_regionkey | r_name |' AS line, 0::BIGINT AS pos UNION ALL SELECT '| --- | --- |', 1 UNION ALL SELECT '| ' || r_regionkey || ' | ' || r_name || ' |', 1 + row_number() OVER (ORDER BY r_regionkey) FROM region
""")
def markdown_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report as ordered rows of Markdown."""
    return RP.markdown_rows(table(spark, sf_dir, "region").select("r_regionkey", "r_name"), [F.col("r_regionkey")])


@query("""
    SELECT doc_id, 'run-1' AS run_id, 'lifecycle_initialized' AS event_type, 'initial_snapshot' AS version_kind, substr(sha256('run-1|' || doc_id || '|lifecycle_initialized'), 1, 20) AS event_id
    FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
""")
def lifecycle_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records without a state are initialized once."""
    d, l = (table(spark, sf_dir, t).select(F.col("doc_id").alias("record_id")) for t in ("documents", "labels"))  # noqa: E741
    return L.initialize(d, l, "run-1", F.lit("2026-01-01")).select(F.col("record_id").alias("doc_id"), "run_id", "event_type", "version_kind", "event_id")


@query("""
    SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'baseline' WHEN o_orderkey % 3 = 0 AND o_orderkey % 5 = 0 THEN 'unchanged' WHEN o_orderkey % 3 <> 0 AND o_orderkey % 7 = 0 THEN 'unchanged'
        WHEN o_orderkey % 3 <> 0 THEN 'new' WHEN o_orderstatus = 'F' THEN 'changed' ELSE 'unchanged' END AS change_status FROM orders
""")
def baseline_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change status before and after a source has a baseline."""
    k = F.col("o_orderkey")
    known = k % 3 == 0
    return table(spark, sf_dir, "orders").select("o_orderkey", D.baseline_status(k % 2 != 0, known, known & (k % 5 == 0), k % 7 == 0, F.col("o_orderstatus") == "F").alias("change_status"))


@query(f"""
    WITH {_SNAPSHOTS} SELECT b.id, CASE WHEN b.id % 4 = 0 AND a.id IS NOT NULL THEN a.summary WHEN b.id % 4 = 0 THEN NULL ELSE b.summary END AS summary, b.id % 4 = 0 AND a.id IS NOT NULL AS reused
    FROM b LEFT JOIN a USING (id)
""")
def reuse_last_success(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4: failed rows keep what was last read."""
    a, b = _snapshots(spark, sf_dir)
    failed = F.col("id") % 4 == 0
    current = b.select("id", failed.alias("failed"), F.when(~failed, F.col("summary")).alias("summary"))
    return D.reuse_last_success(current, a, "id", ["summary"]).select("id", "summary", "reused")


@query("SELECT event_id, event_type <> 'error' AND value > 5 AND NOT (event_id % 11 = 0) AND NOT (event_id % 13 = 0) AS complete FROM events")
def view_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a run saw everything."""
    k = F.col("event_id")
    return table(spark, sf_dir, "events").select("event_id", L.view_complete(F.col("event_type") != "error", F.col("value") > 5, k % 11 == 0, k % 13 == 0).alias("complete"))


@query("""
    WITH r AS (SELECT user_id, event_id // 2 AS run, max((event_type IN ('error', 'view'))::INT) = 1 AS met, min(event_id) AS pos FROM events GROUP BY 1, 2),
    n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pos) AS i FROM r)
    SELECT user_id, run, i - coalesce(max(CASE WHEN NOT met THEN i END) OVER (PARTITION BY user_id ORDER BY pos), 0) AS count FROM n
""")
def condition_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs in a row that met a condition, each run once."""
    e = table(spark, sf_dir, "events").select("user_id", F.expr("event_id div 2").alias("run"), F.col("event_id").alias("pos"), F.col("event_type").isin("error", "view").alias("met"))
    return AL.counters(e, "user_id", "pos", "run", "met").select("user_id", "run", "count")


@query("SELECT event_id, event_id % 5 <> 0 AND event_id * 7 % 100 < 50 AS stale FROM events")
def stale_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluations that come too late."""
    k = F.col("event_id")
    return table(spark, sf_dir, "events").select("event_id", AL.is_stale(F.when(k % 5 == 0, 0).otherwise(1), k * 7 % 100, F.lit(0), F.lit(50)).alias("stale"))


@query(f"""
    WITH RECURSIVE {_ALERT_LOG},
    m AS (SELECT k, i, ts, r, CASE WHEN r IS NOT NULL THEN ts + INTERVAL 24 HOUR END AS until, CASE WHEN r IS NOT NULL THEN 'open' END AS action, r AS told FROM n WHERE i = 1
          UNION ALL
          SELECT n.k, n.i, n.ts, n.r, CASE WHEN n.r IS NOT NULL AND (m.r IS NULL OR n.r > m.r OR m.until <= n.ts) THEN n.ts + INTERVAL 24 HOUR ELSE m.until END,
                 CASE WHEN m.r IS NULL AND n.r IS NOT NULL THEN 'open' WHEN m.r IS NOT NULL AND n.r IS NULL THEN 'resolve' WHEN m.r IS NULL THEN NULL
                      WHEN n.r > m.r THEN 'escalate' WHEN m.until <= n.ts THEN 'update' ELSE 'suppress' END, coalesce(n.r, m.r)
          FROM m JOIN n ON n.k = m.k AND n.i = m.i + 1)
    SELECT count(*) FILTER (WHERE action = 'open') AS n_open, count(*) FILTER (WHERE action = 'escalate') AS n_escalate, count(*) FILTER (WHERE action = 'update') AS n_update,
           count(*) FILTER (WHERE action = 'suppress') AS n_suppress, count(*) FILTER (WHERE action = 'resolve') AS n_resolve,
           count(*) FILTER (WHERE action <> 'suppress' AND told = 0) AS severity_0, count(*) FILTER (WHERE action <> 'suppress' AND told = 1) AS severity_1,
           count(*) FILTER (WHERE action <> 'suppress' AND told = 2) AS severity_2, count(*) FILTER (WHERE action <> 'suppress' AND told = 3) AS severity_3 FROM m
""")
def alert_action_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: alert actions by kind and severity."""
    e = table(spark, sf_dir, "events")
    rank = F.when(F.col("event_type") == "error", 2).when(F.col("event_type") == "signup", 1).when(F.col("event_type") == "click", 3)
    seen = e.select((F.col("user_id") % 40).cast("string").alias("alert_key"), F.col("ts").cast("timestamp").alias("started_at"), F.col("event_id").alias("run_id"), rank.alias("severity_rank"))
    return AL.action_counts(AL.machine(seen))


@query("""
    WITH h AS (SELECT o_orderkey AS run_id, 0 AS part, o_orderkey AS pos, o_orderstatus AS v FROM orders WHERE o_orderkey % 3 = 0
               UNION ALL SELECT o_orderkey, 1, o_orderkey, 'new' FROM orders WHERE o_orderkey % 4 = 0 AND o_orderstatus <> 'P')
    SELECT run_id::VARCHAR AS run_id, arg_max(v, struct_pack(p := part, q := pos)) AS v FROM h GROUP BY run_id ORDER BY min(struct_pack(p := part, q := pos)) DESC LIMIT 400
""")
def health_history_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final runs replaced in place, the last four hundred kept."""
    o = table(spark, sf_dir, "orders")
    run = F.col("o_orderkey")
    history = o.filter(run % 3 == 0).select(run.cast("string").alias("run_id"), F.lit(None).cast("string").alias("health_phase"), F.col("o_orderstatus").alias("v"), run.alias("pos"))
    record = o.filter(run % 4 == 0).select(run.cast("string").alias("run_id"), F.when(F.col("o_orderstatus") == "P", "provisional").otherwise("final").alias("health_phase"), F.lit("new").alias("v"), run.alias("pos"))
    return H.upsert_history(history, record, 400).select("run_id", "v")


@query("""
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN floor(value)::BIGINT + 2 ELSE 7 END AS total, event_id % 4 = 0 AS on_switch, event_id % 5 <> 0 AS port_ok FROM events
""")
def usage_and_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of usage, switches, ports."""
    k = F.col("event_id")
    total = C.tokens_used(F.when(k % 3 == 1, F.floor("value")), F.lit(2), F.when(k % 3 == 2, 7))
    port = F.when(k % 5 == 0, "70000").otherwise("587")
    return table(spark, sf_dir, "events").select("event_id", total.alias("total"), T.truthy(F.when(k % 4 == 0, " Yes").otherwise("off")).alias("on_switch"), C.valid_port(port).alias("port_ok"))


@query(r"""
    WITH d AS (SELECT doc_id, text, doc_id % 5 <> 0 AS traced, doc_id % 4 AS n, lang = 'en' AS dated, n_chars, (doc_id % 7 = 0)::INT AS w FROM documents)
    SELECT doc_id, CASE WHEN NOT traced THEN 'low' WHEN dated AND n_chars >= 80 AND n >= 3 AND w = 0 THEN 'high' ELSE 'medium' END AS quality,
           CASE WHEN NOT traced THEN 35 WHEN dated AND n_chars >= 80 AND n >= 3 AND w = 0 THEN 90 ELSE least(84, 65 + least(n, 3) * 5 + CASE WHEN dated THEN 4 ELSE 0 END) END::BIGINT AS confidence,
           contains(lower(text), 'the ') AND length('the ') < length(text) AS grows FROM d
""")
def parser_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """quality by whether a record can be traced and how much was found, and growth of texts."""
    k = F.col("doc_id")
    quality, confidence = C.parser_quality(k % 5 != 0, (k % 4).cast("int"), F.col("lang") == "en", F.col("n_chars"), (k % 7 == 0).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", quality.alias("quality"), F.round(confidence * 100).cast("long").alias("confidence"), T.grows(F.lit("the "), F.col("text")).alias("grows"))


@query(r"""
    WITH b AS (SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'About Tion  now' WHEN doc_id % 11 = 1 THEN '' ELSE lang || ' caution' END AS title, string_split(lower(text), chr(10)) AS bs FROM documents),
    m AS (SELECT *, list_filter(bs, lambda x: contains(x, 'tion')) AS ms, array_to_string(bs, ' ') AS whole, lower(trim(regexp_replace(title, '\s+', ' ', 'g'))) || ' ' || array_to_string(bs[1:3], ' ') AS start FROM b),
    p AS (SELECT *, list_filter(ms, lambda x: contains(x, 'anti') OR contains(x, 'enti')) AS ps FROM m)
    SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'direct' WHEN len(ms) > 0 AND len(ms) = len(ps) THEN 'incidental' WHEN regexp_matches(start, 'the .{0,80}tion') THEN 'direct'
        WHEN contains(whole, 'tion') AND (contains(whole, 'anti') OR contains(whole, 'enti')) THEN 'incidental' WHEN title <> '' AND len(bs) > 0 AND NOT contains(start, 'tion') THEN 'not_direct' ELSE 'unknown' END AS relevance FROM p
""")
def relevance_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """whether a text is about something, by its title and blocks."""
    k = F.col("doc_id")
    title = F.when(k % 11 == 0, "About Tion  now").when(k % 11 == 1, "").otherwise(F.concat("lang", F.lit(" caution")))
    return table(spark, sf_dir, "documents").select("doc_id", C.relevance(title, F.split("text", "\n"), "tion", ("anti", "enti"), "the .{0,80}tion").alias("relevance"))


@query(r"""
    WITH b AS (SELECT doc_id, lang, flatten(list_transform(string_split(text, chr(10)), lambda x: string_split(regexp_replace(x, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)))) AS ss FROM documents),
    f AS (SELECT doc_id, lang, list_filter(ss, lambda x: contains(lower(x), 'tion'))[1] AS a, list_filter(ss, lambda x: contains(lower(x), 'ment') AND NOT contains(lower(x), 'que') AND NOT contains(lower(x), 'anti'))[1] AS b FROM b)
    SELECT doc_id, CASE WHEN coalesce(a, '') <> '' THEN 'targeting' WHEN coalesce(b, '') <> '' THEN 'completed' ELSE 'unknown' END AS status,
           rtrim(substr(trim(regexp_replace(CASE WHEN coalesce(a, '') <> '' THEN a ELSE coalesce(b, '') END, '\s+', ' ', 'g')), 1, 600), ' ') AS sentence, CASE WHEN lang = 'en' THEN doc_id % 1000 END AS counted FROM f
""")
def status_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the sentence that tells a status, and a number told in direct texts."""
    blocks = F.split("text", "\n")
    status, sentence = C.step_status(blocks, "tion", "ment", ("que", "anti"))
    number = C.counted(F.array(F.concat(F.lit("with "), F.col("doc_id") % 1000, F.lit(" small  UNITS aboard"))), r"small\s+units", F.col("lang") == "en")
    return table(spark, sf_dir, "documents").select("doc_id", status.alias("status"), sentence.alias("sentence"), number.cast("long").alias("counted"))


@query("""
    WITH e AS (SELECT event_id, CASE event_id % 6 WHEN 0 THEN '7' WHEN 1 THEN '0' WHEN 2 THEN '-3' WHEN 3 THEN 'x' WHEN 4 THEN ' 12 ' ELSE '' END AS n, CASE event_id % 5 WHEN 0 THEN '0.25' WHEN 1 THEN '1.5' WHEN 2 THEN 'no' WHEN 3 THEN NULL ELSE '1' END AS r FROM events)
    SELECT event_id, CASE event_id % 6 WHEN 0 THEN 7 WHEN 4 THEN 12 ELSE 5 END::BIGINT AS number, event_id % 6 IN (1, 2, 3) AS number_warned, CASE event_id % 5 WHEN 0 THEN 0.25 WHEN 4 THEN 1.0 ELSE 0.5 END::DOUBLE AS ratio, event_id % 5 IN (1, 2) AS ratio_warned FROM e
""")
def safe_settings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """settings that fall back to their defaults, and when that is worth a warning."""
    k = F.col("event_id")
    given = F.when(k % 6 == 0, "7").when(k % 6 == 1, "0").when(k % 6 == 2, "-3").when(k % 6 == 3, "x").when(k % 6 == 4, " 12 ").otherwise("")
    share = F.when(k % 5 == 0, "0.25").when(k % 5 == 1, "1.5").when(k % 5 == 2, "no").when(k % 5 == 4, "1")
    (number, warned), (ratio, doubted) = C.safe_positive(given, 5), C.safe_ratio(share, 0.5)
    return table(spark, sf_dir, "events").select("event_id", number.alias("number"), warned.alias("number_warned"), ratio.alias("ratio"), doubted.alias("ratio_warned"))


@query("""
    SELECT doc_id, CASE WHEN source = 'src1' THEN ['official', 'one', 'news'] || CASE WHEN n_chars % 2 = 0 THEN ['orbit'] ELSE [] END WHEN source = 'src2' THEN ['official', 'orbit'] ELSE ['official'] || CASE WHEN n_chars % 2 = 0 THEN ['orbit'] ELSE [] END END AS tags FROM documents
""")
def source_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tags of a source, and one more by keyword."""
    words = F.when(F.col("n_chars") % 2 == 0, F.array(F.lit("x"), F.lit("orbit"))).otherwise(F.array(F.lit("x")))
    return table(spark, sf_dir, "documents").select("doc_id", C.source_tags(F.col("source"), {"src1": ("one", "news"), "src2": ("orbit",)}, words, "orbit").alias("tags"))


@query(r"""
    SELECT o_orderkey, '{"facts.cust.id":"' || o_custkey || '","facts.keys":"[' || o_orderkey || ',' || o_custkey || ']","facts.status":"' || o_orderstatus || '"}' AS flat,
           '{"a":"' || CASE WHEN length(o_orderpriority) > 5 THEN rtrim(substr(o_orderpriority, 1, 4)) || '…' ELSE o_orderpriority END || '","b":"' || o_orderstatus || '"}' AS limited, '{"k":["' || o_orderstatus || '","' || o_orderstatus || '"]}' AS listed FROM orders
""")
def flattened_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nested facts as paths, and mappings cut to what can be shown."""
    o = table(spark, sf_dir, "orders").withColumn("x", F.struct(F.struct(F.struct(F.col("o_custkey").alias("id")).alias("cust"), F.col("o_orderstatus").alias("status"), F.array("o_orderkey", "o_custkey").alias("keys")).alias("facts")))
    flat = N.flattened(F.col("x"), o.schema["x"].dataType)
    limited = N.limited(F.create_map(F.lit("b"), F.concat(F.lit(" "), "o_orderstatus"), F.lit("a"), F.col("o_orderpriority")), 5)
    listed = N.limited_lists(F.create_map(F.lit("k"), F.array_repeat("o_orderstatus", 5)), most=2)
    return o.select("o_orderkey", F.to_json(flat).alias("flat"), F.to_json(limited).alias("limited"), F.to_json(listed).alias("listed"))


@query(f"""
    WITH {_SNAPSHOTS},
    x AS (SELECT b.id, a.price AS p0, b.price AS p1, a.status AS s0, b.status AS s1, CASE WHEN b.id % 4 = 0 THEN '' ELSE 'h1' END AS t0, CASE WHEN b.id % 5 = 0 THEN '' ELSE 'h1' END AS t1, b.id % 3 AS q0, b.id % 4 AS q1, (b.id % 10)::INT AS c0, (b.id % 9)::INT AS c1 FROM a JOIN b USING (id)),
    w AS (SELECT id, list_filter([CASE WHEN t0 = '' AND t1 <> '' THEN 'field_evidence.title' END, CASE WHEN p0 IS NULL AND p1 IS NOT NULL THEN 'price' END, CASE WHEN s0 = '' AND s1 <> '' THEN 'status' END, CASE WHEN q1 > q0 THEN 'source_quality' END, CASE WHEN c1 > c0 THEN 'extraction_confidence' END], lambda v: v IS NOT NULL) AS better,
                 list_filter([CASE WHEN t0 <> '' AND t1 = '' THEN 'field_evidence.title' END, CASE WHEN p0 IS NOT NULL AND p1 IS NULL THEN 'price' END, CASE WHEN s0 <> '' AND s1 = '' THEN 'status' END, CASE WHEN q1 < q0 THEN 'source_quality' END, CASE WHEN c1 < c0 THEN 'extraction_confidence' END], lambda v: v IS NOT NULL) AS worse FROM x)
    SELECT id, CASE WHEN len(better) > 0 THEN 'improved' WHEN len(worse) > 0 THEN 'degraded' ELSE 'unchanged' END AS status, list_sort(better) AS improved, list_sort(list_filter(worse, lambda v: NOT list_contains(better, v))) AS degraded FROM w
""")
def extraction_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What extraction gained or lost between two readings, besides the facts themselves."""
    a, b = (x.select("id", "price", "status") for x in _snapshots(spark, sf_dir))
    x = a.alias("a").join(b.alias("b"), "id")
    k = F.col("id")
    semantic = D.semantic_diff({f: (F.col(f"a.{f}"), F.col(f"b.{f}")) for f in ("price", "status")})
    evidence = [F.create_map(F.lit("title"), F.when(k % n == 0, "").otherwise("h1")) for n in (4, 5)]
    quality = [F.element_at(F.array(*[F.lit(q) for q in C.QUALITY]), (k % n + 1).cast("int")) for n in (3, 4)]
    d = D.extraction_diff(semantic, tuple(evidence), tuple(quality), ((k % 10) / 10, (k % 9) / 10))
    return x.select("id", d["status"].alias("status"), d["improved_reasons"].alias("improved"), d["degraded_reasons"].alias("degraded"))


@query(f"""
    WITH {_SNAPSHOTS},
    c AS (SELECT id, id % 3 AS source_id, id % 19 = 5 AS reused, CASE WHEN id % 23 = 3 THEN 'v2' ELSE 'v1' END AS parser, status || '|' || summary AS h, price, status, CASE WHEN id % 29 = 4 THEN summary || ': more' WHEN id % 29 = 5 THEN 'other' ELSE summary END AS title FROM b),
    e AS (SELECT id, CASE WHEN id % 31 = 6 THEN NULL ELSE status || '|' || summary END AS h, status || '|' || summary AS ch, price, status, summary AS title FROM a WHERE id % 4 <> 0),
    j AS (SELECT c.*, e.id IS NOT NULL AS known, e.h AS eh, e.ch AS ech, e.price AS ep, e.status AS es, e.title AS et, c.id % 8 = 0 AS failed, source_id <> 2 AS booted, source_id = 1 AS upgraded FROM c LEFT JOIN e USING (id)),
    f AS (SELECT *, known AND parser = 'v2' AS reparsed, CASE WHEN parser = 'v2' THEN NOT (lower(et) = lower(title) OR starts_with(lower(title), lower(et) || ':') OR starts_with(lower(et), lower(title) || ':')) OR (status <> '' AND es <> status) WHEN eh IS NOT NULL THEN status <> es AND status <> '' ELSE ech IS DISTINCT FROM h END AS facts FROM j),
    r AS (SELECT *, CASE WHEN reused THEN 'detail_fetch_failed_reused_previous_success' WHEN NOT booted THEN 'baseline_established' WHEN NOT known AND failed THEN 'detail_failure_recovered' WHEN NOT known AND upgraded THEN 'parser_enrichment_discovery' WHEN NOT known THEN 'new_item'
                         WHEN facts THEN 'semantic_content_changed' WHEN reparsed OR ep IS DISTINCT FROM price THEN 'parser_enrichment' ELSE 'no_semantic_change' END AS reason FROM f)
    SELECT id, reason AS change_reason, CASE reason WHEN 'baseline_established' THEN 'baseline' WHEN 'new_item' THEN 'new' WHEN 'semantic_content_changed' THEN 'changed' ELSE 'unchanged' END AS change_status,
           CASE WHEN reused THEN 'failed' WHEN reason IN ('detail_failure_recovered', 'parser_enrichment_discovery', 'parser_enrichment') THEN 'improved' ELSE 'unchanged' END AS extraction_change_status,
           CASE WHEN known THEN 1 ELSE 2 END::BIGINT AS first_seen_at, CASE WHEN known AND reason <> 'semantic_content_changed' THEN 1 ELSE 2 END::BIGINT AS last_changed_at, ech AS previous_content_hash FROM r
""")
def baseline_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current items against stored ones, earlier failures and the state of their sources."""
    a, b = _snapshots(spark, sf_dir)
    k, h = F.col("id"), F.concat_ws("|", "status", "summary")
    title = F.when(k % 29 == 4, F.concat("summary", F.lit(": more"))).when(k % 29 == 5, "other").otherwise(F.col("summary"))
    current = b.select(k, (k % 3).alias("source_id"), (k % 19 == 5).alias("reused"), F.lit(2).cast("long").alias("fetched_at"), F.when(k % 23 == 3, "v2").otherwise("v1").alias("parser_version"), h.alias("semantic_hash"), F.col("price").alias("extraction_hash"), title.alias("title"), F.col("status").alias("published"), "status")
    old = a.filter(k % 4 != 0).select(k, F.lit("v1").alias("parser_version"), F.when(k % 31 != 6, h).alias("semantic_hash"), h.alias("content_hash"), F.col("price").alias("extraction_hash"), F.col("summary").alias("title"), F.col("status").alias("published"), "status", F.lit(1).cast("long").alias("first_seen_at"), F.lit(1).cast("long").alias("last_changed_at"))
    failures = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")).filter(k % 8 == 0)
    sources = spark.createDataFrame([(0, True, None), (1, True, "v0"), (2, False, None)], "source_id long, bootstrapped boolean, previous_parser_version string")
    found = D.baseline_changes(current, old, failures, sources, ["status"])
    return found.select("id", "change_reason", "change_status", "extraction_change_status", "first_seen_at", "last_changed_at", "previous_content_hash")


@query("""
    SELECT doc_id::VARCHAR AS id, source AS source_id, CASE WHEN length(text) > 800 THEN rtrim(substr(text, 1, 799), ' ') || '…' ELSE text END AS evidence, 0::BIGINT AS n_keywords, NULL::VARCHAR AS summary FROM documents
""")
def record_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allowed columns only, in their order, with evidence cut and missing lists empty."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("source").alias("source_id"), F.col("text").alias("evidence"), "n_chars")
    got = RC.projected(d, ["id", "source_id", "summary", "evidence", "matched_keywords"], ["matched_keywords"])
    return got.select("id", "source_id", "evidence", F.size("matched_keywords").cast("long").alias("n_keywords"), "summary")


@query("SELECT doc_id FROM documents WHERE doc_id % 3 <> 0 AND doc_id % 5 IN (0, 1) AND NOT (source = 'src3' AND lang <> 'en')")
def changed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: items that are new or changed, of a restricted source only what is direct."""
    k = F.col("doc_id")
    d = table(spark, sf_dir, "documents").withColumns({"record_scope": F.when(k % 3 == 0, "page").otherwise("item"), "change_status": F.when(k % 5 == 0, "new").when(k % 5 == 1, "changed").otherwise("unchanged")})
    return RC.changed_items(d, F.col("source") == "src3", F.col("lang") == "en").select("doc_id")


@query("""
    SELECT h.o_orderkey::VARCHAR AS run_id, h.o_orderstatus AS overall_health, a.n AS alerts FROM orders h LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_quantity > 25 GROUP BY 1) a ON h.o_orderkey = a.l_orderkey WHERE h.o_orderpriority <> '5-LOW'
""")
def aligned_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Final health with the alert report of the same run."""
    run = F.col("o_orderkey").cast("string")
    health = table(spark, sf_dir, "orders").select(run.alias("run_id"), F.when(F.col("o_orderpriority") == "5-LOW", "provisional").otherwise("final").alias("health_phase"), F.lit(True).alias("is_final"), F.col("o_orderstatus").alias("overall_health"))
    alerts = table(spark, sf_dir, "lineitem").filter("l_quantity > 25").groupBy(F.col("l_orderkey").cast("string").alias("run_id")).agg(F.count(F.lit(1)).alias("alerts"))
    return RC.aligned(health, alerts).select("run_id", "overall_health", "alerts")


@query("""
    WITH c AS (SELECT user_id, event_id AS pos, event_type || floor(value)::BIGINT % 4 AS url FROM events), f AS (SELECT user_id, url, min(pos) AS pos FROM c GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY pos) AS n FROM f)
    SELECT user_id, list(url ORDER BY pos) AS urls, list('t' || pos ORDER BY pos) AS titles FROM r WHERE n <= 5 GROUP BY 1
""")
def link_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five different links of each page."""
    e = table(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("pos"), F.concat(F.lit(" "), "event_type", F.floor("value") % 4).alias("url"), F.concat(F.lit("t"), "event_id").alias("title"), F.array(F.lit("k")).alias("matched_keywords"))
    return RC.link_payload(e, "user_id").select("user_id", F.col("links.url").alias("urls"), F.col("links.title").alias("titles"))


@query("SELECT n_nationkey, row_number() OVER (ORDER BY n_regionkey::VARCHAR, n_nationkey::VARCHAR) - 1 AS place FROM nation")
def state_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States by source and id, both as text."""
    n = RC.in_order(table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("source_id"), F.col("n_nationkey").alias("record_id")))
    # A report's rows are few; they are numbered in the order in which they come.
    listed = n.coalesce(1).agg(F.collect_list("record_id").alias("x"))
    return listed.select(F.posexplode("x").alias("place", "n_nationkey")).select("n_nationkey", F.col("place").cast("long").alias("place"))


@query("""
    WITH f AS (SELECT event_id, user_id % 5 AS k, event_type AS action FROM events ORDER BY event_id LIMIT 40)
    SELECT min(event_id) AS pos, 'a' || k AS alert_key, action FROM f GROUP BY ALL
""")
def shown_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the first forty alerts the first of each kind."""
    a = table(spark, sf_dir, "events").select(F.col("event_id").alias("pos"), F.concat(F.lit("a"), F.col("user_id") % 5).alias("alert_key"), F.col("event_type").alias("action"), F.lit("open").alias("status"))
    return RC.shown_alerts(a).select("pos", "alert_key", "action")


@query("""
    WITH w AS (SELECT strftime(ts, '%G-W%V') AS iso_week, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS errors, max(event_id) AS latest FROM events GROUP BY 1), m AS (SELECT * FROM w WHERE iso_week <> (SELECT max(iso_week) FROM w))
    SELECT iso_week, CASE WHEN errors > 0 AND latest % 2 = 0 THEN n * 10 WHEN iso_week = (SELECT max(iso_week) FROM w) THEN n * 10 ELSE n END AS n, CASE WHEN iso_week <> (SELECT max(iso_week) FROM w) THEN errors END AS errors FROM w
    WHERE iso_week <> (SELECT max(iso_week) FROM w) OR true
""")
def week_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K7: rows of weeks put in the place of those the manifest has; its other columns stay."""
    w = table(spark, sf_dir, "events").groupBy(TM.iso_week(F.col("ts")).alias("iso_week")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"), F.max("event_id").alias("latest"))
    last = F.broadcast(w.agg(F.max("iso_week").alias("last")))
    marked = w.join(last, F.lit(True))
    manifest = marked.filter("iso_week <> last").select("iso_week", "n", "errors")
    new = marked.filter("(errors > 0 and latest % 2 = 0) or iso_week = last").select("iso_week", (F.col("n") * 10).alias("n"))
    return RC.week_index(manifest, new)


@query("""
    WITH e AS (SELECT event_id, value, substr(sha256('src|' || event_id), 1, 16) AS id FROM events),
    b AS (SELECT count(*) FILTER (WHERE value > 60) AS broken FROM e),
    n AS (SELECT event_id FROM events WHERE event_type = 'error' UNION ALL SELECT event_id FROM events WHERE event_type = 'error' AND value > 30),
    o AS (SELECT count(*) AS replayed FROM n JOIN events USING (event_id) WHERE ts <= TIMESTAMP '2024-01-02'), u AS (SELECT sum(c - 1)::BIGINT AS twice FROM (SELECT count(*) AS c FROM n GROUP BY event_id))
    SELECT unnest(['ids_are_derived', 'bootstrap_did_not_replay_history', 'notified_once']) AS rule, unnest([broken = 0, replayed = 0, twice = 0]) AS passed, unnest([broken, replayed, twice]) AS violations FROM b, o, u
""")
def replay_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4, Q8: ids computed anew, and no notification of what happened before the first evaluation."""
    e = table(spark, sf_dir, "events")
    right = I.record_id(F.lit("src"), F.col("event_id"))
    marked = e.withColumn("id", F.when(F.col("value") > 60, "wrong").otherwise(right))
    errors = e.filter("event_type = 'error'").select("event_id")
    notified = errors.unionByName(e.filter("event_type = 'error' and value > 30").select("event_id"))
    return Q.report(Q.derived_ids(marked, "ids_are_derived", right, "id"), Q.no_replay(e.select("event_id", F.col("ts").alias("occurred_at")), notified, F.lit("2024-01-02").cast("timestamp")))


_RUNS_SQL = """
    c AS (SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS e, count(*) FILTER (WHERE event_type = 'view') AS v, count(*) FILTER (WHERE event_type = 'click') AS k, count(*) FILTER (WHERE event_type = 'purchase') AS p, count(*) FILTER (WHERE event_type = 'signup') AS g, min(ts) AS started, max(ts) AS finished FROM events GROUP BY 1),
    r AS (SELECT *, CASE user_id % 5 WHEN 0 THEN 'provisional' WHEN 4 THEN CASE WHEN user_id % 2 = 0 THEN 'odd' ELSE 'final' END ELSE 'final' END AS phase, CASE WHEN p % 5 + g % 5 > 0 THEN (p % 5) / (p % 5 + g % 5)::DOUBLE END AS rate,
                 CASE WHEN user_id % 3 = 0 THEN 100.0 ELSE greatest(0, (epoch_us(finished) - epoch_us(started)) / 1000000.0) END::DOUBLE AS seconds, user_id % 7 = 0 AS late, CASE v % 4 WHEN 0 THEN 'success' WHEN 1 THEN 'failure' WHEN 2 THEN 'skipped' ELSE 'unknown' END AS step FROM c),
    d AS (SELECT *, CASE WHEN e % 2 = 0 THEN 'healthy' ELSE 'degraded' END AS c1, CASE WHEN rate IS NULL THEN 'unknown' WHEN rate >= 0.5 THEN 'healthy' ELSE 'degraded' END AS c3, CASE WHEN k % 2 = 1 THEN 'degraded' ELSE 'healthy' END AS c4,
                 CASE user_id % 4 WHEN 0 THEN 'healthy' WHEN 1 THEN 'healthy' WHEN 2 THEN 'degraded' ELSE 'unknown' END AS c5, CASE WHEN phase = 'provisional' THEN 'pending_at_render_time' ELSE CASE step WHEN 'success' THEN 'healthy' WHEN 'failure' THEN 'unhealthy' WHEN 'skipped' THEN 'not_applicable' ELSE 'unknown' END END AS c6,
                 CASE WHEN phase = 'provisional' THEN 'pending_at_render_time' ELSE CASE step WHEN 'success' THEN 'healthy' WHEN 'failure' THEN 'degraded' WHEN 'skipped' THEN 'not_applicable' ELSE 'unknown' END END AS c8 FROM r),
    h AS (SELECT *, CASE WHEN phase = 'odd' THEN 'unhealthy' WHEN late THEN 'degraded' WHEN p % 6 = 0 OR c6 = 'unhealthy' THEN 'unhealthy'
                         WHEN g % 3 = 0 OR 'degraded' IN (c1, c3, c4, c5, c8) OR (phase = 'final' AND 'unknown' IN (c1, c3, c4, c5, c6, c8)) OR seconds > 900 THEN 'degraded' ELSE 'healthy' END AS overall_health FROM d)
"""


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's events as one run: counts, outcomes of steps and open alerts."""
    n = lambda t: F.count_if(F.col("event_type") == t)
    c = table(spark, sf_dir, "events").groupBy("user_id").agg(n("error").alias("e"), n("view").alias("v"), n("click").alias("k"), n("purchase").alias("p"), n("signup").alias("g"), F.min("ts").cast("timestamp").alias("started_at"), F.max("ts").cast("timestamp").alias("finished_at"))
    u, step = F.col("user_id"), F.when(F.col("v") % 4 == 0, "Passed").when(F.col("v") % 4 == 1, "ERROR").when(F.col("v") % 4 == 2, "disabled").otherwise("?")
    phase = F.when(u % 5 == 0, "provisional").when((u % 5 == 4) & (u % 2 == 0), "odd").otherwise("final")
    return c.select(
        u.alias("run_id"), "started_at", "finished_at", phase.alias("health_phase"), F.lit(2).alias("total_sources"), (2 - F.col("e") % 2).alias("reachable_sources"), F.lit(2).alias("complete_sources"), (F.col("p") % 5).alias("success"), (F.col("g") % 5).alias("failed"),
        F.lit(False).alias("stale"), (F.col("k") % 2).alias("attention_items"), F.when(u % 4 == 0, "disabled").when(u % 4 == 1, "generated").otherwise("x").alias("model_status"), F.when(u % 4 == 1, "passed").when(u % 4 == 2, "failed").otherwise("unknown").alias("validation_status"),
        *[step.alias(f"{name}_outcome") for name in H.STEPS], F.when(u % 3 == 0, 100.0).alias("duration_given"), F.when(F.col("g") % 3 == 0, 1).otherwise(0).alias("open_warning"), F.lit(0).alias("open_high"), F.when(F.col("p") % 6 == 0, 1).otherwise(0).alias("open_critical"),
        F.when(u % 7 == 0, F.col("finished_at") + F.expr("interval 1 day")).alias("latest_started_at"),
    )


@query(f"""WITH {_RUNS_SQL}
    SELECT user_id AS run_id, overall_health, phase = 'final' AS is_final, phase <> 'odd' AND NOT late AS write_allowed, seconds AS duration_seconds, c3 AS detail_extraction, c6 AS output_validation, c8 AS email,
           CASE WHEN phase = 'odd' THEN 'invalid_health_phase' WHEN late THEN 'stale_run_ignored' WHEN seconds > 900 THEN 'runtime_above_threshold' END AS warning FROM h""")
def run_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of a run, its health in two phases, and whether it may be written."""
    return H.run_health(_runs(spark, sf_dir)).select("run_id", "overall_health", "is_final", "write_allowed", "duration_seconds", "detail_extraction", "output_validation", "email", "warning")


@query(f"""WITH {_RUNS_SQL}, f AS (SELECT * FROM h WHERE phase = 'final' AND NOT late),
    s AS (SELECT count(*) FILTER (WHERE user_id % 2 = 1) AS changed, count(*) FILTER (WHERE user_id % 11 = 0) AS missing, count(*) - 30 AS over FROM f)
    SELECT unnest(['final_run_health_phase', 'final_components_complete', 'final_component_statuses_valid', 'final_has_no_pending_components', 'final_step_outcome_mapping_consistent', 'final_health_history_unique', 'final_health_history_only_final', 'final_health_history_current_upserted', 'final_health_history_retention', 'final_alert_report_aligned']) AS rule,
           unnest([0, 0, 0, 0, 0, 0, 0, changed, greatest(0, over), missing])::BIGINT AS violations, unnest([true, true, true, true, true, true, true, changed = 0, over <= 0, missing = 0]) AS passed FROM s""")
def final_health_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q10: final health against its history, its alert reports and the outcomes of its steps; some runs' history and reports are spoilt."""
    h = H.run_health(_runs(spark, sf_dir)).filter("is_final and write_allowed")
    history = h.select("run_id", "health_phase", F.when(F.col("run_id") % 2 == 1, "other").otherwise(F.col("overall_health")).alias("overall_health"))
    return Q.final_health(h, history, h.filter("run_id % 11 <> 0").select("run_id"), (*H.INTERNAL, *H.STEPS), H.STEPS, 30)


@query("""
    WITH e AS (SELECT event_id AS seq, user_id % 20 AS s, event_type <> 'error' AS reachable, event_type <> 'signup' AS complete, floor(value)::BIGINT AS n FROM events),
    m AS (SELECT *, row_number() OVER w AS i, CASE WHEN count(CASE WHEN complete THEN n END) OVER v >= 3 THEN median(CASE WHEN complete THEN n END::DOUBLE) OVER v END AS med FROM e
          WINDOW w AS (PARTITION BY s ORDER BY seq), v AS (PARTITION BY s ORDER BY seq ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)),
    u AS (SELECT seq, s, CASE WHEN NOT reachable THEN i - coalesce(max(CASE WHEN reachable THEN i END) OVER (PARTITION BY s ORDER BY seq), 0) ELSE 0 END AS count FROM m),
    w AS (SELECT *, reachable AND complete AS whole, coalesce(med > 0 AND n < med * 0.5, false) AS low FROM m),
    x AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY seq) AS j FROM w WHERE whole),
    y AS (SELECT seq, s, low, j - coalesce(max(CASE WHEN NOT low THEN j END) OVER (PARTITION BY s ORDER BY seq), 0) AS count FROM x)
    SELECT seq, 'source_unreachable|' || s || '|global' AS alert_key, count::BIGINT AS count, CASE WHEN count >= 2 THEN 2 WHEN count >= 1 THEN 1 END::BIGINT AS severity_rank FROM u
    UNION ALL SELECT w.seq, 'candidate_discovery_degraded|' || w.s || '|global', coalesce(y.count, 0)::BIGINT, CASE WHEN y.low AND y.count >= 2 THEN 1 END::BIGINT FROM w LEFT JOIN y USING (seq, s)
""")
def run_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that can't be reached or lose their candidates, in every run that looked."""
    k = F.col("event_type")
    s = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.col("event_id").alias("run_id"), F.col("ts").alias("started_at"), (F.col("user_id") % 20).alias("source_id"), (k != "error").alias("reachable"), (k != "signup").alias("complete"), F.floor("value").alias("candidate_count"))
    both = CN.unreachable(s).unionByName(CN.collapsed(s))
    return both.select("seq", "alert_key", "count", F.col("severity_rank").cast("long").alias("severity_rank"))


@query("""
    WITH e AS (SELECT event_id AS seq, user_id, event_type AS t, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i FROM events),
    r AS (SELECT seq, user_id, CASE t WHEN 'purchase' THEN 1.0 WHEN 'error' THEN 0.0 ELSE 0.25 END AS rate FROM e WHERE t <> 'signup'),
    q AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS j FROM r),
    a AS (SELECT seq, user_id, rate, CASE WHEN rate < 0.5 THEN j - coalesce(max(CASE WHEN rate >= 0.5 THEN j END) OVER (PARTITION BY user_id ORDER BY seq), 0) ELSE 0 END AS n FROM q),
    b AS (SELECT seq, user_id, t, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS j FROM e WHERE t IN ('purchase', 'error', 'click')),
    c AS (SELECT seq, user_id, CASE WHEN t <> 'purchase' THEN j - coalesce(max(CASE WHEN t = 'purchase' THEN j END) OVER (PARTITION BY user_id ORDER BY seq), 0) ELSE 0 END AS n FROM b)
    SELECT seq, 'detail_success_rate_degraded|' || user_id || '|global' AS alert_key, n::BIGINT AS count, CASE WHEN n >= 2 THEN CASE WHEN n >= 3 AND rate = 0 THEN 2 ELSE 1 END END::BIGINT AS severity_rank FROM a
    UNION ALL SELECT seq, 'llm_validation_failed|' || user_id || '|global', n::BIGINT, CASE WHEN n >= 3 THEN 2 WHEN n >= 1 THEN 1 END::BIGINT FROM c
    UNION ALL SELECT seq, CASE seq % 2 WHEN 0 THEN 'email_delivery_failed' ELSE 'transaction_failed' END || '|global|global', CASE WHEN t IN ('error', 'click') THEN 1 ELSE 0 END::BIGINT, CASE WHEN t IN ('error', 'click') THEN CASE seq % 2 WHEN 0 THEN 1 ELSE 3 END END::BIGINT FROM e WHERE t IN ('error', 'click', 'purchase')
    UNION ALL SELECT seq, 'stale_run_ignored|global|global', (t = 'view')::BIGINT, CASE WHEN t = 'view' THEN 1 END::BIGINT FROM e
""")
def step_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates, validation, steps and stale runs as conditions, and the types each run looked for."""
    t = F.col("event_type")
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.col("event_id").alias("run_id"), F.col("ts").alias("started_at"), "user_id", t)
    rates = CN.success_rate(e.withColumn("success", F.when(t == "purchase", 4).when(t.isin("view", "click"), 1).otherwise(0)).withColumn("failed", F.when(t == "error", 4).when(t.isin("view", "click"), 3).otherwise(0)), ["user_id"])
    models = CN.validation(e.withColumn("model_status", F.when(t == "purchase", "generated").when(t == "click", "validation_failed")).withColumn("validation_status", F.when(t == "purchase", "passed").when(t == "error", "failed")), ["user_id"])
    steps = CN.steps(e.withColumn("alert_type", F.when(F.col("seq") % 2 == 0, "email_delivery_failed").otherwise("transaction_failed")).withColumn("status", F.when(t == "purchase", "passed").when(t == "error", "failed").when(t == "click", "canceled").otherwise("disabled")))
    late = CN.stale_runs(e.withColumn("stale", t == "view"))
    return rates.unionByName(models).unionByName(steps).unionByName(late).select("seq", "alert_key", "count", F.col("severity_rank").cast("long").alias("severity_rank"))


@query()
def embedded_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H5: candidates in JSON that pages embed (here added to every third page)."""
    extra = F.concat(F.col("html"), F.lit('<script type="application/ld+json">{"items": [{"url": "/item/'), F.col("page_id").cast("string"), F.lit('", "name": "An item"}]}</script>'))
    p = table(spark, sf_dir, "pages").select("page_id", F.when(F.col("page_id") % 3 == 0, extra).otherwise(F.col("html")).alias("html"))
    return HT.page_rows(p, "page_id", "json").select("page_id", "pos", F.col("a").alias("url"), F.col("b").alias("title"), F.col("d").alias("origin"))


@query(r"SELECT event_id, CAST(regexp_extract(props, '\"k\": *(\d+)', 1) AS BIGINT) AS k, coalesce(nullif(CAST(regexp_extract(props, '\"k\": *(\d+)', 1) AS BIGINT), 0), -1) AS k_or FROM events")
def nested_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of open objects, null-safe, zero falling through."""
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return table(spark, sf_dir, "events").select("event_id", k.alias("k"), T.truthy_or(k, F.lit(-1).cast("bigint")).alias("k_or"))


@query(f"""WITH {_LOG_SQL}, f AS (SELECT *, row_number() OVER (PARTITION BY record_id ORDER BY started_at DESC, seq DESC) AS r FROM tl)
    SELECT record_id, state, CASE WHEN state = 'active' THEN 'normal' WHEN state = 'long_absent' OR streak >= 3 THEN 'high' ELSE 'warning' END AS level FROM f WHERE r = 1""")
def alert_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level of each record from its state."""
    s = L.final_states(L.timeline(_log(spark, sf_dir), _POLICY))
    high = (F.col("state") == "long_absent") | (F.col("streak") >= 3)
    return s.select("record_id", "state", F.when(F.col("state") == "active", "normal").when(high, "high").otherwise("warning").alias("level"))


@query()
def reconcile_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole run planned from its observations; the report of its rules."""
    from recordwatch.plans.reconcile import plan_run

    return plan_run(_log(spark, sf_dir), _POLICY)["rules"]
