"""Fuzzy line deduplication: SimHash, pigeonhole blocks, edit similarity, one occurrence per connected group.

Lines are compared in a normal form (lower case, without ASCII punctuation and control characters). Two different
lines are linked if the SimHashes of their words, weighted by length, differ in at most ``radius`` bits and the edit
similarity of their words, 1 - edits / words of the longer, is at least ``similarity``. Candidates share all but
``radius`` of the blocks of a SimHash, which no pair within the radius can avoid.

Buckets of up to 64 lines compare their lines directly and emit the near ones. Larger buckets never emit all their pairs:
first every line is compared with the two ends of each of its buckets, linked lines become groups, and only lines of
different groups are then compared. Of each group the first occurrence stays, by id
and then by place in the text.

Edge cases: null texts are empty; lines whose normal form is empty are never dropped; a text without dropped lines is
returned as it is; of repeated rows (same id and text) each keeps the same lines; rows with null ids come last, and rows
of one id with different texts are different rows, in the order of their texts' hashes; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordwatch.llm import line_edits
from recordwatch.llm import simhash_native as S
from recordwatch.llm.common import cut, kept, release, text_or_empty
from recordwatch.llm.components import connected

RADIUS, SIMILARITY = 3, 0.8
#: Keys of lines that are under comparison are broadcast up to so many rows; beyond, rows are shuffled to them.
BROADCAST_ROWS = 500_000
#: Lines of a bucket that are compared with each other directly.
DIRECT = 64
LAST_ID = (1 << 63) - 1


def normal_form(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"[\x00-\x1F!-/:-@\[-`{-\x7F]+", ""))


def words_form(line: Column) -> Column:
    """Letters and digits in lower case, every run of anything else as one blank."""
    # Single blanks are left alone: to put a blank for each of them took a third of the time.
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N} ][^\p{L}\p{N}]*| [^\p{L}\p{N}]+", " "))


def occurrences(docs: DataFrame, id_col: str, text_col: str, form: Callable[[Column], Column] = normal_form) -> DataFrame:
    """``id, row, pos, body, h1, h2`` of every line with a normal form; the two hashes identify it, and ``row`` the text."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), text_or_empty(text_col).alias("text"))
    lines = rows.select("id", F.xxhash64("text").alias("row"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    # Exploded, not filtered: a filter would be pushed below and work out the normal form twice.
    told = F.explode(F.filter(F.array(form(F.col("line"))), lambda body: body != ""))
    found = lines.select("id", "row", "pos", told.alias("body"))
    return found.select("*", F.xxhash64("body").alias("h1"), F.xxhash64(F.lit("line"), "body").alias("h2"))


def line_fingerprints(found: DataFrame) -> DataFrame:
    """``rid, h1, h2, fp`` of every different line."""
    lines = found.groupBy("h1", "h2").agg(F.max("body").alias("body"))
    terms = lines.select("h1", "h2", F.explode(F.split("body", " ")).alias("word")).filter("word <> ''")
    # Long words say more than the short ones that all lines share, so they weigh up to 16 times as much.
    doublings = F.least(F.shiftright(F.char_length("word"), 1), F.lit(4))
    marked = terms.groupBy("h1", "h2").agg(*S.votes(F.xxhash64("word"), doublings)).select("h1", "h2", S.fingerprint().alias("fp"))
    return cut(marked.withColumn("rid", F.monotonically_increasing_id()))


def symbols(body: Column) -> Column:
    """One character for each word, so that character edits are word edits; two words share one in 55,000 cases."""
    coded = F.transform(F.filter(F.split(body, " "), lambda w: w != ""), lambda w: F.lpad(F.hex(F.pmod(F.xxhash64(w), F.lit(54_000)) + 1024), 4, "0"))
    return F.decode(F.unhex(F.array_join(coded, "")), "UTF-16BE")


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts are similar enough."""
    a, b = texts.select(F.col("rid").alias("a"), F.col("coded").alias("of_a")), texts.select(F.col("rid").alias("b"), F.col("coded").alias("of_b"))
    longer = F.greatest(F.char_length("of_a"), F.char_length("of_b"))
    enough = F.levenshtein("of_a", "of_b") <= longer * (1 - similarity) + 1e-9
    sizes = F.least(F.char_length("of_a"), F.char_length("of_b")) >= longer * similarity - 1e-9
    return pairs.join(a, "a").join(b, "b").filter(sizes).filter(enough).select("a", "b")


def _keyed(found: DataFrame, wanted: DataFrame) -> DataFrame:
    """``found`` joined with ``wanted`` by the hashes of lines."""
    return found.join(F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted, ["h1", "h2"])


def line_groups(found: DataFrame, radius: int = RADIUS, similarity: float = SIMILARITY, blocks: int | None = None) -> DataFrame:
    """``h1, h2, line_group`` of every different line; linked lines share the group."""
    lines = line_fingerprints(found)
    masks = S.block_masks(blocks or S.blocks_for(lines.count(), radius), radius)
    bucket = Window.partitionBy("t", "key")
    near_enough = lambda x, y: F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= radius
    keyed = S.with_keys(lines.select("rid", "fp"), masks)
    ends = keyed.withColumn("first", F.min(F.struct("rid", "fp")).over(bucket)).withColumn("last", F.max(F.struct("rid", "fp")).over(bucket))
    ends = ends.withColumn("n", F.count(F.lit(1)).over(bucket)).filter("n > 1")
    # Most buckets of two are chance; they are done with as soon as their two lines are seen to be apart.
    shared = cut(ends.filter((F.col("n") > 2) | near_enough("first.fp", "last.fp")))
    few = shared.filter(F.col("n") <= DIRECT).select("t", "key", "rid", "fp")
    other = few.select("t", "key", F.col("rid").alias("rid_b"), F.col("fp").alias("fp_b"))
    direct = few.join(other, ["t", "key"]).filter("rid > rid_b").filter(near_enough("fp", "fp_b")).select(F.col("rid").alias("a"), F.col("rid_b").alias("b"))
    crowd = shared.filter(F.col("n") > DIRECT)
    to_ends = crowd.select("rid", "fp", F.explode(F.array("first", "last")).alias("end")).filter("rid <> end.rid").filter(near_enough("fp", "end.fp"))
    near = cut(direct.unionByName(to_ends.select(F.greatest("rid", "end.rid").alias("a"), F.least("rid", "end.rid").alias("b"))).distinct())
    live = near.select(F.explode(F.array("a", "b")).alias("rid")).unionByName(crowd.select("rid")).distinct()
    wanted = cut(lines.join(live, "rid").select("h1", "h2", "rid"))
    texts = cut(_keyed(found, wanted).groupBy("rid").agg(F.min("body").alias("body")).select("rid", symbols(F.col("body")).alias("coded")))
    links = cut(_verified(near, texts, similarity))
    roots = connected(links)
    named = crowd.select("t", "key", "rid", "fp").join(roots, F.col("rid") == F.col("node"), "left").select("t", "key", "rid", "fp", F.coalesce("root", "rid").alias("grp"))
    mixed = named.withColumn("low", F.min("grp").over(bucket)).withColumn("high", F.max("grp").over(bucket)).filter("low <> high")
    left = cut(mixed.select("t", "key", "rid", "fp", "grp"))
    if not left.isEmpty():
        right = left.select("t", "key", *[F.col(c).alias(f"{c}_b") for c in ("rid", "fp", "grp")])
        across = left.join(right, ["t", "key"]).filter("rid > rid_b and grp <> grp_b").filter(near_enough("fp", "fp_b"))
        more = _verified(across.select(F.col("rid").alias("a"), F.col("rid_b").alias("b")).distinct(), texts, similarity)
        roots = connected(links.unionByName(more))
    return lines.join(roots, lines.rid == roots.node, "left").select("h1", "h2", F.coalesce("root", "rid").alias("line_group"))


def stored_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One table of two kinds of rows: ``rid, h1, h2, body`` of each different line, and ``h1, h2, id, row, pos`` of each place it stands at.

    Lines are told apart by their text in a hash aggregation that first merges copies within tasks. Texts are read and normalized only here.
    """
    found = occurrences(docs, id_col, text_col, words_form)
    none = {"body": "string", "id": "bigint", "row": "bigint", "pos": "int"}
    of = lambda *names: F.struct("h1", "h2", *[F.col(c).alias(c) if c in names else F.lit(None).cast(kind).alias(c) for c, kind in none.items()])
    both = found.select(F.inline(F.array(of("body"), of("id", "row", "pos")))).distinct()
    return kept(both.withColumn("rid", F.monotonically_increasing_id()))


def _small(df: DataFrame) -> DataFrame:
    """``df`` broadcast where it is counted to be small."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int | None = RADIUS, similarity: float = SIMILARITY, blocks: int | None = None) -> DataFrame:
    """``id, row, pos`` of every line that isn't the first of its group (a null id shows as the largest long).

    With a radius of None the edit similarity of ``words_form`` alone links lines, whatever their SimHashes.
    The first places are taken out by place, so a group of any size is dealt out over all tasks.
    """
    if radius is None:
        stored = stored_lines(docs, id_col, text_col)
        release(docs.sparkSession)
        lines = stored.filter("body is not null").select("rid", "h1", "h2", "body")
        places = stored.filter("pos is not null").select("h1", "h2", "id", "row", "pos")
        groups = kept(lines.select("rid", "h1", "h2").join(line_edits.line_groups(lines, similarity), "rid").drop("rid"))
    else:
        places = occurrences(docs, id_col, text_col)
        groups = cut(line_groups(places, radius, similarity, blocks))
    of_group = [F.coalesce("line_group", "h1").alias("g1"), F.when(F.col("line_group").isNull(), F.col("h2")).alias("g2")]
    grouped = places.join(_small(groups), ["h1", "h2"], "left").select(*of_group, "id", "row", "pos")
    first = grouped.groupBy("g1", "g2").agg(F.min(F.struct("id", "row", "pos")).alias("first")).select("first.*")
    return places.select("id", "row", "pos").join(first, ["id", "row", "pos"], "left_anti")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int | None = RADIUS, similarity: float = SIMILARITY, blocks: int | None = None) -> DataFrame:
    """``id_col, n_lines, n_kept, text_col`` of each row, the text without its dropped lines."""
    gone = kept(dropped_lines(docs, id_col, text_col, radius, similarity, blocks).groupBy(F.col("id").alias("__id"), F.col("row").alias("__row")).agg(F.collect_set("pos").alias("gone")))
    rows = docs.select(docs[id_col].alias(id_col), text_or_empty(text_col).alias("text"))
    same = (F.coalesce(rows[id_col].cast("long"), F.lit(LAST_ID)) == gone["__id"]) & (F.xxhash64(rows["text"]) == gone["__row"])
    joined = rows.join(_small(gone), same, "left")
    lines = F.split("text", "\n")
    stay = F.filter(lines, lambda line, k: ~F.array_contains("gone", k))
    return joined.select(
        id_col, F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.coalesce(F.size("gone"), F.lit(0))).cast("long").alias("n_kept"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(stay, "\n")).alias(text_col),
    )
