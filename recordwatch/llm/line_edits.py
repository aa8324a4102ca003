"""Groups of lines by edit similarity alone: no pair of lines that is similar enough is missed.

An edit of a word changes at most k of a line's runs of k neighbouring words, so a line loses at most ``lost`` of its runs
to any line that is similar enough, and keeps at least one. In any order of all runs, the first one that both lines have is
therefore among the first ``lost + 1`` of each: these are a line's keys, and similar lines share a key. The order begins with
runs whose words a sample shows to be rare; it decides the cost, never the result. Runs have three words, the ends of a line
count as words: two lines seldom share such a key by chance, so that keys are shuffled with no more than the line's length.

Lines that share a key are verified by their edits: every line is compared with two lines of each of its keys first,
linked lines become groups, and then all lines of a key that are of different groups are compared. An edit changes at
most two of the parities of a line's words by 256 classes, so most pairs that meet by chance are told apart by number
before their texts are fetched.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordwatch.llm.common import dropped, kept, release
from recordwatch.llm.components import connected

#: One line in so many is counted, by classes of words; the rank of a class that is counted as often as ``COMMON`` is the number of binary digits of its count.
SAMPLE, COMMON, CLASSES, MOST_RANK = 32, 2, 1 << 16, 31
#: The bits of a key below its rank, and those that are shuffled: the less, the smaller the files; keys that are the same by chance cost a comparison.
BELOW, SHUFFLED = 56, 48
#: Words in a key of :func:`line_groups`.
SPAN = 3
#: Parts of the keys that are dealt one after the other, to hold less on disk at a time; keys are not stored but worked out for each.
PASSES = 1
#: Below this a pair of similar lines need not have three neighbouring words in common.
LEAST_SIMILARITY = 0.8
#: Parts of 64 classes each by which pairs are told apart before their texts are fetched.
FINE = 4
MARKS = ["n", *[f"m{k}" for k in range(FINE)]]


def lost(n: Column, span: int, similarity: float) -> Column:
    """Runs of ``span`` words that a line of ``n`` words can lack in a similar one: ``span`` for each edit, one less for each word the other has more."""
    edits = lambda words: F.floor(words * (1 - similarity) + 1e-9)
    return F.greatest(*[edits(n + more) * span - more for more in range(span)]).cast("int")


def runs(lines: DataFrame, ranks: list[int], span: int) -> DataFrame:
    """``rid, n`` and ``runs`` of each line of ``lines`` (``rid, body``): the runs of ``span`` words; from three words on the ends of the line count as words."""
    # In SQL, since each literal of a Column is a call to the JVM. Ranks add up above the bits of the sum of the hashes.
    told = f"cast(split('{','.join(map(str, ranks))}', ',') as array<bigint>)"
    ranked = f"transform(words, w -> (w & {(1 << BELOW - 2) - 1}L) + shiftleft(coalesce(get({told}, cast(w & {CLASSES - 1}L as int)), 0L), {BELOW}))"
    end = f"array(({MOST_RANK}L << {BELOW}) + 1L)"
    words = lines.select("rid", hashes().alias("words")).select("rid", F.size("words").alias("n"), F.expr(f"concat({end}, {ranked}, {end})" if span > 2 else ranked).alias("ranked"))
    total = " + ".join(["w", *[f"get(ranked, i + {k})" for k in range(1, span)]])
    return words.select("rid", "n", F.expr(f"slice(transform(ranked, (w, i) -> coalesce({total}, 0L)), 1, greatest(size(ranked) - {span - 1}, 0))").alias("runs"))


def first_runs(span: int, similarity: float) -> Column:
    """The keys among the ``runs`` of a line of ``n`` words, with repeats; none where it is too short to be similar to another."""
    able = F.floor(F.floor(F.col("n") / similarity + 1e-9) * (1 - similarity) + 1e-9) > 0
    return F.slice(F.sort_array("runs"), F.lit(1), F.when(able, lost(F.col("n"), span, similarity) + 1).otherwise(0))


def keyed_lines(lines: DataFrame, ranks: list[int], similarity: float, span: int = 2) -> DataFrame:
    """``rid, n`` and ``keys`` of each line of ``lines`` (``rid, body``)."""
    return runs(lines, ranks, span).select("rid", "n", F.array_distinct(first_runs(span, similarity)).alias("keys"))


def parities(words: str, part: int, parts: int = FINE) -> Column:
    """Whether the number of words of each of 64 classes is odd, as bits; each of the ``parts`` has other classes."""
    mine = lambda h: h.bitwiseAND(F.lit(64 * (parts - 1))) == 64 * part
    bit = lambda h: F.call_function("shiftleft", mine(h).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
    return F.aggregate(words, F.lit(0).cast("long"), lambda odd, w: odd.bitwiseXOR(bit(w)))


def may_be_similar(a: list[Column], b: list[Column], similarity: float) -> Column:
    """False only for lines (their numbers of words and parities) whose sizes or parities rule the similarity out."""
    longer = F.greatest(a[0], b[0])
    changed = reduce(lambda x, y: x + y, [F.bit_count(x.bitwiseXOR(y)) for x, y in zip(a[1:], b[1:])])
    return (F.least(a[0], b[0]) >= longer * similarity - 1e-9) & (changed <= 2 * (longer * (1 - similarity) + 1e-9))


def hashes(body: str = "body") -> Column:
    return F.transform(F.split(body, " "), lambda w: F.xxhash64(w))


def word_ranks(lines: DataFrame) -> list[int]:
    """The rank of each class of words, by how often a sample of the ``lines`` has them; only these numbers reach the driver."""
    sample = lines.filter(F.pmod("h2", F.lit(SAMPLE)) == 0).select(F.explode(hashes()).alias("w"))
    counts = sample.groupBy(F.col("w").bitwiseAND(F.lit(CLASSES - 1)).cast("int").alias("class")).count().filter(F.col("count") >= COMMON)
    ranks = [0] * CLASSES
    for row in counts.collect():
        ranks[row["class"]] = min(MOST_RANK, row["count"].bit_length())
    return ranks


def symbols(body: Column) -> Column:
    """One character for each word, so that character edits are word edits; two words share one in 55,000 cases."""
    coded = F.transform(F.split(body, " "), lambda w: F.lpad(F.hex(F.pmod(F.xxhash64(w), F.lit(54_000)) + 1024), 4, "0"))
    return F.decode(F.unhex(F.array_join(coded, "")), "UTF-16BE")


def marked(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rid`` and ``MARKS`` of the ``wanted`` of ``lines`` (``rid, body``)."""
    words = lines.join(wanted, "rid").select("rid", hashes().alias("words"))
    return kept(words.select("rid", F.size("words").alias("n"), *[parities("words", k).alias(f"m{k}") for k in range(FINE)]))


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("rid")).distinct()


def _side(df: DataFrame, k: str, columns: list[str]) -> DataFrame:
    return df.select(F.col("rid").alias(k), *[F.col(c).alias(f"{k}_{c}") for c in columns])


def likely_pairs(pairs: DataFrame, sized: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs`` (a, b) that the marks of their lines don't tell apart."""
    met = pairs.join(_side(sized, "a", MARKS), "a").join(_side(sized, "b", MARKS), "b")
    return kept(met.filter(may_be_similar(*[[F.col(f"{k}_{c}") for c in MARKS] for k in "ab"], similarity)).select("a", "b"))


def verified(likely: DataFrame, lines: DataFrame, similarity: float) -> DataFrame:
    """Those of ``likely`` pairs (a, b) whose ``lines`` (``rid, body``) are similar enough."""
    texts = kept(lines.join(ends_of(likely), "rid").select("rid", symbols(F.col("body")).alias("coded")))
    longer = F.greatest(F.char_length("a_coded"), F.char_length("b_coded"))
    _settled(lines)
    told = likely.join(_side(texts, "a", ["coded"]), "a").join(_side(texts, "b", ["coded"]), "b").withColumn("most", F.floor(longer * (1 - similarity) + 1e-9).cast("int"))
    links = kept(told.filter("levenshtein(a_coded, b_coded, most) >= 0").select("a", "b"))
    dropped(texts)
    release(lines.sparkSession)
    return links


def _settled(lines: DataFrame) -> None:
    """Let the shuffle files of earlier steps go. Spark holds on to the last query until there is another one."""
    lines.sparkSession.range(0).collect()
    release(lines.sparkSession)


def dealt_keys(lines: DataFrame, ranks: list[int], turn: int, similarity: float) -> DataFrame:
    """``rid, n, key`` for each key of one turn, dealt out by ``key``."""
    # What is exploded is no column: else a filter on it would be pushed below and work out all runs twice.
    keys = runs(lines, ranks, SPAN).select("rid", "n", F.explode(first_runs(SPAN, similarity)).alias("run"))
    # Two columns are shuffled: the number of words stands above a key's bits. To cut it there makes lines more alike, never less.
    told = F.lit((1 << SHUFFLED) - 1)
    sized = F.shiftleft(F.least("n", F.lit((1 << 64 - SHUFFLED) - 1)).cast("long"), SHUFFLED)
    both = keys.select("rid", sized.bitwiseOR(F.col("run").bitwiseAND(told)).alias("both"))
    if PASSES > 1:
        both = both.filter(F.col("both").bitwiseAND(told) % PASSES == turn)
    return both.repartition(F.col("both").bitwiseAND(told)).select("rid", F.shiftrightunsigned("both", SHUFFLED).cast("int").alias("n"), F.col("both").bitwiseAND(told).alias("key"))


def _met_in(lines: DataFrame, ranks: list[int], turn: int, similarity: float) -> DataFrame:
    """The part of :func:`met_lines` of the keys of one turn."""
    bucket, line = Window.partitionBy("key"), F.struct("rid", "n")
    rows = dealt_keys(lines, ranks, turn, similarity)
    # Any two of a key's lines will do, if they are the same two for all of its lines.
    ends = rows.select("*", F.first(line).over(bucket).alias("first"), F.last(line).over(bucket).alias("last"), F.count(F.lit(1)).over(bucket).alias("lines")).filter("lines > 1")
    alike = lambda e: F.least("n", f"{e}.n") >= F.greatest("n", f"{e}.n") * similarity - 1e-9
    to = [F.when((F.col("rid") != F.col(f"{e}.rid")) & alike(e), F.col(f"{e}.rid")).alias(e) for e in ("first", "last")]
    # Three lines of a key have all met at its ends.
    met = ends.select(F.when(F.col("lines") > 3, F.col("key")).alias("key"), "rid", *to)
    return kept(met.filter("key is not null or first is not null or last is not null"))


def met_lines(lines: DataFrame, similarity: float) -> DataFrame:
    """``rid``, ``key`` (null where no more than three lines have it), and the ``first`` and ``last`` line of the key that may be similar by their lengths."""
    ranks, met = word_ranks(lines), None
    for turn in range(PASSES):
        part = _met_in(lines, ranks, turn, similarity)
        met = part if met is None else met.unionByName(part)
        # Nothing is left of the turn but its table, so that its shuffle files can go.
        _settled(lines)
    return met


def across_groups(left: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of lines of one key (``key, rid, grp`` and ``MARKS``) that are of different groups and that their marks don't tell apart.

    Lines meet only those whose length is of the same class or the one below; no similar line is farther off. A pair meets once:
    the longer line, of equals the one with the greater ``rid``, looks for the other.
    """
    size = F.floor(F.log("n") / math.log(1.0001 / similarity)).cast("int")
    one = left.withColumn("size", size)
    other = left.select("key", *[F.col(c).alias(f"{c}_b") for c in ("rid", "grp", *MARKS)], F.explode(F.array(size, size + 1)).alias("size"))
    alike = may_be_similar([F.col(c) for c in MARKS], [F.col(f"{c}_b") for c in MARKS], similarity)
    pairs = one.join(other, ["key", "size"]).filter("grp <> grp_b and (n > n_b or n = n_b and rid > rid_b)").filter(alike)
    return pairs.select(F.greatest("rid", "rid_b").alias("a"), F.least("rid", "rid_b").alias("b")).distinct()


def line_groups(lines: DataFrame, similarity: float) -> DataFrame:
    """``rid, line_group`` of the lines that are similar to another, of ``lines`` (``rid, h2, body``, each line once); linked lines share the group."""
    if similarity < LEAST_SIMILARITY:
        raise ValueError(f"similarity below {LEAST_SIMILARITY}")
    met = met_lines(lines, similarity)
    ends = met.select("rid", F.explode(F.array("first", "last")).alias("end")).filter("end is not null")
    near = kept(ends.select(F.greatest("rid", "end").alias("a"), F.least("rid", "end").alias("b")).distinct())
    # An end has no row of its own where the other end is of another length.
    sized = marked(lines, met.select(F.explode(F.array("rid", "first", "last")).alias("rid")).filter("rid is not null").distinct())
    likely = likely_pairs(near, sized, similarity)
    dropped(near)
    _settled(lines)
    links = verified(likely, lines, similarity)
    roots = connected(links)
    shared = met.filter("key is not null").select("key", "rid")
    named = shared.join(roots, F.col("rid") == F.col("node"), "left").select("key", "rid", F.coalesce("root", "rid").alias("grp"))
    bucket = Window.partitionBy("key")
    mixed = named.withColumn("low", F.min("grp").over(bucket)).withColumn("high", F.max("grp").over(bucket))
    left = kept(mixed.filter("low <> high").select("key", "rid", "grp").join(sized, "rid"))
    dropped(met, sized)
    release(lines.sparkSession)
    fresh = kept(across_groups(left, similarity).join(likely, ["a", "b"], "left_anti"))
    more = verified(fresh, lines, similarity)
    if not more.isEmpty():
        roots = connected(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    dropped(likely, left, fresh, links, more)
    release(lines.sparkSession)
    return roots.select(F.col("node").alias("rid"), F.col("root").alias("line_group"))
