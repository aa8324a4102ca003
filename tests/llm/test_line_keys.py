"""The keys of lines are few, and rare pairs of words come first."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from recordwatch.llm import line_edits


def test_keys_are_few_and_rare_first(spark):
    text = " ".join(["the of"] * 15 + [f"w{k}" for k in range(30)])
    lines = spark.createDataFrame([(1, text), (2, "a b c"), (3, "a b c d")], "rid long, body string")
    ranks = [0] * line_edits.CLASSES
    for row in spark.createDataFrame([("the",), ("of",)], "w string").select(F.xxhash64("w").bitwiseAND(F.lit(line_edits.CLASSES - 1)).alias("c")).collect():
        ranks[row.c] = line_edits.MOST_RANK
    keys = {r.rid: r["keys"] for r in line_edits.keyed_lines(lines, ranks, 0.8).collect()}
    # Twelve edits of sixty words, two pairs each, and one pair more; runs of three words took 37.
    assert len(keys[1]) == 25 and keys[2] == [] and len(keys[3]) == 2
    assert all(k >> line_edits.BELOW == 0 for k in keys[1])


def test_lines_of_common_words_alone_are_linked(spark):
    """Order and ranks only decide the cost: pairs that share nothing but common words are found too."""
    base = ["the", "of", "and", "in", "to", "is", "on", "at", "by", "it"] * 3
    edited = [*base[:7], "new", *base[8:20], *base[21:]]
    other = base[::-1]
    rows = [(k, 5 * k, " ".join(x)) for k, x in enumerate((base, edited, other))]
    got = {r.rid: r.line_group for r in line_edits.line_groups(spark.createDataFrame(rows, "rid long, h2 long, body string"), 0.8).collect()}
    assert got == {0: 0, 1: 0}


def test_lines_that_share_pairs_of_words_alone_do_not_meet(spark):
    """Such pairs met by chance, more than in proportion to the table; now a key is three words or two at an end."""
    rows = [(k, 32 * k, " ".join(f"p{j} q{j} x{k}y{j}" for j in range(10))) for k in range(6)]
    assert line_edits.met_lines(spark.createDataFrame(rows, "rid long, h2 long, body string"), 0.8).count() == 0


def test_an_end_without_a_row_of_its_own_is_linked(spark):
    """Three lines have a key; the first is similar to the middle one only, by length too."""
    shared = "rare words here"
    rows = [
        (0, 5, f"{shared} a b c d e f g"),
        (1, 5, f"{shared} a b c d e f h"),
        (2, 5, f"{shared} " + " ".join(f"z{k}" for k in range(60))),
    ]
    for order in ((0, 1, 2), (0, 2, 1), (2, 0, 1)):
        lines = spark.createDataFrame([(k, rows[r][1], rows[r][2]) for k, r in enumerate(order)], "rid long, h2 long, body string")
        got = {r.rid: r.line_group for r in line_edits.line_groups(lines, 0.8).collect()}
        alike = sorted(k for k, r in enumerate(order) if r < 2)
        assert got == dict.fromkeys(alike, alike[0])


def test_keys_are_worked_out_and_shuffled_once(spark):
    """Keys were worked out for each of two passes and shuffled with the number of words as a column of its own."""
    lines = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(70_000))), (2, "a b c"), (3, "a b c d e f g"), (1 << 40, "z b c d e f g")], "rid long, body string")
    ranks = [0] * line_edits.CLASSES
    assert line_edits.PASSES == 1
    dealt = line_edits.dealt_keys(lines, ranks, 0, 0.8)
    mask = (1 << line_edits.SHUFFLED) - 1
    expected = {(r.rid, min(r.n, 65_535), k & mask) for r in line_edits.keyed_lines(lines, ranks, 0.8, line_edits.SPAN).collect() for k in r["keys"]}
    assert {tuple(r) for r in dealt.collect()} == expected and len(expected) > 42_000
    plan = dealt.withColumn("lines", F.count(F.lit(1)).over(Window.partitionBy("key")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_lines_of_different_groups_meet_once_whatever_their_lengths(spark):
    rng = random.Random(3)
    rows = [(key, 100 * key + k, rng.randrange(4), rng.choice([4, 5, 9, 10, 11, 12, 13, 14, 100, 80, 79]), 0, 0, 0, 0) for key in range(6) for k in rng.sample(range(100), 25)]
    left = spark.createDataFrame(rows, "key long, rid long, grp long, n int, m0 long, m1 long, m2 long, m3 long")
    got = [tuple(r) for r in line_edits.across_groups(left, 0.8).collect()]
    expected = {(a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] > b[1] and a[2] != b[2] and min(a[3], b[3]) >= 0.8 * max(a[3], b[3]) - 1e-9}
    assert len(got) == len(expected) and set(got) == expected
