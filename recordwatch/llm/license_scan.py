"""Licence scan: lines, blocks of lines and whole texts compared with licence templates by the Dice coefficient of their word bigrams.

Bigrams are sets, of words in a normal form (letters and digits in lower case). Two sets of a and b bigrams share at most
the smaller number, so a coefficient of d needs a >= b * d / (2 - d) and the same for b: a piece of text is taken up only
if a template of such a size exists, and it meets only templates whose bigrams it shares.

A block is any run of lines; its place is its first line. Of each licence, blocks count where neither the whole text nor a
line of the block is like it, the best first and none that overlaps a better one. Only texts that hold d / (2 - d) of a
template's bigrams are searched for blocks, from lines that share a bigram with it up to b * (2 - d) / d bigrams.

Edge cases: null and empty texts have no match (count 0, null licence); of equal coefficients the first licence by name
wins, then the first line; a line that is the whole text counts once; a repeated row has the same result each time; rows that
share an id, or have none, are told apart by their texts; an empty table gives an empty result; other columns are ignored; templates of fewer than two words match nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordwatch.llm.common import kept, let, text_or_empty

LEAST_DICE = 0.8

# Short licence notices as projects write them.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}

#: Standard texts and headers as they are published, by file name.
STANDARD: dict[str, str] = {p.stem: p.read_text() for p in sorted(Path(__file__).with_name("licenses").glob("*.txt"))}


def normal_form(text: Column) -> Column:
    """Words of letters and digits in lower case, one blank between them."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def every_bigram(words: Column) -> Column:
    """Array of the hashes of two words in a row."""
    return let(words, lambda ws: F.slice(F.transform(ws, lambda w, k: F.xxhash64(w, F.get(ws, k + 1))), F.lit(1), F.greatest(F.size(ws) - 1, F.lit(0))))


def bigrams(words: str = "words") -> Column:
    return F.array_distinct(every_bigram(F.col(words)))


def split_words(body: Column) -> Column:
    return F.split(body, " ").alias("words")


def among(array: str, values: list[int]) -> Column:
    """The elements of an array column that are among many ``values``; as SQL, since each literal of a Column is a call to the JVM."""
    return F.expr(f"filter({array}, g -> g IN ({', '.join(f'{v}L' if v > -(1 << 63) else 'CAST(-9223372036854775808 AS BIGINT)' for v in values)}))") if values else F.array().cast("array<bigint>")


def matches(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST_DICE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text_sha256, pos, license, dice`` of every line or block (pos >= 0) and whole text (pos -1) that is like a template.

    ``id`` is the input's id column; rows of one id are told apart by their texts' hash. Templates are a parameter of at most a few dozen texts.
    """
    spark = docs.sparkSession
    told = spark.createDataFrame(list((TEMPLATES | STANDARD if templates is None else templates).items()), "license string, text string")
    told = told.select("license", split_words(normal_form(F.col("text")))).filter("size(words) > 1").select("license", bigrams().alias("grams"))
    grams_of = {r.license: list(r.grams) for r in told.collect()}
    sizes = [len(g) for g in grams_of.values()]
    known = sorted({g for grams in grams_of.values() for g in grams})
    low, high = (min(sizes) * least / (2 - least), max(sizes) * (2 - least) / least) if sizes else (1, 0)
    likely = kept(likely_texts(docs.select(docs[id_col].alias("id"), text_or_empty(text_col).alias("text")), grams_of, known, least))
    texts = likely.withColumn("id", F.col("uid"))  # from here on a text is known by its own number
    lines = texts.select("id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    # A whole text is a piece of its own where it has several lines.
    whole = texts.filter(F.instr("text", "\n") > 0).select("id", F.lit(-1).alias("pos"), F.col("text").alias("line"))
    units = lines.select("id", "pos", "line").unionByName(whole).select("id", "pos", split_words(normal_form(F.col("line"))))
    fit = units.filter(F.size("words") >= low + 1).select("id", "pos", F.monotonically_increasing_id().alias("unit"), bigrams().alias("grams"))
    fit = fit.filter((F.size("grams") >= low) & (F.size("grams") <= high)).select("id", "pos", "unit", F.size("grams").alias("a"), among("grams", known).alias("grams"))
    fit = fit.filter(F.size("grams") >= low).select("id", "pos", "unit", "a", F.explode("grams").alias("gram"))
    index = told.select("license", F.size("grams").alias("b"), F.explode("grams").alias("gram"))
    bound = (F.col("a") >= F.col("b") * (least / (2 - least)) - 1e-9) & (F.col("b") >= F.col("a") * (least / (2 - least)) - 1e-9)
    shared = fit.join(F.broadcast(index), "gram").filter(bound).groupBy("unit", "id", "pos", "license", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    dice = 2 * F.col("n") / (F.col("a") + F.col("b"))
    alone = shared.select("id", "pos", "license", dice.alias("dice")).filter(F.col("dice") >= least - 1e-9)
    found = alone.unionByName(blocks(texts, told, least)).withColumnRenamed("id", "uid")
    named = likely.select("uid", "id", F.sha2("text", 256).alias("text_sha256"))
    return found.join(named, "uid").select("id", "text_sha256", "pos", "license", "dice")


def likely_texts(rows: DataFrame, grams_of: dict[str, list[int]], known: list[int], least: float) -> DataFrame:
    """``id, text, held, uid`` of the ``rows`` (``id, text``) that hold d / (2 - d) of the bigrams of some templates, by name.

    No piece of another text can be like a template. Texts are read, normalized and hashed once, here.
    """
    share = least / (2 - least)
    hold = lambda grams: F.size(among("hits", grams)) >= len(grams) * share - 1e-9
    enough = min(map(len, grams_of.values()), default=1) * share - 1e-9
    # Exploded, not filtered: filters would be pushed down to the text and work everything out once more for each use.
    some = lambda array, least_size: F.explode(F.filter(F.array(array), lambda h: F.size(h) >= least_size))
    texts = rows.select("id", "text", every_bigram(split_words(normal_form(F.col("text")))).alias("grams"))
    hits = texts.select("id", "text", some(F.array_distinct(among("grams", known)), max(enough, 0.5)).alias("hits"))
    held = F.array_compact(F.array(*[F.when(hold(grams), F.lit(name)) for name, grams in grams_of.items()]).cast("array<string>"))
    return hits.select("id", "text", some(held, 1).alias("held")).withColumn("uid", F.monotonically_increasing_id())


def _occurrences(texts: DataFrame) -> DataFrame:
    """``uid, id, held, q, pos, gram, last, earlier`` of every bigram of every line that has words, the q-th such line of its text.

    ``last`` is the last line at which a block can begin and still hold this occurrence: q, or q - 1 for the bigram that
    joins a line to the one before. ``earlier`` is the greatest ``last`` of the same bigram before it, or -1: a block
    counts the occurrence as a new bigram if it begins after ``earlier`` and not after ``last``.
    """
    split = F.transform(F.split("text", "\n"), lambda line, k: F.struct(k.alias("pos"), split_words(normal_form(line))))
    lines = texts.select("uid", "id", "held", F.filter(split, lambda x: x["words"][0] != "").alias("lines"))
    word_before = lambda all_lines, k: F.when(k > 0, F.element_at(F.get(all_lines, k - 1)["words"], -1))
    joined = let(F.col("lines"), lambda xs: F.transform(xs, lambda x, k: F.struct(x["pos"].alias("pos"), x["words"].alias("words"), word_before(xs, k).alias("before"))))
    each = lines.select("uid", "id", "held", F.posexplode(joined).alias("q", "x")).select("uid", "id", "held", "q", "x.pos", "x.words", "x.before")
    link = F.when(F.col("before").isNotNull(), F.array(F.struct(F.xxhash64("before", F.col("words")[0]).alias("gram"), (F.col("q") - 1).alias("last"))))
    own = F.transform(bigrams(), lambda g: F.struct(g.alias("gram"), F.col("q").alias("last")))
    none = F.array().cast("array<struct<gram: bigint, last: int>>")
    found = each.select("uid", "id", "held", "q", "pos", F.inline(F.concat(own, F.coalesce(link, none))))
    before = Window.partitionBy("uid", "gram").orderBy("q", F.desc("last")).rowsBetween(Window.unboundedPreceding, -1)
    return found.withColumn("earlier", F.coalesce(F.max("last").over(before), F.lit(-1)))


def blocks(texts: DataFrame, told: DataFrame, least: float) -> DataFrame:
    """``id, pos, license, dice`` of the blocks of two lines or more in ``texts`` (see :func:`likely_texts`, with a ``uid``)."""
    share = least / (2 - least)
    licenses = F.broadcast(told.select("license", F.size("grams").cast("int").alias("b")))
    index = F.broadcast(told.select("license", F.explode("grams").alias("gram"), F.lit(True).alias("hit")))
    each = _occurrences(texts.filter(F.instr("text", "\n") > 0)).select("uid", "id", "q", "pos", "gram", "last", "earlier", F.explode("held").alias("license"))
    each = each.join(index, ["license", "gram"], "left").select("uid", "id", "license", "q", "pos", F.struct("last", "earlier", F.coalesce("hit", F.lit(False)).alias("hit")).alias("g"))
    lines = each.groupBy("uid", "id", "license", "q", "pos").agg(F.collect_list("g").alias("grams"))
    parts = lines.groupBy("uid", "id", "license").agg(F.array_sort(F.collect_list(F.struct("q", "pos", "grams"))).alias("parts")).join(licenses, "license")
    like = lambda counted: 2 * F.size(F.filter(counted, lambda g: g["hit"])) / (F.size(counted) + F.col("b"))
    every = F.flatten(F.transform("parts", lambda x: F.filter(x["grams"], lambda g: g["earlier"] < 0)))
    parts = parts.filter(like(every) < least - 1e-9)
    best = "struct<a: int, n: int, dice: double, end: int>"

    def longer(first: Column) -> Callable[[Column, Column], Column]:
        def add(state: Column, x: Column) -> Column:
            new = F.filter(x["grams"], lambda g: (g["earlier"] < first) & (first <= g["last"]))
            counts = F.struct((state["a"] + F.size(new)).alias("a"), (state["n"] + F.size(F.filter(new, lambda g: g["hit"]))).alias("n"))

            def step(c: Column) -> Column:
                dice = F.when(c["a"] > 0, 2 * c["n"] / (c["a"] + F.col("b"))).otherwise(F.lit(0.0))
                better = dice > state["dice"] + 1e-12
                return F.struct(c["a"].alias("a"), c["n"].alias("n"), F.when(better, dice).otherwise(state["dice"]).alias("dice"), F.when(better, x["pos"]).otherwise(state["end"]).alias("end")).cast(best)

            # No longer block can be like the template once this one has too many bigrams.
            return F.when((state["a"] > F.col("b") / share + 1e-9) | (x["q"] < first), state).otherwise(F.transform(F.array(counts), step)[0])

        return add

    nothing = F.struct(F.lit(0).alias("a"), F.lit(0).alias("n"), F.lit(0.0).alias("dice"), F.lit(-1).alias("end")).cast(best)
    starts = F.array_distinct(F.flatten(F.transform("parts", lambda x: F.transform(F.filter(x["grams"], lambda g: g["hit"]), lambda g: g["last"]))))
    place = F.map_from_entries(F.transform("parts", lambda x: F.struct(x["q"], x["pos"])))
    ends = let(F.col("parts"), lambda xs: F.transform(starts, lambda first: F.struct(first.alias("first"), F.aggregate(xs, nothing, longer(first)).alias("to"))))
    own = lambda x: F.filter(x["grams"], lambda g: g["last"] == x["q"])
    alone = F.transform(F.filter("parts", lambda x: like(own(x)) >= least - 1e-9), lambda x: F.struct(F.lit(0).alias("kind"), (-like(own(x))).alias("d"), x["pos"].alias("pos"), x["pos"].alias("end")))
    parts = parts.select("id", "license", alone.alias("alone"), place.alias("place"), F.filter(ends, lambda x: x["to"]["dice"] >= least - 1e-9).alias("ends"))
    # A line without bigrams of its own is known by the next one's link alone; its place is the one before.
    at = lambda places, first: F.coalesce(F.element_at(places, first), F.element_at(places, first + 1) - 1)
    told_ends = let(F.col("place"), lambda places: F.transform("ends", lambda x: F.struct(F.lit(1).alias("kind"), (-x["to"]["dice"]).alias("d"), at(places, x["first"]).alias("pos"), x["to"]["end"].alias("end"))))
    several = F.filter(told_ends, lambda x: x["end"] > x["pos"])
    none = F.slice(F.array(F.struct(F.lit(0).alias("kind"), F.lit(0.0).alias("d"), F.lit(0).alias("pos"), F.lit(0).alias("end"))), 1, 0)
    apart = lambda chosen, x: ~F.exists(chosen, lambda y: (y["pos"] <= x["end"]) & (x["pos"] <= y["end"]))
    chosen = F.aggregate(F.array_sort(F.concat("alone", several)), none, lambda got, x: F.when(apart(got, x), F.concat(got, F.array(x))).otherwise(got))
    return parts.select("id", "license", F.explode(chosen).alias("block")).filter("block.kind = 1").select("id", F.col("block.pos").alias("pos"), "license", (-F.col("block.d")).alias("dice"))


def scan_documents(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST_DICE) -> DataFrame:
    """``doc_id, n_matches, licenses, best_license, best_dice, best_line`` of each row."""
    found = matches(docs, templates, least).groupBy(F.col("id").alias("__id"), "text_sha256").agg(
        F.countDistinct("pos").alias("n"), F.array_sort(F.collect_set("license")).alias("found"),
        F.min(F.struct((-F.col("dice")).alias("d"), "license", "pos")).alias("best"),
    )
    ids = docs.select("doc_id", F.sha2(text_or_empty(), 256).alias("__sha"))
    return ids.join(found, ids.doc_id.eqNullSafe(found["__id"]) & (ids["__sha"] == found["text_sha256"]), "left").select(
        "doc_id", F.coalesce("n", F.lit(0)).alias("n_matches"), F.coalesce(F.array_join("found", ","), F.lit("")).alias("licenses"),
        F.col("best.license").alias("best_license"), F.round(-F.col("best.d"), 6).alias("best_dice"), F.col("best.pos").cast("long").alias("best_line"),
    )
