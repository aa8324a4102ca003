"""Spelling variants: words one edit apart, and for each word the commoner word it may stand for.

Two words that differ by one inserted, deleted or replaced code point share one of the two segments of either: with the
edit in the second half the other word begins with the first, with the edit in the first half it ends with the second.
Every word's two segments go to automaton shards, by the kind of segment and its outer ``OUTER`` code points (all of a shorter
one's); every word is scanned by the shards where segments of words as long within one can be, two to four. Aho-Corasick automata name the segments in a word;
those count that stand at its beginning (or end) and whose word is as long within one; the rest of both words is compared
in blocks of codes. A pair that both segments find counts by the first. Shards with many segments or many words to scan
are split both ways, so memory is bounded by a split; only sums and the best neighbour leave a shard.

Roots follow forms by doubling; every form has at least twice its word's count, so chains end after the logarithm of the
largest count and doubling after the logarithm of that.

Edge cases: a null text has no words and a null id is hashed as empty; words below ``least_chars`` can't be had by the
scan if they have fewer than four code points, so :func:`variants` ignores those and null words; repeated words of its input
are added up; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordwatch.llm.common import cut, kept, text_or_empty

LETTER = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Code points at most by which segments are dealt to shards; words below ``SHORTEST`` have segments that are no use.
OUTER, SHORTEST = 4, 4
#: Segments and scanned words of a split of a shard; words scanned before they are compared; cells compared at a time.
SEGMENTS, SCANNED, BATCH, CELLS = 20_000, 40_000, 20_000, 4_000_000
FOUND = "word string, n_near long, best_n long, best string"


def document_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_chars: int = 5, least_n: int = 3, every: int = 97) -> DataFrame:
    """``word, n``: maximal runs of Latin letters, A-Z lower-cased, that occur ``least_n`` times.

    In every run whose CRC-32 with its document's id is divisible by ``every``, one code point is left out. Runs are
    counted before the shuffle; runs that are too short to become words aren't read at all.
    """
    runs = F.regexp_extract_all(text_or_empty(text_col), F.lit(f"({LETTER}{{{least_chars},}})"), F.lit(1))
    each = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    each = each.withColumn("run", F.translate("run", UPPER, LOWER)).withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    each = each.withColumn("at", (F.col("h") % F.length("run")).cast("int"))
    cut_out = F.concat(F.substring("run", F.lit(1), F.col("at")), F.substring("run", F.col("at") + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, cut_out).otherwise(F.col("run"))
    counted = each.select(word.alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter((F.col("n") >= least_n) & (F.length("word") >= least_chars))


def _codes(words: list[str], length: int) -> np.ndarray:
    """A row of code points for each word, all of one length."""
    out = np.array(words, dtype=f"U{max(length, 1)}").view(np.uint32).reshape(len(words), max(length, 1))[:, :length]
    return out.astype(np.uint8) if out.size == 0 or out.max() < 256 else out


def _one_edit(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (of a, of b) that are exactly one edit apart; both have rows of one length, which differ by at most one."""
    if a.shape[1] == b.shape[1]:
        apart = np.zeros((len(a), len(b)), np.int32)
        for k in range(a.shape[1]):
            apart += a[:, k, None] != b[None, :, k]
        return np.nonzero(apart == 1)
    if a.shape[1] < b.shape[1]:
        y, x = _one_edit(b, a)
        return x, y
    size = b.shape[1]
    ahead, behind = (np.zeros((len(a), len(b)), np.int32) for _ in range(2))
    for count, shift, order in ((ahead, 0, range(size)), (behind, 1, range(size - 1, -1, -1))):
        equal = np.ones((len(a), len(b)), bool)
        for k in order:
            equal &= a[:, k + shift, None] == b[None, :, k]
            if not equal.any():
                break
            count += equal
    return np.nonzero(ahead + behind >= size)


class _Shard:
    """The automaton of a split of a shard, and what its words are near to."""

    def __init__(self, tail: bool, words: list[str], counts: list[int]):
        import ahocorasick

        self.tail, self.words, self.counts = tail, words, counts
        groups: dict[str, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for k, word in enumerate(words):
            half = len(word) // 2
            groups[word[half:] if tail else word[:half]][len(word)].append(k)
        self.groups = list(groups.items())
        self.automaton = ahocorasick.Automaton()
        for g, (segment, _) in enumerate(self.groups):
            self.automaton.add_word(segment, g)
        self.automaton.make_automaton()
        self.codes: dict[tuple[int, int], np.ndarray] = {}

    def _rest(self, word: str, segment: int) -> str:
        return word[: len(word) - segment] if self.tail else word[segment:]

    def near(self, scanned: list[str]) -> Iterator[tuple[str, int, int, str]]:
        """``FOUND`` of the scanned words that are near to words of this split."""
        meet: dict[tuple[int, int, int], list[int]] = defaultdict(list)
        for b, word in enumerate(scanned):
            last = len(word) - 1
            for end, g in self.automaton.iter(word):
                segment, by_length = self.groups[g]
                if (end == last) if self.tail else (end == len(segment) - 1):
                    for length in by_length:
                        if abs(length - len(word)) <= 1:
                            meet[g, length, len(word)].append(b)
        found: dict[int, list] = {}
        for (g, length, other), rows in meet.items():
            segment, own = len(self.groups[g][0]), self.groups[g][1][length]
            if (g, length) not in self.codes:
                self.codes[g, length] = _codes([self._rest(self.words[k], segment) for k in own], length - segment)
            theirs, step = _codes([self._rest(scanned[b], segment) for b in rows], other - segment), max(1, CELLS // len(own))
            for at in range(0, len(rows), step):
                for i, j in zip(*map(np.ndarray.tolist, _one_edit(self.codes[g, length], theirs[at : at + step]))):
                    word, b = self.words[own[i]], rows[at + j]
                    if self.tail and scanned[b].startswith(word[: length // 2]):
                        continue
                    best = (-self.counts[own[i]], word)
                    if b in found:
                        found[b] = [found[b][0] + 1, min(found[b][1], best)]
                    else:
                        found[b] = [1, best]
        for b, (n, (minus, word)) in found.items():
            yield scanned[b], n, -minus, word


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``shard, scan, tail, word, n`` in order of shard and scan: first a split's segments, then the words it scans."""
    shard, automaton, words, counts, waiting = None, None, [], [], []

    def done() -> Iterator[pa.RecordBatch]:
        found = list(automaton.near(waiting)) if automaton and waiting else []
        waiting.clear()
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["word", "n_near", "best_n", "best"])

    for batch in batches:
        for key, scan, tail, word, n in zip(*(batch.column(name).to_pylist() for name in ("shard", "scan", "tail", "word", "n"))):
            if key != shard:
                yield from done()
                shard, automaton, words, counts = key, None, [], []
            if not scan:
                words.append(word)
                counts.append(n)
                continue
            if automaton is None:
                automaton = _Shard(tail, words, counts)
            waiting.append(word)
            if len(waiting) >= BATCH:
                yield from done()
    yield from done()


def near_words(words: DataFrame, segments: int = SEGMENTS, scanned: int = SCANNED) -> DataFrame:
    """``word, n_near, best_n, best`` for the words of ``words`` (distinct, ``SHORTEST`` code points at least) that have near ones: how many, and the one of largest n, first in order of code points."""
    size = F.length("word")
    head = lambda of: F.left("word", F.least(F.lit(OUTER), F.floor(of / 2).cast("int")))
    tail = lambda of: F.right("word", F.least(F.lit(OUTER), (of - F.floor(of / 2)).cast("int")))
    sides = lambda of: F.array(F.struct(F.lit(False).alias("tail"), head(of).alias("outer")), F.struct(F.lit(True).alias("tail"), tail(of).alias("outer")))
    own = words.select("word", "n", F.explode(sides(size)).alias("of")).select("word", "n", "of.tail", "of.outer")
    sought = words.select("word", "n", F.explode(F.array_distinct(F.concat(*[sides(size + more) for more in (-1, 0, 1)]))).alias("of")).select("word", "n", "of.tail", "of.outer")
    splits = lambda of, most, name: of.groupBy("tail", "outer").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias(name))
    cells = splits(own, segments, "rows").join(splits(sought, scanned, "cols"), ["tail", "outer"])
    h = lambda n: F.pmod(F.xxhash64("word"), n).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    held = own.join(cells, ["tail", "outer"]).withColumn("row", h(F.col("rows"))).withColumn("col", all_of("cols")).withColumn("scan", F.lit(False))
    asked = sought.join(cells, ["tail", "outer"]).withColumn("col", h(F.col("cols"))).withColumn("row", all_of("rows")).withColumn("scan", F.lit(True))
    both = held.unionByName(asked).withColumn("shard", F.concat_ws("|", F.col("tail").cast("string"), "row", "col", "outer"))
    both = both.select("shard", "scan", "tail", "word", "n").repartition("shard").sortWithinPartitions("shard", "scan")
    found = both.mapInArrow(_scan, FOUND)
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for rows of ``word, form`` (both never null, no cycles): the last word that forms lead to, by doubling."""
    at = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        then = at.select(F.col("word").alias("__of"), F.col("root").alias("__then"))
        moved = cut(at.join(then, at["root"] == then["__of"], "left").select("word", F.coalesce("__then", "root").alias("root"), F.col("__then").isNotNull().alias("moved")))
        at = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return at


def variants(words: DataFrame, times: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for the words of ``words`` (``word, n``).

    A word's form is its near word of largest n (of equals the first by code points) if that n is ``times`` its own or more.
    """
    held = kept(words.filter(F.length("word") >= SHORTEST).groupBy("word").agg(F.sum("n").alias("n")))
    known = held.join(near_words(held), "word", "left")
    is_form = F.col("best_n") >= F.col("n") * times
    known = kept(known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")))
    ends = roots(known.filter("form is not null"))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
