"""Best-fit packing of token sequences by a configuration linear program.

The pieces' lengths form a histogram of at most ``capacity`` counts, whatever the number of documents. On it
the configuration programme (fewest sequences whose configurations cover every length as often as it occurs)
is solved by multiplicative weights: each round prices lengths by how badly they are covered so far, a knapsack dynamic
programme finds for every length the most valuable configuration with it, and what is still uncovered takes a share of
each. Prices over the value of the best configuration are a dual solution, so each round also gives a bound that no packing
can beat. All shares together are the fractional solution; it is rounded down,
then by greatest fraction up while stock lasts, what is left is solved again, and the little that no configuration uses
goes, longest first, where it fits best. The result is a table of runs: so many sequences of one
configuration. Documents join it by length and by their rank among the pieces of that length, counted in
salted groups, so no length gathers in one task.

Edge cases: a null or empty text is the end id alone; a document longer than a sequence is cut, and only then;
a row with a null id is packed like any other; repeated rows are each packed; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordwatch.llm.bpe import load, read_spec
from recordwatch.llm.common import cut, text_or_empty

CAPACITY, END_ID = 4096, 1
#: Rounds of multiplicative weights for all lengths and for what a rounding leaves, and how fast weights change.
ROUNDS, MORE_ROUNDS, RATE = 24, 8, 0.05
#: How often what is left is solved again at most; configurations within so much of the best value are worth rounding up.
SOLVED, SLACK = 6, 1e-3
#: Values that differ by so much count as equal in the knapsack programme.
TIE = 1e-4
#: Pieces of one length that are ranked together; longer queues are salted.
RANKED_TOGETHER = 1_000


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece of every document."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end, step = load(spec.value), array("I", [end_id]).tobytes(), 4 * capacity
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = bpe.encode(text) + end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    for column, value in zip(out, (doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part))):
                        column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return source.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


@dataclass
class Priced:
    """Best configurations at given prices: for each room their ``value``, and a run of ``count`` pieces of length ``take``.

    ``fall`` is the largest room up to this one where something is worth taking, or 0.
    """

    value: np.ndarray
    take: np.ndarray
    count: np.ndarray
    fall: np.ndarray


def priced(prices: np.ndarray, wanted: np.ndarray, capacity: int, draw: np.random.Generator) -> Priced:
    """The knapsack programme; a room takes one of the lengths that are worth most there, drawn by how much of each is ``wanted``."""
    sizes = np.flatnonzero(prices > 0)[::-1]
    values = prices[sizes]
    likely = np.log(wanted[sizes])
    chance = draw.gumbel(size=len(sizes) + capacity + 1)
    fits = np.searchsorted(-sizes, -np.arange(capacity + 1)).tolist()
    value, take = np.zeros(capacity + 1), [0] * (capacity + 1)
    count, fall = [0] * (capacity + 1), [0] * (capacity + 1)
    for room in range(1, capacity + 1):
        value[room], fall[room] = value[room - 1], fall[room - 1]
        if fits[room] < len(sizes):
            first = fits[room]
            gains = values[first:] + value[room - sizes[first:]]
            most = gains.max()
            if most > value[room]:
                ties = np.flatnonzero(gains >= most * (1 - TIE))
                size = int(sizes[first + ties[(likely[first + ties] + chance[first + ties + room]).argmax()]])
                value[room], take[room], fall[room] = most, size, room
                count[room] = 1 + (count[room - size] if take[room - size] == size else 0)
    return Priced(value, np.array(take), np.array(count), np.array(fall))


def _with_each(sizes: np.ndarray, found: Priced, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and counts, a column for each of ``sizes``, of the best configuration with it."""
    lengths, counts, room = [sizes], [np.ones(len(sizes), np.int64)], found.fall[capacity - sizes]
    while room.any():
        lengths.append(found.take[room])
        counts.append(found.count[room])
        room = found.fall[room - lengths[-1] * counts[-1]]
    return np.stack(lengths), np.stack(counts)


@dataclass
class Solution:
    """A fractional cover of all lengths: (length, count), ... -> sequences; ``bound`` is the best dual value, ``prices`` its solution."""

    sequences: dict[tuple[tuple[int, int], ...], float]
    bound: float
    prices: np.ndarray

    @property
    def value(self) -> float:
        return sum(self.sequences.values())


def solve(stock: np.ndarray, capacity: int = CAPACITY, rounds: int = ROUNDS, rate: float = RATE) -> Solution:
    """The configuration programme for ``stock[l]`` pieces of each length l, by multiplicative weights over the lengths.

    No round covers more of a length than is still uncovered, so rare lengths that fit many gaps are not used up on paper.
    """
    sizes = np.flatnonzero(stock)
    need = stock.astype(float)
    left = need.copy()
    weight = need * np.arange(capacity + 1)
    bound, dual, slack = 0.0, np.zeros(capacity + 1), SLACK
    sequences: dict[tuple[tuple[int, int], ...], float] = {}
    draw = np.random.default_rng(1)
    for turn in range(rounds):
        open_ = sizes[left[sizes] > 1e-6 * need[sizes]]
        if not len(open_):
            break
        prices = np.zeros(capacity + 1)
        prices[open_] = weight[open_] / need[open_]
        found = priced(prices, left, capacity, draw)
        best = found.value[capacity]
        if weight[open_].sum() / best > bound:
            bound, dual = weight[open_].sum() / best, prices / best
        lengths, counts = _with_each(open_[::-1], found, capacity)
        worth = prices[lengths[0]] + found.value[capacity - lengths[0]]
        share, before = 0.5 if turn < rounds - 1 else 1.0, left.sum()
        for size, count in zip(lengths.T[worth >= best * (1 - slack)].tolist(), counts.T[worth >= best * (1 - slack)].tolist()):
            key: dict[int, int] = {}
            for k, n in zip(size, count):
                if n:
                    key[k] = key.get(k, 0) + n
            x = share * min(left[k] / n for k, n in key.items())
            if x > 1e-9:
                told = tuple(sorted(key.items(), reverse=True))
                sequences[told] = sequences.get(told, 0.0) + x
                for k, n in told:
                    left[k] -= n * x
        # Where hardly anything is worth the best value any more, less will do.
        slack = slack * 2 if left.sum() > 0.9 * before else slack
        weight[sizes] *= np.exp(rate * left[sizes] / need[sizes])
    for size in sizes[left[sizes] > 0].tolist():
        told = ((size, capacity // size),)
        sequences[told] = sequences.get(told, 0.0) + left[size] / (capacity // size)
    return Solution(sequences, bound, dual)


class _Plan:
    """Rows (length, first rank, count in a sequence, first sequence, offset) for a stock of lengths."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.sequences = capacity, 0
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.used = [0] * (capacity + 1)

    def put(self, found: tuple[tuple[int, int], ...], times: int) -> None:
        """``times`` sequences of one configuration of (length, count)."""
        offset = 0
        for size, n in found:
            self.rows.append((size, self.used[size], n, self.sequences, offset))
            self.used[size] += n * times
            offset += n * size
        self.sequences += times

    def round(self, stock: list[int], found: Solution) -> int:
        """Takes the solution's configurations from ``stock``, rounded down, then up from the greatest fraction; returns how many sequences that gave."""
        before = self.sequences
        order = sorted(found.sequences.items(), key=lambda x: (-x[1], x[0]))

        def take(key: tuple[tuple[int, int], ...], most: int) -> None:
            times = min(most, *(stock[size] // n for size, n in key))
            if times > 0:
                self.put(key, times)
                for size, n in key:
                    stock[size] -= n * times

        tight = [(key, x) for key, x in order if sum(found.prices[size] * n for size, n in key) >= 1 - SLACK]
        for key, x in tight:
            if x >= 1:
                take(key, int(x))
        for key, x in sorted(tight, key=lambda x: (-(x[1] % 1), x[0])):
            take(key, 1)
        return self.sequences - before

    def best_fit(self, stock: list[int]) -> None:
        """Largest first, each to the open sequence with the least room that still holds it, by runs of equal sequences.

        Pieces of one length fill a sequence as far as it goes, since after each piece it is the one with the least room;
        so a run of equal sequences takes as many of them each, and one sequence at most takes fewer. What is done
        and kept depends on the number of lengths and runs, not on how many pieces or sequences these stand for.
        """
        runs_by_room: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}
        rooms = np.zeros(self.capacity + 1, bool)

        def keep(found: tuple[tuple[int, int], ...], times: int, room: int) -> None:
            if room:
                runs_by_room.setdefault(room, []).append((found, times))
                rooms[room] = True
            else:
                self.put(found, times)

        for size in range(self.capacity, 0, -1):
            n = stock[size]
            while n:
                room = int(rooms[size:].argmax()) + size
                found, times = runs_by_room[room].pop() if rooms[room] else ((), n)
                if found:
                    rooms[room] = bool(runs_by_room[room])
                else:
                    room = self.capacity
                each = room // size
                full, rest = min(times, n // each), 0
                if full < times and n > full * each:
                    rest = n - full * each
                n -= full * each + rest
                if full:
                    keep((*found, (size, each)), full, room - each * size)
                if rest:
                    keep((*found, (size, rest)), 1, room - rest * size)
                if found and times > full + bool(rest):
                    keep(found, times - full - bool(rest), room)
        for runs in runs_by_room.values():
            for found, times in runs:
                self.put(found, times)


@dataclass
class Plan:
    """``rows`` (length, first rank, count in a sequence, first sequence, offset), sorted; ``sequences``, of them ``rounded`` from the solution; ``bound``."""

    rows: np.ndarray
    sequences: int
    rounded: int
    bound: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Where the pieces of each length go. The run of a row ends at the first rank of the length's next row.

    The work depends on the number of lengths and configurations, not on the number of pieces: the solution's configurations
    are taken as often as it says, and what is left is fitted by runs of equal lengths and equal sequences.
    """
    stock = [0] * (capacity + 1)
    for size, n in histogram.items():
        stock[size] = int(n)
    out, bound = _Plan(capacity), 0.0
    if stock[capacity]:
        bound = float(stock[capacity])
        out.put(((capacity, 1),), stock[capacity])
        stock[capacity] = 0
    for turn in range(SOLVED):
        if not any(stock):
            break
        found = solve(np.array(stock), capacity, MORE_ROUNDS if turn else ROUNDS)
        bound += 0 if turn else found.bound
        if not out.round(stock, found):
            break
    rounded = out.sequences
    out.best_fit(stock)
    return Plan(np.array(sorted(out.rows), np.int64).reshape(-1, 5), out.sequences, rounded, math.ceil(bound - 1e-6))


def pack(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``found`` (pieces, see :func:`pieces`) with ``sequence_id`` and ``offset``.

    The histogram (at most ``capacity`` rows) and the plan (whose size depends on the number of lengths and rounds, not
    on the number of pieces) pass through the driver.
    """
    found = cut(found)
    histogram = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = found.sparkSession.sparkContext.broadcast(plan(histogram, capacity).rows)
    # One row per length: bounded by the capacity, so it may be broadcast.
    queues = found.sparkSession.createDataFrame([(size, n // RANKED_TOGETHER + 1) for size, n in histogram.items()], "length long, queues long")
    salted = found.join(F.broadcast(queues), "length").withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.col("queues")))
    counts = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = salted.withColumn("k", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")))
    placed = ranked.join(starts, ["length", "salt"]).select(*found.columns, (F.col("k") - 1 + F.col("before")).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = runs.value
        keys = (table[:, 0] << 40) + table[:, 1]
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            at = table[np.searchsorted(keys, (length << 40) + rank, "right") - 1]
            within = rank - at[:, 1]
            sequence, offset = at[:, 3] + within // at[:, 2], at[:, 4] + within % at[:, 2] * length
            columns = [batch.column(i) for i in range(batch.num_columns - 1)]
            yield pa.record_batch([*columns, pa.array(sequence), pa.array(offset)], [*batch.schema.names[:-1], "sequence_id", "offset"])

    return placed.mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenize ``docs`` (doc_id, text) and pack all pieces into sequences of at most ``capacity`` tokens."""
    return pack(pieces(docs, tokenizer, capacity, end_id), capacity)
