"""Best-fit packing of token sequences by linear grouping.

Lengths are at most ``capacity``, so a histogram of lengths has at most ``capacity`` rows
however many documents there are. The plan is made from it on the driver:

1. Lengths over ``small`` are dealt into groups of equal cardinality, longest first, and
   rounded up to the longest of their group.
2. Few sizes are left, so the best mix of configurations (how many of each group fill one
   sequence) is a small linear programme, solved by column generation and rounded down.
3. Actual lengths replace the rounded ones, which leaves room in the sequences.
4. What is left, mostly small, is put where it fits best, longest first.

Equal sequences are kept as one run with a count throughout, so the plan has a size bound
by ``capacity``. Each piece finds its place from its length and its rank among the pieces
of that length, which is a prefix sum over partitions.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terracelake.llm.common import prepare, store, text_of
from terracelake.llm.tokens import WordIds, encoder

# Shares of the capacity up to which a piece counts as small, each with a number of groups.
# A low share leaves more to the programme, a high one more to the best fit; which is better
# depends on the lengths, so each is planned (a second in all) and the shortest plan is kept.
TRIALS = ((1 / 4, 48), (1 / 3, 96), (1 / 2, 64))

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass
class Run:
    """``count`` sequences that hold the same lengths. ``items``: (length, how many), newest first, linked."""

    count: int
    room: int
    items: tuple | None = None

    def holding(self, length: int, many: int, count: int) -> Run:
        return Run(count, self.room - length * many, ((length, many), self.items))


def best_configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, patience: int = 60):
    """Fractional numbers of configurations that cover ``demand`` with the fewest sequences.

    Column generation: a simplex basis of as many configurations as there are sizes, and a
    knapsack that finds the configuration worth most at the current prices.
    """
    n = len(sizes)
    basis = np.diag((capacity // sizes).astype(float))
    # Slightly uneven demands keep the simplex steps from going in circles.
    wanted = demand.astype(float) + 1e-6 * (1 + np.arange(n))
    fewest, since = np.inf, 0
    while since < patience:  # steps without progress: the basis is optimal or as good as it gets
        inverse = np.linalg.inv(basis)
        needed = float((inverse @ wanted).sum())
        fewest, since = (needed, 0) if needed < fewest * (1 - 1e-6) else (fewest, since + 1)
        prices = inverse.sum(axis=0)
        worth, column = _knapsack(sizes, prices, capacity)
        if worth <= 1 + 1e-9:
            break
        amounts, step = inverse @ wanted, inverse @ column
        limits = np.where(step > 1e-9, amounts / np.where(step > 1e-9, step, 1), np.inf)
        basis[:, int(limits.argmin())] = column
    return basis, np.maximum(np.linalg.solve(basis, wanted), 0)


def _knapsack(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable configuration. ``best[m][c]``: with at most m pieces in c tokens."""
    best, choice = [np.zeros(capacity + 1)], []
    useful = np.flatnonzero(prices > 1e-12)
    for _ in range(capacity // int(sizes.min())):
        new, picked = best[-1].copy(), np.full(capacity + 1, -1)
        for i in useful:
            value = best[-1][: capacity + 1 - sizes[i]] + prices[i]
            better = value > new[sizes[i]:] + 1e-12
            new[sizes[i]:][better] = value[better]
            picked[sizes[i]:][better] = i
        best.append(new)
        choice.append(picked)
        if (picked < 0).all():
            break
    column, room = np.zeros(len(sizes)), capacity
    for picked in reversed(choice):
        if (i := picked[room]) >= 0:
            column[i] += 1
            room -= int(sizes[i])
    return float(best[-1][capacity]), column


def _grouped(lengths: np.ndarray, counts: np.ndarray, groups: int, capacity: int):
    """Sequences of large pieces, and the lengths that found no whole configuration."""
    total = int(counts.sum())
    groups = min(groups, total)
    edges = [total * g // groups for g in range(groups + 1)]
    ends = np.cumsum(counts)
    queues: list[list[list[int]]] = []
    for a, b in zip(edges, edges[1:]):
        i, queue = int(np.searchsorted(ends, a, "right")), []
        while a < b:
            take = min(b, int(ends[i])) - a
            queue.append([int(lengths[i]), take])
            a, i = a + take, i + 1
        queues.append(queue)
    sizes = np.array([q[0][0] for q in queues])
    demand = np.array([sum(n for _, n in q) for q in queues])
    basis, amounts = best_configurations(sizes, demand, capacity)
    runs: list[Run] = []
    for column, amount in zip(basis.T, np.floor(amounts + 1e-7).astype(np.int64)):
        slots = [g for g in range(groups) for _ in range(int(column[g]))]
        # A configuration may cover more than there is; it is used as often as it can be filled.
        for g in set(slots):
            have = sum(n for _, n in queues[g])
            amount = min(amount, have // slots.count(g))
        if amount > 0 and slots:
            runs += _filled([_taken(queues[g], int(amount)) for g in slots], capacity)
    return runs, [(length, n) for q in queues for length, n in q if n]


def _taken(queue: list[list[int]], amount: int) -> list[tuple[int, int]]:
    out = []
    while amount:
        length, have = queue[0]
        take = min(have, amount)
        out.append((length, take))
        amount -= take
        queue[0][1] -= take
        if not queue[0][1]:
            queue.pop(0)
    return out


def _filled(slots: list[list[tuple[int, int]]], capacity: int) -> list[Run]:
    """Runs of equal sequences, where each slot lists the lengths it holds one after another."""
    ends = [np.cumsum([n for _, n in slot]) for slot in slots]
    cuts = np.unique(np.concatenate(ends))
    runs, a = [], 0
    for b in cuts.tolist():
        run = Run(b - a, capacity)
        for slot, end in zip(slots, ends):
            run = run.holding(slot[int(np.searchsorted(end, a, "right"))][0], 1, b - a)
        runs.append(run)
        a = b
    return runs


def _best_fit(runs: list[Run], rest: list[tuple[int, int]], capacity: int) -> list[Run]:
    """Puts each length, longest first, into the fullest sequence that has room, or a new one."""
    by_room: dict[int, list[Run]] = {}
    rooms: list[int] = []

    def add(run: Run) -> None:
        if run.count:
            if run.room not in by_room:
                by_room[run.room] = []
                insort(rooms, run.room)
            by_room[run.room].append(run)

    for run in runs:
        add(run)
    for length, n in sorted(rest, reverse=True):
        while n:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                add(Run(-(-n // (capacity // length)), capacity))
                continue
            room = rooms[at]
            run = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                rooms.pop(at)
            each = room // length
            full = min(run.count, n // each)
            add(run.holding(length, each, full))
            n -= full * each
            left = run.count - full
            if left and n:  # fewer than a sequence takes
                add(run.holding(length, n, 1))
                n, left = 0, left - 1
            add(Run(left, run.room, run.items))
    return [run for own in by_room.values() for run in own]


def best_plan(histogram: dict[int, int], capacity: int, trials: Sequence[tuple[float, int]]) -> list[Run]:
    """The plan with the fewest sequences among (share of the capacity that is small, groups)."""
    plans = [plan(histogram, capacity, int(capacity * share), groups) for share, groups in trials]
    return min(plans, key=lambda runs: sum(run.count for run in runs))


def plan(histogram: dict[int, int], capacity: int, small: int, groups: int) -> list[Run]:
    """Which lengths share a sequence. ``histogram``: length -> pieces."""
    lengths = np.array(sorted((x for x in histogram if histogram[x]), reverse=True), dtype=np.int64)
    large = lengths[lengths > small]
    runs, rest = [], []
    if len(large):
        runs, rest = _grouped(large, np.array([histogram[int(x)] for x in large]), groups, capacity)
    rest += [(int(x), histogram[int(x)]) for x in lengths if x <= small]
    return _best_fit(runs, rest, capacity)


def places(runs: list[Run]) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces per sequence, offset), sorted by length and rank."""
    rows, ranks, sequence = [], {}, 0
    for run in runs:
        offset, items = 0, run.items
        while items is not None:
            (length, many), items = items
            first = ranks.get(length, 0)
            rows.append((length, first, sequence, many, offset))
            ranks[length] = first + many * run.count
            offset += length * many
        sequence += run.count
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def _pieces(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int,
            with_ids: bool) -> Iterator[pa.RecordBatch]:
    ids_of = encoder(WordIds, path)
    end = np.array([end_id], "<u4").tobytes()
    part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids = ids_of(text) + end
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                own = ids[at:at + 4 * capacity]
                length = len(own) // 4
                rows.append((doc_id, piece, at // 4, length, zlib.crc32(own), part, int(seen[length]),
                             *((own,) if with_ids else ())))
                seen[length] += 1
        columns = list(zip(*rows)) or [()] * (7 + with_ids)
        kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64(), pa.binary()]
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth", "ids"]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names[: 7 + with_ids])


def pack(docs: DataFrame, path: str, end_id: int = 1, capacity: int = 4096,
         trials: Sequence[tuple[float, int]] = TRIALS, with_ids: bool = False) -> DataFrame:
    """Packs the token ids of ``text``, each text's followed by ``end_id``, into sequences.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and
    with ``with_ids`` the packed ids. Only texts of more than ``capacity`` ids are cut.

    Null and empty texts are one piece of the end id. Null doc_ids are kept, and rows with
    the same doc_id are packed each for itself, equal rows too. An empty table gives no
    rows. Other columns are not read.
    """
    spark = prepare(docs.sparkSession)
    kinds = PIECES + ", part int, nth long" + (", ids binary" if with_ids else "")
    texts = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    pieces = store(texts.mapInArrow(
        lambda batches: _pieces(batches, path, end_id, capacity, with_ids), kinds), "pieces")

    counts = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = store(counts, "lengths")
    histogram = {r["length"]: r["n"] for r in  # at most one row per possible length
                 counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = places(best_plan(histogram, capacity, trials))
    shared = spark.sparkContext.broadcast(table)

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        pieces.join(store(counts.select(
            "length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "ranks"),
            ["length", "part"])
        .select("doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []),
                (F.col("before") + F.col("nth")).alias("rank"))
    )

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length_, first, sequence, many, offset = shared.value.T
        keys = (length_ << 40) + first
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
            at = np.searchsorted(keys, (length << 40) + rank, "right") - 1
            nth = rank - first[at]
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.record_batch(
                [*(batch.column(n) for n in names), pa.array(sequence[at] + nth // many[at]),
                 pa.array(offset[at] + nth % many[at] * length)], [*names, "sequence_id", "offset"])

    out = PIECES + (", ids binary" if with_ids else "") + ", sequence_id long, offset long"
    return ranked.mapInArrow(placed, out)
