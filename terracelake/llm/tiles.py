"""Tiles of a block matrix join, and heaps of the best that their slots have seen.

Vectors lie in blocks, many to a row. Every block of one table meets every block of another in a
tile. A task holds a group of the first table's blocks while the second table's blocks pass by one
at a time, so no tile is ever a row that Spark has to sort or send.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracelake.llm.common import store

# Components of the vectors that a task holds.
HELD = 1 << 24
# For tables of blocks: Spark's reader takes a row group at a time, and a row can have a megabyte.
STORED = {"parquet.block.row.count.limit": "16"}


def by_dimension(batches: Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]], size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(dimension, [vectors, *others]) of up to ``size`` rows, from batches of (components, lengths, others)."""
    waiting: dict[int, list[list[np.ndarray]]] = {}
    for flat, lengths, others in batches:
        starts = np.cumsum(lengths) - lengths
        for dim in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == dim)
            vectors = flat[starts[at][:, None] + np.arange(dim)]
            own = waiting.setdefault(dim, [])
            own.append([vectors, *(o[at] for o in others)])
            if sum(len(o[0]) for o in own) >= size:
                whole = [np.concatenate(c) for c in zip(*own)]
                full = len(whole[0]) // size * size
                for a in range(0, full, size):
                    yield dim, [c[a:a + size] for c in whole]
                waiting[dim] = [[c[full:].copy() for c in whole]]
    for dim, own in waiting.items():
        if len((whole := [np.concatenate(c) for c in zip(*own)])[0]):
            yield dim, whole


def lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All components of a column of lists, and the length of each list."""
    return column.flatten().to_numpy(zero_copy_only=False), pc.list_value_length(column).to_numpy(zero_copy_only=False)


def tiled(held: DataFrame, passing: DataFrame, hold: Callable, answer: Callable, schema: str, name: str, size: int) -> DataFrame:
    """Runs every passing block past every held one of its dimension, stored.

    Both tables have the same columns: dim, block, n and what the functions need. ``hold`` makes
    sides of tiles of the dicts of held blocks, together ``size`` rows or more if there are as many; ``answer`` gets a
    passing block and all sides of its dimension, and gives a record batch. Held blocks are dealt into groups of
    ``HELD`` components, at least two a core, and passing blocks go to every group.
    """
    spark = held.sparkSession
    blocks, components = held.agg(F.count("*"), F.sum(F.col("n").cast("long") * F.col("dim"))).first()
    groups = max(1, min(blocks, max(-(-(components or 0) // HELD), 2 * spark.sparkContext.defaultParallelism)))
    left = held.withColumns({"part": F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"), "passes": F.lit(False)})
    right = passing.withColumns({"part": F.explode(F.sequence(F.lit(0), F.lit(groups - 1))), "passes": F.lit(True)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, waiting, sides = None, {}, {}
        for batch in batches:
            for i in range(batch.num_rows):
                # Bytes stay where Arrow has them.
                row = {c: v.as_buffer() if isinstance(v := batch.column(c)[i], pa.BinaryScalar) else v.as_py() for c in batch.schema.names}
                if row["part"] != part:
                    part, waiting, sides = row["part"], {}, {}
                if not row["passes"]:
                    own = waiting.setdefault(row["dim"], [])
                    own.append(row)
                    if sum(b["n"] for b in own) >= size:
                        sides.setdefault(row["dim"], []).extend(hold(waiting.pop(row["dim"])))
                    continue
                for dim, own in waiting.items():
                    sides.setdefault(dim, []).extend(hold(own))
                waiting = {}
                if row["dim"] in sides:
                    yield answer(row, sides[row["dim"]])

    dealt = left.unionByName(right).repartitionById(groups, F.col("part")).sortWithinPartitions("part", "passes", "block")
    return store(dealt.mapInArrow(run, schema), name)


def places(near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of what is true, which is little: eight bytes are looked at together first."""
    flat = near.ravel()
    whole = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:whole].view(np.uint64))
    at = np.concatenate([(words[:, None] * 8 + np.arange(8)).ravel(), np.arange(whole, len(flat))])
    return np.divmod(at[np.nonzero(flat[at])[0]], near.shape[1])


def smallest(slots: np.ndarray, values: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """slot, value, id, place: the first ``k`` of each slot by value, then id. An id that is repeated counts once, with its smallest value."""
    def starts(*columns: np.ndarray) -> np.ndarray:
        new = np.ones(len(columns[0]), bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        return new

    order = np.lexsort((values, ids, slots))
    order = order[starts(slots[order], ids[order])]
    order = order[np.lexsort((ids[order], values[order], slots[order]))]
    first = np.flatnonzero(starts(slots[order]))
    place = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    order, place = order[place < k], place[place < k]
    return slots[order], values[order], ids[order], place


class Heaps:
    """A heap of the ``k`` smallest (value, id) for each of ``n`` slots, each id once. What is added waits until it is worth a sort."""

    def __init__(self, n: int, k: int, kind: type):
        none = np.inf if kind is np.float64 else np.iinfo(kind).max
        self.k, self.sizes = k, np.zeros(n, np.int64)
        self.values, self.ids = np.full((n, k), none, kind), np.full((n, k), np.iinfo(np.int64).max)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waits = 0

    def add(self, slots: np.ndarray, values: np.ndarray, ids: np.ndarray) -> None:
        last = self.values[slots, -1]
        near = (values < last) | (values == last) & (ids <= self.ids[slots, -1])
        if near.any():
            self.waiting.append((slots[near], values[near], ids[near]))
            self.waits += len(self.waiting[-1][0])
            if self.waits >= max(1024, self.values.size // 2):
                self.settle()

    def settle(self) -> None:
        """Merges what waits into the heaps."""
        if not self.waiting:
            return
        slots, values, ids = (np.concatenate(c) for c in zip(*self.waiting))
        self.waiting, self.waits = [], 0
        touched = np.unique(slots)
        row, place = np.divmod(np.flatnonzero(np.arange(self.k) < self.sizes[touched][:, None]), self.k)
        row = touched[row]
        slots, values, ids, place = smallest(np.concatenate([slots, row]), np.concatenate([values, self.values[row, place]]),
                                             np.concatenate([ids, self.ids[row, place]]), self.k)
        self.values[slots, place], self.ids[slots, place] = values, ids
        self.sizes[touched] = np.bincount(slots, minlength=len(self.sizes))[touched]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each slot's number of entries, and the values and ids of all, in order."""
        self.settle()
        held = np.arange(self.k) < self.sizes[:, None]
        return self.sizes, self.values[held], self.ids[held]


def structs(sizes: np.ndarray, **fields: np.ndarray) -> pa.ListArray:
    """Lists of as many structs."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(v) for v in fields.values()], list(fields)))


def lists_of_structs(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a column of lists of lists of two-field structs: each struct's row, and its fields."""
    inner = column.flatten()
    row = np.repeat(np.arange(len(column)), pc.list_value_length(column).to_numpy(zero_copy_only=False))
    one, two = inner.flatten().flatten()
    return np.repeat(row, pc.list_value_length(inner).to_numpy(zero_copy_only=False)), one.to_numpy(zero_copy_only=False), two.to_numpy(zero_copy_only=False)
