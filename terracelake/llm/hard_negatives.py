"""Hard negatives from exact integer scores: Strassen products of int64 tiles, and mergeable heaps.

Anchors and candidates are packed into blocks of integer vectors. The scores of a tile, an anchor
block times a candidate block, come from Strassen's recursion on int64 matrices, padded with
zeros to even halves. Its additions are exact, also where they run over: int64 numbers are a ring
modulo 2**64, and every score itself fits in 63 bits. Where no sum on the way can be too large for it, the
whole recursion runs in single or double precision, which holds the same integers.

Two passes over the tiles. In the first each anchor keeps a heap of its best positives, and the
heaps of all tasks are merged. A positive's score then sets a window, and in the second pass each
window keeps a heap of its best negatives. A heap holds a few entries, so what is merged does not
grow with the tiles that it comes from. Once a heap is full, only scores that can still enter it are looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracelake.llm.common import prepare, store
from terracelake.llm.tiles import STORED, Heaps, by_dimension, lists, lists_of_structs, places, smallest, structs, tiled

# Matrices with a side of at most this many rows or columns are multiplied directly.
LEAF = 32
# Candidates of a tile.
STRIP = 1024
# Squared length of an integer vector from which a score might not fit in a long.
LARGEST = 2.0 ** 62
BINARY = "ids binary, labels binary, numbers binary"
BLOCK = f"dim int, block long, n int, {BINARY}, windows binary"
HEAP = "array<struct<score: bigint, id: bigint>>"
Heap = list[tuple[int, int]]  # (-score, id) in ascending order, each id once


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of int64 matrices modulo 2**64, or of whole numbers whose sums their type holds."""
    if a.dtype != np.int64 or largest(a) * largest(b) * a.shape[1] >= 2 ** 53:
        return a @ b
    return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)  # doubles hold these exactly


def largest(x: np.ndarray) -> float:
    return float(np.abs(x.astype(np.float64)).max(initial=0))


def scores(a: np.ndarray, b: np.ndarray, most: float, leaf: int = LEAF) -> np.ndarray:
    """The product of integer matrices modulo 2**64, by seven products of halves at each level, as whole numbers of
    the smallest type that holds all sums. ``most``: the product of the largest numbers in ``a`` and ``b``."""
    shape = np.array([*a.shape, b.shape[1]])
    levels = 0
    while shape.min() >> levels > leaf:
        levels += 1
    # A level doubles the sums of its products, and adds up to six times the sums that it was to make.
    most *= a.shape[1] * (6 << levels >> 1 if levels else 1)
    kind = np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else np.int64
    rows, inner, columns = (-(-shape >> levels) << levels).tolist()
    whole = _halved(padded(a.astype(kind), rows, inner), padded(b.astype(kind), inner, columns), levels)
    return whole[:shape[0], :shape[2]]


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The same of int64 matrices, as int64 numbers."""
    return scores(a, b, largest(a) * largest(b), leaf).astype(np.int64)


def padded(x: np.ndarray, rows: int, columns: int) -> np.ndarray:
    return x if x.shape == (rows, columns) else np.pad(x, ((0, rows - x.shape[0]), (0, columns - x.shape[1])))


def _halved(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return product(a, b)
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    whole = np.empty((2 * m, 2 * n), a.dtype)
    one, two, three, four = whole[:m, :n], whole[:m, n:], whole[m:, :n], whole[m:, n:]
    both = _halved(a11 + a22, b11 + b22, levels - 1)
    low = _halved(a21 + a22, b11, levels - 1)
    right = _halved(a11, b12 - b22, levels - 1)
    left = _halved(a22, b21 - b11, levels - 1)
    top = _halved(a11 + a12, b22, levels - 1)
    np.add(both, left, out=one)
    one -= top
    one += _halved(a12 - a22, b21 + b22, levels - 1)
    np.add(right, top, out=two)
    np.add(low, left, out=three)
    np.subtract(both, low, out=four)
    four += right
    four += _halved(a21 - a11, b11 + b12, levels - 1)
    return whole


def whole_numbers(flat: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(scale * flat)


def usable(rows: DataFrame) -> DataFrame:
    """id, label, vector (of doubles): only rows with an id, a label and a vector of finite numbers."""
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        rows.toDF("id", "label", "vector")
        .select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
                F.col("vector").cast("array<double>").alias("vector"))
        .filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & sound)
    )


def packed(rows: DataFrame, size: int, scale: float, name: str) -> DataFrame:
    """Blocks of up to ``size`` vectors of the same dimension as integers, in the order of their ids, stored.

    ``rows``: id, label, vector and windows, binary numbers that come with an anchor. A block's integers
    have as few bytes as hold them.
    """

    def columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        flat, lengths = lists(batch.column("vector"))
        return whole_numbers(flat, scale), lengths, [batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label", "windows")]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for made, (dim, own) in enumerate(by_dimension(map(columns, batches), size)):
            with np.errstate(over="ignore"):
                fits = np.flatnonzero((own[0] * own[0]).sum(axis=1) < LARGEST)
            order = fits[np.argsort(own[1][fits], kind="stable")]
            vectors, ids, labels, windows = (c[order] for c in own)
            if not len(ids):
                continue
            kind = next(k for k in (np.int16, np.int32, np.int64) if largest(vectors) <= np.iinfo(k).max)
            values = [dim, (part << 32) + made, len(ids), ids.tobytes(), labels.tobytes(), vectors.astype(kind).tobytes(), b"".join(windows)]
            kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4]
            yield pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)],
                                  ["dim", "block", "n", "ids", "labels", "numbers", "windows"])

    return store(rows.mapInArrow(pack, BLOCK), name, **STORED)


class Side(NamedTuple):
    """A tile's rows; largest: of the numbers' sizes."""

    ids: np.ndarray
    labels: np.ndarray
    numbers: np.ndarray
    largest: float


def side(blocks: list[dict]) -> Side:
    parts = []
    for b in blocks:
        kind = {2: np.int16, 4: np.int32, 8: np.int64}[len(b["numbers"]) // (b["n"] * b["dim"]) if b["dim"] else 8]
        parts.append((*(np.frombuffer(b[c], np.int64) for c in ("ids", "labels")), np.frombuffer(b["numbers"], kind).reshape(b["n"], b["dim"])))
    ids, labels, numbers = parts[0] if len(parts) == 1 else map(np.concatenate, zip(*parts))
    return Side(ids, labels, numbers, largest(numbers))


def strips(blocks: list[dict]) -> list[Side]:
    """Sides of as few rows that the sums of a recursion stay near the processor."""
    whole = side(blocks)
    return [Side(*(c[a:a + STRIP] for c in whole[:3]), whole.largest) for a in range(0, len(whole.ids), STRIP)]


def at_least(found: np.ndarray, floor: np.ndarray) -> np.ndarray:
    """Where a row's scores reach its floor."""
    if found.dtype != np.int64:  # smaller numbers than the limit are exact, and all scores are
        limit = 2 ** 24 if found.dtype == np.float32 else 2 ** 53
        floor = floor.clip(-limit, limit).astype(found.dtype)
    return found >= floor[:, None]


def leading(scores: np.ndarray, ids: np.ndarray, k: int) -> Heap:
    """The first ``k`` by score, ties by id. An id that is repeated counts once, with its best score."""
    _, values, ids, _ = smallest(np.zeros(len(ids), np.int64), -scores, ids, k)
    return list(zip(values.tolist(), ids.tolist()))


def joined(one: Heap, other: Heap, k: int) -> Heap:
    """Two heaps as one."""
    own = np.array([*one, *other], np.int64).reshape(-1, 2)
    return leading(-own[:, 0], own[:, 1], k)


def merged(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    """One heap for each key."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, score, ids = lists_of_structs(batch.column("heaps"))
            row, value, ids, _ = smallest(row, -score, ids, k)
            heap = structs(np.bincount(row, minlength=batch.num_rows), score=-value, id=ids)
            yield pa.record_batch([*(batch.column(c) for c in keys), heap], [*keys, "heap"])

    kinds = ", ".join(f"{c} long" for c in keys)
    return found.groupBy(*keys).agg(F.collect_list("heap").alias("heaps")).mapInArrow(make, f"{kinds}, heap {HEAP}")


def filled(heaps: Heaps, **keys: np.ndarray) -> pa.RecordBatch:
    """The heaps that have entries, with the keys of their slots."""
    sizes, values, ids = heaps.entries()
    some = np.flatnonzero(sizes)
    return pa.record_batch([*(pa.array(v[some]) for v in keys.values()), structs(sizes[some], score=-values, id=ids)], [*keys, "heap"])


def best_positives(anchors: DataFrame, candidates: DataFrame, k: int, block: int) -> DataFrame:
    """anchor_id, heap: the ``k`` best rows of the anchor's label."""

    def answer(anchor: dict, tiles: list[Side]) -> pa.RecordBatch:
        own = side([anchor])
        heaps = Heaps(len(own.ids), k, np.int64)
        for tile in tiles:
            found = scores(own.numbers, tile.numbers.T, own.largest * tile.largest)
            last, last_id = heaps.values[:, -1], heaps.ids[:, -1]
            # Rows with larger ids than the last one's have to be better.
            near = at_least(found, -last + (last_id < tile.ids.min()))
            if len(few := np.flatnonzero(last == np.iinfo(np.int64).max)):
                near[few] = own.labels[few, None] == tile.labels
            row, column = places(near)
            wanted = (own.labels[row] == tile.labels[column]) & (own.ids[row] != tile.ids[column])
            row, column = row[wanted], column[wanted]
            heaps.add(row, -found[row, column].astype(np.int64), tile.ids[column])
        return filled(heaps, anchor_id=own.ids)

    return merged(tiled(candidates, anchors, strips, answer, f"anchor_id long, heap {HEAP}", "positive_heaps", block), ["anchor_id"], k)


def best_negatives(anchors: DataFrame, candidates: DataFrame, k: int, block: int) -> DataFrame:
    """anchor_id, positive_id, positive_score, heap: the ``k`` best rows of another label in each window.

    An anchor's windows are four numbers each: positive_id, its score, and the smallest and largest score allowed.
    """

    def answer(anchor: dict, tiles: list[Side]) -> pa.RecordBatch:
        own = side([anchor])
        windows = np.frombuffer(anchor["windows"], np.int64).reshape(len(own.ids), -1, 4)
        positive_id, positive_score, lowest, high = (windows[:, :, i] for i in range(4))
        heaps = Heaps(high.size, k, np.int64)
        none = np.iinfo(np.int64).max
        for tile in tiles:
            found = scores(own.numbers, tile.numbers.T, own.largest * tile.largest)
            last, last_id = heaps.values[:, -1].reshape(high.shape), heaps.ids[:, -1].reshape(high.shape)
            low = np.where(last == none, lowest, np.maximum(lowest, -last + (last_id < tile.ids.min())))
            low[low > high] = none
            row, column = places(at_least(found, low.min(axis=1)))
            score = found[row, column].astype(np.int64)
            other = (own.labels[row] != tile.labels[column]) & (own.ids[row] != tile.ids[column])
            row, column, score = row[other], column[other], score[other]
            for w in range(high.shape[1]):
                inside = np.flatnonzero((score >= low[row, w]) & (score <= high[row, w]))
                heaps.add(row[inside] * high.shape[1] + w, -score[inside], tile.ids[column[inside]])
        return filled(heaps, anchor_id=np.repeat(own.ids, high.shape[1]), positive_id=positive_id.ravel(), positive_score=positive_score.ravel())

    keys = ["anchor_id", "positive_id", "positive_score"]
    return merged(tiled(candidates, anchors, strips, answer, f"anchor_id long, positive_id long, positive_score long, heap {HEAP}",
                        "negative_heaps", block), keys, k)


def windowed(anchors: DataFrame, positives: DataFrame, most: int, low: int, high: int) -> DataFrame:
    """The anchors with their windows. Missing ones are empty: their smallest score is over their largest."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for heap in batch.column("heap").to_pylist():
                rows = [(e["id"], e["score"], -(-low * e["score"] // 100), high * e["score"] // 100) for e in heap]
                out.append(np.array(rows + [(0, 0, 1, 0)] * (most - len(rows)), np.int64).tobytes())
            yield pa.record_batch([*(batch.column(c) for c in ("id", "label", "vector")), pa.array(out, pa.binary())],
                                  ["id", "label", "vector", "windows"])

    return anchors.join(positives.withColumnRenamed("anchor_id", "id"), "id").select("id", "label", "vector", "heap").mapInArrow(
        make, "id long, label long, vector array<double>, windows binary")


def hard_negatives(rows: DataFrame, anchors: DataFrame, scale: float = 256, positives: int = 5, negatives: int = 3,
                   low: int = 50, high: int = 95, block: int = 2048, anchor_block: int = 512) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Both tables have an id, a label and an array of numbers, in this order. Each number x counts as
    floor(scale * x), and a score is the integer inner product with the anchor. An anchor's
    positives are its ``positives`` best other rows of its label. For each of them its
    ``negatives`` best rows of another label follow whose score is between ``low`` and ``high`` percent of
    the positive's, both included. Higher scores come first, ties go to the smaller id.

    Rows with a null id, a null label, a null vector or null or non-finite components take no part, nor do
    vectors so long that a score might not fit in a long (a squared length of 2**62). Vectors of
    different dimensions have no score. A positive whose window is empty has no rows, so nor has
    one with a score below zero. Rows that share an id are candidates each for itself, but an id
    counts once, with its best score, among an anchor's positives and in a window; no row
    with the anchor's own id is its candidate. Of anchors that share an id the one with the
    smallest label, then vector, counts. An empty table gives no rows.
    """
    prepare(rows.sparkSession)
    none = F.lit(b"").alias("windows")
    candidates = packed(usable(rows).select("*", none), block, scale, "candidate_blocks")
    asked = store(usable(anchors).groupBy("id").agg(F.min(F.struct("label", "vector")).alias("own"))
                  .select("id", "own.label", "own.vector"), "anchors")
    found = store(best_positives(packed(asked.select("*", none), anchor_block, scale, "anchor_blocks"), candidates, positives, block), "positives")
    windows = packed(windowed(asked, found, positives, low, high), anchor_block, scale, "window_blocks")
    return (
        best_negatives(windows, candidates, negatives, block)
        .select("anchor_id", "positive_id", "positive_score", F.posexplode("heap").alias("place", "one"))
        .select("anchor_id", "positive_id", (F.col("place") + 1).alias("rank"), F.col("one.id").alias("negative_id"),
                "positive_score", F.col("one.score").alias("negative_score"))
    )
