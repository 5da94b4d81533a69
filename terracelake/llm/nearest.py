"""Exact nearest neighbours by a block matrix join over int8 tiles.

Vectors are packed into blocks. A task also keeps each as int8 numbers times a scale, with the norm
of what that loses. The product of two int8 blocks gives all distances of a tile to within
a bound that follows from those norms (Cauchy-Schwarz), so a pair whose lower bound is over
the k-th smallest distance or upper bound can't be among the nearest. The few pairs that are left are
recomputed from the original vectors in double precision.
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

BLOCK = "dim int, block long, n int, ids binary, vectors binary"
# Pairs recomputed at a time, in components.
EXACT = 1 << 22
# Up to here products and sums of bounds stay finite in single precision.
LARGE = 1e18


def usable(vectors: DataFrame) -> DataFrame:
    """id, vector (of doubles): only vectors of finite numbers that aren't all zero."""
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        vectors.toDF("id", "vector").select(F.col("id").cast("long").alias("id"), F.col("vector").cast("array<double>").alias("vector"))
        .filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & sound & F.exists("vector", lambda x: x != 0))
    )


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """int8 numbers, and per vector: scale, norm, norm of the int8 vector, norm of what it loses."""
    scale = np.abs(x).max(axis=1) / 127
    scale[scale == 0] = 1  # too small to divide
    small = np.rint(x / scale[:, None]).astype(np.int8)
    about = small * scale[:, None]
    norms = np.stack([scale, *(np.sqrt((v * v).sum(axis=1)) for v in (x, about, x - about))])
    return small, norms


def packed(vectors: DataFrame, rows: int, name: str) -> DataFrame:
    """Blocks of up to ``rows`` vectors of the same dimension, stored; in single precision if that holds them exactly."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        columns = ((*lists(b.column("vector")), [b.column("id").to_numpy()]) for b in batches)
        for made, (dim, (x, ids)) in enumerate(by_dimension(columns, rows)):
            with np.errstate(over="ignore", under="ignore"):
                short = x.astype(np.float32)
            values = [dim, (part << 32) + made, len(ids), ids.tobytes(), (short if (short == x).all() else x).tobytes()]
            kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 2]
            yield pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)], ["dim", "block", "n", "ids", "vectors"])

    return store(vectors.mapInArrow(pack, BLOCK), name, **STORED)


class Side(NamedTuple):
    """A tile's vectors of a dimension. wide: their int8 numbers, and four columns more; norms: see ``quantised``."""

    ids: np.ndarray
    vectors: np.ndarray
    wide: np.ndarray
    norms: np.ndarray


def rounding(dim: int) -> float:
    """What single precision may cost a row of ``wide`` times another, at most, as a share of the squared norms."""
    return 8 * (dim + 8) / 2 ** 24


def widened(small: np.ndarray, norms: np.ndarray, asks: bool) -> np.ndarray:
    """The int8 numbers with columns for the bound.

    The lower bound of a squared distance is |q|^2 + |v|^2 - 2 qv - 2 (lost_q |v| + about_q lost_v), and qv is the product
    times both scales. How far the product is over the smallest that a pair at most so distant can have is
    then a product of four columns more. ``tile`` fills in the first of a query, which has that distance.
    """
    scale, norm, about, lost = norms
    with np.errstate(all="ignore"):
        if asks:
            more = [np.zeros_like(scale), (rounding(small.shape[1]) - 1) / (2 * scale), lost / scale, about / scale]
        else:
            more = [1 / scale, norm ** 2 / scale, norm / scale, lost / scale]
    columns = np.stack(more, axis=1)
    return np.concatenate([small, columns], axis=1, dtype=np.float32 if np.abs(columns).max(initial=0) < LARGE else np.float64, casting="unsafe")


def side(blocks: list[dict], asks: bool = False) -> Side:
    parts = []
    for b in blocks:
        n, dim = b["n"], b["dim"]
        x = np.frombuffer(b["vectors"], np.float32 if len(b["vectors"]) == 4 * n * dim else np.float64).reshape(n, dim)
        small, norms = quantised(x.astype(np.float64))
        parts.append((np.frombuffer(b["ids"], np.int64), x, widened(small, norms, asks), norms))
    if len(parts) == 1:
        return Side(*parts[0])
    return Side(*(np.concatenate(c, axis=axis) for c, axis in zip(zip(*parts), (0, 0, 0, 1))))


def tile(q: Side, v: Side, k: int, heaps: Heaps, room: np.ndarray | None = None) -> None:
    """Adds what a tile has to the nearest found so far, a heap of (distance, id) per query. Single-precision
    products go to ``room`` if they fit: asking the system for so much memory takes as long as half a product."""
    (q_scale, q_norm, q_about, q_lost), (v_scale, v_norm, _, v_lost) = q.norms, v.norms
    dim = q.vectors.shape[1]
    with np.errstate(all="ignore"):  # squares of components above about 1e154 overflow: such bounds say nothing
        most = heaps.values[:, -1] ** 2 * (1 + 1e-9)
        unknown = np.flatnonzero(np.isinf(most))
        # Rows that share an id are one candidate, so only distinct ids make a k-th.
        if len(unknown) and len(v.ids) > k and len(np.unique(v.ids)) == len(v.ids):
            product = (q.wide[unknown, :dim] @ v.wide[:, :dim].T).astype(np.float64)
            high = q_norm[unknown, None] ** 2 + v_norm ** 2 - 2 * product * q_scale[unknown, None] * v_scale
            high += 2 * (q_lost[unknown, None] * v_norm + q_about[unknown, None] * v_lost)
            high += rounding(dim) * (q_norm[unknown, None] + v_norm) ** 2
            high[~np.isfinite(high) | (q.ids[unknown, None] == v.ids)] = np.inf
            most[unknown] = np.partition(high, k - 1, axis=1)[:, k - 1]
        all_near = np.isinf(most)
        most[all_near] = 0
        share = rounding(dim)
        column = (most * (1 + share) + 1e-290 - q_norm ** 2 * (1 - share)) / (2 * q_scale)
        wide = q.wide if np.abs(column).max() < LARGE else q.wide.astype(np.float64)
        wide[:, dim] = column
        pairs, single = len(q.ids) * len(v.ids), wide.dtype == v.wide.dtype == np.float32
        fits = room is not None and single and pairs <= len(room)
        over = np.matmul(wide, v.wide.T, out=room[:pairs].reshape(len(q.ids), -1) if fits else None)
    if over.dtype == np.float64:
        over[~np.isfinite(over)] = np.inf
    near = over >= 0
    near[all_near] = True
    rows, columns = places(near)
    other = q.ids[rows] != v.ids[columns]
    rows, columns = rows[other], columns[other]
    step = max(1, EXACT // dim)
    for at in range(0, len(rows), step):
        r, c = rows[at:at + step], columns[at:at + step]
        apart = q.vectors[r].astype(np.float64) - v.vectors[c]
        with np.errstate(over="ignore"):
            exact = np.sqrt((apart ** 2).sum(axis=1))
        if len(large := np.flatnonzero(np.isinf(exact))):
            apart = np.abs(apart[large])
            longest = apart.max(axis=1)
            exact[large] = longest * np.sqrt(((apart / longest[:, None]) ** 2).sum(axis=1))
        heaps.add(r, exact, v.ids[c])


def tile_nearest(queries: dict, vectors: dict, k: int, best: list[list[tuple[float, int]]]) -> None:
    """The same for blocks with their int8 numbers and norms, and one list of (distance, id) per query."""
    def unpacked(b: dict, asks: bool) -> Side:
        n, dim = b["n"], b["dim"]
        norms = np.frombuffer(b["norms"]).reshape(4, n)
        return Side(np.frombuffer(b["ids"], np.int64), np.frombuffer(b["vectors"]).reshape(n, dim),
                    widened(np.frombuffer(b["small"], np.int8).reshape(n, dim), norms, asks), norms)

    heaps = Heaps(len(best), k, np.float64)
    for i, own in enumerate(best):
        if own:
            heaps.add(np.full(len(own), i), np.array([d for d, _ in own]), np.array([j for _, j in own], np.int64))
    heaps.settle()
    tile(unpacked(queries, True), unpacked(vectors, False), k, heaps)
    sizes, values, ids = heaps.entries()
    found = list(zip(values.tolist(), ids.tolist()))
    for i, (end, n) in enumerate(zip(np.cumsum(sizes).tolist(), sizes.tolist())):
        best[i] = found[end - n:end]


FOUND = "query_id long, near array<struct<score: double, vec_id: bigint>>"


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, block: int = 2048, query_block: int = 512) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k vectors nearest to each query by Euclidean distance.

    Both tables have an id and an array of numbers, in this order. Candidates are all vectors but
    those with the query's own id; ties go to the smaller id.

    Each pair of a query block and a vector block is a tile. Vector blocks are dealt into groups that a
    task can hold, and query blocks go to every group; a task has the nearest of one query block at a time.
    The tasks' lists are then merged per query.

    Rows with a null id, and vectors that are null, zero, or hold null or non-finite components,
    take no part. Vectors of different dimensions aren't compared. Rows that share an id are one
    vector, whose nearest row counts. A query with fewer candidates has fewer rows; an empty
    table gives none.
    """
    prepare(vectors.sparkSession)
    own = packed(usable(vectors), block, "vector_blocks")
    # Few queries lie in each input split; gathered, they fill their blocks.
    asked = packed(usable(queries).hint("rebalance"), query_block, "query_blocks")

    def answer(row: dict, sides: list[Side]) -> pa.RecordBatch:
        q = side([row], asks=True)
        heaps = Heaps(len(q.ids), k, np.float64)
        room = np.empty(len(q.ids) * max(len(v.ids) for v in sides), np.float32)
        for v in sides:
            tile(q, v, k, heaps, room)
        sizes, score, vec_id = heaps.entries()
        return pa.record_batch([pa.array(q.ids), structs(sizes, score=score, vec_id=vec_id)], ["query_id", "near"])

    found = tiled(own, asked, lambda blocks: [side(blocks)], answer, FOUND, "tiles", block)

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, score, vec_id, _ = smallest(*lists_of_structs(batch.column("lists")), k)
            near = structs(np.bincount(row, minlength=batch.num_rows), score=score, vec_id=vec_id)
            yield pa.record_batch([batch.column("query_id"), near], ["query_id", "near"])

    return (
        found.groupBy("query_id").agg(F.collect_list("near").alias("lists")).mapInArrow(merged, FOUND)
        .select("query_id", F.posexplode("near").alias("place", "one"))
        .select("query_id", (F.col("place") + 1).alias("rank"), "one.vec_id", "one.score")
    )
