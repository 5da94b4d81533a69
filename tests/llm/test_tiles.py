"""Tiles that are never rows, and heaps against sorted lists."""

from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql.readwriter import DataFrameWriter

from tests.llm.test_hard_negatives import brute, vectors
from tests.llm.test_search import brute_nearest, our_nearest, same_nearest
from terracelake.llm import nearest as nearest_module
from terracelake.llm import tiles
from terracelake.llm.hard_negatives import hard_negatives, scores
from terracelake.llm.tiles import Heaps, by_dimension, places


@settings(max_examples=80, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(-3, 3), st.integers(0, 9)), max_size=60), st.integers(1, 5), st.integers(1, 20),
       st.sampled_from([np.int64, np.float64]))
def test_heaps(rows, k, step, kind):
    heaps = Heaps(4, k, kind)
    for a in range(0, len(rows), step):
        some = rows[a:a + step]
        heaps.add(np.array([s for s, _, _ in some]), np.array([v for _, v, _ in some], kind), np.array([i for _, _, i in some]))
        heaps.settle()
    want = []
    for slot in range(4):
        least = {}
        for s, v, i in rows:
            if s == slot:
                least[i] = min(v, least.get(i, v))
        want.append(sorted((v, i) for i, v in least.items())[:k])
    sizes, values, ids = heaps.entries()
    assert sizes.tolist() == [len(w) for w in want]
    assert list(zip(values.tolist(), ids.tolist())) == [e for w in want for e in w]


def test_blocks_of_a_dimension():
    source = np.random.default_rng(1)
    rows = [(i, source.normal(size=n)) for i, n in enumerate(source.choice([0, 2, 3], 100).tolist())]
    some = [rows[:40], [], rows[40:95], rows[95:]]
    batches = [(np.concatenate([v for _, v in b] + [np.zeros(0)]), np.array([len(v) for _, v in b], np.int64), [np.array([i for i, _ in b], np.int64)])
               for b in some]
    made = list(by_dimension(iter(batches), 8))
    assert sorted(i for _, (_, ids) in made for i in ids.tolist()) == list(range(100))
    assert all((x[j] == rows[i][1]).all() and x.shape[1] == dim for dim, (x, ids) in made for j, i in enumerate(ids.tolist()))
    for dim in (0, 2, 3):
        sizes = [len(ids) for d, (_, ids) in made if d == dim]
        assert all(n == 8 for n in sizes[:-1]) and 0 < sizes[-1] <= 8


@pytest.fixture
def plans(monkeypatch):
    """What is stored, by name: its plan."""
    seen, real = {}, DataFrameWriter.parquet

    def parquet(self, path, *more, **options):
        seen[path.rpartition("/")[2]] = self._df._jdf.queryExecution().optimizedPlan().toString()
        return real(self, path, *more, **options)
    monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
    return seen


def test_nearest_in_groups_makes_no_rows_of_tiles(spark, plans, monkeypatch):
    """A tile that is a row of a join has both blocks in it: 6 GB of vectors made some 3 TB of them to sort."""
    monkeypatch.setattr(tiles, "HELD", 100)
    source = np.random.default_rng(3)
    rows = [(i, source.normal(size=4).tolist()) for i in range(300)] + [(i, [0.5] * 3) for i in range(300, 330)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    same_nearest(our_nearest(vectors, vectors.filter("vec_id % 4 = 0"), 6, block=16, query_block=8),
                 brute_nearest(rows, [r for r in rows if r[0] % 4 == 0], 6))
    assert "MapInArrow" in plans["tiles"] and "Join" not in plans["tiles"]


def test_negatives_in_groups_make_no_rows_of_tiles(spark, plans, monkeypatch):
    monkeypatch.setattr(tiles, "HELD", 200)
    rows = vectors(5, 200, 9) + [(i, i % 3, [3e5 * (i - 208)] * 3) for i in range(200, 216)]
    rows += [(i + 300, label, v) for i, label, v in rows[:60]]  # copies
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(5)
    got = hard_negatives(table, table.filter("vec_id % 4 = 0"), block=16, anchor_block=8)
    assert sorted(map(tuple, got.collect())) == brute(rows, [r for r in rows if r[0] % 4 == 0])
    for name in ("positive_heaps", "negative_heaps"):
        assert "MapInArrow" in plans[name] and "Join" not in plans[name]


@pytest.mark.parametrize("most", [1, 50, 104, 105, 150, 211, 600, 1 << 18, 1 << 22, 1 << 23, 1 << 24, 1 << 27])
@pytest.mark.parametrize("leaf", [4, 8, 32, 64])
def test_scores_are_exact_in_every_type(most, leaf):
    """All numbers as large as they can be, so sums are too; the types change within these sizes."""
    source = np.random.default_rng(most)
    a, b = (source.choice([-most, most], size) for size in ((64, 64), (64, 64)))
    a[:32], b[:, :32] = most, most
    got = scores(a, b, float(most) ** 2, leaf)
    assert [int(x) for x in got.ravel()] == [int(x) for x in (a.astype(object) @ b.astype(object)).ravel()]
    assert got.dtype == (np.float32 if most <= 50 else got.dtype)


@settings(max_examples=50, deadline=None)
@given(st.integers(0, 9), st.integers(1, 30), st.sampled_from([0.0, 0.01, 0.5, 1.0]), st.integers(0, 99))
def test_places(m, n, share, seed):
    near = np.random.default_rng(seed).random((m, n)) < share
    assert [p.tolist() for p in places(near)] == [p.tolist() for p in np.nonzero(near)]


@pytest.mark.parametrize("least, most", [(-162, -140), (-40, -30), (-5, 5), (-150, 150), (16, 22), (100, 153)])
def test_bounds_hold_for_all_sizes(least, most):
    source = np.random.default_rng(most - least)
    dim, k = 3, 4

    def block(n, at):
        x = source.normal(size=(n, dim)) * 10 ** source.uniform(least, most, size=(n, 1))
        small, norms = nearest_module.quantised(x)
        return x, {"n": n, "dim": dim, "ids": np.arange(at, at + n).tobytes(), "vectors": x.tobytes(), "small": small.tobytes(), "norms": norms.tobytes()}
    q, queries = block(30, 1000)
    best, seen = [[] for _ in q], np.zeros((0, dim))
    for at in (0, 60):
        v, vectors = block(60, at)
        seen = np.concatenate([seen, v])
        nearest_module.tile_nearest(queries, vectors, k, best)
    for x, own in zip(q, best):
        want = sorted((math.dist(x, y), i) for i, y in enumerate(seen))[:k]
        assert np.allclose([d for d, _ in own], [d for d, _ in want], rtol=1e-9, atol=1e-150)
