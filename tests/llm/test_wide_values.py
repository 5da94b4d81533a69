"""Vectors whose squares do not fit in doubles."""

from __future__ import annotations

import math

import pytest

from terracelake.llm.nearest import nearest


def test_vectors_whose_squares_overflow(spark):
    rows = [(i, [1e160 * i, 1e160]) for i in range(1, 7)] + [(7, [1.0, 2.0])]
    vectors = spark.createDataFrame(rows, "id long, vector array<double>")
    got = {}
    for r in nearest(vectors, vectors, 3, block=2, query_block=2).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for i, x in rows:
        want = sorted((math.dist(x, y), j) for j, y in rows if j != i)[:3]
        own = sorted(got[i])
        assert [j for _, j, _ in own] == [j for _, j in want]
        assert [d for _, _, d in own] == pytest.approx([d for d, _ in want], rel=1e-9)
