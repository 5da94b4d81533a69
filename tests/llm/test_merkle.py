"""The Merkle manifest against a plain tree."""

from __future__ import annotations

import hashlib
import random
import string
import zlib

import pytest
from pyspark.sql import functions as F

from terracelake.llm import merkle
from terracelake.llm.merkle import verified_manifest
from terracelake.llm.queries import QUERIES

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def brute_leaf(row):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(leaves):
    """The levels of a tree, from the leaves to the last node."""
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def climb(levels, at, folded, proof):
    for nodes in levels[:-1]:
        run = nodes[at // 16 * 16:at // 16 * 16 + 16]
        proof += run[:at % 16] + run[at % 16 + 1:]
        folded = h(*run[:at % 16], folded, *run[at % 16 + 1:])
        at //= 16
    return folded


def brute(rows):
    """rows: doc_id, source, lang, n_chars, text."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in order:
        groups[source].sort(key=lambda r: (r[0] is not None, r[0] or 0, brute_leaf(r)))
        trees[source] = tree([brute_leaf(r) for r in groups[source]])
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for nth, source in enumerate(order):
        for at, row in enumerate(groups[source]):
            held = row
            if row[0] is not None and row[4] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                held = (*row[:4], row[4].translate(LOWER))
            proof = []
            folded = climb(top, nth, climb(trees[source], at, brute_leaf(held), proof), proof)
            out.append((row[0], brute_leaf(row), trees[source][-1][0], top[-1][0], h(*proof), folded, folded == top[-1][0]))
    return sorted(map(repr, out))


KINDS = "doc_id long, source string, lang string, n_chars long, text string"


def tampered():
    return {"text": F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.translate("text", string.ascii_uppercase, string.ascii_lowercase))
            .otherwise(F.col("text"))}


def ours(docs):
    return sorted(repr(tuple(r)) for r in verified_manifest(docs, tampered()).collect())


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    got = QUERIES["op13_merkle_manifest"](spark, folder).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute(rows)
    assert 0 < sum(not r.verified for r in got) < len(got) / 3


@pytest.mark.parametrize("bits, sources", [(16, (1, 1, 16, 17, 300)), (2, (700, 2)), (3, tuple(1 for _ in range(40)))])
def test_trees(spark, monkeypatch, bits, sources):
    monkeypatch.setattr(merkle, "SPREAD_BITS", bits)
    source = random.Random(bits)
    rows = [(i * 7 + n, None if n == 0 else f"s{n}é", "en", i, f"Text {source.random()} A") for n, size in enumerate(sources) for i in range(size)]
    docs = spark.createDataFrame(rows, KINDS).repartition(5)
    assert ours(docs) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (5, "", "", 0, ""), (5, "a", None, 1, "A-"), (5, "a", None, 1, "A-"), (5, "a", None, 1, "B"), (None, "a", "x", 2, "no id"),
            (10, "B", "en", 3, "É" * 30000), (7, "b", "en", -4, None), (-3, "b", "en", -4, "negative"), (12, "\U0001F600", "de", 1, "emoji"), (13, "￿", "de", 1, "last")]
    docs = spark.createDataFrame(rows, KINDS).withColumns({c: F.lit("own") for c in ("leaf", "held", "tree", "place", "root", "id")})
    assert ours(docs) == brute(rows)
    assert ours(docs.limit(0)) == []
    one = spark.createDataFrame(rows[6:7], KINDS)
    assert ours(one) == brute(rows[6:7])
    few = spark.createDataFrame(rows[2:5], KINDS)
    assert ours(few) == brute(rows[2:5])
    assert spark.conf.get("spark.sql.cteRecursionRowLimit") != "-1"


def test_no_key_of_the_climb_has_too_many_leaves(spark, monkeypatch):
    monkeypatch.setattr(merkle, "SPREAD_BITS", 5)
    kept = {}
    real = merkle.store

    def store(df, name):
        kept[name] = real(df, name)
        return kept[name]
    monkeypatch.setattr(merkle, "store", store)
    docs = spark.createDataFrame([(i, "one", "en", 1, f"t{i}") for i in range(600)], KINDS)
    assert verified_manifest(docs).filter("verified").count() == 600
    runs = kept["spread_runs"].groupBy("tree", "level", "run").count().collect()
    assert max(r["count"] for r in runs) == 19 and len(runs) == 38 + 3 + 1
