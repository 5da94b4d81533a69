"""Sharding, nearest neighbours, licences, quality and the pipeline against brute force."""

from __future__ import annotations

import importlib
import re
import string
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terracelake.llm import nearest as nearest_module
from terracelake.llm import quality
from terracelake.llm.common import store
from terracelake.llm.decontaminate import aligned, words_of
from terracelake.llm.licenses import MODIFIERS, NAMES, PHRASES, SHORT, TEMPLATES, scan_licenses
from terracelake.llm.nearest import nearest
from terracelake.llm.quality import judge
from terracelake.llm.queries import ORACLE_SQL, QUERIES
from terracelake.llm.sharding import shard_by_bytes
from tests.llm.test_dedup import brute_components, brute_print
from tests.oracle import connect, difference

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SMALL = "/root/testdata/sf0.001"


def check_shards(docs, shards):
    rows = sorted(shard_by_bytes(docs, shards).collect(), key=lambda r: r.first_byte)
    want = sorted(((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect()), key=repr)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=repr) == want
    total, at, slots = sum(r.size for r in rows), 0, {}
    for r in rows:
        assert r.first_byte == at and r.shard == min(shards - 1, int((at + r.size / 2) * shards / total))
        assert r.slot == slots.get(r.shard, 0)
        slots[r.shard] = r.slot + 1
        at += r.size
    assert [r.shard for r in rows] == sorted(r.shard for r in rows)
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    return rows


def test_shards(spark):
    check_shards(spark.read.parquet(f"{SMALL}/documents.parquet").repartition(5), 40)
    rows = [(3, "abc"), (None, "no id"), (1, None), (2, ""), (2, ""), (7, "é" * 5000), *[(4, "same")] * 50]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("range", "tie", "size", "shard")})
    check_shards(docs, 5)
    assert shard_by_bytes(docs.limit(0)).collect() == []


def brute_nearest(vectors, queries, k):
    sound = [(i, np.array(v, float)) for i, v in vectors if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    asked = [(i, np.array(v, float)) for i, v in queries if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for q, x in asked:
        best = out.setdefault(q, {})
        for i, y in sound:
            if i != q and len(x) == len(y):
                best[i] = min(best.get(i, np.inf), float(np.sqrt(((x - y) ** 2).sum())))
    return {q: sorted((d, i) for i, d in best.items())[:k] for q, best in out.items() if best}


def our_nearest(vectors, queries, k, **options):
    out = {}
    for r in nearest(vectors, queries, k, **options).collect():
        out.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    assert all([r for r, _, _ in sorted(own)] == list(range(1, len(own) + 1)) for own in out.values())
    return {q: [(s, v) for _, s, v in sorted(own)] for q, own in out.items()}


def same_nearest(got, want):
    assert got.keys() == want.keys()
    for q in got:
        assert [v for _, v in got[q]] == [v for _, v in want[q]]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], rtol=1e-12, atol=0)


@pytest.mark.parametrize("block", [7, 2048])
def test_nearest(spark, block):
    random = np.random.default_rng(1)
    rows = [(i, [float(np.float32(x)) for x in random.normal(size=12)]) for i in range(150)]
    rows += [(i, rows[3][1]) for i in range(200, 240)]  # ties
    rows += [(300, None), (301, [0.0] * 12), (302, [1.0] * 11 + [float("nan")]), (303, [1.0] * 11 + [None]), (304, []),
             (305, [float("inf")] + [1.0] * 11), (306, [1.0, 2.0]), (307, [2.0, 1.0]), (None, [1.0] * 12), (5, [0.5] * 12),
             (308, [1e-310, 0.0]), (309, [1e150] * 2)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    queries = vectors.filter("vec_id % 3 = 0")
    same_nearest(our_nearest(vectors, queries, 5, block=block, query_block=block),
                 brute_nearest(rows, [r for r in rows if r[0] is not None and r[0] % 3 == 0], 5))
    assert nearest(vectors.limit(0), queries).collect() == [] and nearest(vectors, queries.limit(0)).collect() == []


def test_nearest_of_the_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r.vec_id, list(r.embedding)) for r in vectors.collect()]
    got = {}
    for r in QUERIES["op8_block_nearest"](spark, "/root/testdata/sf0.01").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    same_nearest({q: [(s, v) for _, s, v in sorted(own)] for q, own in got.items()},
                 brute_nearest(rows, [r for r in rows if r[0] % 100 == 0], 10))


def test_int8_bounds_leave_few_pairs(monkeypatch):
    random = np.random.default_rng(2)
    def block(n):
        x = random.normal(size=(n, 64))
        small, norms = nearest_module.quantised(x)
        return {"n": n, "dim": 64, "ids": np.arange(n).tobytes(), "vectors": x.tobytes(), "small": small.tobytes(), "norms": norms.tobytes()}
    pairs = []
    real = np.nonzero
    monkeypatch.setattr(nearest_module.np, "nonzero", lambda a: (pairs.append(int(a.sum())), real(a))[1])
    best = [[] for _ in range(20)]
    nearest_module.tile_nearest(block(20), block(2000), 10, best)
    assert pairs[0] < 20 * 60 and all(len(b) == 10 for b in best)


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_notices(words, threshold=0.8):
    """label -> largest share of a template's words in a run of words as long as it, or a quarter longer."""
    found = {}
    for label, notice in TEMPLATES:
        own = WORD.findall(notice.translate(LOWER))
        tokens = set(own)
        whole = len(tokens) < SHORT
        need, width = (len(tokens), len(own)) if whole else (int(np.ceil(len(tokens) * threshold)), int(np.ceil(len(own) / threshold)))
        if len(tokens & set(words)) < need:
            continue
        for i in range(len(words)):
            block = set(words[i:i + width])
            if len(tokens & block) >= need and not (tokens & set(NAMES)) - block and not block & (set(MODIFIERS) - tokens):
                found[label] = max(found.get(label, 0), len(tokens & block) / len(tokens))
    return found


def brute_licenses(text, threshold=0.8):
    words = WORD.findall((text or "").translate(LOWER))
    places = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words))
              if words[i:i + len(phrase.split())] == phrase.split()]
    base = sorted({label for _, label in places})
    found = brute_notices(words, threshold)
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(sorted({*base, *found})),
            1.0 if places else max(found.values(), default=0.0))


def our_licenses(docs):
    return sorted((repr(tuple(r)) for r in scan_licenses(docs).collect()))


def test_licenses(spark):
    texts = ["MIT License, mit LICENSE! Apache\nlicense", None, "", " \n ", "Licensed under CC BY-NC 4.0.", "the mit licenses", "mIt licenSe",
             "x" * 5000 + " General Public  License", "GNU general public license 3 general public license", "K\u212a\u0130 mit license\u212a é½ 漢字", "THIS WORK IS LICENSED UNDER THE GNU GENERAL PUBLIC LICENSE VERSION 3", "UNLIKELY Kin",
             "Released under the MIT", "free of charge, permission is hereby granted to any person obtaining a copy",
             "This program is free software you can redistribute it and or modify it under the terms of the gnu public license",
             "words and more words\n" * 500 + "Released under the MIT License.\nthe end"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (3, texts[4]), (3, texts[4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("words", "token", "labels", "share")})
    assert our_licenses(docs) == sorted(repr((i, *brute_licenses(t))) for i, t in rows)
    assert scan_licenses(docs.limit(0)).collect() == []


def test_labels_of_the_table_are_its_notices(spark):
    """The table's notices are four sentences; each gives one label."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    notices = {"Licensed under the Apache License, Version 2.0": "apache", "Released under the MIT License": "mit",
               "GNU General Public License, version 3": "gpl", "Licensed under CC BY-NC 4.0": "cc-by-nc"}
    want = {r.doc_id: ",".join(sorted({label for notice, label in notices.items() if notice in r.text})) for r in docs.collect()}
    got = {r.doc_id: r.labels for r in scan_licenses(docs).collect()}
    assert got == want and sum(map(bool, got.values())) >= 39


def test_a_long_line(spark):
    clause = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met "
    rows = [(1, clause * 5000), (2, "mit license " * 20_000), (3, "plain words " * 50_000 + clause), (4, "gnu " * 100_000)]
    start = time.time()
    got = {r.doc_id: (r.n_words, r.labels, r.score) for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == {1: (105_000, "bsd", 1.0), 2: (40_000, "mit", 1.0), 3: (100_021, "bsd", 1.0), 4: (100_000, "", 0.0)}
    assert time.time() - start < 60


def test_licenses_of_the_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert our_licenses(docs) == sorted(repr((r.doc_id, *brute_licenses(r.text))) for r in docs.collect())


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_quality_on_held_out_labels(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    taught = labels.filter(F.xxhash64("doc_id") % 2 == 0)
    judged = judge(docs, taught)
    assert judged.count() == docs.count() and set(docs.columns) <= set(judged.columns)
    rows = judged.join(labels.filter(F.xxhash64("doc_id") % 2 != 0).select("doc_id", "quality", F.col("toxic").alias("is_toxic")), "doc_id").collect()
    clean = [r.keep for r in rows if r.quality == 1 and r.is_toxic == 0]
    low = [r.keep for r in rows if r.quality == 0]
    assert np.mean(clean) > 0.97 and np.mean(low) < 0.15 and len(low) > 10


def site_docs(spark):
    good, bad = "calm words about gardens and rivers", "stupid idiot trash words about gardens"
    rows = [(i, f"{good} number{i}", "a", "en") for i in range(60)] + [(i, f"{bad} number{i}", "b", "en") for i in range(60, 120)]
    rows += [(200, None, None, None), (201, "", "c", "en"), (None, good, "a", None), (202, bad, "new", "en"), (202, bad, "new", "en"), (203, "gardens " * 30000, "a", "en")]
    labels = [(i, 1, int(i >= 60)) for i in range(0, 120, 2)] + [(None, 0, 0), (3, None, None), (5, None, 0), (5, 1, None), (60, 1, 0)]
    return (spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("toxic", F.lit("own")),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_quality_of_sites(spark):
    docs, labels = site_docs(spark)
    rows = judge(docs, labels).collect()
    keep = {r.doc_id: r.keep for r in rows}
    assert len(rows) == docs.count() and all(keep[i] for i in range(60)) and not any(keep[i] for i in range(60, 120))
    assert not keep[202] and keep[None]
    assert all(r.keep for r in judge(docs, labels.limit(0)).collect())
    assert judge(docs.limit(0), labels).collect() == []
    assert judge(docs.limit(0), labels.limit(0)).collect() == []


def test_rates_shrink_to_their_parents(spark):
    """One bad document of one at a new site moves its rate less than many do at a known one."""
    groups = spark.createDataFrame([("many", 1000, 900.0), ("few", 1, 0.9), ("other", 1000, 10.0), ("also", 1000, 20.0)], "site string, n long, toxic double")
    rates = {r.site: r.toxic_rate for r in quality.shrunk(groups, "toxic", F.lit(0.31)).collect()}
    assert rates["many"] > 0.89 and 0.31 < rates["few"] < 0.8 and rates["other"] < 0.02
    even = spark.createDataFrame([("a", 100, 31.0), ("b", 100, 31.0)], "site string, n long, toxic double")
    assert {round(r.toxic_rate, 6) for r in quality.shrunk(even, "toxic", F.lit(0.31)).collect()} == {0.31}


@pytest.mark.parametrize("key", ORACLE_SQL)
def test_query_equals_sql(spark, key):
    wrong, rows = difference(spark, connect("/root/testdata/sf0.01"), QUERIES[key], ORACLE_SQL[key], "/root/testdata/sf0.01")
    assert wrong is None and rows > 0


def brute_stage(name, rows, bench):
    """doc_id -> text that a stage should leave, from what it was given."""
    if name == "line_dedup":
        held = {}
        keys = {i: [x.strip(" \t\n\v\f\r").translate(LOWER) for x in t.split("\n")] for i, t in rows.items()}
        for i, own in keys.items():
            for key in own:
                held[key] = min(i, held.get(key, i))
        return {i: "\n".join(x for x, key in zip(t.split("\n"), keys[i]) if len(key) < 10 or held[key] == i) for i, t in rows.items()}
    if name == "simhash_near_dedup":
        prints = {i: brute_print(t) for i, t in rows.items()}
        truth = brute_components(set(prints.values()))
        smallest = {}
        for i in sorted(rows, reverse=True):
            smallest[truth[prints[i]]] = i
        return {i: rows[i] for i in smallest.values()}
    holds = set()
    for i, text in rows.items():
        vocabulary = {}
        number = lambda words: np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], dtype=np.int64)
        ids = number(words_of(text))
        for item in bench:
            words = number(words_of(item))
            if len(words) and aligned(words, ids)[0] <= int(0.2 * len(words) + 1e-9):
                holds.add(i)
                break
    return {i: t for i, t in rows.items() if i not in holds}


def test_pipeline(spark):
    """Each stage against brute force on what it was given; the first is held to its labels elsewhere."""
    pipeline = importlib.import_module("corpus_pipeline")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    bench = [r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    columns = docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        given = {r.doc_id: r.text for r in docs.collect()}
        docs = store(stage(spark, docs, SMALL), name)
        left = {r.doc_id: r.text for r in docs.collect()}
        assert docs.columns == columns and docs.count() == len(left)
        assert docs.filter("n_chars <> length(text)").isEmpty()
        if name == "quality_classifier":
            assert left.items() <= given.items() and 0.5 * len(given) < len(left) < len(given)
        else:
            assert left == brute_stage(name, given, bench), name
    last = pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r.doc_id for r in last} == {r.doc_id for r in docs.collect()}
    whole = pipeline.run(spark, SMALL).collect()
    assert sorted((r.doc_id, r.piece, r.ids_crc32) for r in whole) == sorted((r.doc_id, r.piece, r.ids_crc32) for r in last)
    empty = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        assert stage(spark, empty, SMALL).collect() == []
