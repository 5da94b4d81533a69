"""The n-gram Jaccard join against brute force."""

from __future__ import annotations

import random
import re
import string

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terracelake.llm import ngram_join
from terracelake.llm.bitmaps import bitmap, on_map
from terracelake.llm.ngram_join import Words, can_link, least_required, lead_length, required, similar_documents, tile_links

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def brute_set(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def brute(rows, percent=90):
    """(doc_id, set size, smallest doc_id) of every row; rows: (doc_id, text)."""
    sets = [brute_set(t) for _, t in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i
    holders = {}
    for i, own in enumerate(sets):
        for gram in own:
            holders.setdefault(gram, []).append(i)
    pairs = {(i, j) for held in holders.values() for i in held for j in held if i < j}
    for i, j in pairs:
        shared = len(sets[i] & sets[j])
        if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
            group[root(i)] = root(j)
    smallest = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            smallest[root(i)] = min(doc_id, smallest.get(root(i), doc_id))
    return sorted((repr((d, len(sets[i]), smallest.get(root(i)))) for i, (d, _) in enumerate(rows)))


def ours(docs, **options):
    return sorted(repr(tuple(r)) for r in similar_documents(docs, **options).collect())


def test_table(spark):
    """sf0.01 is held to its SQL."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert ours(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


def groups_of_copies(seed, groups, each, words, most):
    """Texts that drift away from their group's first one, some within 0.9 of others and some just not."""
    source = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"g{g}w{source.randint(0, words)}" for _ in range(words)]
        for _ in range(each):
            own = list(base)
            for _ in range(source.randint(0, most)):
                own[source.randrange(len(own))] = f"x{source.random()}"
            if source.random() < 0.2:
                own += [f"end{source.randint(0, 3)}"] * source.randint(1, 9)
            rows.append((len(rows), " ".join(own)))
    return rows


@pytest.mark.parametrize("block, dense", [(512, 64), (4, 0)])
def test_groups(spark, monkeypatch, block, dense):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "DENSE", dense)
    monkeypatch.setattr(ngram_join, "WIDTH", 16)
    rows = groups_of_copies(block, 6, 30, 70, 4)
    # A passage that half of all rows share.
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(1000 + i, f"{passage} " + " ".join(f"own{i}_{j}" for j in range(20))) for i in range(60)]
    rows += [(1100 + i, f"{passage} tail{i % 4}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert ours(docs) == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"w{i % 1999}" for i in range(60_000))
    nine = "a b c d e f g h i j k"
    rows = [(5, None), (3, ""), (9, " \t\n"), (8, "one"), (2, "ONE"), (7, "two words"), (6, "two\x0bWORDS"), (4, nine), (10, nine + " l"),
            (11, nine + " l m"), (None, nine), (None, "alone and without an id"), (12, long), (13, long + " tail of it"), (12, nine + " other"),
            (14, "É é"), (15, "é é"), (16, "k K K"), (17, "same same same same"), (18, "same same same"), (4, nine)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("own") for c in ("node", "n", "lead", "column", "block", "n_shingles", "component_id")})
    assert ours(docs) == brute(rows)
    assert similar_documents(docs.limit(0)).collect() == []
    assert ours(docs, percent=100) == brute(rows, 100) and ours(docs, percent=60) == brute(rows, 60)
    with pytest.raises(ValueError):
        similar_documents(docs, percent=0)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 14), min_size=1), min_size=2, max_size=9), st.integers(0, 8), st.sampled_from([50, 70, 90]),
       st.sampled_from([0, 4, 10 ** 9]))
def test_tiles(rows, first, percent, dense):
    sets = [np.array(sorted(x), np.uint64) for x in rows]
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ngram_join, "DENSE", dense)
        patch.setattr(ngram_join, "WIDTH", 4)
        check_tiles(rows, sets, first, percent)


def check_tiles(rows, sets, first, percent):
    for at in (None, min(first, len(sets) - 1)):
        links = {(i, j) for i in range(len(rows)) for j in range(len(rows)) if i != j and (at is None or (i < at) != (j < at))
                 and 100 * len(rows[i] & rows[j]) >= percent * len(rows[i] | rows[j])}
        found = tile_links(sets, at, percent)
        assert set(found) <= links and len(found) < len(rows)
        group = {i: i for i in range(len(rows))}
        for i, j in found:
            old, new = group[i], group[j]
            group = {k: new if v == old else v for k, v in group.items()}
        assert all(group[i] == group[j] for i, j in links)


def test_rows_that_link_share_a_lead():
    source = random.Random(5)
    for _ in range(3000):
        union = source.sample(range(10 ** 6), source.randint(10, 120))
        cut = len(union) // 10
        a = sorted(union[:len(union) - source.randint(0, cut)])
        b = sorted(union[source.randint(0, cut):])
        if 100 * len(set(a) & set(b)) >= 90 * len(set(a) | set(b)):
            both = set(a[:lead_length(len(a), 90)]) & set(b[:lead_length(len(b), 90)])
            assert len(both) >= min(required(len(a)), required(len(b))) >= max(least_required(len(a), 90), least_required(len(b), 90))
    assert can_link(9, 90) and not can_link(8, 90)


def test_the_map_has_every_column(spark):
    columns = [-(1 << 63), (1 << 63) - 1, 0, -1, 5, 131071, 131072, 40000, 32767, 32768]
    known = bitmap(spark.createDataFrame([(c,) for c in columns], "column long"), "column", 1 << 17)
    bits = np.flatnonzero(np.unpackbits(known, bitorder="little"))
    assert set(bits.tolist()) == {c % (1 << 17) for c in columns}
    assert on_map(known, np.array([*columns, 6], np.int64)).tolist() == [True] * len(columns) + [False]


def test_common_passages_come_last():
    words = Words({b"often": 50, b"seen": 90, b"rare": 2})
    grams, rarest = words.grams("often seen often rare seen often seen often new", 3)
    assert sorted(rarest.tolist()) == [0, 2, 2, 2, 50, 50] and len(grams) == 6


def test_tiles_of_a_group_that_is_all_alike_are_few(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    counted = {}
    real = ngram_join.store

    def store(df, name):
        out = real(df, name)
        if name in ("first_tiles", "other_tiles"):
            counted[name] = out.count()
        return out
    monkeypatch.setattr(ngram_join, "store", store)
    base = [f"w{i}" for i in range(400)]
    for n in (80, 160, 320):
        rows = [(i, " ".join([*base[:i], f"own{i}", *base[i + 1:]])) for i in range(n)]
        assert len({r.component_id for r in similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}) == 1
        assert counted["first_tiles"] <= n and counted["other_tiles"] <= n / 8
