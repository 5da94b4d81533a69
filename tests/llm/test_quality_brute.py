"""The classifier's evidence, rates and decisions against plain Python."""

from __future__ import annotations

import math
import string
import zlib

import pytest

from terracelake.llm import quality
from terracelake.llm.quality import HEADS, MASK, STEPS, judge, train


def plain_features(text):
    octets = text.encode()
    words = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in octets.split()]
    out = set()
    for word in words:
        core = word.strip(string.punctuation.encode())
        if core:
            out.add(zlib.crc32(core) & MASK)
        if len(core) > 5:
            out.add(zlib.crc32(b"^" + core[:5]) & MASK)
    letters = sum(chr(c) in string.ascii_letters for c in octets)
    lines = octets.split(b"\n")
    shape = (sum(chr(c) in string.ascii_uppercase for c in octets) / max(1, letters),
             sum(chr(c) in string.punctuation and chr(c) not in ".," for c in octets) / max(1, len(octets)),
             len(set(words)) / max(1, len(words)), len(set(lines)) / len(lines), len(octets) / max(1, len(words)), len(lines) / max(1, len(words)))
    at = MASK + 1
    for value, steps in zip(shape, STEPS):
        for step in steps:
            if value > step:
                out.add(at)
            at += 1
    return out


def logistic(x):
    return 1 / (1 + math.exp(-x))


def logit(p):
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def shrunk(groups, prior):
    """groups: key -> [n, sum]; prior: key -> share of the parent. Rates by the method of moments."""
    total = sum(n for n, _ in groups.values())
    spare = total - sum(n * n for n, _ in groups.values()) / total
    strength = 1e6
    if len(groups) > 1 and spare > 0:
        q = sum(n * (s / n - prior[g]) ** 2 for g, (n, s) in groups.items())
        between = (q - sum(prior[g] * (1 - prior[g]) for g in groups)) / spare
        if between > 0:
            within = sum(n * prior[g] * (1 - prior[g]) for g, (n, _) in groups.items()) / total
            strength = min(1e6, max(1.0, within / between - 1))
    return {g: (s + strength * prior[g]) / (n + strength) for g, (n, s) in groups.items()}


def plain_judge(rows, heads):
    """rows: doc_id, text, source, lang. Returns (doc_id, toxic, low, keep)."""
    evidence = {h: [heads[h].offset + sum(heads[h].weights.get(f, 0.0) for f in plain_features(t or "")) for _, t, _, _ in rows] for h in HEADS}
    posterior = {}
    for h in HEADS:
        prior = min(max(heads[h].prior, 1e-6), 1 - 1e-6)
        own = [logistic(e + math.log(prior / (1 - prior))) for e in evidence[h]]
        sections, sites = {}, {}
        for p, (_, _, source, lang) in zip(own, rows):
            for groups, key in ((sections, (source or "", lang or "")), (sites, source or "")):
                groups.setdefault(key, [0, 0.0])
                groups[key][0] += 1
                groups[key][1] += p
        everywhere = sum(own) / len(own)
        site_rate = shrunk(sites, dict.fromkeys(sites, everywhere))
        rate = shrunk(sections, {g: site_rate[g[0]] for g in sections})
        posterior[h] = [logistic(e + logit(rate[s or "", x or ""])) if heads[h].weights else 0.0 for e, (_, _, s, x) in zip(evidence[h], rows)]
    return [(r[0], a, b, a <= 0.5 and b <= 0.5) for r, a, b in zip(rows, posterior["toxic"], posterior["low"])]


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_decisions(spark, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = [(r.doc_id, r.text, r.source, r.lang) for r in docs.collect()]
    want = sorted(plain_judge(rows, train(docs, labels)))
    got = sorted((r.doc_id, r.toxic, r.low, r.keep) for r in judge(docs, labels).collect())
    assert [(g[0], g[3]) for g in got] == [(w[0], w[3]) for w in want]
    for g, w in zip(got, want):
        assert g[1] == pytest.approx(w[1], rel=1e-6, abs=1e-9) and g[2] == pytest.approx(w[2], rel=1e-6, abs=1e-9)


def test_weights_are_the_best_of_selected_features(spark):
    """At the fitted weights the penalised likelihood has no slope, and the features are those that tell most."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    kinds = {}
    for r in labels.collect():
        bad = "toxic" if (r.toxic or 0) > 0 else "low" if r.quality is not None and r.quality < 1 else "clean"
        kinds[r.doc_id] = bad
    own = {r.doc_id: plain_features(r.text or "") for r in docs.collect() if r.doc_id in kinds}
    for name, head in train(docs, labels).items():
        used = [(f, kinds[i] == name) for i, f in own.items() if kinds[i] in (name, "clean")]
        n, p = len(used), sum(bad for _, bad in used)
        held, bads = {}, {}
        for f, bad in used:
            for x in f:
                held[x] = held.get(x, 0) + 1
                bads[x] = bads.get(x, 0) + bad

        def h(x):
            return x * math.log(x) if x > 0 else 0.0
        g = {x: 2 * (h(bads[x]) + h(t - bads[x]) + h(p - bads[x]) + h(n - p - t + bads[x]) - h(t) - h(n - t) - h(p) - h(n - p) + h(n))
             for x, t in held.items()}
        best = sorted((x for x in g if g[x] > quality.LEAST_G + 1e-6), key=lambda x: (-g[x], x))[:quality.SELECTED]
        assert set(best[:100]) <= set(head.weights) and len(head.weights) <= quality.SELECTED
        start = head.offset + math.log(p / (n - p))
        slope = {x: -quality.RIDGE * w for x, w in head.weights.items()}
        for f, bad in used:
            miss = bad - logistic(start + sum(head.weights.get(x, 0.0) for x in f))
            for x in f & head.weights.keys():
                slope[x] += miss
        assert max(map(abs, slope.values())) < 0.02


def test_only_selected_features_come_to_the_driver(spark, monkeypatch):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    taken = []
    real = type(docs).toArrow
    monkeypatch.setattr(type(docs), "toArrow", lambda self: (taken.append(real(self)), taken[-1])[1])
    train(docs, labels)
    assert all(max(map(len, t.column("features").to_pylist()), default=0) <= quality.SELECTED for t in taken if "features" in t.column_names)
