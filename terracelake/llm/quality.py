"""Keeps documents of good quality, by hierarchical empirical Bayes.

A linear classifier turns each text into evidence: log likelihood ratios of being toxic and of
being low-grade. How much evidence it takes depends on where a document comes from. The
share of bad documents is estimated for every site (host) and section (path) by grouped sums
of the documents' own probabilities; a site with few documents is shrunk towards the global
share and a section towards its site, each by as much as the spread between them warrants.
"""

from __future__ import annotations

import math
import string
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from terracelake.llm.common import prepare, store, text_of

# At most so many labelled documents of each kind are fitted to.
SAMPLE = {"toxic": 3000, "low": 3000, "clean": 9000}
HEADS = ("toxic", "low")

BITS = 18  # features are numbered by hash
MASK = (1 << BITS) - 1
PREFIX = 5  # letters of a word that are a feature of their own
SELECTED = 768  # features a head may use
LEAST_G = 12.0  # G statistic from which a feature tells anything
RIDGE = 0.1
REMEMBERED = 150_000

PUNCTUATION = string.punctuation.encode()
UPPER, LETTERS = string.ascii_uppercase.encode(), string.ascii_letters.encode()
SYMBOLS = bytes(set(PUNCTUATION) - set(b".,"))

# What a text looks like is told by which of these its shape goes over, in the order of shape().
STEPS = (
    (.03, .06, .1, .2, .4, .7), (.005, .02, .04, .07, .12, .2), (.05, .1, .2, .3, .4, .5, .6),
    (.2, .4, .6, .7, .8, .9), (4, 5, 5.5, 6.5, 7, 8, 9), (.005, .05, .1, .15, .2),
)
FEATURES = MASK + 1 + sum(map(len, STEPS))


def shape(text: bytes, words: list[bytes], distinct: int) -> tuple[float, ...]:
    """Shares of capitals and symbols, of distinct words and lines, bytes per word, lines per word."""
    letters = (len(text) - len(text.translate(None, LETTERS))) or 1
    lines = text.split(b"\n")
    n = len(words) or 1
    return ((len(text) - len(text.translate(None, UPPER))) / letters,
            (len(text) - len(text.translate(None, SYMBOLS))) / (len(text) or 1),
            distinct / n, len(set(lines)) / len(lines), len(text) / n, len(lines) / n)


class WordFeatures(dict):
    """Word (lower case, with punctuation) -> its features, or only those that are wanted."""

    def __init__(self, wanted: frozenset[int] | None = None):
        super().__init__()
        self.wanted = wanted

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= REMEMBERED:
            self.clear()
        core = word.strip(PUNCTUATION)
        found = (zlib.crc32(core) & MASK,) if core else ()
        if len(core) > PREFIX:
            found += (zlib.crc32(b"^" + core[:PREFIX]) & MASK,)
        if self.wanted is not None:
            found = tuple(f for f in found if f in self.wanted)
        if len(word) <= 64:
            self[word] = found
        return found


def features(text: str, word_features: WordFeatures) -> set[int]:
    """Which features a text has: its words, the beginnings of longer words, and its shape."""
    octets = text.encode()
    words = octets.lower().split()
    distinct = set(words)
    out = set().union(*map(word_features.__getitem__, distinct))
    at = MASK + 1
    for value, steps in zip(shape(octets, words, len(distinct)), STEPS):
        out.update(at + i for i, step in enumerate(steps) if value > step)
        at += len(steps)
    return out


@dataclass
class Head:
    """Weights of the selected features, such that their sum is a log likelihood ratio."""

    weights: dict[int, float]
    offset: float
    prior: float  # share of all labelled documents

    def evidence(self, own: set[int]) -> float:
        return self.offset + sum(self.weights[f] for f in own if f in self.weights)


def selected(a: np.ndarray, t: np.ndarray, p: float, n: float) -> np.ndarray:
    """The features with the highest G statistic, in ascending order. a, t: texts of the p bad and of all n that have each."""

    def h(x):
        return np.where(x > 0, x * np.log(np.maximum(x, 1e-12)), 0)
    g = 2 * (h(a) + h(t - a) + h(p - a) + h(n - p - t + a) - h(t) - h(n - t) - h(p) - h(n - p) + h(float(n)))
    chosen = np.argsort(-g, kind="stable")[:SELECTED]
    return np.sort(chosen[g[chosen] > LEAST_G])


def fit(rows: Sequence[np.ndarray], bad: np.ndarray, chosen: np.ndarray, prior: float) -> Head:
    """Logistic regression by Newton's method on the ``chosen`` features. ``rows``: these features of each text."""
    n, p = len(bad), float(bad.sum())
    if p == 0 or p == n:
        return Head({}, 0.0, prior)
    columns = np.concatenate(rows)
    at = np.repeat(np.arange(n), [len(r) for r in rows])
    place = np.full(FEATURES, -1)
    place[chosen] = np.arange(len(chosen))
    x = np.zeros((n, len(chosen) + 1), np.float32)
    x[:, -1] = 1
    known = place[columns] >= 0
    x[at[known], place[columns[known]]] = 1
    w = np.zeros(len(chosen) + 1)
    ridge = np.append(np.full(len(chosen), RIDGE), 1e-6)
    for _ in range(20):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        spread = np.maximum(q * (1 - q), 1e-6).astype(np.float32)
        step = np.linalg.solve((x * spread[:, None]).T @ x + np.diag(ridge),
                               x.T @ (bad - q).astype(np.float32) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-3:
            break
    weights = dict(zip(chosen.tolist(), w[:-1].tolist()))
    return Head(weights, float(w[-1]) - math.log(p / (n - p)), prior)


def labelled(labels: DataFrame) -> DataFrame:
    """doc_id, kind: one row per labelled document. A document of several labels has the worst of them."""
    known = labels.filter(F.col("doc_id").isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"), F.min(F.coalesce("quality", F.lit(1))).alias("quality"),
    ).select("doc_id", F.when(F.col("toxic") > 0, "toxic").when(F.col("quality") < 1, "low").otherwise("clean").alias("kind"))


def train(docs: DataFrame, labels: DataFrame) -> dict[str, Head]:
    """Fits on a sample of SAMPLE labelled documents of each kind, the same ones every time."""
    kinds = store(labelled(labels), "labelled")
    sample = None
    for kind, most in SAMPLE.items():
        own = kinds.filter(F.col("kind") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        sample = own if sample is None else sample.union(own)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = WordFeatures()
        for batch in batches:
            found = [np.sort(np.array(list(features(text, own)), np.int32)) for text in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("kind"), pa.array(found, pa.list_(pa.int32()))], ["kind", "features"])

    rows = store(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
        .join(F.broadcast(sample), "doc_id")  # at most sum(SAMPLE.values()) rows
        # However often a labelled document is repeated in the table, it is fitted to once.
        .groupBy("doc_id").agg(F.first("kind").alias("kind"), F.min("text").alias("text"))
        .select("kind", "text").mapInArrow(featured, "kind string, features array<int>"), "sample_features")
    # Counts of at most FEATURES features come to the driver, and of the texts only what is selected.
    held = rows.select("kind", F.explode("features").alias("feature")).groupBy("feature").agg(
        *(F.count_if(F.col("kind") == kind).alias(kind) for kind in SAMPLE)).toArrow()
    texts = {r["kind"]: r["n"] for r in rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    have = {}
    for kind in SAMPLE:
        have[kind] = np.zeros(FEATURES)
        have[kind][held.column("feature").to_numpy()] = held.column(kind).to_numpy()
    counts = {r["kind"]: r["n"] for r in kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    heads = {}
    for head in HEADS:
        p, n = texts.get(head, 0), texts.get(head, 0) + texts.get("clean", 0)
        chosen = selected(have[head], have[head] + have["clean"], float(p), float(n)) if 0 < p < n else np.zeros(0, np.int64)
        used = rows.filter(F.col("kind").isin(head, "clean")).select(
            "kind", F.array_intersect("features", F.array(*map(F.lit, chosen.tolist())).cast("array<int>")).alias("features"))
        used = used.toArrow() if len(chosen) else None
        kind = used.column("kind").to_pylist() if used else [head] * p + ["clean"] * (n - p)
        vectors = [np.array(v, np.int64) for v in used.column("features").to_pylist()] if used else [np.zeros(0, np.int64)] * n
        prior = counts.get(head, 0) / total if total else 0.0
        heads[head] = fit(vectors, np.array([k == head for k in kind], float), chosen, prior)
    return heads


def logit(p: Column) -> Column:
    safe = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(safe / (1 - safe))


def logistic(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def shrunk(groups: DataFrame, head: str, prior: Column) -> DataFrame:
    """Adds ``<head>_rate`` of each group, shrunk towards ``prior``.

    ``groups``: n and ``<head>`` (sum of probabilities) per group. The strength of shrinking, in
    documents, is by the method of moments: the spread of the groups' means beyond what
    their numbers of documents explain.
    """
    spread = groups.select("n", (F.col(head) / F.col("n")).alias("mean"), prior.alias("prior")).agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("squares"),
        F.sum(F.col("n") * (F.col("mean") - F.col("prior")) ** 2).alias("q"),
        F.sum(F.col("prior") * (1 - F.col("prior"))).alias("chance"),
        F.sum(F.col("n") * F.col("prior") * (1 - F.col("prior"))).alias("variance")).first()
    strength = 1e6
    if spread["k"] > 1 and spread["all"] > spread["squares"] / spread["all"]:
        between = (spread["q"] - spread["chance"]) / (spread["all"] - spread["squares"] / spread["all"])
        if between > 0:
            strength = min(1e6, max(1.0, spread["variance"] / spread["all"] / between - 1))
    return groups.withColumn(f"{head}_rate", (F.col(head) + strength * prior) / (F.col("n") + strength))


def judge(docs: DataFrame, labels: DataFrame, site: str = "source", section: str = "lang") -> DataFrame:
    """All rows and columns of ``docs`` with ``toxic`` and ``low``, the posterior probabilities of
    being toxic and of being low-grade, and ``keep``, true where both are at most a half.

    ``site`` and ``section`` name the columns that say where a document comes from. Columns that
    are called toxic, low or keep already are replaced. Documents are scored once and stored
    with their evidence; rates per section are joined to that table, so adaptive execution
    can split a site that has most rows. Only sums per section are shuffled before.

    A null or empty text is judged by its shape alone, and a null site or section is one of its
    own. Labels without doc_id or without any value are ignored. Without labels of both
    classes there is no evidence and everything is kept. Rows with the same doc_id are judged each
    for itself, equal rows equally. An empty table gives no rows.
    """
    spark = prepare(docs.sparkSession)
    heads = train(docs, labels)
    shared = spark.sparkContext.broadcast(heads)
    plain = docs.drop("toxic", "low", "keep").withColumns({
        "_qc_site": F.coalesce(F.col(site).cast("string"), F.lit("")),
        "_qc_section": F.coalesce(F.col(section).cast("string"), F.lit(""))})
    evidence = [f"_qc_{head}" for head in HEADS]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads = shared.value
        own = WordFeatures(frozenset().union(*(h.weights for h in heads.values())))
        for batch in batches:
            found = [features(text or "", own) for text in batch.column("text").to_pylist()]
            columns = [pa.array([heads[h].evidence(f) for f in found], pa.float64()) for h in HEADS]
            yield pa.record_batch([*batch.columns, *columns], [*batch.schema.names, *evidence])

    kinds = StructType([*plain.schema, *(StructField(name, DoubleType()) for name in evidence)])
    stored = store(plain.mapInArrow(scored, kinds), "evidence")
    return _posterior(stored, heads)


def _posterior(stored: DataFrame, heads: dict[str, Head]) -> DataFrame:
    sections = ["_qc_site", "_qc_section"]
    prior = {h: min(max(heads[h].prior, 1e-6), 1 - 1e-6) for h in HEADS}
    own = {h: logistic(F.col(f"_qc_{h}") + math.log(prior[h] / (1 - prior[h]))) for h in HEADS}
    by_section = store(stored.groupBy(*sections).agg(
        F.count(F.lit(1)).alias("n"), *(F.sum(own[h]).alias(h) for h in HEADS)), "sections")
    by_site = store(by_section.groupBy("_qc_site").agg(
        F.sum("n").alias("n"), *(F.sum(h).alias(h) for h in HEADS)), "sites")
    overall = by_site.agg(F.sum("n").alias("n"), *(F.sum(h).alias(h) for h in HEADS)).first()
    for h in HEADS:
        by_site = shrunk(by_site, h, F.lit(overall[h] / overall["n"] if overall["n"] else prior[h]))
    by_section = by_section.join(by_site.select("_qc_site", *(F.col(f"{h}_rate").alias(f"{h}_site") for h in HEADS)), "_qc_site")
    for h in HEADS:
        by_section = shrunk(by_section, h, F.col(f"{h}_site"))
    rates = store(by_section.select(*sections, *(f"{h}_rate" for h in HEADS)), "rates")
    judged = stored.join(rates, sections).withColumns(
        {h: logistic(F.col(f"_qc_{h}") + logit(F.col(f"{h}_rate"))) if heads[h].weights else F.lit(0.0) for h in HEADS})
    return judged.withColumn("keep", (F.col("toxic") <= 0.5) & (F.col("low") <= 0.5)).drop(
        *sections, *(f"_qc_{h}" for h in HEADS), *(f"{h}_rate" for h in HEADS))
