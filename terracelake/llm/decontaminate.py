"""Finds benchmark items in documents, whole or with edits.

A document holds an item if some span of its words is within edit distance k = (1 -
similarity) * n of the item's n words. Words are compared in lower case without punctuation
at their ends.

1. Of an item cut into k + 1 pieces, one is in the span unchanged. So a span worth looking
   at holds a run of n // (k + 1) words that stands in some item, and at least n - k words
   that are in any. Both tests know nothing about which item it is, and lose nothing.
2. Windows of each item length that pass are embedded by random walks (CGK): at each step
   the current word is written out, and random bits, which depend on the step and the word, say
   whether to go on to the next word. Sequences that are a few edits apart fall back into step,
   so their embeddings agree in many places.
3. Each repetition has its own walk and samples ``SAMPLED`` places of the embedding, whose
   letters are its key. A window and an item of its length that have the key of any repetition
   in common are a candidate pair.
4. Candidates are verified by an exact alignment of the item with the text around.

Documents are read once, however many items there are: a task has maps of fixed size of the items'
words, runs and keys, and what passes them is joined to the table of keys by Spark.

Equal sequences have equal embeddings and are always found. For the greatest distance allowed
tests/llm measures the recall, which ``REPETITIONS`` sets.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracelake.llm.bitmaps import bitmap, on_map
from terracelake.llm.common import prepare, store, text_of

REPETITIONS = 16
SAMPLED = 2
# Chunks of text that one worker remembers; emptied when full.
REMEMBERED = 150_000
# Bits of each of the three maps that every task has, 4 MB. With more items than fit, more windows pass.
MAP_BITS = 1 << 25
# Chunks of text looked at together.
TOGETHER = 1 << 19
# Windows embedded at a time.
WINDOWS = 1024
# Letters that stand for a word of no item, and for what is beyond the end of a text. Small numbers are read fastest.
UNKNOWN, END = 1, 3

EDGE = string.punctuation + "“”‘’«»…–—¿¡"


def words_of(text: str) -> list[str]:
    """Chunks between white space, in lower case, without punctuation at their ends; none empty."""
    return [w for w in (chunk.strip(EDGE).lower() for chunk in text.split()) if w]


def letter(word: str) -> int:
    return xxhash.xxh64_intdigest(word, 7) | 1


class Letters(dict):
    """Chunk -> the letter of its word, UNKNOWN for words that aren't on the items' map, 0 for no word."""

    def __init__(self, known: np.ndarray):
        super().__init__()
        self.known = known.tobytes()
        self.mask = 8 * len(self.known) - 1

    def __missing__(self, chunk: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        word = chunk.strip(EDGE).lower()
        number = xxhash.xxh64_intdigest(word, 7) | 1 if word else 0
        at = number & self.mask  # as ``on_map``, for one number
        if word and not self.known[at >> 3] >> (at & 7) & 1:
            number = UNKNOWN
        if len(chunk) <= 64:
            self[chunk] = number
        return number


@dataclass
class Sieve:
    """The random numbers of the embedding, which only depend on the lengths of the items."""

    lengths: np.ndarray  # distinct numbers of words, ascending
    similarity: float

    def __post_init__(self):
        random = np.random.default_rng(7)
        longest = int(self.lengths[-1])
        self.slack = np.array([self.edits(n) for n in self.lengths])
        odd = lambda *shape: random.integers(0, 1 << 63, shape, np.uint64) * np.uint64(2) + np.uint64(1)
        self.walk = odd(2 * longest, REPETITIONS, 1)
        self.places = random.random((SAMPLED, REPETITIONS))
        self.mix = odd(SAMPLED, 1, 1)
        self.grams = odd(longest)
        self.own, self.size = odd(REPETITIONS, 1), odd(1)[0]
        self.run_lengths = np.unique(self.lengths // (self.slack + 1))

    def edits(self, n: int) -> int:
        return int((1 - self.similarity) * n + 1e-9)

    def run_hashes(self, text: np.ndarray, at: np.ndarray, q: int) -> np.ndarray:
        total = np.full(len(at), q, np.uint64) * self.size
        for i in range(q):
            total += text[at + i] * self.grams[i]
        return total

    def walks(self, text: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Where each walk stands at each step, from its start: (steps, repetitions, starts)."""
        out = np.empty((len(self.walk), REPETITIONS, len(starts)), np.int32)
        at = np.zeros((REPETITIONS, len(starts)), np.int32)
        last = len(text) - 1
        for step, by in enumerate(self.walk):
            out[step] = at
            at = at + ((text[np.minimum(starts + at, last)] * by) >> np.uint64(63)).astype(np.int32)
        return out

    def keys(self, text: np.ndarray, starts: np.ndarray, walks: np.ndarray, n: int, of=slice(None)) -> np.ndarray:
        """One key for each repetition and start, of the letters at the sampled places of a window of n words.

        ``of``: which starts, if not all that have walks."""
        steps, starts = (self.places * 2 * n).astype(int), starts[of]
        total = np.full((REPETITIONS, len(starts)), n, np.uint64) * self.size
        for place, mix in zip(steps, self.mix):
            at = walks[place, np.arange(REPETITIONS)][:, of]
            total += np.where(at < n, text[np.minimum(starts + at, len(text) - 1)], np.uint64(END)) * mix
        return total * self.own

    def of_item(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Its runs and its keys."""
        n = len(words)
        q = n // (self.edits(n) + 1)
        text = np.append(words, np.uint64(END))
        start = np.zeros(1, np.int64)
        return np.unique(self.run_hashes(words, np.arange(n - q + 1), q)), self.keys(text, start, self.walks(text, start), n)[:, 0]

    def seeds(self, text: np.ndarray, runs: np.ndarray) -> np.ndarray:
        """Places at which a run of words begins that is on the map of the items' runs."""
        found = [np.zeros(0, np.int64)]
        known = np.concatenate(([0], np.cumsum(known_words(text))))
        for q in self.run_lengths.tolist():
            at = np.flatnonzero(known[q:] - known[:-q] == q)
            found.append(at[on_map(runs, self.run_hashes(text, at, q))])
        return np.concatenate(found)

    def likely(self, parts: list[np.ndarray], seeds: list[np.ndarray], keys: np.ndarray) -> Iterator[tuple[int, int, int, np.ndarray]]:
        """Which text, first word and end of a stretch, and its keys: stretches with windows whose keys are on the map.

        parts, seeds: the words of texts and the seeds in each. They are looked at as one text, far enough apart.
        """
        widest = int(self.lengths[-1] + self.slack[-1])
        gap = np.full(widest, END, np.uint64)
        text = np.concatenate([x for part in parts for x in (part, gap)])
        first = np.cumsum([0, *(len(part) + widest for part in parts)])
        seeds = np.concatenate([own + at for own, at in zip(seeds, first)])
        # A start lies at most a widest window before a seed, and never after it.
        mark = np.zeros(len(text) + 1, np.int64)
        np.add.at(mark, np.maximum(0, seeds - widest), 1)
        np.add.at(mark, seeds + 1, -1)
        starts = np.flatnonzero((np.cumsum(mark)[:-1] > 0) & (text != END))
        known = np.concatenate(([0], np.cumsum(known_words(text))))
        wide = (self.lengths + self.slack)[:, None]
        enough = known[np.minimum(starts + wide, len(text))] - known[starts] >= (self.lengths - self.slack)[:, None]
        alive = enough.any(axis=0)
        starts, enough = starts[alive], enough[:, alive]
        found = []
        for block in range(0, len(starts), WINDOWS):
            own, good = starts[block:block + WINDOWS], enough[:, block:block + WINDOWS]
            walks = self.walks(text, own)
            for n, which in zip(self.lengths.tolist(), good):
                at = np.flatnonzero(which)
                if len(at):
                    mine = self.keys(text, own, walks, n, at)
                    hit, start = np.nonzero(on_map(keys, mine))
                    found.append(np.stack([own[at[start]].astype(np.uint64), mine[hit, start]]))
        if not found or not sum(x.shape[1] for x in found):
            return
        place, key = np.concatenate(found, axis=1)
        order = np.lexsort((key, place))
        place, key = place[order].astype(np.int64), key[order]
        ends = np.append(np.flatnonzero(np.diff(place) > widest) + 1, len(place))
        of = np.searchsorted(first, place[ends - 1], "right") - 1
        slack = int(self.slack[-1])
        for begin, end, part in zip([0, *ends[:-1].tolist()], ends.tolist(), of.tolist()):
            a, b = (int(place[i] - first[part]) for i in (begin, end - 1))
            yield part, max(0, a - slack), min(len(parts[part]), b + widest), np.unique(key[begin:end])


def known_words(text: np.ndarray) -> np.ndarray:
    return (text != UNKNOWN) & (text != END)


def aligned(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Fewest edits that turn some span of ``text`` into ``item``; the span's first word and the one after its last."""
    n = len(text)
    index = np.arange(n + 1)
    cost, begin = np.zeros(n + 1, np.int64), index.copy()
    for i, word in enumerate(item.tolist(), 1):
        swap = cost[:-1] + (text != word)
        drop = cost + 1
        new, come = drop.copy(), begin.copy()
        better = swap <= new[1:]
        new[1:][better], come[1:][better] = swap[better], begin[:-1][better]
        # Words of the text that aren't in the item cost one each: a running minimum of cost - place.
        low = np.minimum.accumulate(new - index)
        source = np.maximum.accumulate(np.where(new - index == low, index, 0))
        cost, begin = low + index, come[source]
    end = int(cost.argmin())
    return int(cost[end]), int(begin[end]), end


def items_of(benchmark: DataFrame) -> DataFrame:
    """item (a number), item_id, n and words (letters) of every item that has words, stored. Equal rows are one item."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [np.array([letter(w) for w in words_of(t)], np.uint64).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("item_id"), pa.array([len(w) for w in words], pa.int32()), pa.array(words, pa.list_(pa.int64()))],
                                  ["item_id", "n", "words"])

    own = benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("text")).distinct()
    return store(own.mapInArrow(make, "item_id long, n int, words array<long>").filter("n > 0")
                 .withColumn("item", F.monotonically_increasing_id()), "items")


def indexed(items: DataFrame, sieve: Sieve) -> DataFrame:
    """item, words, runs, keys of every item, stored: the key table, and what goes on the maps."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [sieve.of_item(w.values.to_numpy().view(np.uint64)) for w in batch.column("words")]
            numbers = [pa.array([x[i].view(np.int64) for x in made], pa.list_(pa.int64())) for i in (0, 1)]
            yield pa.record_batch([batch.column("item"), batch.column("words"), *numbers], ["item", "words", "runs", "keys"])

    return store(items.mapInArrow(make, "item long, words array<long>, runs array<long>, keys array<long>"), "item_index")


def stretches(docs: DataFrame, sieve: Sieve, maps) -> DataFrame:
    """row, doc_id, print, begin, words, keys of every stretch of text whose windows have a key that some item may have. Stored.

    Documents are read once and never shuffled. A text is handled whole, whatever its length.
    """

    def scan(texts: list[str], letters: Letters) -> Iterator[tuple[int, list]]:
        known, runs, keys = maps.value
        at = 0
        while at < len(texts):
            parts, ends, size = [], [], 0
            while at + len(parts) < len(texts) and size < TOGETHER:
                own = np.fromiter(map(letters.__getitem__, texts[at + len(parts)].split()), np.uint64)
                own = np.append(own[own > 0], np.uint64(END))  # no run of known words goes over an end
                parts.append(own)
                size += len(own)
                ends.append(size)
            seeds = sieve.seeds(np.concatenate(parts), runs)
            where = np.searchsorted(ends, seeds, "right")
            seeded = np.unique(where).tolist()
            texts_with = [parts[i][:-1] for i in seeded]
            if seeded:
                near = [seeds[where == i] - (ends[i] - len(parts[i])) for i in seeded]
                for i, begin, end, own in sieve.likely(texts_with, near, keys):
                    yield at + seeded[i], begin, texts_with[i][begin:end], own
            at += len(parts)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = Letters(maps.value[0])
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        for batch in batches:
            found = list(scan(batch.column("text").to_pylist(), letters))
            columns = [[f[1] for f in found], *([f[i].view(np.int64) for f in found] for i in (2, 3))]
            of = pa.array([f[0] for f in found], pa.int64())
            yield pa.record_batch([*(batch.column(c).take(of) for c in ("row", "doc_id", "print")), *map(pa.array, columns, kinds)],
                                  ["row", "doc_id", "print", "begin", "words", "keys"])

    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                        F.xxhash64(text_of()).alias("print"), text_of().alias("text"))
    return store(texts.mapInArrow(make, "row long, doc_id long, print long, begin long, words array<long>, keys array<long>")
                 .withColumn("stretch", F.monotonically_increasing_id()), "stretches")


def verified(pairs: DataFrame, sieve: Sieve) -> DataFrame:
    """The pairs (row, doc_id, print, begin, words of the stretch; item, item_id, n, item_words) that are near enough, with their spans."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, found = [], []
            for i, (text, item, begin) in enumerate(zip(batch.column("words"), batch.column("item_words"), batch.column("begin").to_pylist())):
                text, item = text.values.to_numpy(), item.values.to_numpy()
                k = sieve.edits(len(item))
                if np.isin(item, text).sum() >= len(item) - k:
                    distance, first, end = aligned(item, text)
                    if distance <= k:
                        keep.append(i)
                        found.append((distance, begin + first, begin + end - 1))
            columns = [pa.array([f[c] for f in found], kind) for c, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))]
            yield pa.record_batch([*(batch.column(c).take(pa.array(keep, pa.int64())) for c in ("row", "doc_id", "print", "item", "item_id", "n")),
                                   *columns], ["row", "doc_id", "print", "item", "item_id", "n", "distance", "first_word", "last_word"])

    return pairs.mapInArrow(make, "row long, doc_id long, print long, item long, item_id long, n int, distance int, "
                                  "first_word long, last_word long")


def held_items(docs: DataFrame, benchmark: DataFrame, similarity: float) -> DataFrame | None:
    """row, doc_id, print, item, item_id, n, distance, first_word, last_word: each document and item it holds, in the item's best
    place; None if there are no items."""
    spark = prepare(docs.sparkSession)
    items = items_of(benchmark)
    lengths = np.array(sorted(r["n"] for r in items.select("n").distinct().collect()), np.int64)
    if not len(lengths):
        return None
    sieve = Sieve(lengths, similarity)
    index = indexed(items, sieve)
    maps = spark.sparkContext.broadcast([
        bitmap(index.select(F.explode(c).alias("number")), "number", MAP_BITS) for c in ("words", "runs", "keys")])
    near = stretches(docs, sieve, maps)
    keys = store(index.select(F.explode("keys").alias("key"), "item"), "item_keys")
    pairs = store(near.select("stretch", F.explode("keys").alias("key")).join(keys, "key").select("stretch", "item").distinct(), "item_pairs")
    whole = pairs.join(near.drop("keys"), "stretch").join(items.withColumnRenamed("words", "item_words"), "item")
    found = store(verified(whole, sieve), "found_items")
    best = F.min(F.struct("distance", "first_word", "last_word", "doc_id", "print", "item_id", "n")).alias("best")
    return found.groupBy("row", "item").agg(best).select("row", "item", "best.*")


def find_items(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, n_words of the item, distance in
    words, similarity (1 - distance / n_words), first_word and last_word of the best span (of equally
    near ones the first).

    Null and empty texts hold nothing; items without words are in no document. Null doc_ids
    and item_ids are kept. Rows with the same doc_id are looked at each for itself; items that are
    equal rows count once. Empty tables give no rows. Other columns are not read.
    """
    found = held_items(docs, benchmark, similarity)
    if found is None:
        return docs.sparkSession.createDataFrame([], MATCH)
    return found.select(
        "doc_id", "item_id", F.col("n").alias("n_words"), "distance",
        (1 - F.col("distance") / F.col("n")).alias("similarity"), "first_word", "last_word")


MATCH = "doc_id long, item_id long, n_words int, distance int, similarity double, first_word long, last_word long"


def without_items(docs: DataFrame, benchmark: DataFrame, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs``, with all columns, whose text holds no item; see ``find_items``."""
    found = held_items(docs, benchmark, similarity)
    if found is None:
        return docs
    texts = store(found.select(F.col("print").alias("_dc_print")).distinct(), "texts_with_items")
    return docs.withColumn("_dc_print", F.xxhash64(text_of())).join(texts, "_dc_print", "left_anti").select(docs.columns)
