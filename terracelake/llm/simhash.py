"""Near-duplicates by SimHash, with pigeonring filtering.

A fingerprint's 64 bits are a ring of eight segments of eight bits. If two fingerprints
differ in at most four bits then from at least one segment on, every chain of segments of
length l differs in at most l * 4 / 8 bits in all: none in the first segment, at most one in
the first three, two in the first five, three in the first seven. (Were there no such
segment, the ring would fall into chains that are all over their budget, and so would be
the whole.)

So the first segment of a good chain is equal in both, and of the next four at least two are,
though not only the third and fourth. These three equal segments are the bucket in which
the pair is found: five patterns for each of eight starts, 24 bits each. In a bucket, whatever
its size, every chain is held to its budget; the last chain is the whole ring, which is the full distance.

Four differing bits leave one of the five other segments equal too. A large bucket is therefore
divided into buckets of 32 bits, in five ways, before anything in it is compared.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import cache
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracelake.llm.common import prepare, store, text_of
from terracelake.llm.components import smallest_reachable

SEGMENTS, DISTANCE = 8, 4
# Shingles whose bits are counted at a time.
CHUNK = 1 << 15
# A bucket of more fingerprints is compared in pairs of blocks of about this many.
BLOCK = 2048
NO_ID = (1 << 63) - 1  # stands for a null doc_id
# Up to here the fingerprints of a bucket are compared neighbour by neighbour, many buckets at once.
FEW = 16


def budgets(distance: int) -> list[int]:
    """Bits in which the first 1, 2, ... segments of a good chain may differ."""
    return [(i + 1) * distance // SEGMENTS for i in range(SEGMENTS)]


@cache
def patterns(distance: int) -> tuple[tuple[int, int], ...]:
    """Steps from the first segment at which two more are equal, one for every way to keep the budgets."""
    if not 0 <= distance <= DISTANCE:
        raise ValueError(f"three equal segments are only sure up to a distance of {DISTANCE}")
    found = set()
    for differ in product((0, 1), repeat=4):
        if all(sum(differ[:i + 1]) <= budgets(distance)[i + 1] for i in range(4)):
            found.add(tuple(i + 1 for i in range(4) if not differ[i])[:2])
    return tuple(sorted(found))


def fingerprint(text: str, shingle: int) -> int:
    """Each bit is set if it is in over half of the shingles' hashes."""
    words = text.encode().lower().split()  # of bytes: only A-Z and ASCII white space count
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1].tolist()
    stops = ends[k - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    total = np.zeros(64, np.int64)
    for at in range(0, len(starts), CHUNK):
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts[at:at + CHUNK], stops[at:at + CHUNK])], ">u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(starts)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, text_hash and print (the fingerprint) of every text."""

    def printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text, shingle) for text in batch.column("text").to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_hash"), pa.array(prints, pa.int64())],
                                  ["doc_id", "text_hash", "print"])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text"),
    ).mapInArrow(printed, "doc_id long, text_hash long, print long")


def segments() -> list[Column]:
    return [F.expr(f"(shiftrightunsigned(print, {8 * (7 - i)}) & 255)") for i in range(SEGMENTS)]


def buckets(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """key, print: every fingerprint in each of its buckets. key: start and pattern, then 24 bits."""
    segment, own = segments(), patterns(distance)
    keys = []
    for start in range(SEGMENTS):
        for pattern, (a, b) in enumerate(own):
            equal = [segment[(start + step) % SEGMENTS] for step in (0, a, b)]
            keys.append((((F.lit(start * len(own) + pattern) * 256 + equal[0]) * 256 + equal[1]) * 256 + equal[2]).cast("long"))
    return prints.select("print", F.explode(F.array(*keys)).alias("key"))


def divided(keyed: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """key, print: the rows of large buckets in buckets of one more equal segment, five for each."""
    segment, own = segments(), patterns(distance)
    others = []
    for start in range(SEGMENTS):
        for a, b in own:
            rest = [step for step in range(1, SEGMENTS) if step not in (a, b)]
            others.append(F.array(*(F.lit(step) * 256 + segment[(start + step) % SEGMENTS] for step in rest)))
    choose = F.element_at(F.array(*others), (F.shiftright("key", 24) + 1).cast("int"))
    return keyed.select("key", "print", F.explode(choose).alias("more")).select(
        "print", (F.col("key") + F.shiftleft(F.col("more").cast("long"), 32)).alias("key"))


def linked(a: np.ndarray, b: np.ndarray, start: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """Which pairs keep every chain from their start within its budget; the whole ring is the last."""
    differ = (a ^ b).astype(">u8").view(np.uint8).reshape(-1, SEGMENTS)
    left, total = np.arange(len(a)), np.zeros(len(a), np.int64)
    for step, budget in enumerate(budgets(distance)):
        total = total + np.bitwise_count(differ[left, (start[left] + step) % SEGMENTS])
        good = total <= budget
        left, total = left[good], total[good]
    return left


def forest(prints: np.ndarray, start: int, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """Links that connect whatever good chains connect in one bucket: each fingerprint is reached once."""
    # From the bucket's start on, so that a chain is a number of leading bytes.
    turned = (prints << np.uint64(8 * start)) | (prints >> np.uint64(64 - 8 * start)) if start else prints
    limits = [(np.uint64(64 - 8 * (i + 1)), budget) for i, budget in enumerate(budgets(distance))]
    edges, unseen, queue = [], np.arange(len(prints)), deque()
    while len(unseen):
        queue.append(int(unseen[0]))
        unseen = unseen[1:]
        while queue and len(unseen):
            i = queue.popleft()
            at, differ = np.arange(len(unseen)), turned[unseen] ^ turned[i]
            for drop, budget in limits:
                good = np.bitwise_count(differ >> drop) <= budget
                at, differ = at[good], differ[good]
            near = unseen[at].tolist()
            unseen = np.delete(unseen, at)
            queue.extend(near)
            edges += [(i, j) for j in near]
        queue.clear()
    return edges


def bucket_links(key: np.ndarray, prints: np.ndarray, edges: np.ndarray, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Links within buckets. ``edges``: where each bucket begins, and the end of the last.

    FEW only says which of two ways runs faster; both link by the same chains.
    """
    sizes = np.diff(edges)
    few = np.repeat(sizes <= FEW, sizes)
    group = np.repeat(np.arange(len(sizes)), sizes)
    start = ((key & 0xFFFFFFFF) >> 24) // len(patterns(distance))
    out_a, out_b = [], []
    for gap in range(1, min(FEW, int(sizes.max(initial=1)))):
        at = np.flatnonzero((group[gap:] == group[:-gap]) & few[gap:])
        if not len(at):
            break
        a, b = prints[at], prints[at + gap]
        good = linked(a, b, start[at], distance)
        out_a.append(a[good])
        out_b.append(b[good])
    for i in np.flatnonzero(sizes > FEW).tolist():
        own = prints[edges[i]:edges[i + 1]]
        if pairs := forest(own, int(start[edges[i]]), distance):
            a, b = np.array(pairs).T
            out_a.append(own[a])
            out_b.append(own[b])
    none = np.zeros(0, np.uint64)
    return np.concatenate([none, *out_a]), np.concatenate([none, *out_b])


def _linker(distance: int):
    """Rows come sorted by bucket. The last bucket of a batch waits for the next batch."""

    def found(key, pair, prints) -> pa.RecordBatch:
        new = np.flatnonzero((key[1:] != key[:-1]) | (pair[1:] != pair[:-1])) + 1
        a, b = bucket_links(key, prints, np.concatenate(([0], new, [len(key)])), distance)
        both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.record_batch([pa.array(both[:, i].view(np.int64)) for i in (0, 1)], ["a", "b"])

    def links_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wait: list[np.ndarray] | None = None
        for batch in batches:
            now = [batch.column("key").to_numpy(), batch.column("pair").to_numpy(),
                   batch.column("print").to_numpy().view(np.uint64)]
            if not len(now[0]):
                continue
            if wait is not None:
                now = [np.concatenate(x) for x in zip(wait, now)]
            last = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield found(*(x[:cut] for x in now))
            wait = [x[cut:] for x in now]
        if wait is not None:
            yield found(*wait)

    return links_of


def over(keyed: DataFrame, block: int, name: str) -> DataFrame:
    """key, blocks: the buckets of more than ``block`` fingerprints."""
    return store(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
                 .select("key", F.ceil(F.col("n") / block).cast("long").alias("blocks")), name)


def links(prints: DataFrame, block: int = BLOCK, distance: int = DISTANCE) -> DataFrame:
    """a, b: links between distinct fingerprints that connect all that are within ``distance`` bits, directly or not.

    A bucket of more than ``block`` fingerprints is divided by a further equal segment: five rows
    for each of its fingerprints. What is still larger then, because its fingerprints are alike
    in 32 bits, is divided into blocks, and each pair of blocks is compared by itself, so a
    task never holds more than two blocks of one bucket.
    """
    # Each fingerprint becomes forty rows: few and small files would make few and long tasks.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = store(buckets(prints.repartition(tasks), distance), "buckets")
    large = over(keyed, block, "large_buckets")
    finer = store(divided(keyed.join(large, "key", "left_semi"), distance), "divided_buckets")
    paired = (
        finer.join(over(finer, block, "large_divided"), "key", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("print"), F.col("blocks")))
        .select("key", "print", F.expr("""
            explode(transform(sequence(0L, blocks - 1), x -> least(own, x) * blocks + greatest(own, x)))""").alias("pair"))
    )
    whole = keyed.join(large, "key", "left_anti").select("key", "print", F.lit(0).cast("long").alias("pair"))
    return store(whole.union(paired).repartition("key", "pair").sortWithinPartitions("key", "pair")
                 .mapInArrow(_linker(distance), "a long, b long"), "links")


def grouped(docs: DataFrame, shingle: int, distance: int) -> DataFrame:
    """doc_id, text_hash, print, component_id and root (the fingerprint that names the group) of every row."""
    prepare(docs.sparkSession)
    printed = store(fingerprints(docs, shingle), "fingerprints")
    first = store(printed.groupBy("print").agg(F.min("doc_id").alias("first")), "distinct_prints")
    nodes = first.select(F.col("print").alias("node"), F.coalesce("first", F.lit(NO_ID)).alias("first"))
    reached = smallest_reachable(links(first.select("print"), distance=distance), nodes)
    components = store(first.join(reached, first["print"] == reached["node"], "left").select(
        "print", F.coalesce("root", "print").alias("root"),
        F.nullif(F.coalesce("component", "first"), F.lit(NO_ID)).alias("component_id")), "components")
    return printed.join(components, "print")


def near_duplicates(docs: DataFrame, shingle: int = 4, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (a long) and component_id of every row.

    Rows whose fingerprints differ in at most ``distance`` bits (up to four) are linked; component_id is the smallest
    doc_id that can be reached. Equal fingerprints are one node however many rows have them,
    so copies cost nothing after the first grouping.

    Texts without words, null ones too, have fingerprint zero and are linked like any others.
    Rows without doc_id count for no component's smallest; a component of only such rows has
    a null component_id. Rows with the same doc_id each have their own fingerprint. An empty
    table gives no rows. Other columns are not read.
    """
    return grouped(docs, shingle, distance).select("doc_id", F.col("print").alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int = 4, distance: int = DISTANCE) -> DataFrame:
    """The rows of ``docs``, with all columns, of which one stays for each group of near-duplicates.

    It is the one with the smallest doc_id (rows without one come last; among rows with the same
    doc_id the smallest text hash decides). Of rows with the same doc_id and text one stays.
    Other cases are as in ``near_duplicates``.
    """
    return first_of_groups(docs, grouped(docs, shingle, distance))


def first_of_groups(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The first row of each group. ``groups``: doc_id, text_hash and root of every row."""
    own = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.col("text_hash").alias("hash"))
    kept = store(groups.groupBy("root").agg(F.min(own).alias("kept")), "representatives")
    keyed = docs.withColumns({"_sh_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)),
                              "_sh_hash": F.xxhash64(text_of())})
    return (
        keyed.join(kept.select(F.col("kept.id").alias("_sh_id"), F.col("kept.hash").alias("_sh_hash")),
                   ["_sh_id", "_sh_hash"], "left_semi")
        .dropDuplicates(["_sh_id", "_sh_hash"]).drop("_sh_id", "_sh_hash")
    )
