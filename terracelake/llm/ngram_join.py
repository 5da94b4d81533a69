"""Links texts by the Jaccard similarity of their word n-grams: a blocked sparse matrix product.

Rows of the incidence matrix are the distinct sets of n-grams, columns the n-grams. Entries of
its product with itself are the sizes of intersections. Of that product only tiles are made in
which some pair can reach the similarity.

1. Columns are ordered by the number of documents that hold the n-gram's rarest word, which no
   n-gram can exceed, and then by hash. The intersection of a pair that links has at least
   ``percent`` of either set, so the pair shares columns among the first ones of both rows, their
   ``leads``: with ``c`` more columns than may be missing a lead holds the first c columns that the pair
   shares. Rows with fewer columns in common with all others go. Any order is right; this one
   keeps passages that many texts share out of the leads.
2. Rows are gathered in blocks: by the most frequent column of their leads and by size class (rows
   of classes further apart than one are too unlike in size), and divided where there are many.
3. A tile is a pair of blocks that share as many columns in their leads as two rows have to. Overlaps are
   accumulated column by column, frequent columns by dense products and rare ones entry by
   entry. Before and between, pairs go that can't reach the overlap their sizes ask for.

Tiles within a block and between its neighbours come first. Pairs of blocks whose rows these have
connected already are not multiplied, so n texts that are all alike cost about n / BLOCK tiles.
"""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terracelake.llm.bitmaps import bitmap, on_map
from terracelake.llm.common import prepare, store, text_of
from terracelake.llm.components import smallest_reachable

# At most so many words have their frequency known to all tasks; longer words have none.
LISTED, LONGEST = 1 << 17, 64
# Words a worker remembers between texts, and words it counts before it hands them on.
REMEMBERED, COUNTED = 300_000, 500_000
# Rows of a block, and about how many entries it may have.
BLOCK, ENTRIES = 512, 1 << 20
# Of so many columns of a row one more is in its lead, and has to be shared.
EXTRA = 10
# Bits of the maps that every task has, 16 MB: of shared columns, and of texts whose sets are wanted.
MAP_BITS = 1 << 27
# A column with more pairs than this in a tile is multiplied densely, so many columns at a time.
DENSE, WIDTH = 64, 2048
NO_ID = (1 << 63) - 1  # stands for a null doc_id
_FACTORS = np.random.default_rng(11).integers(0, 1 << 63, 64, np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()  # of bytes: only A-Z and ASCII white space count


class Words(dict):
    """Word -> its number in the two tables: hash, and how many documents have it (0 if it isn't listed)."""

    def __init__(self, listed: dict[bytes, int]):
        super().__init__()
        self.listed = listed
        self.hashes, self.known = np.zeros(1024, np.uint64), np.zeros(1024, np.int64)

    def __missing__(self, word: bytes) -> int:
        number = len(self)
        if number == len(self.hashes):
            self.hashes, self.known = (np.concatenate([x, np.zeros_like(x)]) for x in (self.hashes, self.known))
        self.hashes[number], self.known[number] = xxhash.xxh64_intdigest(word, 42), self.listed.get(word, 0)
        self[word] = number
        return number

    def grams(self, text: str, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The sorted distinct hashes of a text's n-grams, and for each the frequency of its rarest word."""
        if len(self) > REMEMBERED:
            self.clear()
        words = words_of(text)
        numbers = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if not len(numbers):
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        k = min(size, len(numbers))  # fewer words are one n-gram
        hashes, known = self.hashes[numbers], self.known[numbers]
        last = len(numbers) - k + 1
        total, rarest = np.full(last, k, np.uint64) * _FACTORS[-1], known[:last].copy()
        for i in range(k):
            total += hashes[i:i + last] * _FACTORS[i]
            rarest = np.minimum(rarest, known[i:i + last])
        grams, first = np.unique(total, return_index=True)
        return grams, rarest[first]


def required(n: int) -> int:
    """Columns that the leads of two rows of at least n share, if the rows link."""
    return 1 + n // EXTRA


def lead_length(n: int, percent: int) -> int:
    """So many first columns of a row of n hold the first ``required(n)`` that it shares with whatever links to it."""
    return n + -percent * n // 100 + required(n)


def least_required(n, percent: int):
    """As ``required``, of the smaller of n and what can link to it. A number or a column of them."""
    return 1 + (percent * n + 99) // 100 // EXTRA if isinstance(n, int) else F.expr(f"1 + ({percent} * {n} + 99) div 100 div {EXTRA}")


def frequent_words(docs: DataFrame) -> dict[bytes, int]:
    """Words in at least one LISTED-th of all (document, word) pairs, of which there are LISTED at most."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Counter()

        def taken() -> pa.RecordBatch:
            batch = pa.record_batch([pa.array(found.keys(), pa.binary()), pa.array(found.values(), pa.int64())], ["word", "n"])
            found.clear()
            return batch
        for batch in batches:
            for text in batch.column("text").to_pylist():
                found.update({w for w in words_of(text) if len(w) <= LONGEST})
                if len(found) > COUNTED:
                    yield taken()
        yield taken()

    counts = store(docs.select(text_of().alias("text")).mapInArrow(counted, "word binary, n long")
                   .groupBy("word").agg(F.sum("n").alias("n")), "word_counts")
    every = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    return {bytes(r["word"]): r["n"] for r in counts.filter(F.col("n") * LISTED >= every).collect()}


def described(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, text_hash, node (names the set), n (its size) and lead of every text."""
    listed = docs.sparkSession.sparkContext.broadcast(frequent_words(docs))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(listed.value)
        for batch in batches:
            nodes, sizes, leads = [], [], []
            for text in batch.column("text").to_pylist():
                grams, rarest = words.grams(text, size)
                nodes.append(name_of(grams))
                sizes.append(len(grams))
                # A set too small to link with any other set has no lead.
                able = can_link(len(grams), percent)
                leads.append(grams[np.lexsort((grams, rarest))[:lead_length(len(grams), percent)]].view(np.int64) if able else [])
            yield pa.record_batch([batch.column("doc_id"), batch.column("text_hash"), pa.array(nodes, pa.int64()),
                                   pa.array(sizes, pa.int64()), pa.array(leads, pa.list_(pa.int64()))],
                                  ["doc_id", "text_hash", "node", "n", "lead"])

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text"),
    ).mapInArrow(make, "doc_id long, text_hash long, node long, n long, lead array<long>")


def name_of(grams: np.ndarray) -> int:
    name = xxhash.xxh64_intdigest(grams.tobytes())
    return name - (1 << 64) if name >> 63 else name


def can_link(n: int, percent: int) -> bool:
    """Whether a set of n can be ``percent`` like any that isn't equal: best is one element more."""
    return 100 * n >= percent * (n + 1)


def sharing(nodes: DataFrame, percent: int) -> DataFrame:
    """column, node, n, df: the lead columns that rows share, of rows that share enough with all others. Stored."""
    shared = store(nodes.select(F.explode("lead").alias("column")).groupBy("column").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"),
                   "shared_columns")
    known = nodes.sparkSession.sparkContext.broadcast(bitmap(shared, "column", MAP_BITS))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leads, keep = [], []
            for n, lead in zip(batch.column("n").to_pylist(), batch.column("lead")):
                own = lead.values.to_numpy()
                own = own[on_map(known.value, own)]
                keep.append(len(own) > 0 and len(own) >= least_required(n, percent))
                leads.append(own if keep[-1] else [])
            out = pa.record_batch([batch.column("node"), batch.column("n"), pa.array(leads, pa.list_(pa.int64()))], ["node", "n", "lead"])
            yield out.filter(pa.array(keep, pa.bool_()))

    likely = store(nodes.select("node", "n", "lead").mapInArrow(make, "node long, n long, lead array<long>"), "likely")
    live = store(likely.select("node", "n", F.explode("lead").alias("column")).join(shared, "column"), "likely_columns")
    enough = live.groupBy("node").agg(F.count(F.lit(1)).alias("own"), F.first("n").alias("n")).filter(
        F.col("own") >= least_required("n", percent)).select("node")
    return store(live.join(store(enough, "enough"), "node"), "live")


def gathered(live: DataFrame, percent: int) -> DataFrame:
    """node, n, home, class, split, splits, block: the block of every row. ``live``: column, node, n, df."""
    homes = store(
        live.groupBy("node").agg(F.max(F.struct("df", "column")).alias("most"), F.max("n").alias("n"))
        # Sizes of a pair that links differ by less than one class.
        .select("node", "n", F.col("most.column").alias("home"),
                F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(101 / percent))).cast("int").alias("class")), "homes")
    sizes = store(homes.groupBy("home", "class").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("entries")).select(
        "home", "class", F.ceil(F.greatest(F.col("rows") / BLOCK, F.col("entries") / ENTRIES)).cast("int").alias("splits")), "home_sizes")
    return store(homes.join(sizes, ["home", "class"])
                 .withColumn("split", F.pmod(F.xxhash64("node"), F.col("splits")).cast("int"))
                 .withColumn("block", block_of("home", "class", "split")), "blocks")


def block_of(home, size_class, split):
    return F.xxhash64(*(F.col(c) if isinstance(c, str) else c for c in (home, size_class, split)))


def first_tiles(blocks: DataFrame) -> DataFrame:
    """a, b: each block with itself, and with the next one of its home; a linear number."""
    each = blocks.groupBy("block", "home", "class", "split", "splits").agg(F.count(F.lit(1)).alias("rows"))
    own = each.filter("rows > 1").select(F.col("block").alias("a"), F.col("block").alias("b"))
    beside = each.filter("split + 1 < splits").select(F.col("block").alias("a"), block_of("home", "class", F.col("split") + 1).alias("b"))
    larger = each.filter("split = 0").select(F.col("block").alias("a"), block_of("home", F.col("class") + 1, "split").alias("b"))
    there = each.select(F.col("block").alias("b"))
    return own.union(beside).union(larger.join(there, "b", "left_semi").select("a", "b"))


def other_tiles(live: DataFrame, blocks: DataFrame, done: DataFrame, reached: DataFrame, percent: int) -> DataFrame:
    """a, b: the other pairs of blocks that share enough columns in the leads and aren't connected yet."""
    known = blocks.select("node", "block", "class", "n").join(reached, "node", "left").select(
        "node", "block", "class", "n", F.coalesce("root", "node").alias("root"))
    whole = known.groupBy("block", "class").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("n").alias("n")).select(
        # A block that is not connected in itself has a name of its own.
        "block", "class", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.col("block")).alias("part"),
        least_required("n", percent).alias("need"))
    held = live.select("column", "node").join(blocks.select("node", "block"), "node").select("column", "block").distinct()
    held = store(held.join(store(whole, "parts"), "block"), "held")
    apart = store(held.groupBy("column").agg(F.min("part").alias("low"), F.max("part").alias("high")).filter("low < high").select("column"), "apart")
    held = store(held.join(apart, "column"), "held_apart")
    other = held.select("column", *(F.col(c).alias(f"{c}_b") for c in ("block", "class", "part", "need")))
    pairs = held.join(other, "column").filter(
        (F.col("block") < F.col("block_b")) & (F.abs(F.col("class") - F.col("class_b")) <= 1) & (F.col("part") != F.col("part_b"))
    ).groupBy(F.col("block").alias("a"), F.col("block_b").alias("b")).agg(
        F.count(F.lit(1)).alias("shared"), F.first(F.least("need", "need_b")).alias("need")).filter("shared >= need").select("a", "b")
    done = done.union(done.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return pairs.join(done, ["a", "b"], "left_anti")


def sets_of(docs: DataFrame, blocks: DataFrame, names: DataFrame, size: int) -> DataFrame:
    """block, node, grams (as bytes) of every row in a block, whole. ``names``: node, text_hash of one of its texts."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words({})
        for batch in batches:
            own = [words.grams(text, size)[0] for text in batch.column("text").to_pylist()]
            right = pa.array([name_of(x) == node for x, node in zip(own, batch.column("node").to_pylist())], pa.bool_())
            out = pa.record_batch([batch.column("block"), batch.column("node"), pa.array([x.tobytes() for x in own], pa.binary())],
                                  ["block", "node", "grams"])
            yield out.filter(right)

    wanted = store(blocks.select("node", "block").join(names, "node"), "wanted")
    known = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, "text_hash", MAP_BITS))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(on_map(known.value, batch.column("text_hash").to_numpy())))

    # The map keeps most other texts out of the shuffle, the join the rest.
    texts = docs.select(F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text")).mapInArrow(
        likely, "text_hash long, text string")
    one = texts.join(wanted, "text_hash").groupBy("node", "block").agg(F.min("text").alias("text"))
    return store(one.mapInArrow(make, "block long, node long, grams binary"), "sets")


def accumulated(row: np.ndarray, column: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray,
                hope: np.ndarray, percent: int) -> np.ndarray:
    """Overlaps of the rows ``left`` with the rows ``right``, as far as pairs in ``hope`` still can link.

    row, column: the entries of the tile.
    """
    place = {}
    for side, own in (("a", left), ("b", right)):
        place[side] = np.full(len(sizes), -1)
        place[side][own] = np.arange(len(own))
    need = -(-percent * (sizes[left][:, None] + sizes[right]) // (100 + percent))
    a, b = (np.flatnonzero(place[side][row] >= 0) for side in "ab")
    in_a, in_b = (np.bincount(column[x], minlength=int(column.max(initial=0)) + 1) for x in (a, b))
    dense = in_a * in_b > DENSE
    total = np.zeros((len(left), len(right)), np.int64)
    many = np.flatnonzero(dense)
    for at in range(0, len(many), WIDTH):
        number = np.full(len(dense), -1)
        number[many[at:at + WIDTH]] = np.arange(len(many[at:at + WIDTH]))
        tiles = []
        for side, entries, own in (("a", a, left), ("b", b, right)):
            tile, entries = np.zeros((len(own), len(many[at:at + WIDTH])), np.float32), entries[number[column[entries]] >= 0]
            tile[place[side][row[entries]], number[column[entries]]] = 1
            tiles.append(tile)
        total += np.rint(tiles[0] @ tiles[1].T).astype(np.int64)  # sums of at most WIDTH ones
    # What is left to add to a pair is at most the smaller number of entries that are left.
    a, b = (x[~dense[column[x]]] for x in (a, b))
    rest = [np.bincount(place[side][row[x]], minlength=len(own)) for side, x, own in (("a", a, left), ("b", b, right))]
    hope &= total + np.minimum(rest[0][:, None], rest[1]) >= need
    a = a[hope.any(axis=1)[place["a"][row[a]]]]
    b = b[hope.any(axis=0)[place["b"][row[b]]]]
    if len(a) and len(b):
        b = b[np.argsort(column[b], kind="stable")]
        begin = np.searchsorted(column[b], column[a], "left")
        times = np.searchsorted(column[b], column[a], "right") - begin
        for at in np.array_split(np.arange(len(a)), 1 + int(times.sum()) // (1 << 22)):
            t = times[at]
            ends = np.cumsum(t)
            other = b[np.arange(int(t.sum())) - np.repeat(ends - t, t) + np.repeat(begin[at], t)]
            np.add.at(total, (np.repeat(place["a"][row[a[at]]], t), place["b"][row[other]]), 1)
    return np.where(hope & (total >= need), total, 0)


def tile_links(sets: list[np.ndarray], first: int | None, percent: int) -> list[tuple[int, int]]:
    """Links that connect whatever links in a tile. ``first``: rows of the first block, or None for one block with itself."""
    sizes = np.array([len(x) for x in sets], np.int64)
    every = np.concatenate(sets)
    _, column = np.unique(every, return_inverse=True)
    row = np.repeat(np.arange(len(sets)), sizes)
    second = np.arange(len(sets)) >= (len(sets) if first is None else first)
    while True:
        in_b = np.bincount(column[second[row]], minlength=int(column.max(initial=0)) + 1)
        in_a = np.bincount(column[~second[row]], minlength=len(in_b))
        shared = in_a > 1 if first is None else (in_a > 0) & (in_b > 0)
        good = shared[column]
        # An intersection with any other row has to be ``percent`` of the row's own size.
        able = 100 * np.bincount(row[good], minlength=len(sets)) >= percent * sizes
        good &= able[row]
        if good.all():
            break
        row, column = row[good], column[good]
    if not len(row):
        return []
    rows = np.unique(row)
    left, right = (rows, rows) if first is None else (rows[~second[rows]], rows[second[rows]])
    x, y = sizes[left][:, None], sizes[right]
    hope = 100 * np.minimum(x, y) >= percent * np.maximum(x, y)
    if first is None:
        hope &= left[:, None] != right
    if not hope.any():
        return []
    near = accumulated(row, column, sizes, left, right, hope, percent) > 0
    return [(int(i), int(j)) for i, j in forest(near, left, right)]


def forest(near: np.ndarray, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int]]:
    """Pairs of ``near`` (left rows by right rows) that connect all it connects; each row is reached once."""
    at = {side: {int(r): i for i, r in enumerate(rows)} for side, rows in (("a", left), ("b", right))}
    unseen = set(left.tolist()) | set(right.tolist())
    while unseen:
        queue = deque([unseen.pop()])
        while queue and unseen:
            i = queue.popleft()
            found = set(right[near[at["a"][i]]].tolist()) if i in at["a"] else set()
            if i in at["b"]:
                found |= set(left[near[:, at["b"][i]]].tolist())
            for j in found & unseen:
                unseen.discard(j)
                queue.append(j)
                yield i, j


def multiplied(tiles: DataFrame, sets: DataFrame, percent: int, name: str) -> DataFrame:
    """a, b: links between the rows of the blocks of each tile. Rows of a tile come to one task, a tile at a time."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own = None, []

        def found() -> pa.RecordBatch:
            own.sort(key=lambda x: x[0] != key[0])
            first = None if key[0] == key[1] else sum(block == key[0] for block, _, _ in own)
            pairs = tile_links([grams for _, _, grams in own], first, percent)
            return pa.record_batch([pa.array([own[p[i]][1] for p in pairs], pa.int64()) for i in (0, 1)], ["a", "b"])
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("a", "b", "block", "node", "grams")]
            for a, b, block, node, grams in zip(*columns):
                if (a, b) != key:
                    if key and len(own) > 1:
                        yield found()
                    key, own = (a, b), []
                own.append((block, node, np.frombuffer(grams, np.uint64)))
        if key and len(own) > 1:
            yield found()

    used = tiles.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    return store(used.join(sets, "block").repartition("a", "b").sortWithinPartitions("a", "b")
                 .mapInArrow(make, "a long, b long"), name)


def linked_sets(docs: DataFrame, told: DataFrame, size: int, percent: int) -> DataFrame:
    """node, root, component: the distinct sets that have a link to another one."""
    nodes = store(told.groupBy("node").agg(F.min("doc_id").alias("first"), F.min("text_hash").alias("text_hash"),
                                           F.first("n").alias("n"), F.first("lead").alias("lead")), "nodes")
    names = nodes.select("node", F.coalesce("first", F.lit(NO_ID)).alias("first"))
    live = sharing(nodes, percent)
    blocks = gathered(live, percent)
    sets = sets_of(docs, blocks, nodes.select("node", "text_hash"), size)
    tiles = store(first_tiles(blocks), "first_tiles")
    links = multiplied(tiles, sets, percent, "first_links")
    reached = store(smallest_reachable(links, names), "reached")
    more = store(other_tiles(live, blocks, tiles, reached.select("node", "root"), percent), "other_tiles")
    others = multiplied(more, sets, percent, "other_links")
    if others.isEmpty():
        return reached
    return store(smallest_reachable(links.union(others), names), "reached")


def similar_documents(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles (size of the set) and component_id (the smallest doc_id reachable by links) of every row.

    A document's set is its distinct runs of ``size`` words: words stand between white space, A-Z are
    lower-cased, and a text of fewer words is one run. Two documents link if
    their intersection is at least ``percent`` of their union, which is decided exactly (n-grams are
    known by 64-bit hashes). Equal sets are one row of the product however many documents have them.

    Texts without words, null ones too, have an empty set and link with nothing. A row without
    doc_id links like others but is no component's smallest; a component of only such rows has
    a null component_id. Rows with the same doc_id each have their own set. An empty table
    gives no rows. Other columns are not read.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent has to be over 0 and at most 100")
    prepare(docs.sparkSession)
    told = store(described(docs, size, percent), "described")
    reached = linked_sets(docs, told, size, percent).select("node", F.col("component").alias("linked"))
    alone = store(told.groupBy("node").agg(F.min("doc_id").alias("own")), "equal_sets")
    components = store(alone.join(reached, "node", "left").select(
        "node", F.nullif(F.coalesce("linked", "own"), F.lit(NO_ID)).alias("component")), "set_components")
    return told.select("doc_id", "node", F.col("n").alias("n_shingles")).join(components, "node").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"))
