"""A Merkle manifest of a table, and proofs that climb it by a recursive query.

Each row is a leaf. Leaves of one group are ordered, and every sixteen nodes in a row, a run,
become one node of the next level, until one is left: the group's subroot. The subroots, in
the order of their groups, are the leaves of one more tree, whose last node is the root.

Building takes one job per level, on a sixteenth of the level before. A stored run is one row: its
children's hashes, and a link to the run in which its own hash stands and to the place there.
A recursive query then climbs from every leaf along these links. At each step it puts the hash
it carries in its place among the children and hashes the run again, so a hash that has been
tampered with ends in another root. From every lowest run it climbs in the same query and
appends the siblings on the way: the sixteen leaves of a run share all of them but the lowest.

All leaves meet in the last runs. Places of leaves are numbered through the whole table, so a run
covers a stretch of them, and it is stored once for each SPREAD of places that it covers:
no key of the climb's join has more than SPREAD leaves.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terracelake.llm.common import prepare, store

FANOUT = 16
SPREAD_BITS = 16  # SPREAD is 65,536
TOP = -1  # the tree of subroots; other trees are known by the place of their first leaf
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


class Manifest(NamedTuple):
    """leaves: place, group, id, tree, no, size, leaf, held; runs: tree, level, run, low, high, children, hash, size_up, up_tree,
    up_level, up_run, up_at; subroots: tree, hash, nth; root: one hash, or None for an empty table."""

    leaves: DataFrame
    runs: DataFrame
    subroots: DataFrame
    root: str | None


def hash_of(fields: Mapping[str, Column]) -> Column:
    """The leaf of a row: sha256 of its values, each with its number of bytes, or - for null."""
    texts = [value.cast("string") for value in fields.values()]
    return F.sha2(F.concat(*(
        F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts)), 256)


def numbered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds ``place``, from 0 in the given order, by ranges that are stored and the ranges' totals. ``rows`` is stored."""
    ranged = store(rows.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
                   .repartitionByRange(*order, "_tie").withColumn("_range", F.spark_partition_id()), f"{name}_ranges")
    totals = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = store(totals.select("_range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("_before")), f"{name}_starts")
    own = Window.partitionBy("_range").orderBy(*order, "_tie")
    return (ranged.withColumn("_nth", F.row_number().over(own)).join(F.broadcast(starts), "_range")
            .withColumn("place", F.col("_before") + F.col("_nth") - 1).drop("_tie", "_range", "_nth", "_before"))


def levels(nodes: DataFrame, name: str) -> tuple[DataFrame | None, DataFrame]:
    """Runs of all levels (None if no tree has two nodes), and the last node of each tree.

    ``nodes``: tree, no, size (nodes of the tree on this level), hash, low, high (first and last place below).
    """
    columns = ["tree", "no", "size", "hash", "low", "high"]
    level, runs, last, nodes = 0, None, None, store(nodes.select(*columns), f"{name}_nodes")
    while True:
        done = nodes.filter("size = 1").select(*columns)
        last = done if last is None else last.union(done)
        more = nodes.filter("size > 1")
        if more.isEmpty():
            return runs, store(last, f"{name}_last")
        made = store(
            more.groupBy("tree", F.expr(f"no div {FANOUT}").alias("run"))
            .agg(F.array_sort(F.collect_list(F.struct("no", "hash"))).alias("own"), F.min("low").alias("low"),
                 F.max("high").alias("high"), F.first("size").alias("size"))
            .select("tree", F.lit(level).alias("level"), "run", "low", "high", F.transform("own", lambda x: x["hash"]).alias("children"),
                    F.expr(f"(size + {FANOUT - 1}) div {FANOUT}").alias("size_up"))
            .withColumn("hash", F.sha2(F.array_join("children", ""), 256)), f"{name}_runs")
        runs = made if runs is None else runs.union(made)
        nodes = made.select("tree", F.col("run").alias("no"), F.col("size_up").alias("size"), "hash", "low", "high")
        level += 1


def build(docs: DataFrame, fields: Mapping[str, Column], group: str, order: str, held: Mapping[str, Column] | None = None) -> Manifest:
    """``fields``: what a leaf is made of. ``group`` and ``order``: the columns that say which tree a row is in and where.

    ``held``: fields of which another party holds other values; their hash comes beside the leaf.
    """
    plain = store(docs.select(
        F.col(group).isNotNull().alias("known"), F.coalesce(F.col(group).cast("string"), F.lit("")).alias("group"),
        F.col(order).alias("id"), hash_of(fields).alias("leaf"), hash_of({**fields, **(held or {})}).alias("held")), "leaf_hashes")
    placed = store(numbered(plain, ["known", "group", "id", "leaf"], "leaves"), "placed_leaves")
    trees = store(placed.groupBy("known", "group").agg(F.min("place").alias("tree"), F.count(F.lit(1)).alias("size")), "trees")
    leaves = store(placed.join(trees, ["known", "group"]).select(
        "place", F.when(F.col("known"), F.col("group")).alias("group"), "id", "tree", (F.col("place") - F.col("tree")).alias("no"), "size",
        "leaf", "held"), "leaves")
    runs, last = levels(leaves.select("tree", "no", "size", F.col("leaf").alias("hash"), F.col("place").alias("low"), F.col("place").alias("high")), "group")
    subroots = store(numbered(last.select("tree", "hash", "low", "high"), ["tree"], "subroots").withColumnRenamed("place", "nth"), "subroots")
    groups = subroots.count()
    top = subroots.select(F.lit(TOP).cast("long").alias("tree"), F.col("nth").alias("no"), F.lit(groups).cast("long").alias("size"),
                          "hash", "low", "high")
    top_runs, root = levels(top, "top")
    every = [r for r in (runs, top_runs) if r is not None]
    hashes = root.select("hash").collect()  # one row at most
    empty = leaves.select("tree", F.lit(0).alias("level"), F.col("no").alias("run"), "place", "place", F.array("leaf"), "size", "leaf").limit(0)
    whole = every[0].unionByName(every[1]) if len(every) == 2 else every[0] if every else empty.toDF(
        "tree", "level", "run", "low", "high", "children", "size_up", "hash")
    linked = store(linked_up(whole.withColumnRenamed("run", "no").withColumn("next", F.col("level") + 1), subroots, groups)
                   .withColumnRenamed("no", "run").drop("next"), "runs")
    return Manifest(leaves, linked, subroots, hashes[0]["hash"] if hashes else None)


def linked_up(nodes: DataFrame, subroots: DataFrame, groups: int) -> DataFrame:
    """Adds up_tree, up_level, up_run and up_at: the run a node stands in and its place there; null for the root.

    ``nodes``: tree, no, size_up (nodes of its tree on its level ``next``) and other columns.
    """
    inner = F.col("size_up") > 1
    kept = nodes.filter(inner).select(
        "*", F.col("tree").alias("up_tree"), F.col("next").alias("up_level"), F.expr(f"no div {FANOUT}").alias("up_run"),
        F.expr(f"CAST(no % {FANOUT} AS INT)").alias("up_at"))
    # The last node of a group's tree stands in the tree of subroots, unless it is the only one.
    places = subroots.select("tree", "nth")
    above = F.lit(groups > 1) & F.col("nth").isNotNull()
    crossing = nodes.filter(~inner).join(places, "tree", "left").select(
        *(F.col(c) for c in nodes.columns), F.when(above, F.lit(TOP).cast("long")).alias("up_tree"), F.when(above, F.lit(0)).alias("up_level"),
        F.when(above, F.expr(f"nth div {FANOUT}")).alias("up_run"), F.when(above, F.expr(f"CAST(nth % {FANOUT} AS INT)")).alias("up_at"))
    return kept.unionByName(crossing)


@contextmanager
def any_number_of_rows(spark: SparkSession) -> Iterator[None]:
    """Spark ends recursive queries at a million rows unless told otherwise."""
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def climbed(starts: DataFrame, runs: DataFrame) -> DataFrame:
    """place, folded, siblings of every start when it has come to the root, stored.

    ``starts``: place, up_tree, up_level, up_run, up_at, and folded (the hash carried) or siblings (what is
    appended to); whichever is null stays null.
    """
    spark = starts.sparkSession
    spread = runs.withColumn("stretch", F.explode(F.expr(f"sequence(shiftright(low, {SPREAD_BITS}), shiftright(high, {SPREAD_BITS}))"))).select(
        "tree", "level", "run", "stretch", "children", "up_tree", "up_level", "up_run", "up_at")
    starts = starts.select("place", "up_tree", "up_level", "up_run", "up_at", "folded", "siblings")
    with any_number_of_rows(spark):
        return store(spark.sql(f"""
            WITH RECURSIVE climb(place, tree, level, run, at, folded, siblings) AS (
              SELECT place, up_tree, up_level, up_run, up_at, folded, siblings FROM {{starts}}
              UNION ALL
              SELECT c.place, r.up_tree, r.up_level, r.up_run, r.up_at,
                     if(c.folded IS NULL, NULL, sha2(array_join(transform(r.children, (x, i) -> if(i = c.at, c.folded, x)), ''), 256)),
                     if(c.siblings IS NULL, NULL, concat(c.siblings, array_join(filter(r.children, (x, i) -> i <> c.at), '')))
              FROM climb c JOIN {{runs}} r
                ON r.tree = c.tree AND r.level = c.level AND r.run = c.run AND r.stretch = shiftright(c.place, {SPREAD_BITS}))
            SELECT place, folded, siblings FROM climb WHERE tree IS NULL""", starts=starts, runs=store(spread, "spread_runs")), "climbed")


def proven(manifest: Manifest) -> DataFrame:
    """place, group, id, leaf, subroot, proof_sha256 and folded_root of every leaf of a manifest.

    folded_root is what ``held`` becomes with the leaf's original siblings; proof_sha256 is the hash of
    these siblings, level by level, left to right.
    """
    leaves, runs, subroots, _ = manifest
    linked = store(linked_up(leaves.withColumn("size_up", F.col("size")).withColumn("next", F.lit(0)), subroots, subroots.count()), "linked_leaves")
    none, empty = F.lit(None).cast("string"), F.lit("")
    # A group of one leaf has no lowest run: the leaf itself appends.
    lowest = runs.filter((F.col("level") == 0) & (F.col("tree") != TOP))
    links = ["up_tree", "up_level", "up_run", "up_at"]
    starts = (
        linked.select("place", *links, F.col("held").alias("folded"), F.when(F.col("size") == 1, empty).alias("siblings"))
        .unionByName(lowest.select(F.col("low").alias("place"), *links, none.alias("folded"), empty.alias("siblings"))))
    top = climbed(starts, runs)
    folded = top.filter("folded IS NOT NULL").select("place", "folded", F.col("siblings").alias("own_siblings"))
    appended = top.filter("folded IS NULL").select(F.col("place").alias("low"), "siblings")
    above = store(lowest.join(appended, "low").select("tree", F.col("run").alias("low_run"), "children", "siblings"), "lowest_runs")
    own = F.array_join(F.filter("children", lambda x, i: i != F.col("no") % FANOUT), "")
    return (
        leaves.withColumn("low_run", F.expr(f"no div {FANOUT}"))
        .join(above, ["tree", "low_run"], "left").withColumn("proof_sha256", F.sha2(F.concat(own, F.col("siblings")), 256))
        .select("place", "group", "id", "tree", "leaf", "proof_sha256")
        .join(folded, "place").join(subroots.select("tree", F.col("hash").alias("subroot")), "tree")
        .select("place", "group", "id", "leaf", "subroot", F.coalesce("proof_sha256", F.sha2("own_siblings", 256)).alias("proof_sha256"),
                F.col("folded").alias("folded_root"))
    )


def verified_manifest(docs: DataFrame, tampered: Mapping[str, Column] | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified (it equals root) of every row of ``docs``.

    Leaves are made of FIELDS, trees are those of a source, in the order of doc_id. ``tampered`` has
    fields (columns of FIELDS) as another party holds them: folded_root is what they lead to.

    Nulls have a form of their own in a leaf, unlike any text. Rows without source are the first tree, and
    rows without doc_id the first of their tree. Rows with the same source and doc_id are ordered by
    their leaves; equal rows are leaves of their own, side by side. An empty table gives
    no rows. Other columns are not read.
    """
    prepare(docs.sparkSession)
    manifest = build(docs, {c: F.col(c) for c in FIELDS}, "source", "doc_id", tampered)
    return proven(manifest).select(
        F.col("id").cast("long").alias("doc_id"), "leaf", "subroot", F.lit(manifest.root).alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == F.lit(manifest.root)).alias("verified"))
