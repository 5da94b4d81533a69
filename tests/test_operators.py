from __future__ import annotations

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from terracelake import operators as op
from terracelake.functions import date_or_null, double_or_null, first_second, last_second
from terracelake.session import stored


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_cube_count_keeps_null_group_and_total_apart(spark):
    items = spark.createDataFrame(
        [(i,) for i in ["Bread", "Bread", "NONE", "Adjustment", "Tea", None]], "item string")
    got = op.cube_count(items, "item")
    assert got.columns == ["item", "count"]
    assert rows(got) == rows(items.cube("item").count())
    assert got.filter("item IS NULL").count() == 2


def test_cube_count_of_two_columns(spark):
    data = [(a, b) for a in ("x", None) for b in (1, 2, None)] * 2 + [("x", 1)]
    df = spark.createDataFrame(data, "a string, b int")
    assert rows(op.cube_count(df, "a", "b")) == rows(df.cube("a", "b").count())


def test_cube_count_of_nothing(spark):
    df = spark.createDataFrame([], "a string")
    assert rows(op.cube_count(df, "a")) == rows(df.cube("a").count())


def test_not_like_any_rejects_null(spark):
    df = spark.createDataFrame([("NONE",), ("None",), (None,), ("Tea",)], "item string")
    assert rows(df.filter(op.not_like_any("item", ("NONE", "T%")))) == [("None",)]


def test_contains_any_ignores_case_and_takes_signs_literally(spark):
    df = spark.createDataFrame([("a ROBOT",), ("100% sure",), ("1000 sure",), (None,)], "t string")
    assert rows(df.filter(op.contains_any("t", ("Robot", "0% s")))) == [("100% sure",), ("a ROBOT",)]


def test_epoch_bounds_are_whole_seconds_inside_the_range(spark):
    got = spark.range(1).select(
        first_second("2016-01-01 00:00:00"), first_second("2016-01-01 00:00:00.25"),
        last_second("2016-01-01 00:00:00.75")).first()
    assert tuple(got) == (1451606400, 1451606401, 1451606400)


def test_epoch_between_equals_the_text_comparison(spark):
    seconds = spark.range(1451606400 - 3, 1451606400 + 4).withColumnRenamed("id", "s")
    first, last = "2016-01-01 00:00:00", "2016-01-01 00:00:02"
    plain = seconds.filter(f"""from_unixtime(s) >= to_timestamp('{first}')
                               AND from_unixtime(s) <= to_timestamp('{last}')""")
    assert rows(seconds.filter(op.epoch_between("s", first, last))) == rows(plain)


def test_safe_casts(spark):
    df = spark.createDataFrame([("2020-02-30",), ("2020-02-29",), ("1.5",), (None,)], "t string")
    got = [tuple(r) for r in df.select(date_or_null("t").cast("string"), double_or_null("t")).collect()]
    assert got == [(None, None), ("2020-02-29", None), (None, 1.5), (None, None)]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_safe_key_join(spark, how):
    left = spark.createDataFrame([("1",), ("1",), ("bad",), ("2",), (None,), ("9",)], "k string")
    right = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d")], "id bigint, v string")
    got = rows(op.safe_key_join(left, right, "k", "id", how).select("k", "v"))
    matched = [("1", "a"), ("1", "a"), ("1", "b"), ("1", "b"), ("2", "c")]
    unmatched = [("9", None), ("bad", None), (None, None)]
    assert got == sorted(matched + (unmatched if how == "left" else []), key=repr)


def test_fanout_counts_equal_the_joined_rows(spark):
    random.seed(3)
    pick = lambda n: [(random.choice([1, 1, 1, 2, 3, 4, None]),) for _ in range(n)]
    base = spark.createDataFrame(pick(12), "id bigint")
    a, b = (spark.createDataFrame(pick(n), f"{name} bigint") for n, name in ((20, "ka"), (15, "kb")))
    got = op.fanout_counts(base, "id", a=(a, "ka"), b=(b, "kb")).groupBy("id").agg(
        F.sum("joined_rows"), F.sum(F.when(F.col("a_rows") > 0, F.col("joined_rows")).otherwise(0)))
    plain = (base.join(a, base.id == a.ka, "left").join(b, base.id == b.kb, "left")
             .groupBy("id").agg(F.count(F.lit(1)), F.count("ka")))
    assert rows(got) == rows(plain)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_to_unique(spark, how):
    many = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50).cast("bigint").alias("k"),
        F.col("id").alias("v"))
    one = spark.range(5, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    got = op.join_to_unique(many, one, "k", how)
    assert got.columns == ["k", "v", "w"]
    assert rows(got) == rows(many.join(one, "k", how))


@pytest.fixture
def small_limits(spark):
    """Thresholds at which test data counts as large and skewed."""
    conf = {
        "spark.sql.shuffle.partitions": "24",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key in conf:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def hot_keys(spark):
    """A third of the rows has one key."""
    return spark.range(600_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).cast("bigint").alias("k"),
        F.xxhash64("id").alias("v"))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_to_unique_splits_a_hot_key(spark, small_limits, how):
    many = hot_keys(spark)
    one = spark.range(20_000).select((F.col("id") % 5000).alias("k")).groupBy("k").agg(
        F.count(F.lit(1)).alias("w"))
    totals = op.join_to_unique(many, one, "k", how).groupBy((F.col("k") % 10).alias("g")).agg(
        F.sum("w").alias("s"), F.max("v"))
    assert sum(r.s for r in totals.collect()) == 600_000 * 4
    assert "SortMergeJoin(skew=true)" in plan_of(totals)


def test_fanout_counts_splits_a_hot_key(spark, small_limits):
    base = hot_keys(spark)
    a = spark.range(20_000).select((F.col("id") % 5000).alias("ka"))
    b = spark.range(7, 8).select(F.col("id").alias("kb"))
    got = op.fanout_counts(base, "k", a=(a, "ka"), b=(b.union(b), "kb"))
    total = got.agg(F.sum("joined_rows").alias("n"), F.max("v"))
    hot = base.filter("k = 7").count()
    assert total.collect()[0].n == 4 * (600_000 - hot) + 8 * hot
    assert "SortMergeJoin(skew=true)" in plan_of(total)


def test_union_all_keeps_duplicates_and_widens(spark):
    a = spark.createDataFrame([(1, 1), (1, 1)], "a int, b int")
    b = spark.createDataFrame([(1, 2.5)], "x int, y double")
    got = op.union_all([a, b, a])
    assert got.dtypes == [("a", "int"), ("b", "double")]
    assert rows(got) == [(1, 1.0)] * 4 + [(1, 2.5)]


def test_top_k_text_order(spark):
    df = spark.createDataFrame([("9.00",), ("22.50",), ("10,910.00",), (None,)], "v string")
    got = [r.v for r in op.top_k(df, 4, [F.col("v").desc()]).collect()]
    assert got == ["9.00", "22.50", "10,910.00", None]


# ---- ntile


@pytest.fixture(params=["merged", "separate"])
def ranges(spark, request):
    """Adaptive execution merges small ranges into one; here it may not."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(request.param == "merged").lower())
    yield request.param
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plain_ntile(df, k, order):
    return df.withColumn("rank", F.ntile(k).over(Window.orderBy(*order)))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=40), st.integers(1, 12))
def test_ntile_equals_ntile(spark, ranges, values, k):
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int")
    order = [F.col("v").desc(), F.col("id")]
    got = op.ntile(df, k, order)
    assert got.schema["rank"].dataType.simpleString() == "int"
    assert rows(got) == rows(plain_ntile(df, k, order))


@pytest.mark.parametrize("k", [3, 7, 10])
def test_ntile_with_a_hot_value(spark, ranges, k):
    df = spark.range(20_011).select(
        "id", F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") % 1000).alias("v"))
    order = [F.col("v").desc(), F.col("id")]
    got = op.ntile(df, k, order)
    assert rows(got) == rows(plain_ntile(df, k, order))


def test_ntile_of_copies_has_even_buckets_and_ranges(spark, ranges):
    df = spark.range(1000).select(F.lit(1).alias("v"))
    got = op.ntile(df, 3, [F.col("v")], divide_ties=True)
    assert got.columns == ["v", "rank"]
    assert rows(got.groupBy("rank").count()) == [(1, 334), (2, 333), (3, 333)]
    if ranges == "separate":
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) >= 4 and max(sizes) < 600


def test_ntile_never_puts_all_rows_into_one_task(spark):
    df = spark.range(500).select("id", (F.col("id") % 7).alias("v"))
    got = op.ntile(df, 4, [F.col("v").desc(), F.col("id")])
    assert rows(got) == rows(plain_ntile(df, 4, [F.col("v").desc(), F.col("id")]))
    # The only window is over the ranges' totals.
    assert "SinglePartition" not in plan_of(got).split("BroadcastExchange")[0]


def test_wide_text_keys_are_not_broadcast(spark):
    """Few rows, but more bytes than the threshold; a narrow side of as many rows is broadcast."""
    import uuid
    words = F.concat(*(F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 256) for i in range(5)))
    wide = spark.range(60_000).select(words.alias("k"), F.col("id").alias("w"))
    narrow = spark.range(60_000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("w"))
    many = spark.range(1000).select(F.col("id").cast("string").alias("k"), F.lit(uuid.uuid4().hex).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8m")
    try:
        assert "BroadcastHashJoin" not in plan_of(op.join_to_unique(stored(wide, "wide"), wide, "k"))
        assert "BroadcastHashJoin" in plan_of(op.join_to_unique(many, narrow, "k"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_empty_lists(spark):
    df = spark.createDataFrame([("a",), (None,)], "t string")
    assert df.filter(op.contains_any("t", ())).count() == 0 and df.filter(op.not_like_any("t", ())).count() == 2
    with pytest.raises(ValueError):
        op.union_all([])
    with pytest.raises(ValueError):
        op.fanout_counts(df, "t")

def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_safe_key_left_join_splits_the_null_keys(spark, small_limits):
    left = spark.range(600_000).select(
        F.when(F.col("id") % 3 == 0, "bad").otherwise((F.col("id") % 5000).cast("string")).alias("k"),
        F.xxhash64("id").alias("v"))
    right = spark.range(5000).select("id", F.lit(1).alias("w"))
    totals = op.safe_key_join(left, right, "k", "id", "left").agg(F.count("v"), F.sum("w"), F.max("v"))
    assert tuple(totals.collect()[0])[:2] == (600_000, 400_000)
    assert "SortMergeJoin(skew=true)" in plan_of(totals)


def test_plain_left_join_splits_a_hot_key(spark, small_limits):
    many = hot_keys(spark)
    one = spark.range(5000).select(F.col("id").alias("k"), F.lit(1).alias("w"))
    totals = many.join(one, "k", "left").agg(F.sum("w"), F.max("v"))
    assert totals.collect()[0][0] == 600_000
    assert "SortMergeJoin(skew=true)" in plan_of(totals)
