"""What reaches the scan, and which physical operators are chosen."""

from __future__ import annotations

import re
from types import SimpleNamespace

import pytest

import workload.operators  # noqa: F401  (registers its queries)
from tests.oracle import connect
from workload.registry import ORACLE_SQL, QUERIES
from pyspark.sql import functions as F

from terracelake import operators as op
from terracelake import session
from terracelake.config import RatingBuckets
from terracelake.plans import item_sales, movie_choices, rating_buckets
from workload import jobs
from workload.registry import table
from workload.storage import scan_csv, tagged_files

FOLDER = "/root/testdata/sf0.01"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_item_sales_filters_in_the_scan_and_expands_nothing(spark):
    plan = plan_of(jobs.item_sales(spark, FOLDER))
    assert "Not(EqualTo(event_type,error))" in plan and "Expand" not in plan
    assert "ReadSchema: struct<event_type:string>" in plan


def test_item_sales_equals_the_filtered_cube(spark):
    events = table(spark, FOLDER, "events")
    cube = (events.cube("event_type").count().filter("event_type NOT LIKE 'error'")
            .orderBy(["count", "event_type"], ascending=[False, True]))
    assert item_sales.build(events, "event_type", ("error",)).collect() == cube.collect()


def test_cube_count_expands_groups_not_rows(spark):
    plan = plan_of(op.cube_count(table(spark, FOLDER, "events"), "event_type"))
    assert re.search(r"Expand .*\n.*HashAggregate", plan)


@pytest.mark.parametrize("kind", ["bigint", "int"])
def test_epoch_range_is_pushed(spark, tmp_path, kind):
    spark.range(10).select(F.col("id").cast(kind).alias("timestamp")).write.parquet(f"{tmp_path}/t")
    plan = plan_of(spark.read.parquet(f"{tmp_path}/t").filter(
        op.epoch_between("timestamp", "2016-01-01 00:00:00", "2016-12-31 23:59:59")))
    assert "GreaterThanOrEqual(timestamp,1451606400)" in plan
    assert "LessThanOrEqual(timestamp,148" in plan  # the plan text is cut off


def test_volatility_dates_reach_the_time_column(spark):
    plan = plan_of(jobs.top_volatility(spark, FOLDER))
    assert "GreaterThanOrEqual(ts,2024-01-03T00:00)" in plan and "In(event_type" in plan
    assert "TakeOrderedAndProject" in plan


def test_ratings_are_shuffled_as_totals_per_film(spark):
    inputs = jobs.choice_inputs(spark, FOLDER)
    matches = movie_choices.matching_films(inputs["keywords"], inputs["cast"], jobs.CHOICES)
    scores = movie_choices.film_scores(inputs["ratings"], matches)
    plan = plan_of(movie_choices.pick_totals(inputs["movies"], scores))
    # Totals per film of three tables, and totals per title.
    assert len(re.findall(r"Exchange hashpartitioning.*\n.*HashAggregate\(.*partial_", plan)) == 4
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan


def test_ratings_are_totalled_before_any_shuffle(spark):
    totals = rating_buckets.rating_totals(**jobs.bucket_inputs(spark, FOLDER), params=jobs.BUCKETS)
    plan = plan_of(totals)
    for exchange in re.finditer(r"Exchange hashpartitioning\(.*\n.*", plan):
        assert "HashAggregate" in exchange.group() or "ExistingRDD" in exchange.group()


def test_outer_join_becomes_inner(spark):
    orders, lines = table(spark, FOLDER, "orders"), table(spark, FOLDER, "lineitem")
    joined = orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").filter("l_quantity > 45")
    assert "Inner" in plan_of(joined) and "LeftOuter" not in plan_of(joined)


def test_text_is_lower_cased_once_for_all_words(spark):
    plan = plan_of(table(spark, FOLDER, "documents").filter(op.contains_any("text", ("tion", "und", "que"))))
    condition = re.search(r"Filter .*", plan).group()
    assert condition.count("lower(text") == 1 and condition.count("Contains(") == 3


def test_tagged_files_are_one_scan(spark):
    plan = plan_of(tagged_files(spark, FOLDER))
    assert plan.count("FileScan csv") == 1 and "Exchange" not in plan


def test_scan_csv_reads_text(spark):
    assert "FileScan csv" in plan_of(scan_csv(spark, FOLDER))


def test_rating_range_defaults_to_one_year():
    assert (RatingBuckets().start, RatingBuckets().end) == ("2016-01-01 00:00:00", "2016-12-31 23:59:59")


def test_session_has_fixed_semantics(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def fake_session(master, conf=None, checkpoint=None):
    context = SimpleNamespace(master=master, folder=checkpoint)
    context.getCheckpointDir = lambda: context.folder
    context.setCheckpointDir = lambda folder: setattr(context, "folder", folder)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=(conf or {}).get))


def test_shared_dir_is_the_one_the_cluster_names():
    spark = fake_session("yarn", {"spark.checkpoint.dir": "hdfs://c/shared/"})
    assert session.shared_dir(spark) == "hdfs://c/shared"
    assert spark.sparkContext.folder == "hdfs://c/shared/"
    assert session.shared_dir(fake_session("yarn", checkpoint="hdfs://c/x")) == "hdfs://c/x"


def test_shared_dir_is_never_local_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(fake_session("yarn"))


def test_hive_support_is_asked_for(monkeypatch):
    """With a stand-in builder: whether a metastore answers is not checked here."""
    asked = []

    class Builder:
        def __getattr__(self, name):
            def call(*args):
                asked.append((name, *args))
                return "session" if name == "getOrCreate" else self
            return call

    monkeypatch.setattr(session, "SparkSession", SimpleNamespace(builder=Builder()))
    assert session.get_session("t", hive=True) == "session" and ("enableHiveSupport",) in asked
    asked.clear()
    session.get_session("t")
    assert ("enableHiveSupport",) not in asked


ORDERED = ("item_sales", "movie_choices", "sort_mixed", "topk_text", "topk_numeric")


@pytest.mark.parametrize("key", ORDERED)
def test_rows_come_in_the_order_of_the_sql(spark, key):
    ours = QUERIES[key](spark, FOLDER)
    theirs = connect(FOLDER).sql(ORACLE_SQL[key]).to_arrow_table()
    assert [tuple(r) for r in ours.select(*theirs.column_names).collect()] == list(zip(*(theirs.column(c).to_pylist() for c in theirs.column_names)))


def test_scratch_is_cleared(spark):
    one = session.stored(spark.range(3), "one")
    assert one.count() == 3
    path = session.scratch_path(spark, "two")
    assert spark.sparkContext.applicationId in path
