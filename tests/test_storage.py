from __future__ import annotations

import shutil
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from terracelake import sinks, sources
from terracelake.cli import main
from terracelake.config import MOVIE_TABLES, Locations
from terracelake.operators import union_all
from terracelake.plans import convert, item_sales
from terracelake.session import scratch_path, shared_dir
from tests import fixtures


def rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def part_files(folder, suffix):
    return sorted(Path(folder).rglob(f"part-*{suffix}"))


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


# ---- CSV sources


QUOTED = 'id,kw\n1,"a, ""b"" c"\n2,"d\ne"\n3,"x"\n'


def test_csv_default_reads_line_by_line(spark, tmp_path):
    write(tmp_path / "q.csv", QUOTED)
    got = sources.read_csv(spark, str(tmp_path / "q.csv"))
    assert got.count() == 4 and dict(got.dtypes)["id"] == "string"


def test_csv_quoted_text(spark, tmp_path):
    write(tmp_path / "q.csv", QUOTED)
    got = sources.read_csv(spark, str(tmp_path / "q.csv"), quoted_text=True)
    assert dict(got.dtypes)["id"] == "int"
    assert rows(got) == [(1, 'a, "b" c'), (2, "d\ne"), (3, "x")]


def test_csv_with_schema_is_not_inferred(spark, tmp_path):
    write(tmp_path / "t.csv", "a,b\n1,2020-01-01\n,x\n")
    got = sources.read_csv(spark, str(tmp_path / "t.csv"), "a string, b string")
    assert rows(got) == [("1", "2020-01-01"), (None, "x")]
    inferred = sources.read_csv(spark, str(tmp_path / "t.csv"))
    assert inferred.dtypes == [("a", "int"), ("b", "string")]


def write_stocks(folder):
    write(folder / "AAPL.csv", "date,open,high,low,close\n2017-01-03,1,12,9,10\n2017-01-04,1,11,10,10\n")
    write(folder / "IBM.csv", "date,open,high,low,close\n2017-01-03,1.5,100.5,99,100\n")
    write(folder / "B+K A.csv", "date,open,high,low,close\n2018-12-31,1,2,1,0\n")


STOCK_NAMES = ["AAPL", "IBM", "B+K A"]


def test_tagged_csv_equals_the_union_of_files(spark, tmp_path):
    write_stocks(tmp_path)
    one_scan = sources.read_tagged_csv(spark, str(tmp_path), STOCK_NAMES, "symbol")
    union = union_all(
        sources.read_csv(spark, str(tmp_path / f"{name}.csv")).withColumn("symbol", F.lit(name.lower()))
        for name in STOCK_NAMES)
    assert one_scan.dtypes == union.dtypes
    assert rows(one_scan) == rows(union) and one_scan.count() == 4
    plan = one_scan._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Union" not in plan


def test_tagged_csv_takes_folders_of_part_files(spark, tmp_path):
    for name in ("ONE", "ONE.MORE"):
        spark.range(10).write.option("header", True).csv(str(tmp_path / f"{name}.csv"))
    got = sources.read_tagged_csv(spark, str(tmp_path), ["ONE", "ONE.MORE"], "tag")
    assert rows(got.groupBy("tag").count()) == [("one", 10), ("one.more", 10)]


def test_tagged_csv_refuses_ambiguous_names(spark, tmp_path):
    with pytest.raises(ValueError, match="csv"):
        sources.read_tagged_csv(spark, str(tmp_path), ["a.csv.b"], "tag")
    with pytest.raises(ValueError, match="csv"):
        sources.read_tagged_csv(spark, "/data/all.csv/", ["a"], "tag")


# ---- sinks


def test_single_csv_is_one_ordered_file(spark, tmp_path):
    df = spark.range(1000).repartition(7).select(F.col("id").alias("n"), F.lit("x|y").alias("t"))
    sinks.write_csv(df, str(tmp_path), [F.col("n").desc()])
    (file,) = part_files(tmp_path, ".csv")
    lines = file.read_text().splitlines()
    assert lines[0] == "n|t" and lines[1] == '999|"x|y"' and len(lines) == 1001
    assert [int(line.split("|")[0]) for line in lines[1:]] == list(range(999, -1, -1))


def test_csv_in_parts_is_whole_and_ordered_by_file(spark, tmp_path):
    df = spark.range(1000).repartition(7).select(F.col("id").alias("n"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_csv(df, str(tmp_path), [F.col("n").asc()], single_file=False)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = part_files(tmp_path, ".csv")
    values = [int(line) for file in files for line in file.read_text().splitlines()[1:]]
    assert len(files) > 1 and values == list(range(1000))


def test_publish_writes_both_formats_and_overwrites(spark, tmp_path):
    for _ in range(2):
        sinks.publish(item_sales.build(fixtures.bakery(spark)), str(tmp_path), item_sales.order())
    (file,) = part_files(tmp_path / "csv", ".csv")
    assert file.read_text() == "item|count\nBread|2\nTea|1\n"
    assert rows(spark.read.parquet(str(tmp_path / "parquet"))) == [("Bread", 2), ("Tea", 1)]


def test_publish_of_an_empty_result_has_a_header(spark, tmp_path):
    sinks.publish(spark.createDataFrame([], "item string, count bigint"), str(tmp_path))
    (file,) = part_files(tmp_path / "csv", ".csv")
    assert file.read_text().strip() in ("item|count", "")
    assert spark.read.parquet(str(tmp_path / "parquet")).count() == 0


def test_partitioned_sink_has_one_file_per_small_key(spark, tmp_path):
    df = spark.range(3000).repartition(6).select("id", F.concat(F.lit("s"), F.col("id") % 5).alias("symbol"))
    sinks.write_partitioned(df, str(tmp_path), "symbol")
    assert sorted(p.name for p in tmp_path.iterdir() if p.is_dir()) == [f"symbol=s{n}" for n in range(5)]
    assert len(part_files(tmp_path, ".parquet")) == 5
    got = spark.read.parquet(str(tmp_path))
    assert got.columns == ["id", "symbol"] and rows(got) == rows(df)


def test_partitioned_sink_splits_a_large_key(spark, tmp_path):
    """A third of the rows has one key; its rows are written by several tasks."""
    df = spark.range(600_000).repartition(6).select(
        "id", F.uuid().alias("t"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("symbol"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        sinks.write_partitioned(df, str(tmp_path), "symbol")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    assert len(part_files(tmp_path / "symbol=hot", ".parquet")) > 2
    assert spark.read.parquet(str(tmp_path)).count() == 600_000


def test_partition_overwrite_modes(spark, tmp_path):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "n int, s string")
    second = spark.createDataFrame([(3, "b")], "n int, s string")
    for keep, expected in ((False, [(3, "b")]), (True, [(1, "a"), (3, "b")])):
        path = str(tmp_path / str(keep))
        sinks.write_partitioned(first, path, "s")
        sinks.write_partitioned(second, path, "s", keep_others=keep)
        assert rows(spark.read.parquet(path)) == expected


def test_partition_and_date_filters_reach_the_scan(spark, tmp_path):
    from terracelake.plans import top_volatility
    sinks.write_partitioned(fixtures.stocks(spark), str(tmp_path), "symbol")
    plan = top_volatility.build(spark.read.parquet(str(tmp_path)))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [symbol" in plan and "symbol#" in plan.split("PartitionFilters")[1].split("]")[0]
    assert "GreaterThanOrEqual(date,2017-01-01)" in plan and "TakeOrderedAndProject" in plan


# ---- conversions


def test_convert_many(spark, tmp_path):
    for n, name in enumerate(("a", "b", "c")):
        write(tmp_path / f"raw/{name}.csv", "x,y\n" + f"{n},t\n" * (n + 1))
    convert.convert_many(spark, str(tmp_path / "raw"), str(tmp_path / "out"), ["a", "b", "c"],
                         schemas={"b": "x string, y string"})
    got = {name: spark.read.parquet(str(tmp_path / "out" / name)) for name in "abc"}
    assert {name: df.count() for name, df in got.items()} == {"a": 1, "b": 2, "c": 3}
    assert got["a"].dtypes[0] == ("x", "int") and got["b"].dtypes[0] == ("x", "string")


def test_convert_many_reports_a_missing_input(spark, tmp_path):
    write(tmp_path / "a.csv", "x\n1\n")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        convert.convert_many(spark, str(tmp_path), str(tmp_path / "out"), ["a", "missing"])


def test_convert_partitioned(spark, tmp_path):
    write_stocks(tmp_path / "raw")
    convert.convert_partitioned(spark, str(tmp_path / "raw"), str(tmp_path / "out"), STOCK_NAMES, "symbol")
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.columns == ["date", "open", "high", "low", "close", "symbol"]
    assert dict(got.dtypes)["date"] == "date" and dict(got.dtypes)["high"] == "double"
    assert rows(got.select("symbol", "high")) == [("aapl", 11.0), ("aapl", 12.0), ("b+k a", 2.0), ("ibm", 100.5)]


# ---- catalog


@pytest.fixture
def database(spark, tmp_path):
    name = f"lake_{tmp_path.name.replace('-', '_')}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/database'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_register_parquet_folders(spark, tmp_path, database):
    root = tmp_path / "silver"
    spark.range(5).write.parquet(str(root / "plain"))
    spark.range(6).write.parquet(str(root / "group/inner"))
    sinks.write_partitioned(fixtures.stocks(spark), str(root / "stocks"), "symbol")
    names = sources.register_tables(spark, str(root), database, "processed_")
    assert names == [f"{database}.processed_{n}" for n in ("inner", "plain", "stocks")]
    assert [spark.table(n).count() for n in names] == [6, 5, 5]
    assert spark.sql(f"SHOW PARTITIONS {names[2]}").count() == 2
    assert spark.table(names[2]).columns[-1] == "symbol"


def test_register_again_after_changes(spark, tmp_path, database, caplog):
    root = tmp_path / "silver"
    data = root / "t"
    spark.range(2).write.parquet(str(data))
    spark.range(1).write.parquet(str(root / "gone"))
    sinks.write_partitioned(fixtures.stocks(spark), str(root / "stocks"), "symbol")
    register = lambda folder: sources.register_tables(spark, str(folder), database, "p_")
    register(root)

    spark.range(2, 4).withColumn("extra", F.lit("new")).write.mode("append").parquet(str(data))
    fixtures.stocks(spark).withColumn("symbol", F.lit("xom")).write.mode("append").partitionBy("symbol").parquet(
        str(root / "stocks"))
    register(root)
    assert rows(spark.table(f"{database}.p_t")) == [(0, None), (1, None), (2, "new"), (3, "new")]
    assert spark.sql(f"SHOW PARTITIONS {database}.p_stocks").count() == 3
    assert spark.table(f"{database}.p_stocks").count() == 10

    # Another root without these folders: the tables stay, and that is logged.
    spark.range(1).write.parquet(str(tmp_path / "other/u"))
    register(tmp_path / "other")
    assert spark.catalog.tableExists(f"{database}.p_gone")
    assert "p_gone" in caplog.text


def test_only_new_partitions_are_added(spark, tmp_path, database, monkeypatch, caplog):
    from terracelake.sources import catalog
    monkeypatch.setattr(catalog, "BATCH", 2)
    data = tmp_path / "silver/t"
    values = [(0, 1, "a"), (1, 1, "b/c = 'd'"), (2, 2, "a"), (3, None, "é"), (4, 3, None)]
    kinds = "n int, y int, k string"
    spark.createDataFrame(values, kinds).write.partitionBy("y", "k").parquet(str(data))
    (name,) = register(spark, tmp_path / "silver", database)
    assert sorted(rows(spark.table(name)), key=repr) == sorted(values, key=repr)

    told = []
    real = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **b: (told.append(text), real(self, text, *a, **b))[1])
    added = lambda: sum(t.count("PARTITION (") for t in told if " ADD IF NOT EXISTS" in t)
    register(spark, tmp_path / "silver", database)
    assert added() == 0 and sources.add_new_partitions(spark, name) == 0
    more = [(5, 2, "new"), (6, 2, "x"), (7, 9, "new"), (8, 1, "a")]
    spark.createDataFrame(more, kinds).write.mode("append").partitionBy("y", "k").parquet(str(data))
    (data / "y=2/other=1").mkdir()
    (data / "y=07/k=q").mkdir(parents=True)
    register(spark, tmp_path / "silver", database)
    assert added() == 4 and sum(" ADD IF NOT EXISTS" in t for t in told) == 2
    assert sources.add_new_partitions(spark, name) == 0
    assert sorted(rows(spark.table(name)), key=repr) == sorted(values + more, key=repr)

    shutil.rmtree(data / "y=9")
    assert sources.add_new_partitions(spark, name) == 0 and "have gone" in caplog.text
    assert spark.sql(f"SHOW PARTITIONS {name}").count() == 9


def test_partitions_move_with_their_table(spark, tmp_path, database):
    for folder, extra in (("one", 0), ("two", 10)):
        spark.range(extra, extra + 4).withColumn("k", F.col("id") % 2).write.partitionBy("k").parquet(str(tmp_path / folder / "t"))
    (name,) = register(spark, tmp_path / "one", database)
    register(spark, tmp_path / "two", database, move=True)
    assert sorted(r.id for r in spark.table(name).collect()) == [10, 11, 12, 13]


def failing(spark):
    """Rows of which the last can't be made."""
    return spark.range(0, 4000, 1, 8).select(F.col("id"), (F.col("id") % 3).alias("k"), F.expr("if(id = 3999, raise_error('no'), 'x')").alias("t"))


@pytest.mark.parametrize("write", [
    lambda df, path: sinks.write_parquet(df, path), lambda df, path: sinks.write_partitioned(df, path, "k"),
    lambda df, path: sinks.write_partitioned(df, path, "k", keep_others=True),
    lambda df, path: sinks.write_csv(df, path), lambda df, path: sinks.write_csv(df, path, single_file=False),
    lambda df, path: sinks.publish(df, path), lambda df, path: sinks.publish(df, path, hidden=["k"]),
])
def test_a_failing_task_leaves_the_old_rows(spark, tmp_path, write):
    path = str(tmp_path / "layer/t")
    with pytest.raises(Exception, match="no"):
        write(failing(spark), path)
    assert not any(p.is_file() and not p.name.startswith((".", "_")) for p in tmp_path.rglob("*"))
    write(failing(spark).filter("id < 500"), path)

    def held():
        return {str(p): p.read_bytes() for p in tmp_path.rglob("*") if p.is_file() and not p.name.startswith((".", "_"))}
    before = held()
    with pytest.raises(Exception, match="no"):
        write(failing(spark), path)
    assert held() == before and before
    write(failing(spark).filter("id < 20"), path)
    assert 0 < len(held()) and held() != before
    assert [p for p in tmp_path.rglob(".*") if p.is_dir()] == []


def test_folders_that_cannot_be_moved_come_back(spark, tmp_path, monkeypatch):
    from terracelake.sinks import swap
    paths = [str(tmp_path / name) for name in ("a", "b", "c")]
    for path in paths[:2]:
        spark.range(3).write.parquet(path)
    real, moves = swap._move, []

    def broken(files, source, target):
        moves.append(target.getName())
        if moves.count("b") == 1 and target.getName() == "b":
            raise OSError("no room")
        real(files, source, target)
    monkeypatch.setattr(swap, "_move", broken)
    with pytest.raises(OSError, match="no room"):
        with swap.replaced(spark, *paths) as new:
            for folder in new:
                spark.range(9).write.parquet(folder)
    assert [spark.read.parquet(path).count() for path in paths[:2]] == [3, 3]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["a", "b"]


def test_register_updates_changed_types_and_keeps_gone_columns(spark, tmp_path, database):
    data = str(tmp_path / "silver/t")
    spark.createDataFrame([(1, "x")], "n int, old string").write.parquet(data)
    sources.register_tables(spark, str(tmp_path / "silver"), database, "p_")
    spark.createDataFrame([(5_000_000_000,)], "n bigint").write.mode("overwrite").parquet(data)
    sources.register_tables(spark, str(tmp_path / "silver"), database, "p_")
    table = spark.table(f"{database}.p_t")
    assert table.dtypes == [("n", "bigint"), ("old", "string")]
    assert rows(table) == [(5_000_000_000, None)]


def test_register_updates_changed_types_of_a_partitioned_table(spark, tmp_path, database):
    data = str(tmp_path / "silver/my-stocks")
    stocks = fixtures.stocks(spark)
    sinks.write_partitioned(stocks, data, "symbol")
    (name,) = sources.register_tables(spark, str(tmp_path / "silver"), database, "p_")
    assert name == f"{database}.p_my_stocks"
    changed = stocks.withColumn("close", F.col("close").cast("int")).withColumn("volume", F.lit(5))
    sinks.write_partitioned(changed, data, "symbol")
    sources.register_tables(spark, str(tmp_path / "silver"), database, "p_")
    table = spark.table(name)
    assert table.columns == ["date", "high", "low", "close", "volume", "symbol"]
    assert dict(table.dtypes)["close"] == "int"
    assert rows(table) == rows(changed.select(table.columns))
    assert "PartitionFilters: [isnotnull(symbol" in (
        table.filter("symbol = 'ibm'")._jdf.queryExecution().executedPlan().toString())


def register(spark, root, database, **options):
    return sources.register_tables(spark, str(root), database, "p_", **options)


def test_register_keeps_the_old_table_if_the_new_one_fails(spark, tmp_path, database, monkeypatch):
    data = str(tmp_path / "silver/t")
    spark.createDataFrame([((1,),)], "s struct<`a-b`:int>").write.parquet(data)
    register(spark, tmp_path / "silver", database)
    spark.createDataFrame([((5_000_000_000,), 1)], "s struct<`a-b`:bigint>, n int").write.mode("overwrite").parquet(data)
    real = type(spark.catalog).createTable
    monkeypatch.setattr(type(spark.catalog), "createTable", lambda *a, **b: 1 / 0)
    with pytest.raises(RuntimeError, match="division"):
        register(spark, tmp_path / "silver", database)
    assert spark.catalog.tableExists(f"{database}.p_t")
    monkeypatch.setattr(type(spark.catalog), "createTable", real)
    register(spark, tmp_path / "silver", database)
    assert rows(spark.table(f"{database}.p_t").select(F.col("s")["a-b"], "n")) == [(5_000_000_000, 1)]
    assert [t.name for t in spark.catalog.listTables(database)] == ["p_t"]


def test_register_leaves_managed_tables_alone(spark, tmp_path, database):
    spark.range(4).write.saveAsTable(f"{database}.p_t")
    spark.range(2).write.parquet(str(tmp_path / "silver/t"))
    spark.range(3).write.parquet(str(tmp_path / "silver/u"))
    with pytest.raises(RuntimeError, match="managed"):
        register(spark, tmp_path / "silver", database)
    assert spark.table(f"{database}.p_t").count() == 4 and spark.table(f"{database}.p_u").count() == 3


def test_register_follows_moved_data_if_told_to(spark, tmp_path, database):
    spark.range(3).write.parquet(str(tmp_path / "a/t"))
    spark.range(50).write.parquet(str(tmp_path / "b/t"))
    register(spark, tmp_path / "a", database)
    with pytest.raises(RuntimeError, match="it lies at"):
        register(spark, tmp_path / "b", database)
    assert spark.table(f"{database}.p_t").count() == 3
    register(spark, tmp_path / "b", database, move=True)
    assert spark.table(f"{database}.p_t").count() == 50


def test_register_refuses_two_folders_of_one_name(spark, tmp_path, database):
    for name in ("links-small", "links_small", "other"):
        spark.range(3).write.parquet(str(tmp_path / "silver" / name))
    with pytest.raises(RuntimeError, match="several folders"):
        register(spark, tmp_path / "silver", database)
    assert [t.name for t in spark.catalog.listTables(database)] == ["p_other"]


def test_register_finds_folders_beside_files(spark, tmp_path, database):
    spark.range(3).write.parquet(str(tmp_path / "silver/t"))
    spark.range(9).write.parquet(str(tmp_path / "silver/t/inner"))
    names = register(spark, tmp_path / "silver", database)
    assert {n: spark.table(n).count() for n in names} == {f"{database}.p_t": 3, f"{database}.p_inner": 9}


def test_register_compares_columns_by_the_session_s_case(spark, tmp_path, database):
    data = str(tmp_path / "silver/t")
    spark.createDataFrame([(1,)], "id int").write.parquet(data)
    register(spark, tmp_path / "silver", database)
    spark.createDataFrame([(2, 3)], "Id int, more int").write.mode("overwrite").parquet(data)
    register(spark, tmp_path / "silver", database)
    assert rows(spark.table(f"{database}.p_t")) == [(2, 3)]


def test_a_spoiled_column_is_seen(spark, monkeypatch):
    """The check of the conversions compares contents, not only numbers of rows."""
    from tests.oracle import connect, difference
    from workload import storage
    from workload.registry import ORACLE_SQL
    monkeypatch.setattr(storage, "CONVERTED", {"nation": storage.CONVERTED["nation"]})
    sql = storage.contents_sql("nation", "nation", "n_nationkey", {"n_name": "n_name", "n_nationkey": storage.text_sql("n_nationkey", "number"), "n_regionkey": storage.text_sql("n_regionkey", "number")})
    folder = "/root/testdata/sf0.001"
    assert difference(spark, connect(folder), storage.convert_many, sql, folder)[0] is None and "n_name" in ORACLE_SQL["convert_many"]
    real = storage.table
    monkeypatch.setattr(storage, "table", lambda *a: real(*a).withColumn("n_name", F.upper(F.reverse("n_name"))))
    assert "rows" in difference(spark, connect(folder), storage.convert_many, sql, folder)[0]


def test_register_raw_csv(spark, tmp_path, database):
    write_stocks(tmp_path / "bronze/stocks")
    write(tmp_path / "bronze/mixed/a.csv", "x\n1\n")
    write(tmp_path / "bronze/mixed/b.csv", "y,z\n1,t\n2,u\n")
    names = sources.register_tables(spark, str(tmp_path / "bronze"), database, "raw_", source="csv",
                                    one_per_file=("mixed",))
    assert names == [f"{database}.raw_{n}" for n in ("a", "b", "stocks")]
    assert [spark.table(n).count() for n in names] == [1, 2, 4]
    assert spark.table(names[1]).dtypes == [("y", "int"), ("z", "string")]


# ---- locations, scratch space, command line


def test_locations_come_from_arguments_then_session(spark):
    spark.conf.set("spark.terracelake.gold", "s3a://b/gold/")
    try:
        at = Locations.from_session(spark, silver="/x")
        assert at.path("gold", "a", "b") == "s3a://b/gold/a/b" and at.path("silver") == "/x"
        with pytest.raises(ValueError, match="bronze"):
            at.path("bronze")
    finally:
        spark.conf.unset("spark.terracelake.gold")


def test_shared_dir_is_stable_and_scratch_paths_are_new(spark):
    assert shared_dir(spark) == shared_dir(spark)
    assert scratch_path(spark, "t") != scratch_path(spark, "t")
    assert scratch_path(spark, "t").startswith(shared_dir(spark))


def write_raw_movies(folder):
    write(folder / "movies_metadata.csv",
          "id,title,release_date,popularity\n1,A,2000-01-02,1.5\n2,B,bad,x\n1997-08-20,D,2001-01-01,\n")
    ratings = "movieid,rating,timestamp\n1,4.0,1451606400\n1,5.0,1483228799\n2,3.0,1460000000\n"
    for name in MOVIE_TABLES:
        text = {"ratings": ratings, "ratings_small": ratings,
                "keywords": "id,keywords\n1,Robot\n1,robot arm\n2,Artificial Intelligence\n",
                "credits": "id,cast\n1,Will Smith\n2,Keanu Reeves\n"}.get(name, "movieid,x\n1,1\n")
        if name != "movies_metadata":
            write(folder / f"{name}.csv", text)


@pytest.mark.parametrize("by_name", [False, True])
def test_every_job_from_raw_to_gold(spark, tmp_path, database, by_name):
    bronze, silver, gold = (str(tmp_path / layer) for layer in ("bronze", "silver", "gold"))
    write(tmp_path / "bronze/bakery/bakery.csv", "date,item\n1,Bread\n1,Tea\n2,Bread\n2,NONE\n")
    write_raw_movies(tmp_path / "bronze/movie_ratings")
    write_stocks(tmp_path / "bronze/stocks")
    run = lambda *words: main(list(words), spark)
    run("convert-bakery", "--bronze", bronze, "--silver", silver)
    run("convert-movies", "--bronze", bronze, "--silver", silver,
        "--schema", "ratings=movieid bigint, rating double, timestamp bigint")
    run("convert-stocks", "--bronze", bronze, "--silver", silver, "--symbol", "AAPL", "IBM")
    source = ["--silver", silver]
    if by_name:
        run("register", "--silver", silver, "--database", database)
        run("register", "--bronze", bronze, "--layer", "bronze", "--database", database)
        source = ["--database", database]
        assert spark.table(f"{database}.raw_ratings").count() == 3
        assert spark.table(f"{database}.processed_ratings").dtypes[0] == ("movieid", "bigint")
    before = spark.catalog.currentDatabase()
    for job in ("item-sales", "movie-choices", "rating-buckets", "top-volatility"):
        run(job, *source, "--gold", gold)
    spark.catalog.setCurrentDatabase(before)

    text = {str(f.parents[1].relative_to(gold)): f.read_text().splitlines() for f in part_files(gold, ".csv")}
    assert text == {
        "bakery/bakery_sales": ["item|count", "Bread|2", "Tea|1"],
        "movies/movie_choices": [
            "title|rank|avg_rating|ratings_count|popularity|release_date",
            "A|1|4.5|4|1.5|2000-01-02", "B|2|3.0|1|x|"],
        "movies/avg_ratings": [
            "rank|avg_rating|ratings_count|popularity", "1|5.0|1|1.5", "2|4.0|1|1.5", "3|3.0|1|"],
        "stocks/stock_volatility": [
            "date|symbol|close|high|low|intraday_volatility",
            "2017-01-03|AAPL|10|12.0000|9.0000|30.00", "2017-01-04|AAPL|10|11.0000|10.0000|10.00",
            "2017-01-03|IBM|100|100.5000|99.0000|1.50"],
    }
    stored = spark.read.parquet(f"{gold}/movies/movie_choices/parquet")
    assert stored.filter("title = 'A'").first().release_date == date(2000, 1, 2)


def test_unknown_job_is_refused(capsys):
    with pytest.raises(SystemExit):
        main(["no-such-job"])
    assert "invalid choice" in capsys.readouterr().err
