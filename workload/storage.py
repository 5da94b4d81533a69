"""Sources, sinks, conversions and the catalog.

Each query writes below the shared folder, to a path of its own, and returns a
DataFrame that reads the result back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terracelake import operators as op
from terracelake import sinks, sources
from terracelake.plans import convert, item_sales
from terracelake.session import scratch_path, stored
from workload.registry import query, table

EVENT_TYPES = ("CLICK", "VIEW", "PURCHASE", "SIGNUP", "ERROR")
MICROSECONDS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"


def write_raw(df: DataFrame, path: str) -> None:
    """Raw input for the readers: comma-separated, with a header."""
    df.write.options(**MICROSECONDS).option("header", True).csv(path)


def as_types_of(df: DataFrame, schema: StructType) -> DataFrame:
    """Back from inferred types (a bigint column is inferred as int)."""
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


# ---- sources


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def scan_parquet(spark: SparkSession, d: str) -> DataFrame:
    return sources.read_parquet(spark, f"{d}/orders.parquet").select(
        "o_orderkey", "o_orderstatus", "o_totalprice")


@query(EVENTS_SQL)
def scan_csv(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    path = scratch_path(spark, "bronze/events.csv")
    write_raw(events, path)
    return as_types_of(sources.read_csv(spark, path, **MICROSECONDS), events.schema)


def write_by_type(spark: SparkSession, d: str) -> tuple[str, StructType]:
    """One upper-case-named CSV per event type; the files do not hold the type."""
    events = table(spark, d, "events")
    rows = events.drop("event_type")
    folder = scratch_path(spark, "bronze/events")
    for name in EVENT_TYPES:
        write_raw(rows.filter(events.event_type == name.lower()), f"{folder}/{name}.csv")
    return folder, rows.schema


@query("SELECT event_id, ts, user_id, value, props, event_type AS symbol FROM events")
def tagged_files(spark: SparkSession, d: str) -> DataFrame:
    folder, schema = write_by_type(spark, d)
    return sources.read_tagged_csv(spark, folder, EVENT_TYPES, "symbol", schema, **MICROSECONDS)


# ---- sinks


@query("SELECT event_type, count(*) AS count FROM events GROUP BY CUBE (event_type)")
def sink_parquet(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "sink_parquet")
    sinks.write_parquet(op.cube_count(table(spark, d, "events"), "event_type"), path)
    return sources.read_parquet(spark, path)


@query("SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def sink_csv_single(spark: SparkSession, d: str) -> DataFrame:
    counts = item_sales.build(table(spark, d, "events"), "event_type", ("none",))
    path = scratch_path(spark, "sink_csv")
    sinks.write_csv(counts, path, item_sales.order("event_type"))
    return sources.read_csv(spark, path, counts.schema, sep="|")


@query("""
    SELECT format, event_type, count(*) AS count FROM events, (VALUES ('csv'), ('parquet')) f(format)
    GROUP BY format, event_type""")
def publish_dual(spark: SparkSession, d: str) -> DataFrame:
    counts = item_sales.build(table(spark, d, "events"), "event_type", ("none",))
    path = scratch_path(spark, "gold/event_counts")
    sinks.publish(counts, path, item_sales.order("event_type"))
    text = sources.read_csv(spark, f"{path}/csv", counts.schema, sep="|")
    stored = sources.read_parquet(spark, f"{path}/parquet")
    return op.union_all([
        df.select(F.lit(name).alias("format"), "event_type", "count")
        for name, df in (("csv", text), ("parquet", stored))])


@query("""
    SELECT event_id, ts, user_id, value, props, event_type FROM events
    WHERE event_type IN ('click', 'view')""")
def sink_partitioned(spark: SparkSession, d: str) -> DataFrame:
    path = scratch_path(spark, "silver/events")
    sinks.write_partitioned(table(spark, d, "events"), path, "event_type")
    return sources.read_parquet(spark, path).filter(op.is_one_of("event_type", ("click", "view")))


@query("""
    SELECT l_orderkey, l_linenumber, l_quantity, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day FROM lineitem
    WHERE l_shipdate < TIMESTAMP '1997-01-01 00:00:00'""")
def sink_replaced(spark: SparkSession, d: str) -> DataFrame:
    """A table by year is replaced; a second replacement fails at its last year, and the first one's rows stay."""
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.to_date("l_shipdate").alias("day"), F.year("l_shipdate").alias("year"))
    path = scratch_path(spark, "silver/lines")
    sinks.write_partitioned(lines, path, "year")
    sinks.write_partitioned(lines.filter("year < 1997"), path, "year")
    failing = lines.withColumn("l_quantity", F.expr("if(year > 1996, raise_error('spoiled'), l_quantity)"))
    try:
        sinks.write_partitioned(failing, path, "year")
    except Exception as error:  # noqa: BLE001
        if "spoiled" not in str(error):
            raise
    return sources.read_parquet(spark, path).select(
        "l_orderkey", "l_linenumber", "l_quantity", F.col("day").cast("string").alias("day"))


# ---- conversions


@query(EVENTS_SQL)
def convert_one(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    raw, processed = scratch_path(spark, "bronze/events.csv"), scratch_path(spark, "silver/events")
    write_raw(events, raw)
    convert.convert_one(spark, raw, processed, **MICROSECONDS)
    return as_types_of(sources.read_parquet(spark, processed), events.schema)


# Each table's key and the kinds of its columns.
CONVERTED = {
    "customer": ("c_custkey", {
        "c_custkey": "number", "c_name": "text", "c_nationkey": "number", "c_acctbal": "number", "c_mktsegment": "text"}),
    "nation": ("n_nationkey", {
        "n_nationkey": "number", "n_name": "text", "n_regionkey": "number"}),
    "orders": ("o_orderkey", {
        "o_orderkey": "number", "o_custkey": "number", "o_orderstatus": "text", "o_totalprice": "number", "o_orderdate": "date", "o_orderpriority": "text"}),
    "part": ("p_partkey", {
        "p_partkey": "number", "p_name": "text", "p_brand": "text", "p_type": "text", "p_size": "number", "p_retailprice": "number"}),
    "region": ("r_regionkey", {
        "r_regionkey": "number", "r_name": "text"}),
    "supplier": ("s_suppkey", {
        "s_suppkey": "number", "s_name": "text", "s_nationkey": "number", "s_acctbal": "number"}),
}


def convert_tables(spark: SparkSession, d: str, names: tuple[str, ...]) -> str:
    raw, processed = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    for name in names:
        write_raw(table(spark, d, name), f"{raw}/{name}.csv")
    convert.convert_many(spark, raw, processed, names, **MICROSECONDS)
    return processed


def contents_sql(name: str, label: str, key: str, values: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{label}' AS table_name, CAST({key} AS BIGINT) AS row_key, '{column}' AS column_name, {text} AS text FROM {name}"
        for column, text in values.items())


def contents(df: DataFrame, label: str, key: str, columns: tuple[str, ...]) -> DataFrame:
    """Every value of a table in one shape: table_name, row_key, column_name, text."""
    shown = [F.struct(F.lit(c).alias("column_name"), shown_text(df, c).alias("text")) for c in columns]
    return df.select(F.lit(label).alias("table_name"), F.col(key).cast("bigint").alias("row_key"),
                     F.explode(F.array(*shown)).alias("cell")).select("table_name", "row_key", "cell.*")


def shown_text(df: DataFrame, column: str):
    """Text as it is, dates as days, and numbers in hundredths, which both engines write alike."""
    kind = dict(df.dtypes)[column]
    if kind.startswith(("timestamp", "date")):
        return F.date_format(column, "yyyy-MM-dd")
    return F.col(column) if kind == "string" else F.round(F.col(column).cast("double") * 100).cast("bigint").cast("string")


def text_sql(column: str, kind: str) -> str:
    if kind == "date":
        return f"strftime({column}, '%Y-%m-%d')"
    return column if kind == "text" else f"CAST(CAST(round(CAST({column} AS DOUBLE) * 100) AS BIGINT) AS VARCHAR)"


@query(" UNION ALL ".join(
    contents_sql(name, name, key, {c: text_sql(c, kind) for c, kind in columns.items()})
    for name, (key, columns) in CONVERTED.items()))
def convert_many(spark: SparkSession, d: str) -> DataFrame:
    processed = convert_tables(spark, d, tuple(CONVERTED))
    return op.union_all([
        contents(sources.read_parquet(spark, f"{processed}/{name}"), name, key, tuple(columns))
        for name, (key, columns) in CONVERTED.items()])


@query("""
    SELECT event_id, ts, user_id, value, props, event_type AS symbol FROM events
    WHERE event_type IN ('purchase', 'signup')""")
def convert_partitioned(spark: SparkSession, d: str) -> DataFrame:
    raw, schema = write_by_type(spark, d)
    processed = scratch_path(spark, "silver/events")
    convert.convert_partitioned(spark, raw, processed, EVENT_TYPES, "symbol", schema, **MICROSECONDS)
    return sources.read_parquet(spark, processed).filter(op.is_one_of("symbol", ("purchase", "signup")))


# ---- catalog


def registered(spark: SparkSession, d: str) -> str:
    """A database of its own with the tables customer, orders and partitioned events."""
    processed = convert_tables(spark, d, ("customer", "orders"))
    sinks.write_partitioned(table(spark, d, "events"), f"{processed}/nested/events", "event_type")
    database = f"lake_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, database)}'")
    sources.register_tables(spark, processed, database, "processed_")
    return database


REGISTERED = {name: CONVERTED[name] for name in ("customer", "orders")} | {
    "events": ("event_id", {"user_id": "number", "event_type": "text", "ts": "date", "value": "number", "props": "text"})}


@query(" UNION ALL ".join(
    contents_sql(name, f"processed_{name}", key, {c: text_sql(c, kind) for c, kind in columns.items()})
    for name, (key, columns) in REGISTERED.items()))
def catalog_register(spark: SparkSession, d: str) -> DataFrame:
    database = registered(spark, d)
    return op.union_all([
        contents(sources.read_table(spark, f"{database}.processed_{name}"), f"processed_{name}", key, tuple(columns))
        for name, (key, columns) in REGISTERED.items()])


@query("""
    WITH days AS (SELECT *, CAST(ts AS DATE) AS day FROM events),
    runs AS (
      SELECT 1 AS run, count(DISTINCT CAST(day AS VARCHAR) || event_type) AS added FROM days WHERE day < DATE '2024-01-10'
      UNION ALL
      SELECT 2, count(DISTINCT CAST(day AS VARCHAR) || event_type) FROM days WHERE day >= DATE '2024-01-10'
      UNION ALL
      SELECT 3, 0)
    SELECT run, added, event_type, count(*) AS rows, sum(event_id) AS ids
    FROM runs, days WHERE run > 1 OR day < DATE '2024-01-10' GROUP BY run, added, event_type""")
def catalog_partitions(spark: SparkSession, d: str) -> DataFrame:
    """A table by day and type is registered, gets more days, and is brought up to date twice: what each run adds and finds."""
    days = table(spark, d, "events").select("event_id", F.to_date("ts").alias("day"), "event_type")
    early = F.col("day") < F.lit("2024-01-10").cast("date")
    processed, database = scratch_path(spark, "silver"), f"lake_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, database)}'")
    found = []

    def run(added: int) -> None:
        counts = sources.read_table(spark, name).groupBy("event_type").agg(
            F.count(F.lit(1)).alias("rows"), F.sum("event_id").cast("decimal(38,0)").alias("ids"))
        found.append(stored(counts.select(
            F.lit(len(found) + 1).alias("run"), F.lit(added).cast("long").alias("added"), "event_type", "rows", "ids"), "found"))

    sinks.write_partitioned(days.filter(early), f"{processed}/days", "day", "event_type")
    (name,) = sources.register_tables(spark, processed, database, "processed_")
    run(spark.sql(f"SHOW PARTITIONS {name}").count())
    sinks.write_partitioned(days.filter(~early), f"{processed}/days", "day", "event_type", keep_others=True)
    for _ in range(2):
        added = sources.add_new_partitions(spark, name)
        spark.catalog.refreshTable(name)
        run(added)
    return op.union_all(found)


@query("""
    SELECT o.o_orderkey, c.c_name, c.c_mktsegment
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def catalog_scan(spark: SparkSession, d: str) -> DataFrame:
    before = spark.catalog.currentDatabase()
    sources.use_database(spark, registered(spark, d))
    try:
        orders = sources.read_table(spark, "processed_orders", "o")
        customers = sources.read_table(spark, "processed_customer", "c")
        return orders.join(customers, F.col("o.o_custkey") == F.col("c.c_custkey")).select(
            F.col("o.o_orderkey").cast("bigint").alias("o_orderkey"), "c.c_name", "c.c_mktsegment")
    finally:
        sources.use_database(spark, before)
