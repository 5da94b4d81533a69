"""Single operators: projections, predicates, joins, aggregates, windows, sorts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracelake import operators as op
from terracelake.functions import (
    bigint_or_null, date_or_null, double_or_null, percent_range, rounded_mean,
)
from workload.registry import query, rounded, table

# ---- projections and predicates


@query("""
    SELECT c_custkey AS id, upper(c_mktsegment) AS segment, c_acctbal AS balance,
           c_acctbal / 2 AS half FROM customer""")
def project_alias(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.ucase("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"), (F.col("c_acctbal") / 2).alias("half"))


@query("""
    SELECT event_id, event_type AS item FROM events
    WHERE nullif(event_type, 'click') NOT LIKE 'error'
      AND nullif(event_type, 'click') NOT LIKE 'signup'""")
def not_like_null(spark: SparkSession, d: str) -> DataFrame:
    """Clicks become null items, which the filters reject as well."""
    items = table(spark, d, "events").select(
        "event_id", F.nullif(F.col("event_type"), F.lit("click")).alias("item"))
    return items.filter(op.not_like_any("item", ("error", "signup")))


@query("""
    SELECT doc_id, source FROM documents
    WHERE (lower(text) LIKE '%tion%' OR lower(text) LIKE '%und%')
      AND (lower(source) LIKE '%src1%' OR lower(source) LIKE '%rc7%' OR lower(source) LIKE '%c9%')""")
def like_contains_ci(spark: SparkSession, d: str) -> DataFrame:
    return (table(spark, d, "documents")
            .filter(op.contains_any("text", ("tion", "und"))
                    & op.contains_any("source", ("SRC1", "rc7", "C9")))
            .select("doc_id", "source"))


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'purchase')")
def in_list(spark: SparkSession, d: str) -> DataFrame:
    return (table(spark, d, "events").filter(op.is_one_of("event_type", ("click", "purchase")))
            .select("event_id", "event_type"))


@query("""
    SELECT o_orderkey, o_orderdate FROM orders
    WHERE o_orderdate BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'""")
def between_date(spark: SparkSession, d: str) -> DataFrame:
    return (table(spark, d, "orders").filter(op.date_between("o_orderdate", "1996-01-01", "1997-06-30"))
            .select("o_orderkey", "o_orderdate"))


@query("""
    SELECT d.doc_id, d.source, l.quality
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL""")
def not_null(spark: SparkSession, d: str) -> DataFrame:
    documents = table(spark, d, "documents").select("doc_id", "source")
    labels = table(spark, d, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id", "left").filter(F.col("quality").isNotNull())


@query("""
    SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds FROM events
    WHERE date_trunc('second', ts)
          BETWEEN TIMESTAMP '2024-01-05 00:00:00' AND TIMESTAMP '2024-01-19 23:59:59'""")
def epoch_range(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select(
        "event_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("seconds"))
    return events.filter(op.epoch_between("seconds", "2024-01-05 00:00:00", "2024-01-19 23:59:59"))


@query("""
    SELECT event_id, ts, event_type FROM events
    WHERE ts BETWEEN TIMESTAMP '2024-01-10 00:00:00' AND TIMESTAMP '2024-01-20 12:30:00'""")
def param_bind(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(
        "SELECT event_id, ts, event_type FROM {events} "
        "WHERE ts BETWEEN to_timestamp_ntz(:first) AND to_timestamp_ntz(:last);",
        args={"first": "2024-01-10 00:00:00", "last": "2024-01-20 12:30:00"},
        events=table(spark, d, "events"))


@query("""
    WITH per_order AS (
      SELECT l_orderkey, avg(l_quantity) AS avg_quantity FROM lineitem GROUP BY l_orderkey)
    SELECT l_orderkey, avg_quantity FROM per_order WHERE avg_quantity > 25""")
def post_agg_filter(spark: SparkSession, d: str) -> DataFrame:
    per_order = (table(spark, d, "lineitem").groupBy("l_orderkey")
                 .agg(F.avg("l_quantity").alias("avg_quantity")))
    return per_order.filter(F.col("avg_quantity") > 25)


# ---- joins


@query("""
    SELECT o_orderkey, o_orderstatus, l_linenumber, l_quantity
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""")
def left_join(spark: SparkSession, d: str) -> DataFrame:
    orders, lines = table(spark, d, "orders"), table(spark, d, "lineitem")
    return (orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
            .select("o_orderkey", "o_orderstatus", "l_linenumber", "l_quantity"))


@query("""
    SELECT o_orderkey, o_orderstatus, l_linenumber, l_quantity
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE l_quantity > 45""")
def outer_to_inner(spark: SparkSession, d: str) -> DataFrame:
    """A filter on the right side rejects unmatched rows, so this is an inner join."""
    orders = table(spark, d, "orders")
    lines = table(spark, d, "lineitem").filter(F.col("l_quantity") > 45)
    return (orders.join(lines, orders.o_orderkey == lines.l_orderkey)
            .select("o_orderkey", "o_orderstatus", "l_linenumber", "l_quantity"))


@query("""
    SELECT o_orderkey, count(l_orderkey) AS ratings_count, count(*) AS joined_rows
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
                LEFT JOIN documents ON o_orderkey = doc_id
                LEFT JOIN conversations ON o_orderkey = conv_id
    GROUP BY o_orderkey""")
def star_join_fanout(spark: SparkSession, d: str) -> DataFrame:
    counts = op.fanout_counts(
        table(spark, d, "orders").select("o_orderkey"), "o_orderkey",
        line=(table(spark, d, "lineitem"), "l_orderkey"),
        document=(table(spark, d, "documents"), "doc_id"),
        turn=(table(spark, d, "conversations"), "conv_id"))
    matched = F.when(F.col("line_rows") > 0, F.col("joined_rows")).otherwise(0)
    return counts.select("o_orderkey", matched.alias("ratings_count"), "joined_rows")


@query("""
    WITH keyed AS (
      SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey END AS key FROM customer)
    SELECT CASE WHEN key IS NULL THEN 'id ' ELSE '' END || c_custkey AS text_key, o_orderkey
    FROM keyed LEFT JOIN orders ON key = o_custkey""")
def safe_key_join(spark: SparkSession, d: str) -> DataFrame:
    """Customer keys as text, every seventh of them not a number."""
    spoiled = F.when(F.col("c_custkey") % 7 == 0, "id ").otherwise("")
    customers = table(spark, d, "customer").select(
        F.concat(spoiled, F.col("c_custkey").cast("string")).alias("text_key"))
    orders = table(spark, d, "orders").select("o_custkey", "o_orderkey")
    return (op.safe_key_join(customers, orders, "text_key", "o_custkey", "left")
            .select("text_key", "o_orderkey"))


# ---- aggregates


@query("SELECT event_type, count(*) AS count FROM events GROUP BY CUBE (event_type)")
def cube_count(spark: SparkSession, d: str) -> DataFrame:
    return op.cube_count(table(spark, d, "events"), "event_type")


@query("""
    SELECT l_returnflag, l_linestatus, count(*) AS lines, sum(l_quantity) AS quantity,
           avg(l_quantity) AS avg_quantity
    FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def group_multi_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"),
        F.avg("l_quantity").alias("avg_quantity"))


@query("""
    SELECT o_orderstatus, count(*) AS joined_rows, count(l_orderkey) AS lines
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderstatus""")
def count_col_vs_star(spark: SparkSession, d: str) -> DataFrame:
    counts = op.fanout_counts(
        table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey",
        line=(table(spark, d, "lineitem"), "l_orderkey"))
    return counts.groupBy("o_orderstatus").agg(
        F.sum("joined_rows").alias("joined_rows"), F.sum("line_rows").alias("lines"))


@query(f"""
    SELECT l_tax, {rounded("avg(l_quantity)", 3)} AS avg_quantity FROM lineitem GROUP BY l_tax""")
def avg_round(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").groupBy("l_tax").agg(
        F.round(F.avg("l_quantity"), 3).alias("avg_quantity"))


@query(f"""
    SELECT p_type,
           {rounded("avg(CASE WHEN p_partkey % 5 <> 0 THEN CAST(p_size AS DOUBLE) END)", 2)} AS avg_size
    FROM part GROUP BY p_type""")
def avg_text_number(spark: SparkSession, d: str) -> DataFrame:
    """Sizes as text, every fifth of them not a number."""
    size = double_or_null(
        F.when(F.col("p_partkey") % 5 == 0, "n/a").otherwise(F.col("p_size").cast("string")))
    return table(spark, d, "part").groupBy("p_type").agg(
        rounded_mean(F.sum(size), F.count(size), 2).alias("avg_size"))


# ---- windows


@query("""
    SELECT c_custkey, CAST(ntile(3) OVER (ORDER BY c_acctbal DESC NULLS LAST, c_custkey) AS INTEGER) AS rank
    FROM customer""")
def ntile_global(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    ranked = op.ntile(customers, 3, [F.col("c_acctbal").desc(), F.col("c_custkey")])
    return ranked.select("c_custkey", "rank")


@query("""
    SELECT CAST(ntile(10) OVER (ORDER BY l_quantity DESC NULLS LAST) AS INTEGER) AS rank,
           l_quantity, count(*) AS lines
    FROM lineitem GROUP BY l_quantity""")
def ntile_over_agg(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").groupBy("l_quantity").agg(F.count(F.lit(1)).alias("lines"))
    return op.ntile(lines, 10, [F.col("l_quantity").desc()]).select("rank", "l_quantity", "lines")


@query("""
    SELECT o_orderkey, CAST(ntile(7) OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS INTEGER) AS rank
    FROM orders""")
def ntile_distributed(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    ranked = op.ntile(orders, 7, [F.col("o_totalprice").desc(), F.col("o_orderkey")])
    return ranked.select("o_orderkey", "rank")


# ---- sorts, top rows, unions


@query("""
    SELECT p_type, p_brand, count(*) AS count FROM part GROUP BY p_type, p_brand
    ORDER BY p_type, count DESC, p_brand""")
def sort_mixed(spark: SparkSession, d: str) -> DataFrame:
    return (table(spark, d, "part").groupBy("p_type", "p_brand")
            .agg(F.count(F.lit(1)).alias("count"))
            .orderBy(["p_type", "count", "p_brand"], ascending=[True, False, True]))


@query("""
    SELECT p_partkey, format('{:,.2f}', p_retailprice) AS price FROM part
    ORDER BY price DESC, p_partkey LIMIT 10""")
def topk_text(spark: SparkSession, d: str) -> DataFrame:
    prices = table(spark, d, "part").select(
        "p_partkey", F.format_number("p_retailprice", 2).alias("price"))
    return op.top_k(prices, 10, [F.col("price").desc(), F.col("p_partkey")])


@query("""
    SELECT p_partkey, format('{:,.2f}', p_retailprice) AS price FROM part
    ORDER BY p_retailprice DESC, p_partkey LIMIT 10""")
def topk_numeric(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").select("p_partkey", "p_retailprice")
    top = op.top_k(parts, 10, [F.col("p_retailprice").desc(), F.col("p_partkey")])
    return top.select("p_partkey", F.format_number("p_retailprice", 2).alias("price"))


@query("""
    SELECT c_custkey AS key, c_acctbal AS value FROM customer
    UNION ALL SELECT s_suppkey, s_acctbal FROM supplier
    UNION ALL SELECT n_nationkey, n_regionkey FROM nation
    UNION ALL SELECT c_custkey, c_acctbal FROM customer""")
def union_all(spark: SparkSession, d: str) -> DataFrame:
    """Duplicates stay; the whole numbers of the third input widen to double."""
    customers = table(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("value"))
    suppliers = table(spark, d, "supplier").select("s_suppkey", "s_acctbal")
    nations = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    return op.union_all([customers, suppliers, nations, customers])


# ---- scalar functions


@query("SELECT c_custkey, lower(c_name) AS name, upper(c_mktsegment) AS segment FROM customer")
def fn_strings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(
        "c_custkey", F.lower("c_name").alias("name"), F.ucase("c_mktsegment").alias("segment"))


@query("""
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) END AS day,
           strftime(date_trunc('second', o_orderdate), '%Y-%m-%d %H:%M:%S') AS second_text,
           date_trunc('second', o_orderdate) AS second
    FROM orders""")
def fn_dates(spark: SparkSession, d: str) -> DataFrame:
    """Dates from text, every ninth of them bad; epoch seconds to text and back."""
    text = F.when(F.col("o_orderkey") % 9 == 0, "unknown").otherwise(
        F.col("o_orderdate").cast("date").cast("string"))
    seconds = F.from_unixtime(F.unix_seconds(F.col("o_orderdate").cast("timestamp")))
    return table(spark, d, "orders").select(
        "o_orderkey", date_or_null(text).alias("day"), seconds.alias("second_text"),
        F.to_timestamp(seconds).cast("timestamp_ntz").alias("second"))


@query("""
    SELECT l_orderkey, l_linenumber, format('{:,.2f}', l_extendedprice) AS price_2,
           format('{:,.4f}', l_discount) AS discount_4
    FROM lineitem""")
def fn_format_number(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.format_number("l_extendedprice", 2).alias("price_2"),
        F.format_number("l_discount", 4).alias("discount_4"))


@query("""
    SELECT l_orderkey, l_linenumber,
           (l_extendedprice - l_quantity) / nullif(l_tax, 0) * 100 AS percent,
           CASE WHEN l_linenumber % 2 = 0 THEN l_orderkey END AS even_key
    FROM lineitem""")
def fn_arithmetic(spark: SparkSession, d: str) -> DataFrame:
    """Some taxes are zero; every odd line's key is not a number."""
    text = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_orderkey").cast("string")).otherwise("-")
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        percent_range(F.col("l_extendedprice"), F.col("l_quantity"), F.col("l_tax")).alias("percent"),
        bigint_or_null(text).alias("even_key"))
