"""The four analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terracelake.config import MovieChoices, RatingBuckets, TopVolatility
from terracelake.plans import item_sales as sales
from terracelake.plans import movie_choices as choices
from terracelake.plans import rating_buckets as buckets
from terracelake.plans import top_volatility as volatility
from workload.registry import query, rounded, table


@query("""
    SELECT event_type, count FROM (
      SELECT event_type, count(*) AS count FROM events GROUP BY CUBE (event_type))
    WHERE event_type NOT LIKE 'error' AND event_type NOT LIKE 'signup'
    ORDER BY count DESC, event_type""")
def item_sales(spark: SparkSession, d: str) -> DataFrame:
    return sales.build(table(spark, d, "events"), "event_type", ("error", "signup"))


CHOICES = MovieChoices(keyword_words=("tion", "und"), cast_names=("that", "from", "que"))


def choice_inputs(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {
        "movies": table(spark, d, "orders").select(
            F.col("o_orderkey").alias("id"), F.col("o_orderkey").alias("title"),
            F.col("o_orderdate").alias("release_date"), F.col("o_totalprice").alias("popularity")),
        "ratings": table(spark, d, "lineitem").select(
            F.col("l_orderkey").alias("movieid"), F.col("l_quantity").alias("rating")),
        "keywords": table(spark, d, "documents").select(
            F.col("doc_id").alias("id"), F.col("text").alias("keywords")),
        "cast": table(spark, d, "conversations").select(
            F.col("conv_id").alias("id"), F.col("text").alias("cast")),
    }


@query(f"""
    WITH picks AS (
      SELECT m.o_orderkey AS title, CAST(m.o_orderdate AS DATE) AS release_date,
             m.o_totalprice AS popularity, count(r.l_orderkey) AS ratings_count,
             {rounded("avg(r.l_quantity)", 3)} AS avg_rating
      FROM orders m
      LEFT JOIN lineitem r ON m.o_orderkey = r.l_orderkey
      LEFT JOIN documents k ON m.o_orderkey = k.doc_id
      LEFT JOIN conversations c ON m.o_orderkey = c.conv_id
      WHERE (lower(k.text) LIKE '%tion%' OR lower(k.text) LIKE '%und%')
        AND (lower(c.text) LIKE '%that%' OR lower(c.text) LIKE '%from%' OR lower(c.text) LIKE '%que%')
      GROUP BY m.o_orderkey, m.o_orderdate, m.o_totalprice)
    SELECT title,
           CAST(ntile(3) OVER (ORDER BY avg_rating DESC NULLS LAST, title) AS INTEGER) AS rank,
           avg_rating, ratings_count, popularity, release_date
    FROM picks WHERE avg_rating > 0
    ORDER BY rank, avg_rating DESC, ratings_count DESC, title""")
def movie_choices(spark: SparkSession, d: str) -> DataFrame:
    return choices.build(**choice_inputs(spark, d), params=CHOICES)


BUCKETS = RatingBuckets("1996-01-01 00:00:00", "1996-12-31 23:59:59")


def bucket_inputs(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {
        "movies": table(spark, d, "part").select(
            F.col("p_partkey").alias("id"), F.col("p_size").cast("string").alias("popularity")),
        "ratings": table(spark, d, "lineitem").select(
            F.col("l_partkey").alias("movieid"), F.col("l_quantity").alias("rating"),
            F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("timestamp")),
    }


@query(f"""
    SELECT CAST(ntile(10) OVER (ORDER BY l_quantity DESC NULLS LAST) AS INTEGER) AS rank,
           avg(l_quantity) AS avg_rating, count(l_partkey) AS ratings_count,
           {rounded("avg(CAST(p_size AS DOUBLE))", 2)} AS popularity
    FROM part LEFT JOIN lineitem ON p_partkey = l_partkey
    WHERE l_quantity IS NOT NULL
      AND date_trunc('second', l_shipdate)
          BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-12-31 23:59:59'
    GROUP BY l_quantity""")
def rating_buckets(spark: SparkSession, d: str) -> DataFrame:
    return buckets.build(**bucket_inputs(spark, d), params=BUCKETS)


VOLATILITY = TopVolatility(("click", "view", "purchase"), "2024-01-03", "2024-01-28")


def daily_values(spark: SparkSession, d: str) -> DataFrame:
    """A stock-like table: one row per day and event type."""
    return table(spark, d, "events").groupBy(
        F.col("ts").cast("date").alias("date"), F.col("event_type").alias("symbol"),
    ).agg(
        F.max("value").alias("high"), F.min("value").alias("low"),
        F.max_by("value", "ts").alias("close"),
    )


@query("""
    WITH stocks AS (
      SELECT CAST(ts AS DATE) AS date, event_type AS symbol, max(value) AS high,
             min(value) AS low, arg_max(value, ts) AS close
      FROM events GROUP BY CAST(ts AS DATE), event_type)
    SELECT date, upper(symbol) AS symbol, close,
           format('{:,.4f}', high) AS high, format('{:,.4f}', low) AS low,
           format('{:,.2f}', (high - low) / nullif(close, 0) * 100) AS intraday_volatility
    FROM stocks
    WHERE symbol IN ('click', 'view', 'purchase')
      AND date BETWEEN DATE '2024-01-03' AND DATE '2024-01-28'
    ORDER BY intraday_volatility DESC NULLS LAST, date, symbol LIMIT 10""")
def top_volatility(spark: SparkSession, d: str) -> DataFrame:
    return volatility.build(daily_values(spark, d), VOLATILITY)
