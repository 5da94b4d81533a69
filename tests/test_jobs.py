from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from terracelake.config import MovieChoices, RatingBuckets, TopVolatility
from terracelake.plans import item_sales, movie_choices, rating_buckets, top_volatility
from terracelake.sinks import publish
from tests import fixtures


def rows(df):
    return [tuple(row) for row in df.collect()]


def test_item_sales_drops_excluded_and_unnamed_items(spark):
    assert rows(item_sales.build(fixtures.bakery(spark))) == [("Bread", 2), ("Tea", 1)]


def test_item_sales_orders_by_count_then_item(spark):
    sales = spark.createDataFrame([(i,) for i in "bbaacd"], "item string")
    assert rows(item_sales.build(sales)) == [("a", 2), ("b", 2), ("c", 1), ("d", 1)]


def choice_inputs(spark):
    return (fixtures.movies(spark), fixtures.ratings(spark),
            fixtures.keywords(spark), fixtures.cast(spark))


def test_movie_choices_counts_the_fan_out(spark):
    got = movie_choices.build(*choice_inputs(spark))
    assert got.columns == ["title", "rank", "avg_rating", "ratings_count", "popularity", "release_date"]
    assert rows(got) == [
        ("A", 1, 4.5, 4, "1.5", date(2000, 1, 2)),
        ("B", 2, 3.0, 1, "x", None),
    ]


def test_movie_choices_equals_the_plain_join(spark):
    """Duplicates on every side, null ratings, films that share title, date and popularity."""
    movies = spark.createDataFrame([
        ("1", "A", "2000-01-02", "1.5"), ("1", "A", "2000-01-02", "1.5"), ("7", "A", "2000-01-02", "1.5"),
        ("2", "B", "2000-1-2", "x"), ("2", "B", "2000-01-02", "x"), ("3", "C", None, None),
        ("4", "D", "2001-01-01", "2"), ("n/a", "E", None, "3"), ("5", "F", None, "1"), ("6", "G", None, "1"),
    ], "id string, title string, release_date string, popularity string")
    ratings = spark.createDataFrame([
        (1, 4.0), (1, None), (1, 2.5), (2, 3.5), (7, 1.0), (3, None), (4, 0.0), (5, 0.0004), (9, 5.0),
    ], "movieid bigint, rating double")
    keywords = spark.createDataFrame(
        [(n, w) for n in range(1, 9) for w in ("a ROBOT", "robots", "other")] + [(1, None), (2, "robot")],
        "id bigint, keywords string")
    cast = spark.createDataFrame(
        [(n, "WILL SMITH and others") for n in range(1, 9)] + [(3, "keanu reeves"), (7, "will smith"), (6, None)],
        "id bigint, cast string")
    frames = {"m": movies, "r": ratings, "k": keywords, "c": cast}
    plain = spark.sql("""
        SELECT title, avg_rating, ratings_count, popularity, try_cast(release_date AS date) AS release_date
        FROM (
          SELECT title, release_date, popularity, count(movieid) AS ratings_count,
                 round(avg(rating), 3) AS avg_rating
          FROM {m} m LEFT JOIN {r} r ON try_cast(m.id AS bigint) = r.movieid
               LEFT JOIN {k} k ON try_cast(m.id AS bigint) = k.id
               LEFT JOIN {c} c ON try_cast(m.id AS bigint) = c.id
          WHERE lower(keywords) LIKE '%robot%' AND (lower(cast) LIKE '%will smith%'
                OR lower(cast) LIKE '%keanu reeves%')
          GROUP BY title, release_date, popularity) WHERE avg_rating > 0""", **frames)
    got = movie_choices.build(movies, ratings, keywords, cast)
    assert sorted(rows(got.drop("rank")), key=repr) == sorted(rows(plain), key=repr)
    assert got.count() == 3


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_inputs_give_what_the_plain_joins_give(spark, seed):
    """Keys repeat on every side; halves keep all sums exact."""
    rng = random.Random(seed)
    key = lambda: rng.choice([1, 1, 1, 2, 3, 4, 5])
    movies = spark.createDataFrame(
        [(rng.choice([str(key()), "x", None]), rng.choice("AB"), rng.choice(["2000-01-02", "?", None]),
          rng.choice(["1.5", "2", "n/a", None])) for _ in range(25)],
        "id string, title string, release_date string, popularity string")
    ratings = spark.createDataFrame(
        [(key(), rng.choice([None, 0.0, 0.5, 4.5, 5.0]), 1451606390 + rng.randrange(20)) for _ in range(60)],
        "movieid bigint, rating double, timestamp bigint")
    keywords = spark.createDataFrame(
        [(key(), rng.choice(["Robots", "ARTIFICIAL intelligence", "none", None])) for _ in range(15)],
        "id bigint, keywords string")
    cast = spark.createDataFrame(
        [(key(), rng.choice(["Keanu REEVES", "x will smith", "y", None])) for _ in range(15)],
        "id bigint, cast string")
    frames = {"m": movies, "r": ratings, "k": keywords, "c": cast}
    choices = spark.sql("""
        WITH picks AS (
          SELECT title, try_cast(release_date AS date) AS release_date, popularity, release_date AS raw,
                 count(movieid) AS ratings_count, round(avg(rating), 3) AS avg_rating
          FROM {m} m LEFT JOIN {r} r ON try_cast(m.id AS bigint) = r.movieid
               LEFT JOIN {k} k ON try_cast(m.id AS bigint) = k.id
               LEFT JOIN {c} c ON try_cast(m.id AS bigint) = c.id
          WHERE (lower(keywords) LIKE '%artificial intelligence%' OR lower(keywords) LIKE '%robot%')
            AND (lower(cast) LIKE '%will smith%' OR lower(cast) LIKE '%keanu reeves%')
          GROUP BY title, m.release_date, popularity)
        SELECT title, ntile(3) OVER (ORDER BY avg_rating DESC, title, raw, popularity) AS rank,
               avg_rating, ratings_count, popularity, release_date
        FROM picks WHERE avg_rating > 0""", **frames)
    got = movie_choices.build(movies, ratings, keywords, cast)
    assert sorted(rows(got), key=repr) == sorted(rows(choices), key=repr) != []
    buckets = spark.sql("""
        SELECT ntile(10) OVER (ORDER BY rating DESC) AS rank, avg(rating) AS avg_rating,
               count(movieid) AS ratings_count, round(avg(try_cast(popularity AS double)), 2) AS popularity
        FROM {m} m LEFT JOIN {r} r ON try_cast(m.id AS bigint) = r.movieid
        WHERE rating IS NOT NULL AND from_unixtime(timestamp) >= to_timestamp('2016-01-01 00:00:00')
          AND from_unixtime(timestamp) <= to_timestamp('2016-12-31 23:59:59')
        GROUP BY rating""", m=movies, r=ratings)
    assert sorted(rows(rating_buckets.build(movies, ratings))) == sorted(rows(buckets)) != []


def test_rating_buckets_includes_both_ends_of_the_range(spark):
    got = rating_buckets.build(fixtures.movies(spark), fixtures.ratings(spark))
    assert got.columns == ["rank", "avg_rating", "ratings_count", "popularity"]
    assert rows(got.orderBy("rank")) == [(1, 5.0, 1, 1.5), (2, 4.0, 1, 1.5), (3, 3.0, 1, None)]


def test_rating_totals_weigh_duplicate_films(spark):
    movies = spark.createDataFrame(
        [("1", "1.0"), ("1", "3.0"), ("2", "bad"), ("2", "5.0"), ("x", "9.0")], "id string, popularity string")
    ratings = spark.createDataFrame(
        [(1, 4.0, 1460000000)] * 3 + [(2, 4.0, 1460000000), (2, None, 1460000000), (3, 4.0, 1460000000)],
        "movieid bigint, rating double, timestamp bigint")
    got = rating_buckets.rating_totals(movies, ratings, RatingBuckets())
    # 3 ratings times 2 films, 1 times 2; popularity (3*(1+3) + 5) / (3*2 + 1)
    assert rows(got) == [(4.0, 8, 2.43)]


def test_top_volatility_sorts_as_text(spark):
    got = top_volatility.build(fixtures.stocks(spark))
    assert [(r.symbol, r.intraday_volatility) for r in got.collect()] == [
        ("AAPL", "9.00"), ("IBM", "9.00"), ("AAPL", "22.50"), ("AAPL", "10,910.00"), ("IBM", "1.00")]
    assert got.first().high == "10.5000"
    assert dict(got.dtypes) == {
        "date": "date", "symbol": "string", "close": "double", "high": "string", "low": "string",
        "intraday_volatility": "string"}


def test_top_volatility_can_sort_as_number(spark):
    got = top_volatility.build(fixtures.stocks(spark), TopVolatility(numeric_order=True, rows=3))
    assert [r.intraday_volatility for r in got.collect()] == ["10,910.00", "22.50", "9.00"]


def test_top_volatility_keeps_last_day_and_zero_close(spark):
    stocks = spark.createDataFrame([
        (date(2018, 12, 31), "msft", 2.0, 1.0, 0.0), (date(2019, 1, 1), "msft", 2.0, 1.0, 1.0),
        (date(2018, 12, 31), "xom", 2.0, 1.0, 1.0),
    ], "date date, symbol string, high double, low double, close double")
    assert rows(top_volatility.build(stocks)) == [
        (date(2018, 12, 31), "MSFT", 0.0, "2.0000", "1.0000", None)]


@pytest.mark.parametrize("numeric", [False, True])
@pytest.mark.parametrize("single", [False, True])
def test_published_volatility_is_in_order(spark, tmp_path, numeric, single):
    """Also where the stored rows lie in many files, and by a value that isn't published."""
    params = TopVolatility(numeric_order=numeric, rows=400)
    stocks = spark.range(400).select(
        F.date_add(F.lit(date(2017, 1, 1)), (F.col("id") % 300).cast("int")).alias("date"),
        F.when(F.col("id") % 2 == 0, "ibm").otherwise("aapl").alias("symbol"),
        (10 + F.col("id") * 37 % 101 / 7).alias("high"), F.lit(9.0).alias("low"), F.lit(10.0).alias("close"))
    built = top_volatility.build(stocks, params, keep_value=True)
    want = [(r.date, r.symbol, r.intraday_volatility) for r in built.collect()]
    publish(built.repartition(9), str(tmp_path), top_volatility.order(params), single, [top_volatility.VALUE])
    files = sorted((tmp_path / "csv").glob("part-*.csv"))
    lines = [line.split("|") for file in files for line in file.read_text().splitlines()[1:]]
    assert [(d, s, v) for d, s, _, _, _, v in lines] == [(str(d), s, v) for d, s, v in want]
    assert (len(files) == 1) or not single
    assert spark.read.parquet(str(tmp_path / "parquet")).columns == [c for c in built.columns if c != top_volatility.VALUE]
