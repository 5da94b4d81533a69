"""Small inputs with results worked out by hand."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession


def bakery(spark: SparkSession) -> DataFrame:
    items = ["Bread", "Bread", "NONE", "Adjustment", "Tea", None]
    return spark.createDataFrame([(item,) for item in items], "item string")


def movies(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([
        ("1", "A", "2000-01-02", "1.5"),
        ("2", "B", "bad", "x"),
        ("3", "C", None, "2.5"),
        ("1997-08-20", "D", "2001-01-01", None),
    ], "id string, title string, release_date string, popularity string")


def ratings(spark: SparkSession) -> DataFrame:
    """The first two are at the very start and end of 2016, the third just after it."""
    return spark.createDataFrame([
        (1, 4.0, 1451606400), (1, 5.0, 1483228799), (3, 4.0, 1483228800), (2, 3.0, 1460000000),
    ], "movieid bigint, rating double, timestamp bigint")


def keywords(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(1, "Robot"), (1, "robot arm"), (2, "Artificial Intelligence")], "id bigint, keywords string")


def cast(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(1, "Will Smith"), (2, "Keanu Reeves")], "id bigint, cast string")


def stocks(spark: SparkSession) -> DataFrame:
    day = [date(2017, 1, n) for n in range(1, 4)]
    return spark.createDataFrame([
        (day[0], "aapl", 11.25, 9.0, 10.0), (day[1], "aapl", 10.5, 9.6, 10.0),
        (day[2], "aapl", 1100.0, 9.0, 10.0), (day[0], "ibm", 100.0, 99.0, 100.0),
        (day[1], "ibm", 100.0, 91.0, 100.0),
    ], "date date, symbol string, high double, low double, close double")
