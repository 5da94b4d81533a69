"""One command per job: ``python -m terracelake <job> ...``."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from terracelake import config
from terracelake.config import Locations, MovieChoices, RatingBuckets, TopVolatility
from terracelake.plans import convert, item_sales, movie_choices, rating_buckets, top_volatility
from terracelake.session import clear_scratch, get_session
from terracelake.sinks import publish
from terracelake.sources import read_parquet, read_table, register_tables, use_database


def _input(spark: SparkSession, args: argparse.Namespace, at: Locations,
           folder: str, table: str) -> DataFrame:
    """A processed table: from the catalog if a database is given, else by path."""
    if args.database:
        use_database(spark, args.database)
        return read_table(spark, config.PROCESSED_PREFIX + table)
    return read_parquet(spark, at.path("silver", *dict.fromkeys([folder, table])))


def run_item_sales(spark: SparkSession, args: argparse.Namespace, at: Locations) -> None:
    sales = _input(spark, args, at, config.BAKERY_DIR, config.BAKERY_TABLE)
    publish(item_sales.build(sales), at.path("gold", config.ITEM_SALES_DIR), item_sales.order(), not args.parts)


def run_movie_choices(spark: SparkSession, args: argparse.Namespace, at: Locations) -> None:
    movies, ratings, keywords, cast = (
        _input(spark, args, at, config.MOVIE_DIR, table)
        for table in ("movies_metadata", "ratings", "keywords", "credits"))
    params = MovieChoices(tuple(args.keyword), tuple(args.cast), args.buckets)
    publish(movie_choices.build(movies, ratings, keywords, cast, params),
            at.path("gold", config.MOVIE_CHOICES_DIR), movie_choices.order(), not args.parts)


def run_rating_buckets(spark: SparkSession, args: argparse.Namespace, at: Locations) -> None:
    movies, ratings = (_input(spark, args, at, config.MOVIE_DIR, table)
                       for table in ("movies_metadata", "ratings_small"))
    params = RatingBuckets(args.start, args.end, args.buckets)
    publish(rating_buckets.build(movies, ratings, params),
            at.path("gold", config.RATING_BUCKETS_DIR), rating_buckets.order(), not args.parts)


def run_top_volatility(spark: SparkSession, args: argparse.Namespace, at: Locations) -> None:
    stocks = _input(spark, args, at, config.STOCK_DIR, "stocks")
    params = TopVolatility(tuple(args.symbol), args.start, args.end, args.rows, args.numeric_order)
    publish(top_volatility.build(stocks, params, keep_value=True), at.path("gold", config.TOP_VOLATILITY_DIR),
            top_volatility.order(params), not args.parts, [top_volatility.VALUE])


def run_convert_bakery(spark: SparkSession, args: argparse.Namespace, at: Locations) -> None:
    convert.convert_one(
        spark, at.path("bronze", config.BAKERY_DIR, f"{config.BAKERY_TABLE}.csv"),
        at.path("silver", config.BAKERY_DIR), args.schema, args.quoted_text)


def run_convert_movies(spark: SparkSession, args: argparse.Namespace, at: Locations) -> None:
    convert.convert_many(
        spark, at.path("bronze", config.MOVIE_DIR), at.path("silver", config.MOVIE_DIR),
        config.MOVIE_TABLES, schemas=dict(args.schema), quoted_text=args.quoted_text)


def run_convert_stocks(spark: SparkSession, args: argparse.Namespace, at: Locations) -> None:
    convert.convert_partitioned(
        spark, at.path("bronze", config.STOCK_DIR), at.path("silver", config.STOCK_DIR),
        args.symbol, "symbol", args.schema, args.keep_others)


def run_register(spark: SparkSession, args: argparse.Namespace, at: Locations) -> None:
    raw = args.layer == "bronze"
    prefix = config.RAW_PREFIX if raw else config.PROCESSED_PREFIX
    for name in register_tables(spark, at.path(args.layer), args.database, prefix,
                                source="csv" if raw else "parquet",
                                merge_schema=not args.same_schema, move=args.move,
                                one_per_file=(config.MOVIE_DIR,) if raw else ()):
        print(name)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="terracelake", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, run: Callable, *layers: str, database: bool = False) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.set_defaults(run=run)
        for layer in layers:
            sub.add_argument(f"--{layer}", help=f"{layer} location; default: spark.terracelake.{layer}")
        sub.add_argument("--database", required=database, help="catalog database")
        if "gold" in layers:
            sub.add_argument("--parts", action="store_true", help="write the text as ordered part files, not as one file")
        sub.add_argument("--hive", action="store_true", help="use the Hive-compatible metastore")
        return sub

    job("item-sales", run_item_sales, "silver", "gold")

    choices = job("movie-choices", run_movie_choices, "silver", "gold")
    choices.add_argument("--keyword", nargs="+", default=config.KEYWORD_WORDS)
    choices.add_argument("--cast", nargs="+", default=config.CAST_NAMES)
    choices.add_argument("--buckets", type=int, default=config.CHOICE_BUCKETS)

    ratings = job("rating-buckets", run_rating_buckets, "silver", "gold")
    ratings.add_argument("--start", default=config.RATINGS_START)
    ratings.add_argument("--end", default=config.RATINGS_END)
    ratings.add_argument("--buckets", type=int, default=config.RATING_BUCKETS)

    volatility = job("top-volatility", run_top_volatility, "silver", "gold")
    volatility.add_argument("--symbol", nargs="+", default=config.VOLATILITY_SYMBOLS)
    volatility.add_argument("--start", default=config.VOLATILITY_START)
    volatility.add_argument("--end", default=config.VOLATILITY_END)
    volatility.add_argument("--rows", type=int, default=config.VOLATILITY_ROWS)
    volatility.add_argument("--numeric-order", action="store_true")

    bakery = job("convert-bakery", run_convert_bakery, "bronze", "silver")
    bakery.add_argument("--schema", help="DDL text; saves the inference pass")
    bakery.add_argument("--quoted-text", action="store_true")

    movies = job("convert-movies", run_convert_movies, "bronze", "silver")
    movies.add_argument("--schema", action="append", default=[], metavar="TABLE=DDL",
                        type=lambda text: text.split("=", 1),
                        help="saves a table's inference pass; may be repeated")
    movies.add_argument("--quoted-text", action="store_true",
                        help="allow line breaks and doubled quotes inside quoted fields")

    stocks = job("convert-stocks", run_convert_stocks, "bronze", "silver")
    stocks.add_argument("--symbol", nargs="+", default=config.STOCK_SYMBOLS)
    stocks.add_argument("--schema", help="DDL text; saves the inference pass")
    stocks.add_argument("--keep-others", action="store_true",
                        help="replace only the partitions of the given symbols")

    register = job("register", run_register, "bronze", "silver", database=True)
    register.add_argument("--layer", choices=("bronze", "silver"), default="silver")
    register.add_argument("--same-schema", action="store_true",
                          help="all files of a folder have the same columns")
    register.add_argument("--move", action="store_true", help="let tables that lie elsewhere follow the data")
    return top


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    own = spark is None
    spark = spark or get_session(args.job, hive=args.hive)
    layers = {layer: getattr(args, layer, None) for layer in ("bronze", "silver", "gold")}
    try:
        args.run(spark, args, Locations.from_session(spark, **layers))
    finally:
        if own:
            clear_scratch(spark)
