"""Rating values given in a time range, in buckets, with their films' popularity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracelake.config import RatingBuckets
from terracelake.functions import bigint_or_null, double_or_null, rounded_mean
from terracelake.operators import epoch_between, ntile


def order() -> list[Column]:
    return [F.col("rank").asc(), F.col("avg_rating").desc()]


def build(movies: DataFrame, ratings: DataFrame,
          params: RatingBuckets = RatingBuckets()) -> DataFrame:
    """``movies``: id, popularity; ``ratings``: movieid, rating, timestamp (seconds).

    Ratings of unknown films and films without ratings in the range play no part.
    """
    return ntile(
        rating_totals(movies, ratings, params), params.buckets, [F.col("avg_rating").desc()],
    ).select("rank", "avg_rating", "ratings_count", "popularity")


def rating_totals(movies: DataFrame, ratings: DataFrame, params: RatingBuckets) -> DataFrame:
    """avg_rating, ratings_count, popularity: one row per rating value.

    Films are reduced to one row of numbers per id, and ratings are counted per film and
    value, before they are shuffled.
    """
    popularity = double_or_null("popularity")
    films = (
        movies.groupBy(bigint_or_null("id").alias("movieid"))
        .agg(F.count(F.lit(1)).alias("films"), F.count(popularity).alias("known"),
             F.sum(popularity).alias("popularity_sum"))
        .filter(F.col("movieid").isNotNull())
    )
    given = ratings.filter(
        F.col("rating").isNotNull() & F.col("movieid").isNotNull()
        & epoch_between("timestamp", params.start, params.end))
    given = given.groupBy("movieid", "rating").agg(F.count(F.lit(1)).alias("times"))
    times = F.col("times")
    # All ratings of a group are equal, so the group's mean is its key.
    return (
        given.join(films, "movieid")
        .groupBy(F.col("rating").cast("double").alias("avg_rating"))
        .agg(
            F.sum(times * F.col("films")).alias("ratings_count"),
            rounded_mean(F.sum(times * F.col("popularity_sum")), F.sum(times * F.col("known")), 2)
            .alias("popularity"),
        )
    )
