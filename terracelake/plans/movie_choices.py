"""Films that fit a taste, with their ratings, in buckets from best to worst."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracelake.config import MovieChoices
from terracelake.functions import bigint_or_null, date_or_null, rounded_mean
from terracelake.operators import contains_any, ntile


def order() -> list[Column]:
    return [F.col("rank").asc(), F.col("avg_rating").desc(), F.col("ratings_count").desc(),
            F.col("title").asc()]


def build(movies: DataFrame, ratings: DataFrame, keywords: DataFrame, cast: DataFrame,
          params: MovieChoices = MovieChoices()) -> DataFrame:
    """``movies``: id, title, release_date, popularity; ``ratings``: movieid, rating;
    ``keywords``: id, keywords; ``cast``: id, cast.

    A film with several matching keyword or cast rows counts its ratings once for each
    pair of them. The pairs are not built: every input is first reduced to one row
    per film, and the counts are multiplied.
    """
    picks = pick_totals(movies, film_scores(ratings, matching_films(keywords, cast, params)))
    ranked = ntile(picks, params.buckets,
                   [F.col("avg_rating").desc(), F.col("title"), F.col("release_date"),
                    F.col("popularity")])
    return ranked.select(
        "title", "rank", "avg_rating", "ratings_count", "popularity",
        date_or_null("release_date").alias("release_date"),
    ).orderBy(*order())


def matching_films(keywords: DataFrame, cast: DataFrame, params: MovieChoices) -> DataFrame:
    """id, copies: the films with a matching keyword and a matching name."""
    by_keyword = (keywords.filter(contains_any("keywords", params.keyword_words))
                  .groupBy(bigint_or_null("id").alias("id"))
                  .agg(F.count(F.lit(1)).alias("keyword_rows")))
    by_cast = (cast.filter(contains_any("cast", params.cast_names))
               .groupBy(bigint_or_null("id").alias("id"))
               .agg(F.count(F.lit(1)).alias("cast_rows")))
    return by_keyword.join(by_cast, "id").select(
        "id", (F.col("keyword_rows") * F.col("cast_rows")).alias("copies"))


def film_scores(ratings: DataFrame, matches: DataFrame) -> DataFrame:
    """id, copies, rating_rows, rated, rating_sum: one row per matching rated film.

    It is totals per film that are shuffled and joined, not ratings.
    """
    totals = [F.count(F.lit(1)).alias("rating_rows"), F.count("rating").alias("rated"),
              F.sum("rating").alias("rating_sum")]
    return matches.join(ratings.groupBy(F.col("movieid").alias("id")).agg(*totals), "id")


def pick_totals(movies: DataFrame, scores: DataFrame) -> DataFrame:
    """title, release_date, popularity, ratings_count, avg_rating: one row per pick."""
    films = movies.select(bigint_or_null("id").alias("id"), "title", "release_date", "popularity")
    copies = F.col("copies")
    return (
        films.filter(F.col("id").isNotNull()).join(scores, "id")
        .groupBy("title", "release_date", "popularity")
        .agg(
            F.sum(F.col("rating_rows") * copies).alias("ratings_count"),
            rounded_mean(F.sum(F.col("rating_sum") * copies), F.sum(F.col("rated") * copies), 3)
            .alias("avg_rating"),
        )
        .filter(F.col("avg_rating") > 0)
    )
