"""Where the layers lie, and the parameters of each analysis."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

# Data set names, search words, defaults and folder names.
BAKERY_TABLE = "bakery"
MOVIE_TABLES = (
    "credits", "keywords", "links", "links_small", "movies_metadata", "ratings", "ratings_small",
)
STOCK_SYMBOLS = (
    "AAPL", "AXP", "BA", "CAT", "CSCO", "CVX", "DIS", "DWDP", "GS", "HD", "IBM", "INTC", "JNJ", "JPM",
    "KO", "MCD", "MMM", "MRK", "MSFT", "NKE", "PFE", "PG", "TRV", "UNH", "UTX", "V", "VZ", "WBA", "WMT", "XOM",
)
NOT_FOR_SALE = ("NONE", "Adjustment")
KEYWORD_WORDS = ("artificial intelligence", "robot")
CAST_NAMES = ("will smith", "arnold schwarzenegger", "keanu reeves")
CHOICE_BUCKETS = 3
RATING_BUCKETS = 10
RATINGS_START, RATINGS_END = "2016-01-01 00:00:00", "2016-12-31 23:59:59"
VOLATILITY_SYMBOLS = ("aapl", "ibm", "msft")
VOLATILITY_START, VOLATILITY_END = "2017-01-01", "2018-12-31"
VOLATILITY_ROWS = 10
RAW_PREFIX, PROCESSED_PREFIX = "raw_", "processed_"
BAKERY_DIR, MOVIE_DIR, STOCK_DIR = "bakery", "movie_ratings", "stocks"
ITEM_SALES_DIR = "bakery/bakery_sales"
MOVIE_CHOICES_DIR = "movies/movie_choices"
RATING_BUCKETS_DIR = "movies/avg_ratings"
TOP_VOLATILITY_DIR = "stocks/stock_volatility"


@dataclass(frozen=True)
class Locations:
    """Root URI of each layer, on any file system Spark can reach."""

    bronze: str | None = None
    silver: str | None = None
    gold: str | None = None

    @classmethod
    def from_session(cls, spark: SparkSession, **given: str | None) -> Locations:
        """Given values first, then ``spark.terracelake.<layer>`` of the session."""
        return cls(**{
            layer: given.get(layer) or spark.conf.get(f"spark.terracelake.{layer}", None)
            for layer in ("bronze", "silver", "gold")
        })

    def path(self, layer: str, *parts: str) -> str:
        root = getattr(self, layer)
        if not root:
            raise ValueError(f"no {layer} location given")
        return "/".join([root.rstrip("/"), *parts])


@dataclass(frozen=True)
class MovieChoices:
    keyword_words: tuple[str, ...] = KEYWORD_WORDS
    cast_names: tuple[str, ...] = CAST_NAMES
    buckets: int = CHOICE_BUCKETS


@dataclass(frozen=True)
class RatingBuckets:
    start: str = RATINGS_START
    end: str = RATINGS_END
    buckets: int = RATING_BUCKETS


@dataclass(frozen=True)
class TopVolatility:
    symbols: tuple[str, ...] = VOLATILITY_SYMBOLS
    start: str = VOLATILITY_START
    end: str = VOLATILITY_END
    rows: int = VOLATILITY_ROWS
    numeric_order: bool = False
