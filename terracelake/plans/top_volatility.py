"""The days on which chosen stocks moved most between low and high."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terracelake.config import TopVolatility
from terracelake.functions import percent_range
from terracelake.operators import date_between, is_one_of, top_k


VALUE = "_volatility"


def order(params: TopVolatility = TopVolatility()) -> list[Column]:
    """Needs the column ``VALUE`` where the order is numeric."""
    return [F.col(VALUE if params.numeric_order else "intraday_volatility").desc(), F.col("date"), F.col("symbol")]


def build(stocks: DataFrame, params: TopVolatility = TopVolatility(), keep_value: bool = False) -> DataFrame:
    """``stocks``: date, symbol, high, low, close. The filters see the stored symbol, so
    they prune partitions; the output shows it in upper case.

    By default the percentage sorts as the text it is shown as, so 9.00 comes before
    22.50 when descending; ``numeric_order`` sorts by its value, which ``keep_value`` adds.
    """
    chosen = stocks.filter(is_one_of("symbol", params.symbols)
                           & date_between("date", params.start, params.end))
    volatility = percent_range(F.col("high"), F.col("low"), F.col("close"))
    shown = chosen.select(
        "date",
        F.ucase("symbol").alias("symbol"),
        "close",
        F.format_number("high", 4).alias("high"),
        F.format_number("low", 4).alias("low"),
        F.format_number(volatility, 2).alias("intraday_volatility"),
        volatility.alias(VALUE),
    )
    top = top_k(shown, params.rows, order(params))
    return top if keep_value else top.drop(VALUE)
