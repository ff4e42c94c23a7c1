"""Chain -> Greeks -> surface, with the rate taken from the day's yield curve."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import options, rates


def greeks_with_curve(chain: DataFrame, curve: DataFrame, day: str, now_ms: Column, extra: list[str], as_float: bool = True) -> DataFrame:
    """Price each row with the three-month rate of its own day; the fallback rate where
    the curve has no such day.  The curve has one row per day, the join is by day."""
    rate = rates.three_month_rate(curve).withColumnRenamed("date", day)
    priced = chain.join(rate, day, "left").withColumn(
        "risk_free_rate", F.coalesce("risk_free_rate", F.lit(options.DEFAULT_RATE))
    )
    return options.greeks_batch(
        priced, now_ms, F.col("risk_free_rate"), extra=[*extra, "risk_free_rate"], as_float=as_float
    )


def surface_from_chain(
    chain: DataFrame, keys: list[str], seq: str, now_ms: int, rate: float = options.DEFAULT_RATE,
    history: DataFrame | None = None, as_float: bool = True,
) -> DataFrame:
    """What the volatility surface looks like per currency, from raw chain rows."""
    priced = options.greeks_batch(chain, now_ms, rate, extra=[*keys, seq], as_float=as_float)
    return surface_from_greeks(priced, keys, seq, history)


def surface_from_greeks(priced: DataFrame, keys: list[str], seq: str, history: DataFrame | None = None) -> DataFrame:
    """The surface over priced contracts, all at the underlying of their group's first row."""
    return options.vol_surface(options.first_underlying(priced, keys, seq), keys, seq, history=history)
