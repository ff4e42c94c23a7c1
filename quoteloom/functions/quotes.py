"""Two-sided quote arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def two_sided(bid: Column, ask: Column) -> Column:
    return (bid > 0) & (ask > 0)


def mid_price(bid: Column, ask: Column) -> Column:
    return F.when(two_sided(bid, ask), (bid + ask) / 2).otherwise(F.lit(0.0))


def spread(bid: Column, ask: Column) -> Column:
    return F.when(two_sided(bid, ask), ask - bid).otherwise(F.lit(0.0))


def spread_bps(bid: Column, ask: Column) -> Column:
    mid = mid_price(bid, ask)
    return F.when(mid > 0, spread(bid, ask) / mid * 10000).otherwise(F.lit(0.0))
