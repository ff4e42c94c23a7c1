"""Row selection by key: latest row, deduplication, merge of old and new rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unique keys of the stored record types.
UNIQUE_KEYS = {
    "tickers": ["instrument_name", "timestamp"],
    "orderbook": ["instrument_name", "timestamp"],
    "trades": ["instrument_name", "trade_id"],
    "greeks": ["instrument_name", "timestamp"],
    "mark_prices": ["instrument_name", "timestamp"],
    "settlement_prices": ["instrument_name", "timestamp"],
}
_NAMING = ("exchange", "symbol", "instrument_name")


def natural_key(df: DataFrame, on: str = "timestamp") -> list[str]:
    """Time plus whichever naming columns the table has."""
    return [on, *[c for c in _NAMING if c in df.columns]]


def _pick(df: DataFrame, keys: list[str], order: list[Column], keep: str) -> DataFrame:
    """One whole row per key.  An aggregate, not a window: a key that holds most of the
    rows is reduced on the map side before anything is shuffled."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    chosen = F.max_by if keep == "last" else F.min_by
    rank = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    picked = df.groupBy(*keys).agg(chosen(F.struct(*rest), rank).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns])


def latest_per_key(df: DataFrame, keys: list[str], on: str = "timestamp", seq: str | None = None) -> DataFrame:
    """The newest row of every key; ``seq`` decides between equal times."""
    order = [F.col(on), *([F.col(seq)] if seq else [])]
    return _pick(df, keys, order, "last")


def dedupe(df: DataFrame, keys: list[str], order_by: list[str], keep: str = "last") -> DataFrame:
    """One row per key: the last or first in ``order_by``."""
    return _pick(df, keys, [F.col(c) for c in order_by], keep)


def merge(
    existing: DataFrame, incoming: DataFrame, keys: list[str], order_by: list[str], keep: str = "last"
) -> DataFrame:
    """Union of both, one row per key.  ``last`` lets incoming rows win, ``first`` the
    existing ones; inside one side ``order_by`` decides."""
    both = existing.withColumn("_batch", F.lit(0)).unionByName(
        incoming.withColumn("_batch", F.lit(1)), allowMissingColumns=True
    )
    order = [F.col("_batch"), *[F.col(c) for c in order_by]]
    return _pick(both, keys, order, keep).drop("_batch")


def rows_added(existing: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming keys that the existing table does not have."""
    return incoming.select(*keys).distinct().join(existing.select(*keys), keys, "left_anti")
