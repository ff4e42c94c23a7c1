"""Landed candle payloads -> OHLCV rows.

Input frames hold one payload per row (JSON text in ``payload``) next to the naming
columns ``exchange``, ``symbol`` and ``timeframe``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAMING = ("exchange", "symbol", "timeframe")
PRICES = ("open", "high", "low", "close")


def _names(df: DataFrame, extra: list[str] | None) -> list[str]:
    return [*(extra or []), *[c for c in NAMING if c in df.columns]]


def klines(df: DataFrame, payload: str = "payload", extra: list[str] | None = None) -> DataFrame:
    """Array of positional arrays: time, open, high, low, close, volume, close time,
    quote volume (0.0 where the array is shorter)."""
    k = F.explode(F.from_json(payload, "array<array<string>>"))
    rows = df.select(*_names(df, extra), k.alias("_k"))

    def at(i: int) -> Column:
        return F.get(F.col("_k"), F.lit(i))

    return rows.select(
        *_names(df, extra),
        at(0).try_cast("bigint").alias("timestamp"),
        *[at(i + 1).try_cast("double").alias(c) for i, c in enumerate(PRICES)],
        at(5).try_cast("double").alias("volume"),
        F.coalesce(at(7).try_cast("double"), F.lit(0.0)).alias("quote_volume"),
        F.lit(None).cast("int").alias("trades"),
    )


_CHART = "ticks array<bigint>, open array<double>, high array<double>, low array<double>, close array<double>, volume array<double>"


def chart_arrays(df: DataFrame, payload: str = "payload", extra: list[str] | None = None) -> DataFrame:
    """Parallel arrays under ``result``; one row per tick, short arrays padded with 0.0."""
    parsed = df.select(*_names(df, extra), F.from_json(payload, f"result struct<{_CHART.replace(' array', ':array')}>")["result"].alias("_c"))
    rows = parsed.select(*_names(df, extra), "_c", F.posexplode("_c.ticks").alias("_i", "timestamp"))

    def padded(name: str) -> Column:
        return F.coalesce(F.get(F.col(f"_c.{name}"), F.col("_i")), F.lit(0.0)).alias(name)

    return rows.select(
        *_names(df, extra),
        "timestamp",
        *[padded(c) for c in (*PRICES, "volume")],
        F.lit(0.0).alias("quote_volume"),
        F.lit(None).cast("int").alias("trades"),
    )


def chart_lengths(df: DataFrame, payload: str = "payload", extra: list[str] | None = None) -> DataFrame:
    """Per payload: number of ticks and whether every other array is as long."""
    parsed = df.select(*_names(df, extra), F.from_json(payload, f"result struct<{_CHART.replace(' array', ':array')}>")["result"].alias("_c"))
    ticks = F.size("_c.ticks")
    same = F.lit(True)
    for name in (*PRICES, "volume"):
        same = same & (F.coalesce(F.size(f"_c.{name}"), F.lit(-1)) == ticks)
    return parsed.filter(F.col("_c").isNotNull()).select(
        *_names(df, extra), ticks.alias("ticks"), same.alias("equal_lengths")
    )


_CANDLE = "array<struct<t:bigint,o:string,h:string,l:string,c:string,v:string,n:int>>"


def candle_objects(df: DataFrame, payload: str = "payload", extra: list[str] | None = None) -> DataFrame:
    """Candle objects as a list or under ``data``; candles without volume are dropped, a
    trade count of 0 becomes null."""
    bare = F.startswith(F.ltrim(F.col(payload)), F.lit("["))
    listed = F.when(bare, F.from_json(payload, _CANDLE)).otherwise(
        F.from_json(payload, f"struct<data:{_CANDLE}>")["data"]
    )
    rows = df.select(*_names(df, extra), F.explode(listed).alias("_c"))
    volume = F.coalesce(F.col("_c.v").try_cast("double"), F.lit(0.0))
    return rows.filter(volume > 0).select(
        *_names(df, extra),
        F.col("_c.t").alias("timestamp"),
        *[F.col(f"_c.{c[0]}").try_cast("double").alias(c) for c in PRICES],
        volume.alias("volume"),
        F.lit(0.0).alias("quote_volume"),
        F.nullif(F.col("_c.n"), F.lit(0)).alias("trades"),
    )
