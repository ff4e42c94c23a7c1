"""Spot-perp, synthetic and cross-exchange basis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .asof import asof_join
from .blocks import BLOCK_MS
from .tables import latest_per_key

DAYS_PER_YEAR = 365


def _points(df: DataFrame, kind: str, base: str, other: str, days: int, symbol: Column, lead: list[str]) -> DataFrame:
    """Basis of ``other`` over ``base``; percent of ``base``."""
    basis = F.col(other) - F.col(base)
    pct = F.when(F.col(base) != 0, basis / F.col(base) * 100).when(F.col(base) == 0, 0.0)
    return df.select(
        *lead,
        "timestamp",
        symbol.alias("symbol"),
        F.lit(kind).alias("basis_type"),
        F.col(base).alias("spot_price"),
        F.col(other).alias("perp_price"),
        basis.alias("basis"),
        pct.alias("basis_pct"),
        (pct * F.try_divide(F.lit(float(DAYS_PER_YEAR)), F.lit(float(days)))).alias("annualized_basis"),
        F.lit(days).alias("days_to_expiry"),
    )


def _paired(a: DataFrame, b: DataFrame, keys: list[str], seq: str | None, block_ms: int) -> DataFrame:
    left = a.withColumnRenamed("price", "_price_a")
    right = b.select(*keys, "timestamp", "price", *([seq] if seq else []))
    return asof_join(
        left, right, keys=keys, direction="nearest", tolerance_ms=None, columns=["price"],
        seq=seq, rename={"price": "_price_b"}, block_ms=block_ms, ages=False,
    )


def spot_perp(
    spot: DataFrame, perp: DataFrame, symbol: str | Column, days_to_expiry: int = DAYS_PER_YEAR,
    keys: list[str] | None = None, seq: str | None = None, carry: list[str] | None = None, block_ms: int = BLOCK_MS,
) -> DataFrame:
    """One basis point per spot row, against the perp row nearest in time."""
    keys = list(keys or [])
    sym = symbol if isinstance(symbol, Column) else F.lit(symbol)
    return _points(
        _paired(spot, perp, keys, seq, block_ms), "spot_perp", "_price_a", "_price_b",
        days_to_expiry, sym, [*keys, *(carry or [])],
    )


def cross_exchange(
    a: DataFrame, b: DataFrame, symbol: str | Column = "CROSS_EXCHANGE", days_to_expiry: int = DAYS_PER_YEAR,
    keys: list[str] | None = None, seq: str | None = None, carry: list[str] | None = None, block_ms: int = BLOCK_MS,
) -> DataFrame:
    """Price on venue a minus price on venue b, one point per a-row."""
    keys = list(keys or [])
    sym = symbol if isinstance(symbol, Column) else F.lit(symbol)
    return _points(
        _paired(a, b, keys, seq, block_ms), "cross_exchange", "_price_b", "_price_a",
        days_to_expiry, sym, [*keys, *(carry or [])],
    )


def synthetic(
    legs: DataFrame, call: str, put: str, strike: str, perp: str, rate: float | Column, days: str,
    carry: list[str] | None = None,
) -> DataFrame:
    """Basis of the perp over the put-call-parity forward, one point per row of legs."""
    r = rate if isinstance(rate, Column) else F.lit(float(rate))
    forward = F.col(call) - F.col(put) + F.col(strike) * F.exp(-r * F.col(days) / DAYS_PER_YEAR)
    staged = legs.withColumn("_forward", forward)
    basis = F.col(perp) - F.col("_forward")
    pct = F.when(F.col(perp) != 0, basis / F.col(perp) * 100).when(F.col(perp) == 0, 0.0)
    return staged.select(
        *(carry or []),
        F.lit("SYNTHETIC").alias("symbol"),
        F.lit("synthetic").alias("basis_type"),
        F.col("_forward").alias("spot_price"),
        F.col(perp).alias("perp_price"),
        basis.alias("basis"),
        pct.alias("basis_pct"),
        F.when(F.col(days) > 0, pct * F.try_divide(F.lit(float(DAYS_PER_YEAR)), F.col(days)))
        .otherwise(F.lit(0.0))
        .alias("annualized_basis"),
        F.col(days).alias("days_to_expiry"),
    )


def call_put_legs(chain: DataFrame, keys: list[str], seq: str, mid: str = "mid_price") -> DataFrame:
    """One row per (keys, expiry, strike) listed on both sides: latest call and put mid."""
    group = [*keys, "expiry", "strike"]

    def side(kind: str) -> Column:
        return F.max_by(mid, F.when(F.col("option_type") == kind, F.col(seq)))

    return (
        chain.groupBy(*group)
        .agg(side("C").alias("call_mid"), side("P").alias("put_mid"))
        .filter(F.col("call_mid").isNotNull() & F.col("put_mid").isNotNull())
    )


def live_basis(
    spot: DataFrame, perp: DataFrame, mapping: DataFrame, now_ms: int, on: str = "timestamp", seq: str | None = None,
) -> DataFrame:
    """Latest spot against latest perp per currency.

    ``mapping`` tells the currency of each spot symbol.
    """
    s = latest_per_key(spot, ["symbol"], on, seq).select("symbol", F.col("price").alias("_spot"))
    p = latest_per_key(perp, ["currency"], on, seq).select("currency", F.col("price").alias("_perp"))
    both = s.join(mapping, "symbol").join(p, "currency").filter(
        (F.col("_spot") > 0) & (F.col("_perp") != 0)
    )
    return _points(
        both.withColumn("timestamp", F.lit(now_ms)), "spot_perp", "_spot", "_perp", DAYS_PER_YEAR,
        F.concat(F.col("currency"), F.lit("_USDT")), [],
    )
