"""Strategies and the data they need, as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks import store

DAY_MS = 86_400_000

# Strategy, title, its priority, number of the requirement, data type, exchanges,
# symbols, frequency, rank.
REQUIREMENTS = (
    ("short_strangle", "Short Strangle + Perp Hedge", "P0", 0, "options_greeks", ["deribit"], ["BTC", "ETH"], "5s", 0),
    ("short_strangle", "Short Strangle + Perp Hedge", "P0", 1, "mark_price", ["deribit"], ["BTC-PERPETUAL", "ETH-PERPETUAL"], "1s", 0),
    ("short_strangle", "Short Strangle + Perp Hedge", "P0", 2, "funding_rate", ["binance", "deribit"], ["BTCUSDT", "BTC-PERPETUAL"], "8h", 2),
    ("short_strangle", "Short Strangle + Perp Hedge", "P0", 3, "margin_params", ["deribit"], ["BTC", "ETH"], "1d", 2),
    ("synthetic_covered_call", "Synthetic Covered Call", "P0", 0, "options_greeks", ["deribit"], ["BTC", "ETH"], "5s", 0),
    ("synthetic_covered_call", "Synthetic Covered Call", "P0", 1, "mark_price", ["deribit"], ["BTC-PERPETUAL", "ETH-PERPETUAL"], "1m", 1),
    ("synthetic_covered_call", "Synthetic Covered Call", "P0", 2, "funding_rate", ["binance", "deribit", "hyperliquid"], ["BTCUSDT", "BTC-PERPETUAL", "BTC"], "8h", 2),
    ("collar", "Collar Strategy", "P0", 0, "options_greeks", ["deribit"], ["BTC", "ETH"], "5s", 0),
    ("collar", "Collar Strategy", "P0", 1, "mark_price", ["deribit"], ["BTC-PERPETUAL"], "1m", 1),
    ("funding_arb", "Funding Rate Arbitrage + Option Protection", "P1", 0, "funding_rate", ["binance", "deribit", "hyperliquid"], ["BTCUSDT", "BTC-PERPETUAL", "BTC"], "8h", 0),
    ("funding_arb", "Funding Rate Arbitrage + Option Protection", "P1", 1, "mark_price", ["binance", "deribit"], ["BTCUSDT", "BTC-PERPETUAL"], "1m", 1),
    ("funding_arb", "Funding Rate Arbitrage + Option Protection", "P1", 2, "options_greeks", ["deribit"], ["BTC"], "5s", 2),
    ("funding_arb", "Funding Rate Arbitrage + Option Protection", "P1", 3, "basis", ["binance", "deribit"], ["BTCUSDT", "BTC-PERPETUAL"], "1m", 1),
    ("gamma_scalping", "Gamma Scalping", "P1", 0, "options_greeks", ["deribit"], ["BTC", "ETH"], "5s", 0),
    ("gamma_scalping", "Gamma Scalping", "P1", 1, "mark_price", ["deribit"], ["BTC-PERPETUAL"], "1s", 0),
    ("gamma_scalping", "Gamma Scalping", "P1", 2, "margin_params", ["deribit"], ["BTC"], "1d", 2),
    ("vol_term_structure", "Volatility Term Structure Arb", "P2", 0, "options_greeks", ["deribit"], ["BTC", "ETH"], "5s", 0),
    ("vol_term_structure", "Volatility Term Structure Arb", "P2", 1, "vol_surface", ["deribit"], ["BTC", "ETH"], "10s", 1),
    ("vol_term_structure", "Volatility Term Structure Arb", "P2", 2, "risk_free_rate", ["fred"], ["USD"], "1d", 2),
)

SCHEMA = (
    "strategy string, display_name string, strategy_priority string, requirement int, data_type string, "
    "exchanges array<string>, symbols array<string>, frequency string, priority int"
)
CELL = ["exchange", "data_type", "symbol"]


def registry(spark: SparkSession, requirements: tuple = REQUIREMENTS) -> DataFrame:
    """One row per requirement.  Pass a longer tuple to register further strategies."""
    return spark.createDataFrame(requirements, SCHEMA)


def with_priority(reg: DataFrame, priority: str | list[str]) -> DataFrame:
    """All strategies, or those of the listed priorities (``"P0,P1"`` or a list)."""
    if priority == "all":
        return reg
    wanted = priority.split(",") if isinstance(priority, str) else list(priority)
    return reg.filter(F.col("strategy_priority").isin(*[w.strip() for w in wanted]))


def cells(reg: DataFrame) -> DataFrame:
    """Every (exchange, symbol) of every requirement."""
    return (
        reg.withColumn("exchange", F.explode("exchanges"))
        .withColumn("symbol", F.explode("symbols"))
        .drop("exchanges", "symbols")
    )


def plan(reg: DataFrame, now_ms: int, days: int = 1) -> DataFrame:
    """Cells with the time range to collect and their place in the strategy's order."""
    return cells(reg).withColumns(
        {"start_ms": F.lit(now_ms - days * DAY_MS), "end_ms": F.lit(now_ms)}
    )


def unknown(spark: SparkSession, reg: DataFrame, names: list[str] | DataFrame) -> DataFrame:
    """Requested strategies (a list, or a table with ``strategy``) that are not registered."""
    asked = names if isinstance(names, DataFrame) else spark.createDataFrame([(n,) for n in names], "strategy string")
    return asked.join(reg.select("strategy").distinct(), "strategy", "left_anti")


def landed_counts(landed: DataFrame, start: Column | None = None, end: Column | None = None, on: str = "timestamp") -> DataFrame:
    """Rows per cell of a landed table; the large side is reduced before it meets the plan."""
    rows = landed
    if start is not None:
        rows = rows.filter(F.col(on) >= start)
    if end is not None:
        rows = rows.filter(F.col(on) < end)
    return rows.groupBy(*CELL).agg(F.count(F.lit(1)).alias("rows"))


def run_counts(planned: DataFrame, landed: DataFrame, now_ms: int, days: int) -> DataFrame:
    """Rows each strategy collects per data type, over all its requirements of that type."""
    counts = landed_counts(landed, F.lit(now_ms - days * DAY_MS), F.lit(now_ms))
    return (
        planned.join(counts, CELL, "left")
        .groupBy("strategy", "data_type")
        .agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"))
    )


def run_rows(planned: DataFrame, landed: DataFrame) -> DataFrame:
    """The landed rows a plan selects, each once, ready for the table sink."""
    wanted = planned.groupBy(*CELL).agg(F.min("start_ms").alias("_lo"), F.max("end_ms").alias("_hi"))
    return (
        landed.join(wanted, CELL)
        .filter((F.col("timestamp") >= F.col("_lo")) & (F.col("timestamp") < F.col("_hi")))
        .select(*landed.columns)
    )


def run_into_store(planned: DataFrame, landed: DataFrame, path: str, now_ms: int, days: int, order_by: list[str]) -> DataFrame:
    """A whole run: select the planned rows, merge them into the dated table, report the
    rows of each strategy and data type.  Running it again changes nothing."""
    rows = store.with_date(run_rows(planned, landed))
    store.upsert(rows, path, keys=["timestamp", *CELL], order_by=order_by)
    return run_counts(planned, landed, now_ms, days)


def completeness(reg: DataFrame, landed: DataFrame) -> DataFrame:
    """Requirement matrix: every cell with its rows, MISSING where nothing landed."""
    return (
        cells(reg)
        .join(landed_counts(landed), CELL, "left")
        .withColumn("status", F.when(F.col("rows").isNotNull(), "OK").otherwise("MISSING"))
    )


def strategy_status(matrix: DataFrame) -> DataFrame:
    met = F.bool_and(F.col("status") == "OK")
    return matrix.groupBy("strategy").agg(
        F.count(F.lit(1)).alias("cells"),
        F.count_if(F.col("status") == "MISSING").alias("missing"),
        F.when(met, "ALL MET").otherwise("INCOMPLETE").alias("strategy_status"),
    )
