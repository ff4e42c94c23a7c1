"""Symbol and timeframe names across venues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Unified symbol -> symbol on the venue, in listing order.
SYMBOLS = {
    "binance_spot": {
        "BTC": "BTCUSDT", "ETH": "ETHUSDT", "SOL": "SOLUSDT", "BNB": "BNBUSDT", "XRP": "XRPUSDT",
        "ADA": "ADAUSDT", "DOGE": "DOGEUSDT", "SHIB": "SHIBUSDT", "PEPE": "PEPEUSDT",
        "WIF": "WIFUSDT", "BONK": "BONKUSDT", "FLOKI": "FLOKIUSDT", "LINK": "LINKUSDT",
        "AVAX": "AVAXUSDT",
    },
    "binance_usdm": {
        "BTC": "BTCUSDT", "ETH": "ETHUSDT", "SOL": "SOLUSDT", "BNB": "BNBUSDT", "XRP": "XRPUSDT",
        "ADA": "ADAUSDT", "DOGE": "DOGEUSDT", "WIF": "WIFUSDT", "LINK": "LINKUSDT",
        "AVAX": "AVAXUSDT",
    },
    "deribit": {"BTC": "BTC-PERPETUAL", "ETH": "ETH-PERPETUAL", "SOL": "SOL-PERPETUAL"},
    "hyperliquid": {
        "BTC": "BTC", "ETH": "ETH", "SOL": "SOL", "XRP": "XRP", "ADA": "ADA", "DOGE": "DOGE",
        "WIF": "WIF", "LINK": "LINK", "AVAX": "AVAX", "PEPE": "kPEPE", "BONK": "kBONK",
        "SHIB": "kSHIB", "FLOKI": "kFLOKI",
    },
}

# Timeframes each venue knows, and their names there.
TIMEFRAMES = {
    "binance": {
        "1m": "1m", "3m": "3m", "5m": "5m", "15m": "15m", "30m": "30m", "1h": "1h", "2h": "2h", "4h": "4h",
        "8h": "8h", "12h": "12h", "1d": "1d", "3d": "3d", "1w": "1w", "1M": "1M", "6h": "6h",
    },
    "hyperliquid": {
        "1m": "1m", "3m": "3m", "5m": "5m", "15m": "15m", "30m": "30m", "1h": "1h", "2h": "2h", "4h": "4h",
        "8h": "8h", "12h": "12h", "1d": "1d", "3d": "3d", "1w": "1w", "1M": "1M",
    },
    "deribit": {
        "1m": "1", "3m": "3", "5m": "5", "15m": "15", "30m": "30", "1h": "60", "2h": "120", "4h": "240",
        "1d": "1D", "1w": "1W", "1M": "1M",
    },
}
# What a venue is asked for when it does not know the timeframe; absent =
# the name is passed on.
UNKNOWN_TIMEFRAME = {"deribit": "1D", "hyperliquid": "1d"}


def symbol_table(spark: SparkSession, symbols: dict[str, dict[str, str]] = SYMBOLS) -> DataFrame:
    rows = [(v, u, s) for v, pairs in symbols.items() for u, s in pairs.items()]
    return spark.createDataFrame(rows, "exchange string, unified string, exchange_symbol string")


def _pairs(symbols: dict[str, dict[str, str]], reverse: bool) -> Column:
    """Lookup as a constant map, ``venue|symbol`` -> name; the first listed pair wins."""
    table: dict[str, str] = {}
    for venue, pairs in symbols.items():
        for unified, listed in pairs.items():
            a, b = (unified, listed) if reverse else (listed, unified)
            table.setdefault(f"{venue}|{a}", b)
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def _lookup(table: Column, exchange: Column, symbol: Column) -> Column:
    return F.coalesce(F.try_element_at(table, F.concat_ws("|", exchange, symbol)), symbol)


def unified_symbol(exchange: Column, symbol: Column, symbols: dict[str, dict[str, str]] = SYMBOLS) -> Column:
    """Venue symbol -> unified name, itself where unknown."""
    return _lookup(_pairs(symbols, False), exchange, symbol)


def exchange_symbol(exchange: Column, unified: Column, symbols: dict[str, dict[str, str]] = SYMBOLS) -> Column:
    """Unified name -> venue symbol, itself where unknown."""
    return _lookup(_pairs(symbols, True), exchange, unified)


def unify_symbols(df: DataFrame, mapping: DataFrame, exchange: str = "exchange", symbol: str = "symbol") -> DataFrame:
    """The same from a mapping table of any size (exchange, unified, exchange_symbol,
    ordinal): a left join, pass-through where nothing matches."""
    first = mapping.groupBy(F.col("exchange").alias(exchange), F.col("exchange_symbol").alias(symbol)).agg(
        F.min_by("unified", "ordinal").alias("_unified")
    )
    return df.join(first, [exchange, symbol], "left").withColumn(
        symbol, F.coalesce("_unified", F.col(symbol))
    ).drop("_unified")


def venue_timeframe(exchange: Column, timeframe: Column) -> Column:
    """Timeframe as the venue spells it."""
    out = timeframe
    for venue, names in TIMEFRAMES.items():
        table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
        unknown = F.lit(UNKNOWN_TIMEFRAME[venue]) if venue in UNKNOWN_TIMEFRAME else timeframe
        out = F.when(exchange == venue, F.coalesce(F.try_element_at(table, timeframe), unknown)).otherwise(out)
    return out


def listed_only(df: DataFrame, universe: DataFrame, symbol: str = "symbol", listed: str = "name") -> DataFrame:
    """Rows whose symbol the venue lists."""
    names = universe.select(F.col(listed).alias(symbol)).distinct()
    return df.join(names, symbol, "left_semi")
