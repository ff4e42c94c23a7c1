"""Record types as StructTypes, and ``conform`` to bring a frame to one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OHLCV = T.StructType(
    [
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("open", T.DoubleType(), False),
        T.StructField("high", T.DoubleType(), False),
        T.StructField("low", T.DoubleType(), False),
        T.StructField("close", T.DoubleType(), False),
        T.StructField("volume", T.DoubleType(), False),
        T.StructField("quote_volume", T.DoubleType(), False),
        T.StructField("exchange", T.StringType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("timeframe", T.StringType(), False),
        T.StructField("trades", T.IntegerType(), True),
    ]
)
FUNDING_RATE = T.StructType(
    [
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("exchange", T.StringType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("funding_rate", T.DoubleType(), False),
        T.StructField("mark_price", T.DoubleType(), True),
        T.StructField("index_price", T.DoubleType(), True),
    ]
)
MARK_PRICE = T.StructType(
    [
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("exchange", T.StringType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("mark_price", T.DoubleType(), False),
        T.StructField("index_price", T.DoubleType(), True),
        T.StructField("basis", T.DoubleType(), True),
    ]
)
SPOT_PRICE = T.StructType(
    [
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("exchange", T.StringType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("price", T.DoubleType(), False),
        T.StructField("bid_price", T.DoubleType(), False),
        T.StructField("ask_price", T.DoubleType(), False),
    ]
)
L1_QUOTE = T.StructType(
    [
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("instrument_name", T.StringType(), False),
        T.StructField("bid_price", T.DoubleType(), False),
        T.StructField("ask_price", T.DoubleType(), False),
        T.StructField("bid_size", T.DoubleType(), False),
        T.StructField("ask_size", T.DoubleType(), False),
        T.StructField("last_price", T.DoubleType(), False),
    ]
)
QUOTE_SNAPSHOT = T.StructType(
    [
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("instrument_name", T.StringType(), False),
        T.StructField("exchange", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("bid_price", T.DoubleType(), False),
        T.StructField("ask_price", T.DoubleType(), False),
        T.StructField("bid_size", T.DoubleType(), False),
        T.StructField("ask_size", T.DoubleType(), False),
        T.StructField("mid_price", T.DoubleType(), False),
        T.StructField("spread", T.DoubleType(), False),
        T.StructField("spread_bps", T.DoubleType(), False),
        T.StructField("bid_iv", T.DoubleType(), True),
        T.StructField("ask_iv", T.DoubleType(), True),
    ]
)
MARGIN_PARAMS = T.StructType(
    [
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("instrument_name", T.StringType(), False),
        T.StructField("exchange", T.StringType(), False),
        T.StructField("instrument_type", T.StringType(), False),
        T.StructField("initial_margin_rate", T.DoubleType(), False),
        T.StructField("maintenance_margin_rate", T.DoubleType(), False),
        T.StructField("max_leverage", T.DoubleType(), False),
        T.StructField("contract_size", T.DoubleType(), False),
        T.StructField("tick_size", T.DoubleType(), False),
        T.StructField("min_order_size", T.DoubleType(), False),
    ]
)
RISK_FREE_RATE = T.StructType(
    [
        T.StructField("date", T.StringType(), False),
        T.StructField("tenor_years", T.DoubleType(), False),
        T.StructField("rate_annual", T.DoubleType(), False),
        T.StructField("rate_continuous", T.DoubleType(), False),
        T.StructField("is_trading_day", T.BooleanType(), False),
    ]
)
BASIS_POINT = T.StructType(
    [
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("basis_type", T.StringType(), False),
        T.StructField("spot_price", T.DoubleType(), False),
        T.StructField("perp_price", T.DoubleType(), False),
        T.StructField("basis", T.DoubleType(), False),
        T.StructField("basis_pct", T.DoubleType(), False),
        T.StructField("annualized_basis", T.DoubleType(), False),
        T.StructField("days_to_expiry", T.IntegerType(), False),
    ]
)
VOL_SURFACE_POINT = T.StructType(
    [
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("symbol", T.StringType(), False),
        T.StructField("atm_iv", T.DoubleType(), False),
        T.StructField("skew_25d", T.DoubleType(), False),
        T.StructField("butterfly_25d", T.DoubleType(), False),
        T.StructField("iv_rank", T.DoubleType(), False),
        T.StructField("term_structure", T.MapType(T.StringType(), T.DoubleType()), False),
        T.StructField("quality", T.StringType(), False),
    ]
)
GREEKS_SNAPSHOT = T.StructType(
    [
        T.StructField("timestamp", T.LongType(), False),
        T.StructField("instrument_name", T.StringType(), False),
        T.StructField("exchange", T.StringType(), False),
        T.StructField("underlying_price", T.DoubleType(), False),
        T.StructField("strike", T.DoubleType(), False),
        T.StructField("expiry", T.StringType(), False),
        T.StructField("time_to_expiry_years", T.DoubleType(), False),
        T.StructField("option_type", T.StringType(), False),
        T.StructField("iv", T.DoubleType(), False),
        T.StructField("iv_source", T.StringType(), False),
        T.StructField("delta", T.DoubleType(), False),
        T.StructField("gamma", T.DoubleType(), False),
        T.StructField("vega", T.DoubleType(), False),
        T.StructField("theta", T.DoubleType(), False),
        T.StructField("rho", T.DoubleType(), False),
        T.StructField("mid_price", T.DoubleType(), False),
        T.StructField("bid_price", T.DoubleType(), False),
        T.StructField("ask_price", T.DoubleType(), False),
    ]
)
GAP = T.StructType(
    [
        T.StructField("gap_start", T.LongType(), False),
        T.StructField("gap_end", T.LongType(), False),
        T.StructField("gap_duration_ms", T.LongType(), False),
        T.StructField("affected_instruments", T.ArrayType(T.StringType()), False),
    ]
)
CONTRACT_MAPPING = T.StructType(
    [
        T.StructField("expiry", T.StringType(), False),
        T.StructField("calls", T.ArrayType(T.StringType()), False),
        T.StructField("puts", T.ArrayType(T.StringType()), False),
        T.StructField("atm_strike", T.DoubleType(), False),
        T.StructField("total_oi", T.DoubleType(), False),
    ]
)
OPTION_INSTRUMENT = T.StructType(
    [
        T.StructField("instrument_name", T.StringType(), False),
        T.StructField("currency", T.StringType(), False),
        T.StructField("kind", T.StringType(), False),
        T.StructField("base_currency", T.StringType(), False),
        T.StructField("quote_currency", T.StringType(), False),
        T.StructField("contract_size", T.DoubleType(), False),
        T.StructField("option_type", T.StringType(), False),
        T.StructField("strike", T.DoubleType(), False),
        T.StructField("expiration_timestamp", T.LongType(), False),
        T.StructField("expiration_date", T.TimestampType(), False),
        T.StructField("settlement_period", T.StringType(), False),
        T.StructField("is_active", T.BooleanType(), False),
        T.StructField("min_trade_amount", T.DoubleType(), False),
        T.StructField("tick_size", T.DoubleType(), False),
        T.StructField("maker_commission", T.DoubleType(), False),
        T.StructField("taker_commission", T.DoubleType(), False),
    ]
)
OPTION_TICKER = T.StructType(
    [
        T.StructField("instrument_name", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("underlying_price", T.DoubleType(), False),
        T.StructField("mark_price", T.DoubleType(), False),
        T.StructField("bid_price", T.DoubleType(), False),
        T.StructField("ask_price", T.DoubleType(), False),
        T.StructField("bid_iv", T.DoubleType(), False),
        T.StructField("ask_iv", T.DoubleType(), False),
        T.StructField("mark_iv", T.DoubleType(), False),
        T.StructField("open_interest", T.DoubleType(), False),
        T.StructField("volume_24h", T.DoubleType(), False),
        T.StructField("settlement_period", T.StringType(), False),
        T.StructField("last", T.DoubleType(), True),
        T.StructField("high", T.DoubleType(), True),
        T.StructField("low", T.DoubleType(), True),
        T.StructField("total_volume", T.DoubleType(), True),
    ]
)
BOOK_LEVEL = T.StructType(
    [
        T.StructField("price", T.DoubleType(), False),
        T.StructField("amount", T.DoubleType(), False),
        T.StructField("order_count", T.IntegerType(), False),
    ]
)
OPTION_BOOK = T.StructType(
    [
        T.StructField("instrument_name", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("underlying_price", T.DoubleType(), False),
        T.StructField("settlement_price", T.DoubleType(), False),
        T.StructField("bids", T.ArrayType(BOOK_LEVEL), False),
        T.StructField("asks", T.ArrayType(BOOK_LEVEL), False),
        T.StructField("current_best_bid", T.DoubleType()),
        T.StructField("current_best_ask", T.DoubleType()),
        T.StructField("current_timestamp", T.LongType()),
        T.StructField("state", T.StringType()),
    ]
)
TRADE = T.StructType(
    [
        T.StructField("trade_seq", T.LongType(), False),
        T.StructField("trade_id", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("instrument_name", T.StringType(), False),
        T.StructField("direction", T.StringType(), False),
        T.StructField("price", T.DoubleType(), False),
        T.StructField("amount", T.DoubleType(), False),
        T.StructField("trade_volume_usd", T.DoubleType(), False),
        T.StructField("trade_index_price", T.DoubleType(), False),
        T.StructField("inventory_index", T.DoubleType(), False),
        T.StructField("volatility", T.DoubleType(), True),
        T.StructField("interest_rate", T.DoubleType(), True),
        T.StructField("mark_price", T.DoubleType(), True),
        T.StructField("index_price", T.DoubleType(), True),
    ]
)
GREEKS_DATA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("instrument_name", T.StringType(), False),
        T.StructField("underlying_price", T.DoubleType(), False),
        T.StructField("mark_price", T.DoubleType(), False),
        T.StructField("open_interest", T.DoubleType(), False),
        T.StructField("delta", T.DoubleType(), False),
        T.StructField("gamma", T.DoubleType(), False),
        T.StructField("rho", T.DoubleType(), False),
        T.StructField("theta", T.DoubleType(), False),
        T.StructField("vega", T.DoubleType(), False),
    ]
)
MARK_PRICE_DATA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("instrument_name", T.StringType(), False),
        T.StructField("mark_price", T.DoubleType(), False),
        T.StructField("index_price", T.DoubleType(), False),
        T.StructField("settlement_price", T.DoubleType(), False),
        T.StructField("underlying_price", T.DoubleType(), False),
    ]
)
SETTLEMENT_PRICE_DATA = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("instrument_name", T.StringType(), False),
        T.StructField("settlement_price", T.DoubleType(), False),
        T.StructField("delivery_price", T.DoubleType(), False),
        T.StructField("settlement_type", T.StringType(), False),
    ]
)
DATA_REQUIREMENT = T.StructType(
    [
        T.StructField("data_type", T.StringType(), False),
        T.StructField("exchanges", T.ArrayType(T.StringType()), False),
        T.StructField("symbols", T.ArrayType(T.StringType()), False),
        T.StructField("frequency", T.StringType(), False),
        T.StructField("priority", T.IntegerType(), False),
    ]
)

# Allowed values of the enumerated string fields.
OPTION_TYPES = ("call", "put")
SETTLEMENT_PERIODS = ("day", "week", "month", "quarter")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the columns of ``schema`` in order and cast them.

    A missing optional column becomes null; a missing required one raises.
    """
    have = set(df.columns)
    missing = [f.name for f in schema if f.name not in have and not f.nullable]
    if missing:
        raise ValueError(f"required columns missing: {', '.join(missing)}")
    return df.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
