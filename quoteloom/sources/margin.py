"""Margin and trading parameters from instrument listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import MARGIN_PARAMS, conform

# Notional upper bound, initial rate, maintenance rate per currency.
TIERS = {
    "BTC": ((50_000, 0.008, 0.004), (250_000, 0.015, 0.007), (1_000_000, 0.025, 0.012), (5_000_000, 0.040, 0.020)),
    "ETH": ((25_000, 0.008, 0.004), (125_000, 0.015, 0.007), (500_000, 0.025, 0.012), (2_500_000, 0.040, 0.020)),
}
DEFAULT_CURRENCY = "BTC"
DEFAULT_LEVERAGE = 50.0
MAX_LEVERAGE = 100.0


def _typed(df: DataFrame, extra: list[str]) -> DataFrame:
    out = conform(df, MARGIN_PARAMS)
    return out if not extra else df.select(*extra, *out.columns)


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name).try_cast("double"), F.lit(0.0))


def _kind(kind: Column) -> Column:
    return F.when(kind == "option", "option").otherwise("perp")


_DERIBIT = (
    "instrument_name string, kind string, contract_size double, tick_size double, "
    "min_trade_amount double, initial_margin double, maintenance_margin double"
)


def margin_deribit(df: DataFrame, payload: str = "payload", ingested: str = "ingest_ms", extra: list[str] | None = None) -> DataFrame:
    """Initial rate gives the leverage (at most 100); without one the leverage is 50 and
    gives the rate.  A missing maintenance rate is half the initial one."""
    extra = list(extra or [])
    rows = df.select(*extra, ingested, F.from_json(payload, _DERIBIT).alias("i"))
    given = _or_zero("i.initial_margin")
    initial = F.when(given > 0, given).otherwise(F.lit(1.0 / DEFAULT_LEVERAGE))
    maintenance = _or_zero("i.maintenance_margin")
    return _typed(
        rows.select(
            *extra,
            F.col(ingested).alias("timestamp"),
            F.coalesce("i.instrument_name", F.lit("")).alias("instrument_name"),
            F.lit("deribit").alias("exchange"),
            _kind(F.col("i.kind")).alias("instrument_type"),
            initial.alias("initial_margin_rate"),
            F.when(maintenance > 0, maintenance).otherwise(initial * 0.5).alias("maintenance_margin_rate"),
            F.when(given > 0, F.least(1.0 / F.nullif(given, F.lit(0.0)), F.lit(MAX_LEVERAGE)))
            .otherwise(F.lit(DEFAULT_LEVERAGE))
            .alias("max_leverage"),
            _or_zero("i.contract_size").alias("contract_size"),
            _or_zero("i.tick_size").alias("tick_size"),
            _or_zero("i.min_trade_amount").alias("min_order_size"),
        ),
        extra,
    )


_BINANCE = (
    "symbol string, contractType string, status string, "
    "filters array<struct<filterType:string,minQty:string,tickSize:string>>, "
    "brackets array<struct<leverage:double,maintMarginRatio:double>>"
)


def margin_binance(df: DataFrame, payload: str = "payload", ingested: str = "ingest_ms", extra: list[str] | None = None) -> DataFrame:
    """Trading perpetuals; order limits from the filters, rates from the first bracket."""
    extra = list(extra or [])
    rows = df.select(*extra, ingested, F.from_json(payload, _BINANCE).alias("i")).filter(
        (F.col("i.contractType") == "PERPETUAL") & (F.col("i.status") == "TRADING")
    )

    def limit(kind: str, field: str) -> Column:
        fitting = F.filter(F.col("i.filters"), lambda f: f["filterType"] == kind)
        return F.coalesce(F.try_element_at(fitting, F.lit(-1))[field].try_cast("double"), F.lit(0.0))

    staged = rows.withColumn("b", F.get(F.col("i.brackets"), F.lit(0)))
    bracketed = F.col("b").isNotNull()
    leverage = F.coalesce(F.col("b.leverage"), F.lit(20.0))
    return _typed(
        staged.select(
            *extra,
            F.col(ingested).alias("timestamp"),
            F.coalesce("i.symbol", F.lit("")).alias("instrument_name"),
            F.lit("binance").alias("exchange"),
            F.lit("perp").alias("instrument_type"),
            F.when(bracketed & (leverage > 0), 1.0 / F.nullif(leverage, F.lit(0.0)))
            .otherwise(F.lit(0.01))
            .alias("initial_margin_rate"),
            F.coalesce(F.col("b.maintMarginRatio"), F.lit(0.005)).alias("maintenance_margin_rate"),
            leverage.alias("max_leverage"),
            F.lit(1.0).alias("contract_size"),
            limit("PRICE_FILTER", "tickSize").alias("tick_size"),
            limit("LOT_SIZE", "minQty").alias("min_order_size"),
        ),
        extra,
    )


def _tiers_of(currency: Column) -> Column:
    """The currency's tiers as a constant array; BTC tiers for an unknown currency."""

    def table(name: str) -> Column:
        return F.array(
            *[
                F.struct(F.lit(float(u)).alias("upper"), F.lit(i).alias("im"), F.lit(m).alias("mm"))
                for u, i, m in TIERS[name]
            ]
        )

    out = table(DEFAULT_CURRENCY)
    for name in TIERS:
        if name != DEFAULT_CURRENCY:
            out = F.when(currency == name, table(name)).otherwise(out)
    return out


def margin_fallback(df: DataFrame, currency: str = "currency", kind: str = "kind", ingested: str = "ingest_ms", extra: list[str] | None = None) -> DataFrame:
    """Static parameters of the lowest tier for (currency, kind) rows."""
    extra = list(extra or [])
    is_btc = F.col(currency) == "BTC"
    staged = df.withColumn("_t", F.get(_tiers_of(F.col(currency)), F.lit(0)))
    kinds = _kind(F.col(kind))
    return _typed(
        staged.select(
            *extra,
            F.col(ingested).alias("timestamp"),
            F.concat(F.col(currency), F.lit("-"), kinds, F.lit("-fallback")).alias("instrument_name"),
            F.lit("deribit").alias("exchange"),
            kinds.alias("instrument_type"),
            F.col("_t.im").alias("initial_margin_rate"),
            F.col("_t.mm").alias("maintenance_margin_rate"),
            (1.0 / F.col("_t.im")).alias("max_leverage"),
            F.lit(1.0).alias("contract_size"),
            F.when(is_btc, 0.0005).otherwise(0.001).alias("tick_size"),
            F.when(is_btc, 0.1).otherwise(0.01).alias("min_order_size"),
        ),
        extra,
    )


def tier_for_notional(df: DataFrame, currency: str, notional: str) -> DataFrame:
    """Add the rates of the lowest tier whose upper bound covers the notional; null above
    the last bound.  The tiers are a constant array, so there is no join."""
    fitting = F.filter(_tiers_of(F.col(currency)), lambda t: F.col(notional) <= t["upper"])
    staged = df.withColumn("_t", F.get(fitting, F.lit(0)))
    return staged.select(
        *df.columns,
        F.col("_t.upper").alias("tier_upper_bound"),
        F.col("_t.im").alias("initial_margin_rate"),
        F.col("_t.mm").alias("maintenance_margin_rate"),
    )
