"""Funding, mark price, spot, quote and rate payloads -> typed rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import quotes
from ..functions.text import unset_if_zero
from ..schemas import FUNDING_RATE, MARK_PRICE, conform


def _num(name: str) -> Column:
    return F.col(name).try_cast("double")


def _zero(name: str) -> Column:
    return F.coalesce(_num(name), F.lit(0.0))


# -- funding -------------------------------------------------------------------------


def funding_binance(df: DataFrame, payload: str = "payload") -> DataFrame:
    items = F.from_json(payload, "array<struct<fundingTime:bigint,fundingRate:string>>")
    rows = df.select("symbol", F.inline(items))
    return rows.select(
        F.col("fundingTime").alias("timestamp"),
        F.lit("binance").alias("exchange"),
        "symbol",
        _num("fundingRate").alias("funding_rate"),
    )


def funding_binance_realtime(df: DataFrame, payload: str = "payload") -> DataFrame:
    item = F.from_json(payload, "time bigint, lastFundingRate string, markPrice string, indexPrice string")
    return df.select("symbol", item.alias("i")).select(
        F.col("i.time").alias("timestamp"),
        F.lit("binance").alias("exchange"),
        "symbol",
        _num("i.lastFundingRate").alias("funding_rate"),
        _num("i.markPrice").alias("mark_price"),
        _num("i.indexPrice").alias("index_price"),
    )


def _optional(x: Column, zero_is_missing: bool) -> Column:
    return unset_if_zero(x) if zero_is_missing else x


def funding_deribit(df: DataFrame, payload: str = "payload", zero_is_missing: bool = True) -> DataFrame:
    """An absent index price is null; so is one of 0, unless ``zero_is_missing`` is off."""
    body = F.from_json(payload, "result array<struct<timestamp:bigint,interest_8h:double,index_price:double>>")
    rows = df.select("symbol", F.inline(body["result"]))
    return rows.select(
        "timestamp",
        F.lit("deribit").alias("exchange"),
        "symbol",
        F.col("interest_8h").alias("funding_rate"),
        _optional(F.col("index_price"), zero_is_missing).alias("index_price"),
    )


def funding_hyperliquid(df: DataFrame, payload: str = "payload", zero_is_missing: bool = True) -> DataFrame:
    """The premium is kept in the mark price column; absent and 0 as in ``funding_deribit``."""
    items = F.from_json(payload, "array<struct<time:bigint,fundingRate:string,premium:string>>")
    rows = df.select("symbol", F.inline(items))
    return rows.select(
        F.col("time").alias("timestamp"),
        F.lit("hyperliquid").alias("exchange"),
        "symbol",
        _num("fundingRate").alias("funding_rate"),
        _optional(_num("premium"), zero_is_missing).alias("mark_price"),
    )


def unify_funding(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [conform(p, FUNDING_RATE) for p in parts])


# -- mark price ----------------------------------------------------------------------


def mark_binance(df: DataFrame, payload: str = "payload") -> DataFrame:
    rows = df.select("symbol", F.explode(F.from_json(payload, "array<array<string>>")).alias("_k"))
    return rows.select(
        F.get("_k", F.lit(0)).try_cast("bigint").alias("timestamp"),
        F.lit("binance").alias("exchange"),
        "symbol",
        F.get("_k", F.lit(4)).try_cast("double").alias("mark_price"),
    )


def mark_deribit(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Chart ticks with a close; ticks beyond the closes are dropped."""
    body = F.from_json(payload, "result struct<ticks:array<bigint>,close:array<double>>")["result"]
    parsed = df.select("symbol", body.alias("_c"))
    rows = parsed.select("symbol", "_c", F.posexplode("_c.ticks").alias("_i", "timestamp"))
    return rows.filter(F.col("_i") < F.size("_c.close")).select(
        "timestamp",
        F.lit("deribit").alias("exchange"),
        "symbol",
        F.get(F.col("_c.close"), F.col("_i")).alias("mark_price"),
    )


def mark_hyperliquid(df: DataFrame, payload: str = "payload", ingested: str = "ingest_ms", symbol: str | None = None) -> DataFrame:
    """Map of symbol -> mid, stamped with the time it landed."""
    rows = df.select(
        F.col(ingested).alias("timestamp"),
        F.explode(F.from_json(payload, "map<string,string>")).alias("symbol", "_mid"),
    )
    if symbol is not None:
        rows = rows.filter(F.col("symbol") == symbol)
    return rows.select(
        "timestamp", F.lit("hyperliquid").alias("exchange"), "symbol", _num("_mid").alias("mark_price")
    )


def unify_marks(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, [conform(p, MARK_PRICE) for p in parts])


# -- spot and quotes -----------------------------------------------------------------


def spot_mid(df: DataFrame, payload: str = "payload", ingested: str = "ingest_ms", extra: list[str] | None = None) -> DataFrame:
    """Book ticker -> spot price; rows without two positive sides are dropped."""
    item = F.from_json(payload, "bidPrice string, askPrice string, time bigint")
    rows = df.select(*(extra or []), "symbol", ingested, item.alias("i"))
    staged = rows.withColumns({"bid_price": _zero("i.bidPrice"), "ask_price": _zero("i.askPrice")})
    price = quotes.mid_price(F.col("bid_price"), F.col("ask_price"))
    return staged.filter(price > 0).select(
        *(extra or []),
        F.coalesce(F.nullif(F.col("i.time"), F.lit(0).cast("long")), F.col(ingested)).alias("timestamp"),
        F.lit("binance").alias("exchange"),
        "symbol",
        price.alias("price"),
        "bid_price",
        "ask_price",
    )


def enrich_quotes(df: DataFrame, exchange: Column, source: Column, extra: list[str] | None = None) -> DataFrame:
    """L1 quotes -> snapshots with mid and spread; one-sided quotes stay, at 0.0."""
    sides = {c: _zero(c) for c in ("bid_price", "ask_price", "bid_size", "ask_size")}
    staged = df.withColumns(sides)
    bid, ask = F.col("bid_price"), F.col("ask_price")

    def volatility(name: str) -> Column:
        return unset_if_zero(_num(name)) if name in df.columns else F.lit(None).cast("double")

    return staged.select(
        *(extra or []),
        "timestamp",
        "instrument_name",
        exchange.alias("exchange"),
        source.alias("source"),
        *sides,
        quotes.mid_price(bid, ask).alias("mid_price"),
        quotes.spread(bid, ask).alias("spread"),
        quotes.spread_bps(bid, ask).alias("spread_bps"),
        volatility("bid_iv").alias("bid_iv"),
        volatility("ask_iv").alias("ask_iv"),
    )


def rest_quotes_deribit(df: DataFrame, payload: str = "payload", ingested: str = "ingest_ms", extra: list[str] | None = None) -> DataFrame:
    fields = "timestamp:bigint,best_bid_price:double,best_ask_price:double,best_bid_amount:double,best_ask_amount:double,last_price:double,bid_iv:double,ask_iv:double"
    rows = df.select(*(extra or []), "instrument_name", ingested, F.from_json(payload, f"result struct<{fields}>")["result"].alias("r"))
    return rows.filter(F.col("r").isNotNull()).select(
        *(extra or []),
        F.coalesce("r.timestamp", ingested).alias("timestamp"),
        "instrument_name",
        F.col("r.best_bid_price").alias("bid_price"),
        F.col("r.best_ask_price").alias("ask_price"),
        F.col("r.best_bid_amount").alias("bid_size"),
        F.col("r.best_ask_amount").alias("ask_size"),
        F.col("r.last_price").alias("last_price"),
        F.col("r.bid_iv").alias("bid_iv"),
        F.col("r.ask_iv").alias("ask_iv"),
    )


def rest_quotes_binance(df: DataFrame, payload: str = "payload", ingested: str = "ingest_ms", extra: list[str] | None = None) -> DataFrame:
    item = F.from_json(payload, "bidPrice string, askPrice string, bidQty string, askQty string, time bigint")
    return df.select(*(extra or []), "instrument_name", ingested, item.alias("i")).select(
        *(extra or []),
        F.coalesce("i.time", ingested).alias("timestamp"),
        "instrument_name",
        F.col("i.bidPrice").alias("bid_price"),
        F.col("i.askPrice").alias("ask_price"),
        F.col("i.bidQty").alias("bid_size"),
        F.col("i.askQty").alias("ask_size"),
    )


def rest_quotes_hyperliquid(df: DataFrame, payload: str = "payload", ingested: str = "ingest_ms", extra: list[str] | None = None) -> DataFrame:
    """Two lists of levels, bids then asks; without asks the best bid stands in.  Each
    row's book belongs to the instrument of that row."""
    levels = F.from_json(payload, "levels array<array<struct<px:string,sz:string>>>")["levels"]
    rows = df.select(*(extra or []), "instrument_name", ingested, levels.alias("l"))
    bid = F.get(F.get(F.col("l"), F.lit(0)), F.lit(0))
    ask = F.coalesce(F.get(F.get(F.col("l"), F.lit(1)), F.lit(0)), bid)
    return rows.select(*(extra or []), "instrument_name", ingested, bid.alias("b"), ask.alias("a")).filter(
        F.col("b").isNotNull()
    ).select(
        *(extra or []),
        F.col(ingested).alias("timestamp"),
        "instrument_name",
        F.col("b.px").alias("bid_price"),
        F.col("a.px").alias("ask_price"),
        F.col("b.sz").alias("bid_size"),
        F.col("a.sz").alias("ask_size"),
    )


# -- rates ---------------------------------------------------------------------------


def rate_observations(df: DataFrame, value: str = "value") -> DataFrame:
    """Published percent texts -> fractions in ``rate``; ".", blanks and junk dropped."""
    rate = F.col(value).try_cast("double") / 100
    return df.withColumn("rate", rate).filter(F.col("rate").isNotNull() & ~F.isnan("rate")).drop(value)
