"""Option venue payloads (REST results and pushed messages) -> typed records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import utc_timestamp

# Routing of pushed messages: the first of these words found in the channel decides.
ROUTES = (
    ("ticker", "tickers"),
    ("book", "books"),
    ("trades", "trades"),
    ("markprice", "mark_prices"),
    ("greeks", "greeks"),
)


def _get(name: str, default: float | str | bool | None = None) -> Column:
    col = F.col(f"d.{name}")
    return (col if default is None else F.coalesce(col, F.lit(default))).alias(name)


def _time(name: str = "d.timestamp") -> Column:
    return utc_timestamp(F.coalesce(F.col(name), F.lit(0).cast("long"))).alias("timestamp")


def _parse(df: DataFrame, payload: str, fields: str, extra: list[str] | None, wrapped: bool) -> DataFrame:
    """Columns ``extra`` and the parsed body ``d``; ``wrapped`` bodies sit under ``result``.

    The body passes through a generator: a filter on it would otherwise be pushed below
    and parse the text a second time.
    """
    schema = f"struct<{fields}>"
    body = F.from_json(payload, f"struct<result:{schema}>")["result"] if wrapped else F.from_json(payload, schema)
    return df.select(*(extra or []), F.explode(F.array(body)).alias("d")).filter(F.col("d").isNotNull())


_INSTRUMENT = (
    "instrument_name:string,base_currency:string,quote_currency:string,kind:string,contract_size:double,"
    "option_type:string,strike:double,expiration_timestamp:bigint,settlement_period:string,is_active:boolean,"
    "min_trade_amount:double,tick_size:double,maker_commission:double,taker_commission:double"
)


def instruments(df: DataFrame, payload: str = "payload", extra: list[str] | None = None) -> DataFrame:
    parsed = df.select(
        *(extra or []), F.explode(F.from_json(payload, f"struct<result:array<struct<{_INSTRUMENT}>>>")["result"]).alias("d")
    )
    return parsed.select(
        *(extra or []),
        _get("instrument_name"),
        F.col("d.base_currency").alias("currency"),
        *[_get(c) for c in ("kind", "base_currency", "quote_currency", "contract_size", "option_type", "strike", "expiration_timestamp")],
        utc_timestamp(F.col("d.expiration_timestamp")).alias("expiration_date"),
        _get("settlement_period"),
        _get("is_active", True),
        _get("min_trade_amount"),
        _get("tick_size"),
        _get("maker_commission", 0.0),
        _get("taker_commission", 0.0),
    )


_TICKER = (
    "instrument_name:string,timestamp:bigint,underlying_price:double,mark_price:double,bid_price:double,"
    "ask_price:double,best_bid_price:double,best_ask_price:double,bid_iv:double,ask_iv:double,mark_iv:double,"
    "open_interest:double,volume:double,stats:struct<volume:double>,settlement_period:string,last:double,"
    "last_price:double,high:double,low:double,total_volume:double"
)


def tickers(df: DataFrame, payload: str = "payload", pushed: bool = False, extra: list[str] | None = None) -> DataFrame:
    """Pushed tickers prefer the best bid and ask and a top-level volume."""
    parsed = _parse(df, payload, _TICKER, extra, wrapped=not pushed)
    zero = F.lit(0.0)
    bid, ask, volume = F.col("d.bid_price"), F.col("d.ask_price"), F.col("d.stats.volume")
    if pushed:
        bid = F.coalesce("d.best_bid_price", bid)
        ask = F.coalesce("d.best_ask_price", ask)
        volume = F.coalesce("d.volume", volume)
    return parsed.select(
        *(extra or []),
        _get("instrument_name", ""),
        _time(),
        _get("underlying_price", 0.0),
        _get("mark_price", 0.0),
        F.coalesce(bid, zero).alias("bid_price"),
        F.coalesce(ask, zero).alias("ask_price"),
        *[_get(c, 0.0) for c in ("bid_iv", "ask_iv", "mark_iv", "open_interest")],
        F.coalesce(volume, zero).alias("volume_24h"),
        _get("settlement_period", "day"),
        F.col("d.last_price" if pushed else "d.last").alias("last"),
        _get("high"),
        _get("low"),
        (F.lit(None).cast("double") if pushed else F.col("d.total_volume")).alias("total_volume"),
    )


_BOOK = (
    "instrument_name:string,timestamp:bigint,underlying_price:double,settlement_price:double,"
    "bids:array<string>,asks:array<string>,current_best_bid:double,current_best_ask:double,"
    "best_bid_price:double,best_ask_price:double,current_timestamp:bigint,state:string"
)


def _levels(raw: Column) -> Column:
    """Levels as ``[price, amount, count?]`` or ``{price, amount}`` -> structs."""

    def level(text: Column) -> Column:
        # A list of numbers needs no JSON parser.
        listed = F.split(F.translate(text, '[]" ', ""), ",")
        is_list = F.startswith(F.ltrim(text), F.lit("["))

        def value(i: int, name: str) -> Column:
            named = F.get_json_object(text, f"$.{name}")
            return F.coalesce(
                F.when(is_list, F.get(listed, F.lit(i))).otherwise(named).try_cast("double"), F.lit(0.0)
            )

        count = F.when(is_list, F.get(listed, F.lit(2)).try_cast("double").cast("int"))
        return F.struct(
            value(0, "price").alias("price"),
            value(1, "amount").alias("amount"),
            F.coalesce(count, F.lit(0)).alias("order_count"),
        )

    return F.transform(F.coalesce(raw, F.array().cast("array<string>")), level)


def books(df: DataFrame, payload: str = "payload", pushed: bool = False, extra: list[str] | None = None) -> DataFrame:
    parsed = _parse(df, payload, _BOOK, extra, wrapped=not pushed)
    side = "best_{}_price" if pushed else "current_best_{}"
    return parsed.select(
        *(extra or []),
        _get("instrument_name", ""),
        _time(),
        _get("underlying_price", 0.0),
        _get("settlement_price", 0.0),
        _levels(F.col("d.bids")).alias("bids"),
        _levels(F.col("d.asks")).alias("asks"),
        F.col("d." + side.format("bid")).alias("current_best_bid"),
        F.col("d." + side.format("ask")).alias("current_best_ask"),
        _get("current_timestamp"),
        _get("state"),
    )


def book_summary(df: DataFrame, carry: list[str]) -> DataFrame:
    """Number of levels and best prices; null where a side is empty."""
    return df.select(
        *carry,
        F.size("bids").alias("bid_levels"),
        F.size("asks").alias("ask_levels"),
        F.get(F.col("bids"), F.lit(0))["price"].alias("best_bid"),
        F.get(F.col("asks"), F.lit(0))["price"].alias("best_ask"),
    )


_TRADE = (
    "trade_seq:bigint,trade_id:string,timestamp:bigint,instrument_name:string,direction:string,price:double,"
    "amount:double,trade_volume_usd:double,trade_index_price:double,inventory_index:double,volatility:double,"
    "interest_rate:double,mark_price:double,index_price:double"
)


def trades(df: DataFrame, payload: str = "payload", pushed: bool = False, extra: list[str] | None = None) -> DataFrame:
    shape = f"array<struct<{_TRADE}>>"
    items = F.from_json(payload, shape) if pushed else F.from_json(payload, f"struct<result:struct<trades:{shape}>>")["result"]["trades"]
    rows = df.select(*(extra or []), F.explode(items).alias("d"))
    return rows.select(
        *(extra or []),
        F.coalesce(F.col("d.trade_seq"), F.lit(0).cast("long")).alias("trade_seq"),
        _get("trade_id", ""),
        _time(),
        _get("instrument_name", ""),
        _get("direction", ""),
        *[_get(c, 0.0) for c in ("price", "amount", "trade_volume_usd", "trade_index_price", "inventory_index")],
        *[_get(c) for c in ("volatility", "interest_rate", "mark_price", "index_price")],
    )


_GREEKS = "timestamp:bigint,instrument_name:string,underlying_price:double,mark_price:double,open_interest:double,delta:double,gamma:double,rho:double,theta:double,vega:double"


def greeks(df: DataFrame, payload: str = "payload", pushed: bool = False, extra: list[str] | None = None) -> DataFrame:
    parsed = _parse(df, payload, _GREEKS, extra, wrapped=not pushed)
    return parsed.select(
        *(extra or []),
        _time(),
        _get("instrument_name", ""),
        *[_get(c, 0.0) for c in ("underlying_price", "mark_price", "open_interest", "delta", "gamma", "rho", "theta", "vega")],
    )


_MARK = "timestamp:bigint,instrument_name:string,mark_price:double,index_price:double,settlement_price:double,underlying_price:double"


def mark_prices(df: DataFrame, payload: str = "payload", pushed: bool = False, extra: list[str] | None = None) -> DataFrame:
    """REST results are a list of which the first counts."""
    if pushed:
        parsed = _parse(df, payload, _MARK, extra, wrapped=False)
    else:
        listed = F.from_json(payload, f"struct<result:array<struct<{_MARK}>>>")["result"]
        parsed = df.select(*(extra or []), F.get(listed, F.lit(0)).alias("d")).filter(F.col("d").isNotNull())
    return parsed.select(
        *(extra or []),
        _time(),
        _get("instrument_name", ""),
        *[_get(c, 0.0) for c in ("mark_price", "index_price", "settlement_price", "underlying_price")],
    )


_SETTLED = "timestamp:bigint,instrument_name:string,settlement_price:double,delivery_price:double,type:string"


def settlement_prices(df: DataFrame, payload: str = "payload", extra: list[str] | None = None) -> DataFrame:
    """The latest (first listed) settlement of each result."""
    listed = F.from_json(payload, f"struct<result:struct<settlements:array<struct<{_SETTLED}>>>>")["result"]["settlements"]
    parsed = df.select(*(extra or []), F.get(listed, F.lit(0)).alias("d")).filter(F.col("d").isNotNull())
    return parsed.select(
        *(extra or []),
        _time(),
        _get("instrument_name"),
        _get("settlement_price"),
        _get("delivery_price", 0.0),
        F.col("d.type").alias("settlement_type"),
    )


def route(channel: Column) -> Column:
    """Record type of a message from its channel; null for other channels."""
    out = F.lit(None).cast("string")
    for word, kind in reversed(ROUTES):
        out = F.when(F.contains(channel, F.lit(word)), F.lit(kind)).otherwise(out)
    return out


def messages(df: DataFrame, raw: str = "value") -> DataFrame:
    """Pushed JSON text -> method, channel, body text and record type; lines that are not
    JSON, and messages without a method, are dropped."""
    parsed = df.withColumn("_m", F.from_json(raw, "method string, params struct<channel:string,data:string>"))
    return (
        parsed.filter(F.col("_m.method").isNotNull())
        .withColumns(
            {
                "method": F.col("_m.method"),
                "channel": F.coalesce("_m.params.channel", F.lit("")),
                "data": F.col("_m.params.data"),
            }
        )
        .withColumn("record_type", route(F.col("channel")))
        .drop("_m", raw)
    )


_L1_FIELDS = (
    "timestamp", "instrument_name", "best_bid_price", "best_ask_price", "best_bid_amount",
    "best_ask_amount", "last_price",
)


def l1_quotes(df: DataFrame, raw: str = "value", ingested: str = "ingest_ms", extra: list[str] | None = None) -> DataFrame:
    """Best-quote rows from pushed messages of both venues; everything else is dropped.

    Each text is parsed once: the parsed parts pass through generators, as in ``_parse``.
    """
    # Top level as a map: one venue tells its fields apart by case only.
    top = F.from_json(raw, "map<string,string>")
    fields = ",".join(f"{c}:{'string' if c == 'instrument_name' else 'bigint' if c == 'timestamp' else 'double'}" for c in _L1_FIELDS)
    body = F.from_json(F.try_element_at("m", F.lit("params")), f"channel string, data struct<{fields}>")
    parsed = df.select(*(extra or []), ingested, F.explode(F.array(top)).alias("m"))
    parsed = parsed.select("*", F.explode(F.array(body)).alias("p"))

    def field(name: str) -> Column:
        return F.try_element_at("m", F.lit(name))

    is_option = F.coalesce(
        (field("method") == "subscription") & F.contains(F.col("p.channel"), F.lit("ticker")), F.lit(False)
    )
    is_book = F.coalesce(field("e") == "bookTicker", F.lit(False))

    def either(name: str, other: str | None) -> Column:
        book = field(other).try_cast("double") if other else F.lit(0.0)
        return F.coalesce(F.when(is_option, F.col(f"p.data.{name}")).otherwise(book), F.lit(0.0))

    return parsed.filter(is_option | is_book).select(
        *(extra or []),
        F.coalesce(
            F.when(is_option, F.col("p.data.timestamp")).otherwise(field("T").try_cast("bigint")), F.col(ingested)
        ).alias("timestamp"),
        F.coalesce(F.when(is_option, F.col("p.data.instrument_name")).otherwise(field("s")), F.lit("")).alias(
            "instrument_name"
        ),
        either("best_bid_price", "b").alias("bid_price"),
        either("best_ask_price", "a").alias("ask_price"),
        either("best_bid_amount", "B").alias("bid_size"),
        either("best_ask_amount", "A").alias("ask_size"),
        either("last_price", None).alias("last_price"),
    )


def select_instruments(
    listing: DataFrame,
    start_ms: int,
    end_ms: int,
    include_expired: bool = False,
    whitelist: DataFrame | None = None,
) -> DataFrame:
    """Active contracts and, if asked, all expired ones whose expiry lies strictly inside the
    range; then the whitelist."""
    wanted = F.col("is_active")
    if include_expired:
        at = F.col("expiration_timestamp")
        wanted = wanted | (~F.col("is_active") & (at > start_ms) & (at < end_ms))
    out = listing.filter(wanted)
    if whitelist is not None:
        out = out.join(whitelist.select("instrument_name").distinct(), "instrument_name", "left_semi")
    return out
