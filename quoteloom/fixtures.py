"""Market-data views derived from the given tables.

Each view is one SQL text that both Spark and the oracle engine can run; ``MS(x)`` stands
for epoch milliseconds of a UTC timestamp and is spelled out per engine.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .session import configure

NOW_MS = 1_772_323_200_000  # 2026-03-01 00:00 UTC

VIEWS = {
    "ticks": (
        "events",
        """SELECT event_id AS seq, MS(ts) AS timestamp, event_type AS instrument, user_id,
                  value AS price FROM events""",
    ),
    "chain": (
        "part",
        """SELECT seq, ccy, expiry_str,
  ccy || '-' || expiry_str || '-' || cast(strike AS varchar(20)) || '-' || cp AS instrument_name,
  CASE WHEN ccy = 'BTC' THEN 100000.0e0 ELSE 3000.0e0 END AS underlying_price, strike, cp,
  CASE WHEN seq % 17 = 0 THEN 0e0 ELSE (p_retailprice - 899e0) / 10e0 END AS bid_price,
  CASE WHEN seq % 17 = 0 OR seq % 19 = 0 THEN 0e0 ELSE (p_retailprice - 898e0) / 10e0 END AS ask_price,
  CASE WHEN seq % 11 = 0 THEN 0e0 ELSE 0.40e0 + p_size / 100e0 END AS mark_iv,
  CASE WHEN seq % 13 = 0 THEN 0e0 ELSE 0.38e0 + p_size / 100e0 END AS bid_iv,
  CASE WHEN seq % 13 = 0 THEN 0e0 ELSE 0.42e0 + p_size / 100e0 END AS ask_iv,
  cast(p_size * 10 + seq % 7 AS double) AS open_interest
FROM (SELECT p_partkey AS seq, p_size, p_retailprice,
  CASE WHEN p_partkey % 2 = 0 THEN 'BTC' ELSE 'ETH' END AS ccy,
  CASE WHEN p_size % 2 = 0 THEN 'C' ELSE 'P' END AS cp,
  CASE cast(floor(p_partkey / 2e0) AS int) % 4 WHEN 0 THEN '28MAR26' WHEN 1 THEN '26JUN26'
       WHEN 2 THEN '9MAY26' ELSE '25DEC26' END AS expiry_str,
  CASE WHEN p_partkey % 2 = 0 THEN 40000 + 2500 * (cast(floor(p_partkey / 8e0) AS int) % 50)
       ELSE 1200 + 75 * (cast(floor(p_partkey / 8e0) AS int) % 50) END AS strike
  FROM part) b""",
    ),
    "fred": (
        "orders",
        """SELECT series_no, CASE series_no WHEN 0 THEN 'DGS1MO' WHEN 1 THEN 'DGS3MO' WHEN 2 THEN 'DGS6MO'
    WHEN 3 THEN 'DGS1' WHEN 4 THEN 'DGS2' WHEN 5 THEN 'DGS5' WHEN 6 THEN 'DGS10' ELSE 'DGS30' END AS series_id,
  obs_date, CASE WHEN k % 29 = 0 THEN '.'
  ELSE cast(cast((k % 500) / 100e0 AS decimal(6, 2)) AS varchar(20)) END AS value
FROM (SELECT cast(o_orderkey % 8 AS int) AS series_no, cast(o_orderdate AS date) AS obs_date,
             max(o_orderkey) AS k FROM orders GROUP BY 1, 2) b""",
    ),
    "candles": (
        "lineitem",
        """SELECT l_returnflag AS symbol, MS(l_shipdate) AS timestamp, l_orderkey AS seq,
  l_linenumber AS seq2, l_partkey, l_suppkey, l_extendedprice AS open, l_extendedprice * (1 + l_tax) AS close,
  CASE WHEN l_partkey % 50 = 0 THEN l_extendedprice * 0.9e0
       ELSE l_extendedprice * (1 + l_tax) + 1e0 END AS high,
  l_extendedprice * (1 - l_discount) AS low, l_quantity AS volume FROM lineitem""",
    ),
    "landed": (
        "events",
        """SELECT seq, timestamp, price, instrument, user_id, data_type,
  CASE data_type WHEN 'risk_free_rate' THEN 'fred' WHEN 'options_greeks' THEN 'deribit'
    WHEN 'vol_surface' THEN 'deribit' WHEN 'margin_params' THEN 'deribit'
    ELSE CASE user_id % 3 WHEN 0 THEN 'binance' WHEN 1 THEN 'deribit' ELSE 'hyperliquid' END END AS exchange,
  CASE data_type WHEN 'risk_free_rate' THEN 'USD'
    WHEN 'options_greeks' THEN CASE WHEN user_id % 2 = 0 THEN 'BTC' ELSE 'ETH' END
    WHEN 'vol_surface' THEN CASE WHEN user_id % 2 = 0 THEN 'BTC' ELSE 'ETH' END
    WHEN 'margin_params' THEN 'BTC'
    ELSE CASE user_id % 3 WHEN 0 THEN 'BTCUSDT' WHEN 1 THEN 'BTC-PERPETUAL' ELSE 'BTC' END END AS symbol,
  CASE WHEN seq % 7 < 5 AND data_type = 'mark_price' THEN NULL ELSE price END AS mark_price,
  CASE WHEN seq % 7 = 3 THEN NULL ELSE price END AS funding_rate,
  price - 0.5e0 AS bid_price, CASE WHEN seq % 2 = 0 THEN NULL ELSE price + 0.5e0 END AS ask_price
FROM (SELECT event_id AS seq, MS(ts) AS timestamp, value AS price, event_type AS instrument, user_id,
  CASE (event_id + user_id) % 7 WHEN 0 THEN 'options_greeks' WHEN 1 THEN 'mark_price' WHEN 2 THEN 'funding_rate'
    WHEN 3 THEN 'margin_params' WHEN 4 THEN 'basis' WHEN 5 THEN 'vol_surface' ELSE 'risk_free_rate' END AS data_type
  FROM events) b""",
    ),
}


def spell(sql: str, engine: str) -> str:
    """Replace MS(x) by the engine's own expression."""
    form = r"unix_millis(cast(\1 AS timestamp))" if engine == "spark" else r"(epoch_us(\1) // 1000)"
    return re.sub(r"\bMS\(([a-z_.]+)\)", form, sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base, sql = VIEWS[name]
    sql = re.sub(rf"\bFROM {base}\b", f"FROM {{{base}}}", spell(sql, "spark"))
    return spark.sql(sql, **{base: table(spark, sf_dir, base)})


def oracle_with(*names: str) -> str:
    """``WITH`` clause that defines the views for the oracle engine."""
    return "WITH " + ",\n".join(f"{n} AS ({spell(VIEWS[n][1], 'duckdb')})" for n in names)
