"""Upserts, table reads, maintenance."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quoteloom.operators import tables
from quoteloom.plans import candles as candle_plan
from quoteloom.session import shared_dir
from quoteloom.sinks import store

from .base import NOW_MS, oracle_with, query, table, view
from .quality import CELL

_SPLIT = """top AS (SELECT max(event_id) AS m FROM events), old AS (SELECT timestamp, instrument, seq, price FROM ticks, top WHERE seq < m * 0.6e0),
new AS (SELECT timestamp, instrument, seq, price + 1 AS price FROM ticks, top WHERE seq >= m * 0.4e0)"""
_KEY = ["timestamp", "instrument"]


def _halves(spark, d):
    ticks = view(spark, d, "ticks").select("timestamp", "instrument", "seq", "price")
    top = ticks.agg(F.max("seq")).first()[0]
    return (
        ticks.filter(F.col("seq") < top * 0.6),
        ticks.filter(F.col("seq") >= top * 0.4).withColumn("price", F.col("price") + 1),
    )


def _merge_sql(rank: str) -> str:
    return f"""{oracle_with('ticks')}, {_SPLIT}, u AS (SELECT *, 0 AS b FROM old UNION ALL SELECT *, 1 FROM new)
SELECT timestamp, instrument, seq, price FROM u QUALIFY row_number() OVER (PARTITION BY timestamp, instrument ORDER BY {rank}) = 1"""


@query("upsert_keep_last", _merge_sql("b DESC, seq DESC"))
def upsert_keep_last(spark, d):
    return tables.merge(*_halves(spark, d), _KEY, ["seq"], "last")


@query("upsert_keep_first", _merge_sql("b, seq"))
def upsert_keep_first(spark, d):
    return tables.merge(*_halves(spark, d), _KEY, ["seq"], "first")


@query("rows_added", f"{oracle_with('ticks')}, {_SPLIT} SELECT DISTINCT timestamp, instrument FROM new WHERE (timestamp, instrument) NOT IN (SELECT timestamp, instrument FROM old)")
def rows_added(spark, d):
    return tables.rows_added(*_halves(spark, d), _KEY)


@query(
    "dedupe_trades",
    """SELECT l_orderkey || '-' || l_linenumber AS trade_id, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, l_quantity DESC, l_discount DESC, l_tax DESC) = 1""",
)
def dedupe_trades(spark, d):
    rows = table(spark, d, "lineitem").withColumn("trade_id", F.concat_ws("-", "l_orderkey", "l_linenumber"))
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    out = tables.dedupe(rows, ["trade_id"], order)
    return out.select("trade_id", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


_WRITTEN: dict[tuple, str] = {}


def _write(spark, d) -> str:
    """The landed records as a dated table in the shared folder, written in two upserts
    that overlap."""
    path = f"{shared_dir(spark)}/landed-{uuid.uuid4().hex}"
    rows = store.with_date(view(spark, d, "landed").select("seq", "timestamp", *CELL, "price", "user_id"))
    keys = ["timestamp", "exchange", "symbol"]
    for half in (F.col("seq") % 3 != 0, F.col("seq") % 3 != 1):
        store.upsert(rows.filter(half), path, keys=keys, order_by=["seq"])
    return path


def _stored(spark, d) -> str:
    """That table, written once per application and input for the queries that only read."""
    mark = (spark.sparkContext.applicationId, d)
    if mark not in _WRITTEN:
        _WRITTEN[mark] = _write(spark, d)
    return _WRITTEN[mark]


_TABLE = """dated AS (SELECT seq, timestamp, exchange, data_type, symbol, price, user_id, strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d') AS date FROM landed),
kept AS (SELECT *, row_number() OVER (PARTITION BY exchange, data_type, symbol, timestamp ORDER BY CASE WHEN seq % 3 <> 1 THEN 1 ELSE 0 END DESC, seq DESC) AS rn FROM dated), tab AS (SELECT * EXCLUDE (rn) FROM kept WHERE rn = 1)"""


def _read(spark, d):
    return store.read_table(spark, _stored(spark, d))


@query("upsert_table", f"{oracle_with('landed')}, {_TABLE} SELECT * FROM tab")
def upsert_table(spark, d):
    return store.read_table(spark, _write(spark, d))


@query("load_range", f"{oracle_with('landed')}, {_TABLE} SELECT seq, timestamp, symbol, date FROM tab WHERE date BETWEEN '2024-01-05' AND '2024-01-09' AND symbol = 'BTC'")
def load_range(spark, d):
    out = store.load_range(_read(spark, d), "2024-01-05", "2024-01-09", "BTC", "symbol")
    return out.select("seq", "timestamp", "symbol", "date")


@query(
    "load_latest_day",
    f"""{oracle_with('landed')}, {_TABLE}, recent AS (SELECT * FROM tab WHERE date BETWEEN '2023-12-22' AND '2024-01-20')
SELECT seq, timestamp, data_type, symbol, date FROM recent QUALIFY date = max(date) OVER (PARTITION BY data_type, symbol)""",
)
def load_latest_day(spark, d):
    out = store.load_latest_day(_read(spark, d), ["data_type", "symbol"], "2024-01-20")
    return out.select("seq", "timestamp", "data_type", "symbol", "date")


@query(
    "load_latest_day_null_key",
    f"""{oracle_with('landed')}, {_TABLE}, recent AS (SELECT * REPLACE (nullif(symbol, (SELECT min(symbol) FROM landed)) AS symbol) FROM tab WHERE date BETWEEN '2023-12-22' AND '2024-01-20')
SELECT seq, symbol, date FROM recent QUALIFY date = max(date) OVER (PARTITION BY symbol)""",
)
def load_latest_day_null_key(spark, d):
    rows = _read(spark, d)
    least = rows.agg(F.min("symbol")).first()[0]
    rows = rows.withColumn("symbol", F.nullif("symbol", F.lit(least)))
    return store.load_latest_day(rows, ["symbol"], "2024-01-20").select("seq", "symbol", "date")


@query("store_stats", f"{oracle_with('landed')} SELECT exchange, data_type, symbol, count(*) AS row_count, min(timestamp) AS start_time, max(timestamp) AS end_time FROM landed GROUP BY 1, 2, 3")
def store_stats(spark, d):
    return store.store_stats(view(spark, d, "landed"), CELL)


_PLAN_NOW = 1_706_140_800_000  # 2024-01-25 UTC


@query(
    "incremental_plan",
    f"""{oracle_with('landed')}, s AS (SELECT user_id, max(timestamp) AS e FROM landed WHERE timestamp < {_PLAN_NOW} GROUP BY 1), un AS (SELECT c_custkey AS user_id FROM customer)
SELECT user_id, e AS last_ms, coalesce(e + 86400000, {_PLAN_NOW} - 86400000) AS start_ms, cast({_PLAN_NOW} AS bigint) AS end_ms FROM un LEFT JOIN s USING (user_id) WHERE e IS NULL OR e + 86400000 < {_PLAN_NOW}""",
)
def incremental_plan(spark, d):
    past = view(spark, d, "landed").filter(F.col("timestamp") < _PLAN_NOW)
    universe = table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    return store.incremental_plan(universe, store.store_stats(past, ["user_id"]), ["user_id"], _PLAN_NOW)


@query(
    "query_tickers",
    f"{oracle_with('ticks')} SELECT seq, timestamp, instrument, price FROM ticks WHERE instrument = 'view' AND timestamp >= 1704412800000 AND timestamp <= 1705276800000 ORDER BY timestamp DESC, seq LIMIT 100",
)
def query_tickers(spark, d):
    rows = view(spark, d, "ticks").select("seq", "timestamp", "instrument", "price")
    return store.query_rows(rows, "view", 1_704_412_800_000, 1_705_276_800_000, 100, column="instrument", ties=["seq"])


@query("latest_per_key", f"{oracle_with('ticks')} SELECT * FROM ticks QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY timestamp DESC, seq DESC) = 1")
def latest_per_key(spark, d):
    return tables.latest_per_key(view(spark, d, "ticks"), ["user_id"], seq="seq")


@query("count_by_day", f"{oracle_with('ticks')} SELECT strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d') AS date, count(*) AS rows FROM ticks GROUP BY 1")
def count_by_day(spark, d):
    return store.count_by_day(view(spark, d, "ticks"))


@query(
    "retention_plan",
    f"""{oracle_with('landed')}, {_TABLE}, p AS (SELECT DISTINCT exchange, data_type, symbol, date FROM tab)
SELECT date, count(*) AS partitions, CASE WHEN date >= '2024-01-11' THEN 'KEEP' ELSE 'WOULD_DELETE' END AS action FROM p GROUP BY 1""",
)
def retention_plan(spark, d):
    plan = store.retention_plan(store.files_of(spark, _stored(spark, d)), "2024-01-25")
    return plan.groupBy(F.col("date").cast("string").alias("date"), "action").agg(F.count(F.lit(1)).alias("partitions"))


@query("source_inventory", f"{oracle_with('landed')} SELECT DISTINCT exchange, data_type, symbol, true AS has_files FROM landed")
def source_inventory(spark, d):
    found = store.source_inventory(store.files_of(spark, _stored(spark, d)))
    return found.select(*CELL, (F.col("files") > 0).alias("has_files"))


@query(
    "file_checks",
    f"""{oracle_with('landed')}, {_TABLE} SELECT exchange, data_type, symbol, date, count(*) AS rows, cast(0 AS bigint) AS errors FROM tab GROUP BY 1, 2, 3, 4
UNION ALL SELECT 'binance', 'spot_price', 'BROKEN', '1970-01-01', 0, 2""",
)
def file_checks(spark, d):
    """The table as it is, and a folder of epoch zero with a file that is no Parquet."""
    broken = f"{shared_dir(spark)}/broken-{uuid.uuid4().hex}"
    cell = f"{broken}/exchange=binance/data_type=spot_price/symbol=BROKEN/date=1970-01-01"
    spark.range(1).select(F.lit("not parquet")).write.text(cell)
    store.rename_files(spark, cell, ".txt", ".parquet")
    checks = store.file_checks(spark, _stored(spark, d)).unionByName(store.file_checks(spark, broken))
    return checks.groupBy(*CELL, "date").agg(F.sum("rows").alias("rows"), F.sum("errors").alias("errors"))


@query(
    "storage_audit",
    f"""{oracle_with('landed')}, {_TABLE} SELECT '/exchange=' || exchange || '/data_type=' || data_type || '/symbol=' || symbol || '/date=' || date AS folder,
count(*)::BIGINT AS rows, true AS has_files FROM tab GROUP BY exchange, data_type, symbol, date""",
)
def storage_audit(spark, d):
    found = store.storage_audit(spark, _stored(spark, d))
    return found.select("folder", "rows", ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("has_files"))


@query(
    "candle_update",
    f"""{oracle_with('ticks')}, k AS (SELECT 'binance_spot' AS exchange, CASE user_id % 3 WHEN 0 THEN 'BTC' WHEN 1 THEN 'ETH' ELSE 'NEW' END AS symbol, timestamp, price, seq FROM ticks),
e AS (SELECT exchange, symbol, timestamp, arg_min(price, price) AS price FROM k WHERE seq % 2 = 0 GROUP BY 1, 2, 3), l AS (SELECT exchange, symbol, timestamp, arg_min(price + 1, price) AS price FROM k GROUP BY 1, 2, 3)
SELECT exchange, symbol, '1m' AS timeframe, timestamp, coalesce(e.price, l.price) AS open FROM l LEFT JOIN e USING (exchange, symbol, timestamp)""",
)
def candle_update(spark, d):
    """Two landings of kline payloads: candles of the first one stay as they are."""
    path = f"{shared_dir(spark)}/candles-{uuid.uuid4().hex}"
    ticks = view(spark, d, "ticks")
    third = F.col("user_id") % 3
    symbol = F.when(third == 0, "BTCUSDT").when(third == 1, "ETHUSDT").otherwise("NEW")

    def landed(rows, price):
        ts = F.col("timestamp").cast("string")
        p = price.cast("string")
        body = F.concat(F.lit("[["), ts, *[x for _ in range(4) for x in (F.lit(',"'), p, F.lit('"'))], F.lit(',"1"]]'))
        return rows.select(
            F.lit("klines").alias("form"), F.lit("binance_spot").alias("exchange"), symbol.alias("symbol"), F.lit("1m").alias("timeframe"), body.alias("payload")
        )

    candle_plan.update(landed(ticks.filter(F.col("seq") % 2 == 0), F.col("price")), path)
    candle_plan.update(landed(ticks, F.col("price") + 1), path)
    return store.read_table(spark, path, [*candle_plan.SERIES, "date"]).select("exchange", "symbol", "timeframe", "timestamp", "open")
