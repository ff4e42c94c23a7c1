"""Streaming queries run to the end of their input, and their batch twins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quoteloom.session import configure, shared_dir
from quoteloom.sinks.store import read_table
from quoteloom.sources import option_feed
from quoteloom.streaming import keyed, live

from .base import NOW_MS, greeks_ctes, oracle_with, query, r, rounded, table, view
from .market import _ATM, _C25, _NEAR, _P25

ALL = {"availableNow": True}
ROW_GROUP = 4 << 20


def _stream(spark, d, name):
    """A given table as a file stream."""
    schema = table(spark, d, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(d)


def _ticks(spark, d):
    return _stream(configure(spark), d, "events").select(
        F.col("event_id").alias("arrival"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("event_type").alias("instrument_name"),
        F.col("value").alias("price"),
        "user_id",
    )


def _folder(spark) -> str:
    return f"{shared_dir(configure(spark))}/stream-{uuid.uuid4().hex}"


def _messages(rows, arrival="seq"):
    """Pushed messages as text: four kinds of option records, other venue quotes, junk."""
    p, ts = F.col("price"), F.col("timestamp")
    name = F.concat(F.lit("I"), F.col("user_id"))
    kind = F.col(arrival) % 7
    ticker = F.struct(ts, name.alias("instrument_name"), p.alias("best_bid_price"), (p + 1).alias("best_ask_price"), F.lit(2.0).alias("best_bid_amount"))
    book = F.struct(ts, name.alias("instrument_name"), F.array(F.array(p, p * 2)).alias("bids"))
    trade = F.array(F.struct(ts, name.alias("instrument_name"), F.col(arrival).cast("string").alias("trade_id"), p.alias("price")))
    mark = F.struct(ts, name.alias("instrument_name"), p.alias("mark_price"))

    def pushed(channel, data):
        params = F.struct(F.concat(F.lit(channel + "."), name).alias("channel"), data.alias("data"))
        return F.to_json(F.struct(F.lit("subscription").alias("method"), params.alias("params")))

    quote = F.concat(
        F.lit('{"e":"bookTicker","s":"'), name, F.lit('","T":'), ts, F.lit(',"b":"'), p, F.lit('","B":"3.0","a":"'), p + 1, F.lit('","A":"4.0"}')
    )
    return rows.select(
        F.col(arrival).alias("arrival"),
        F.lit(NOW_MS).alias("ingest_ms"),
        F.when(kind == 0, pushed("ticker", ticker))
        .when(kind == 1, pushed("book", book))
        .when(kind == 2, pushed("trades", trade))
        .when(kind == 3, pushed("markprice.options", mark))
        .when(kind == 4, pushed("greeks", mark))
        .when(kind == 5, quote)
        .otherwise(F.lit('{"method": not json'))
        .alias("value"),
    )


def _batch_messages(spark, d):
    return _messages(view(spark, d, "ticks"))


@query(
    "channel_route",
    f"""{oracle_with('ticks')} SELECT CASE seq % 7 WHEN 0 THEN 'tickers' WHEN 1 THEN 'books' WHEN 2 THEN 'trades' WHEN 3 THEN 'mark_prices' ELSE 'greeks' END AS record_type, count(*) AS messages
FROM ticks WHERE seq % 7 < 5 GROUP BY 1""",
)
def channel_route(spark, d):
    routed = option_feed.messages(_batch_messages(spark, d))
    return routed.groupBy("record_type").agg(F.count(F.lit(1)).alias("messages"))


_L1 = f"""{oracle_with('ticks')}, q AS (SELECT seq AS arrival, timestamp, 'I' || user_id AS instrument_name, price AS bid_price, price + 1 AS ask_price,
  CASE WHEN seq % 7 = 0 THEN 2e0 ELSE 3e0 END AS bid_size, CASE WHEN seq % 7 = 0 THEN 0 ELSE 4e0 END AS ask_size, cast(0 AS double) AS last_price FROM ticks WHERE seq % 7 IN (0, 5))
SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY instrument_name ORDER BY arrival DESC) = 1"""


@query("l1_latest", _L1)
def l1_latest(spark, d):
    return live.latest_quotes(option_feed.l1_quotes(_batch_messages(spark, d), extra=["arrival"]))


@query("stream_l1_latest", _L1)
def stream_l1_latest(spark, d):
    """Over thirteen batches: the state must be that of the last one, not of batch 9.

    A batch is one file, which one task or a few read; its rows are dealt to all cores before
    they become messages and are parsed."""
    folder = _folder(spark)
    files = f"{folder}/in"
    view(spark, d, "ticks").repartition(13, "seq").write.options(**{"maxRecordsPerFile": 0, "parquet.block.size": ROW_GROUP}).parquet(files)
    ticks = live.file_stream(spark, spark.read.parquet(files).schema, files, max_bytes=1)
    ticks = ticks.repartition(spark.sparkContext.defaultParallelism)
    quotes = option_feed.l1_quotes(_messages(ticks), extra=["arrival"])
    live.write_changes(live.latest_quotes(quotes), f"{folder}/out", f"{folder}/ckpt", **ALL).awaitTermination()
    return live.read_latest(spark, f"{folder}/out", ["instrument_name"])


@query("stream_l1_state", _L1)
def stream_l1_state(spark, d):
    """The same into a state table of one row per instrument."""
    folder = _folder(spark)
    quotes = option_feed.l1_quotes(_messages(_ticks(spark, d).withColumnRenamed("arrival", "seq")), extra=["arrival"])
    live.write_state(live.latest_quotes(quotes), f"{folder}/out", f"{folder}/ckpt", ["instrument_name"], **ALL).awaitTermination()
    return live.read_state(spark, f"{folder}/out")


@query(
    "perp_prices",
    f"""{oracle_with('ticks')} SELECT upper(instrument) AS currency, timestamp, price FROM ticks WHERE seq % 2 = 0""",
)
def perp_prices(spark, d):
    quotes = view(spark, d, "ticks").select(
        F.concat(F.upper("instrument"), F.when(F.col("seq") % 2 == 0, "-PERPETUAL").otherwise("-28MAR26-1-C")).alias("instrument_name"),
        "timestamp", F.col("price").alias("mid_price"),
    )
    return live.perp_prices(quotes)


@query(
    "stream_counters",
    f"{oracle_with('ticks')} SELECT count(*)::BIGINT AS records, max(timestamp) AS newest, cast(0 AS bigint) AS waiting FROM ticks",
)
def stream_counters(spark, d):
    """Counters of every batch, appended to a table."""
    import time

    folder = _folder(spark)
    listener = live.CollectorMetrics()
    spark.streams.addListener(listener)
    try:
        counted = live.with_counters(_ticks(spark, d))
        query = live.write_changes(counted, f"{folder}/out", f"{folder}/ckpt", "append", **ALL)
        query.awaitTermination()
        for _ in range(100):  # progress reaches the listener on a thread of its own
            if listener.batches:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    table = listener.flush(spark, f"{folder}/counters")
    return table.agg(F.sum("flush_size").alias("records"), F.max("newest").alias("newest"), F.lit(len(listener.batches)).cast("long").alias("waiting"))


@query(
    "stream_table",
    f"""{oracle_with('ticks')} SELECT timestamp, 'binance' AS exchange, 'spot_price' AS data_type, instrument AS symbol, price, seq AS arrival, strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d') AS date
FROM ticks QUALIFY row_number() OVER (PARTITION BY timestamp, instrument ORDER BY seq DESC) = 1""",
)
def stream_table(spark, d):
    folder = _folder(spark)
    rows = _ticks(spark, d).select(
        "timestamp", F.lit("binance").alias("exchange"), F.lit("spot_price").alias("data_type"), F.col("instrument_name").alias("symbol"), "price", "arrival"
    )
    live.write_table(rows, f"{folder}/out", f"{folder}/ckpt", order_by=["arrival"], **ALL).awaitTermination()
    return read_table(spark, f"{folder}/out")


@query(
    "stream_routed",
    f"""{oracle_with('ticks')}, t AS (SELECT CASE seq % 7 WHEN 0 THEN 'tickers' WHEN 1 THEN 'books' WHEN 2 THEN 'trades' WHEN 3 THEN 'mark_prices' ELSE 'greeks' END AS record_type, * FROM ticks WHERE seq % 7 < 5)
SELECT record_type, count(*) AS records, min(timestamp) AS first_ms, max(timestamp) AS last_ms FROM (SELECT DISTINCT record_type, user_id, timestamp, CASE WHEN record_type = 'trades' THEN seq END AS id FROM t) x GROUP BY 1""",
)
def stream_routed(spark, d):
    folder = _folder(spark)
    messages = _messages(_ticks(spark, d).withColumnRenamed("arrival", "seq"))
    live.write_routed(messages, f"{folder}/out", f"{folder}/ckpt", **ALL).awaitTermination()
    parts = [
        spark.read.parquet(f"{folder}/out/{kind}").select(F.lit(kind).alias("record_type"), "timestamp")
        for kind in ("tickers", "books", "trades", "mark_prices", "greeks")
    ]
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part)
    return both.groupBy("record_type").agg(
        F.count(F.lit(1)).alias("records"), F.unix_millis(F.min("timestamp")).alias("first_ms"), F.unix_millis(F.max("timestamp")).alias("last_ms")
    )


@query(
    "stream_distinct",
    f"{oracle_with('ticks')} SELECT count(*) AS records, count(DISTINCT instrument || timestamp) AS keys FROM (SELECT DISTINCT instrument, timestamp FROM ticks) x",
)
def stream_distinct(spark, d):
    """Each record arrives twice; one of each stays."""
    folder = _folder(spark)
    twice = _ticks(spark, d).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    kept = live.distinct_records(twice, ["instrument_name", "timestamp"])
    live.write_changes(kept, f"{folder}/out", f"{folder}/ckpt", "append", **ALL).awaitTermination()
    out = spark.read.parquet(f"{folder}/out")
    return out.agg(F.count(F.lit(1)).alias("records"), F.countDistinct("instrument_name", "timestamp").alias("keys"))


@query(
    "stream_snapshots",
    f"""{oracle_with('ticks')} SELECT instrument AS instrument_name, timestamp // 1000 * 1000 AS snapshot_ts, arg_max(price, (timestamp, seq)) AS price FROM ticks
WHERE timestamp // 1000 * 1000 + 1000 <= (SELECT max(timestamp) - 60000 FROM ticks) GROUP BY 1, 2""",
)
def stream_snapshots(spark, d):
    """Every step the watermark has passed by the end of the input."""
    folder = _folder(spark)
    shots = live.snapshot_stream(_ticks(spark, d))
    live.write_changes(shots, f"{folder}/out", f"{folder}/ckpt", "append", **ALL).awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("instrument_name", "snapshot_ts", "price")


_SILENT = 7_200_000


@query(
    "stream_silence",
    f"""{oracle_with('ticks')}, f AS (SELECT instrument || '-' || (user_id % 20) AS feed, timestamp, seq FROM ticks),
s AS (SELECT feed, lag(timestamp) OVER (PARTITION BY feed ORDER BY timestamp, seq) AS p, timestamp AS t FROM f)
SELECT feed, p AS silent_from, p + {_SILENT} AS alert_at, t AS resumed_at, t - p AS silence_ms FROM s WHERE t - p > {_SILENT}
UNION ALL SELECT feed, max(timestamp), max(timestamp) + {_SILENT}, NULL, NULL FROM f GROUP BY feed
  HAVING max(timestamp) + {_SILENT} < (SELECT max(timestamp) - 60000 FROM ticks)""",
)
def stream_silence(spark, d):
    """Silences that ended, and an open alert for every feed that is silent at the end."""
    folder = _folder(spark)
    feed = F.concat("instrument_name", F.lit("-"), F.col("user_id") % 20)
    alerts = live.silence_alerts(_ticks(spark, d).withColumn("feed", feed), "feed", _SILENT)
    live.write_changes(alerts, f"{folder}/out", f"{folder}/ckpt", "append", **ALL).awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch")


BATCH_ROWS = 2_000_000


def _in_files(rows, by, folder, files=3):
    """The rows as a stream of several batches that follow ``by``: the files are written one
    after the other, and each batch reads one.  A table of more than ``BATCH_ROWS`` for each of
    ``files`` makes more of them, not larger ones; it is cut once, so none reads it whole."""
    spark = rows.sparkSession
    low, high, count = rows.agg(F.min(by), F.max(by), F.count(F.lit(1))).first()
    files = max(files, -(-count // BATCH_ROWS))
    # Cuts at low + (high - low) * k / files; the last file has the highest one too.
    width = max(1, high - low)
    part = F.least(F.floor((F.col(by) - low).cast("decimal(20,0)") * files / width), F.lit(files - 1)).cast("int")
    rows.withColumn("_part", part).repartition(files, "_part").write.partitionBy("_part").parquet(f"{folder}-cut")
    cut = spark.read.schema(f"{','.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema)}, _part int").parquet(f"{folder}-cut")
    for k in range(files):
        cut.where(F.col("_part") == k).drop("_part").coalesce(1).write.mode("append").option("parquet.block.size", ROW_GROUP).parquet(folder)
    return live.file_stream(spark, rows.schema, folder, max_bytes=1)


@query(
    "stream_market",
    f"""{oracle_with('chain', 'ticks')}, latest AS (SELECT * FROM chain QUALIFY row_number() OVER (PARTITION BY ccy, instrument_name ORDER BY seq DESC) = 1),
{greeks_ctes(source='latest')}, {_NEAR.format(key='ccy')},
n AS (SELECT ccy, count(*) AS contracts, {r('arg_min(cast(iv AS float), (abs(cast(strike AS float) - cast(underlying_price AS float)), seq))', 5)} AS nearest_iv FROM g GROUP BY 1),
atm AS (SELECT ccy, arg_min(iv, (dd, seq)) AS atm_iv FROM dist JOIN bands USING (ccy) WHERE band IS NULL OR (mny <= band AND iv > 0) GROUP BY 1),
wing AS (SELECT ccy, {_C25} - {_P25} AS skew_25d, ({_C25} + {_P25}) / 2 - {_ATM} AS butterfly_25d FROM g GROUP BY 1),
s AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'BTC' ELSE 'ETH' END AS ccy, arg_max(price, seq) AS spot_price FROM ticks WHERE instrument = 'view' GROUP BY 1),
p AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'BTC' ELSE 'ETH' END AS ccy, arg_max(price, seq) AS perp_price FROM ticks WHERE instrument = 'click' GROUP BY 1)
SELECT ccy, contracts, nearest_iv, {r('atm_iv')} AS atm_iv, {r('skew_25d')} AS skew_25d, {r('butterfly_25d')} AS butterfly_25d,
  CASE WHEN atm_iv = 0 AND skew_25d = 0 AND butterfly_25d = 0 THEN 'estimated' ELSE 'good' END AS quality,
  spot_price, perp_price, {r('perp_price - spot_price')} AS basis
FROM n JOIN atm USING (ccy) JOIN wing USING (ccy) JOIN s USING (ccy) JOIN p USING (ccy)""",
)
def stream_market(spark, d):
    """Greeks, surface and basis from three streams, each changing from batch to batch; the
    current ones are read back."""
    folder, out = _folder(spark), f"{_folder(spark)}/out"
    even = F.col("user_id") % 2 == 0

    def prices(kind, column, names):
        rows = view(spark, d, "ticks").where(F.col("instrument") == kind)
        return rows.select("seq", "timestamp", "price", F.when(even, names[0]).otherwise(names[1]).alias(column))

    chain = _in_files(view(spark, d, "chain"), "seq", f"{folder}/chain")
    spot = _in_files(prices("view", "symbol", ("BTCUSDT", "ETHUSDT")), "seq", f"{folder}/spot")
    perp = _in_files(prices("click", "currency", ("BTC", "ETH")), "seq", f"{folder}/perp")

    def mapping():
        return spark.createDataFrame([("BTCUSDT", "BTC"), ("ETHUSDT", "ETH")], "symbol string, currency string")

    live.write_live_market(chain, spot, perp, mapping, out, f"{folder}/ckpt", ["ccy"], lambda _: NOW_MS, **ALL).awaitTermination()
    # A contract whose newest row was filtered out has no current Greeks.
    current = live.read_state(spark, f"{out}/state").where("kind = 'chain'").select("chain.seq")
    greeks = live.read_latest(spark, f"{out}/options_greeks", ["ccy", "instrument_name"]).join(current, "seq", "left_semi")
    rank = F.struct(F.abs(F.col("strike") - F.col("underlying_price")), F.col("seq"))
    greeks = greeks.groupBy("ccy").agg(F.count(F.lit(1)).alias("contracts"), F.min_by("iv", rank).alias("nearest_iv"))
    surface = live.read_latest(spark, f"{out}/vol_surface", ["ccy"]).select("ccy", "atm_iv", "skew_25d", "butterfly_25d", "quality")
    pairs = live.read_latest(spark, f"{out}/basis", ["symbol"])
    pairs = pairs.select(F.split("symbol", "_")[0].alias("ccy"), "spot_price", "perp_price", "basis")
    both = rounded(greeks, "nearest_iv", digits=5).join(surface, "ccy").join(pairs, "ccy")
    return rounded(both, "atm_iv", "skew_25d", "butterfly_25d", "basis")


_STEP = 600_000


@query(
    "stream_snapshots_filled",
    f"""{oracle_with('ticks')}, w AS (SELECT max(timestamp) - 60000 AS passed FROM ticks), b AS (SELECT instrument, min(timestamp) AS lo FROM ticks GROUP BY 1),
sp AS (SELECT instrument, unnest(range((lo + {_STEP - 1}) // {_STEP} * {_STEP}, passed, {_STEP})) AS timestamp FROM b, w),
s AS (SELECT instrument, timestamp, arg_max(price, seq) AS price FROM ticks GROUP BY 1, 2)
SELECT sp.instrument AS instrument_name, sp.timestamp, s.price, sp.timestamp - s.timestamp AS age_ms FROM sp ASOF LEFT JOIN s ON sp.instrument = s.instrument AND sp.timestamp >= s.timestamp""",
)
def stream_snapshots_filled(spark, d):
    """Every step up to the watermark, repeated while no quote comes, over several batches."""
    folder = _folder(spark)
    rows = view(spark, d, "ticks").select(F.col("instrument").alias("instrument_name"), "timestamp", "price", F.col("seq").alias("arrival"))
    shots = keyed.filled_snapshot_stream(_in_files(rows, "timestamp", f"{folder}/in"), ["price"], step_ms=_STEP)
    live.write_changes(shots, f"{folder}/out", f"{folder}/ckpt", "append", **ALL).awaitTermination()
    return spark.read.parquet(f"{folder}/out").drop("batch")


@query(
    "stream_flush",
    f"""{oracle_with('ticks')}, n AS (SELECT instrument, seq, row_number() OVER (PARTITION BY instrument ORDER BY seq) - 1 AS k FROM ticks)
SELECT instrument AS instrument_name, k // 40 AS flush, count(*) AS records, min(seq) AS first_seq, max(seq) AS last_seq FROM n GROUP BY 1, 2 HAVING count(*) = 40""",
)
def stream_flush(spark, d):
    """Flushes of forty rows of an instrument, across batches; what is left waits for its age."""
    folder = _folder(spark)
    rows = view(spark, d, "ticks").select(F.col("instrument").alias("instrument_name"), "seq", "timestamp", "price")
    flushed = keyed.flush_stream(_in_files(rows, "seq", f"{folder}/in"), ["instrument_name"], 40, 3_600_000, "seq")
    with keyed.rocksdb(spark):
        query = live.write_changes(flushed, f"{folder}/out", f"{folder}/ckpt", "append", processingTime="0 seconds")
    taken, total = {}, rows.count()
    try:
        while sum(taken.values()) < total:  # timers keep such a query running for ever
            query.awaitTermination(0.2)
            taken.update({p["batchId"]: p["numInputRows"] for p in query.recentProgress if p["numInputRows"]})
    finally:
        query.stop()
    out = spark.read.parquet(f"{folder}/out").where("reason = 'rows'")
    return out.groupBy("instrument_name", "flush").agg(
        F.count(F.lit(1)).alias("records"), F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq")
    )


@query(
    "stream_failures",
    f"""{oracle_with('ticks')}, o AS (SELECT seq, user_id % 5 AS feed, instrument <> 'error' AS ok FROM ticks),
x AS (SELECT *, count(*) FILTER (ok) OVER (PARTITION BY feed ORDER BY seq) AS run, max(seq) OVER (PARTITION BY feed) AS newest FROM o)
SELECT feed, min(seq) AS first_failure, max(seq) AS last_failure, count(*) AS failures, count(*) >= 2 AS alert, max(seq) = any_value(newest) AS open FROM x WHERE NOT ok GROUP BY feed, run""",
)
def stream_failures(spark, d):
    """Failure runs over several batches, those that are still open included."""
    folder = _folder(spark)
    rows = view(spark, d, "ticks").select("seq", (F.col("user_id") % 5).alias("feed"), (F.col("instrument") != "error").alias("ok"))
    outcomes = _in_files(rows, "seq", f"{folder}/in")
    keyed.write_failures(outcomes, f"{folder}/out", f"{folder}/ckpt", F.col("ok"), "seq", 2, ["feed"], **ALL).awaitTermination()
    return live.read_state(spark, f"{folder}/out")
