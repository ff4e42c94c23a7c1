"""Streaming operators over several micro-batches, against their batch twins."""

import time

import pytest
from pyspark.sql import functions as F

from quoteloom.operators import metrics, tables
from quoteloom.plans import registry
from quoteloom.streaming import live

SCHEMA = "instrument_name string, timestamp long, price double, arrival long"
HOUR = 3_600_000


@pytest.fixture
def feed(spark, tmp_path):
    """Rows in several files, read one file per batch in arrival order."""
    rows = [("AB"[i % 2], 1_700_000_000_000 + i * 60_000 + (5 * HOUR if i >= 30 else 0), float(i), i) for i in range(60)]
    rows[40] = ("A", rows[10][1], -1.0, 40)  # a late repeat of an earlier time
    source = tmp_path / "in"
    for n in range(6):
        part = spark.createDataFrame(rows[n * 10:(n + 1) * 10], SCHEMA).coalesce(1)
        part.write.mode("append").parquet(str(source))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(source))
    return stream, spark.createDataFrame(rows, SCHEMA), tmp_path


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_latest_by_arrival(spark, feed):
    stream, batch, tmp = feed
    run(live.write_changes(live.latest_quotes(stream), f"{tmp}/out", f"{tmp}/c", availableNow=True))
    got = live.read_latest(spark, f"{tmp}/out", ["instrument_name"])
    assert rows_of(got, "instrument_name", "price") == rows_of(tables.latest_per_key(batch, ["instrument_name"], "arrival"), "instrument_name", "price")


def test_table_sink_over_batches(spark, feed):
    stream, batch, tmp = feed
    keys = ["instrument_name", "timestamp"]
    shaped = lambda df: df.withColumns({"exchange": F.lit("x"), "data_type": F.lit("t"), "symbol": F.col("instrument_name")})
    run(live.write_table(shaped(stream), f"{tmp}/out", f"{tmp}/c", keys, order_by=["arrival"], availableNow=True))
    got = spark.read.parquet(f"{tmp}/out")
    assert rows_of(got, "instrument_name", "timestamp", "price") == rows_of(tables.dedupe(batch, keys, ["arrival"]), "instrument_name", "timestamp", "price")


def test_silence_alerts(spark, feed):
    stream, batch, tmp = feed
    run(live.write_changes(live.silence_alerts(stream, "instrument_name", HOUR), f"{tmp}/out", f"{tmp}/c", "append", availableNow=True))
    got = spark.read.parquet(f"{tmp}/out")
    ended = got.filter("resumed_at is not null")
    want = metrics.feed_silence(batch, "instrument_name", HOUR)
    assert rows_of(ended, "feed", "silent_from", "resumed_at") == rows_of(want, "instrument_name", "silent_from", "resumed_at")
    # Feed A fell silent while B's data moved the watermark on, or the other way round;
    # an open alert, where there is one, starts at a silence that later ended.
    opened = {(r.feed, r.silent_from) for r in got.filter("resumed_at is null").collect()}
    assert opened <= {(r.feed, r.silent_from) for r in ended.collect()}


def test_open_silence_alert_on_timeout(spark, tmp_path):
    t0 = 1_700_000_000_000
    batches = [[("A", t0, 1.0, 0), ("B", t0, 1.0, 1)], [("B", t0 + 3 * HOUR, 1.0, 2)], [("B", t0 + 6 * HOUR, 1.0, 3)], [("B", t0 + 6 * HOUR + 1, 1.0, 4)]]
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    run(live.write_changes(live.silence_alerts(stream, "instrument_name", HOUR), f"{tmp_path}/out", f"{tmp_path}/c", "append", availableNow=True))
    got = spark.read.parquet(f"{tmp_path}/out").filter("feed = 'A'").collect()
    assert [(r.silent_from, r.alert_at, r.resumed_at) for r in got] == [(t0, t0 + HOUR, None)]


def test_counters(spark, feed):
    stream, batch, tmp = feed
    listener = live.CollectorMetrics()
    spark.streams.addListener(listener)
    try:
        run(live.write_changes(live.with_counters(stream), f"{tmp}/out", f"{tmp}/c", "append", availableNow=True))
        for _ in range(50):
            if sum(b[1] for b in listener.batches) == 60:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    table = listener.table(spark)
    assert table.agg(F.sum("flush_size")).first()[0] == 60
    sizes = metrics.histogram_le(table, "flush_size", metrics.FLUSH_SIZE_BOUNDS)
    assert {r.le: r.observations for r in sizes.collect()}[10.0] == 6


def test_perp_prices(spark):
    quotes = spark.createDataFrame([("BTC-PERPETUAL", 1, 10.0), ("BTC-28MAR26-1-C", 1, 5.0)], "instrument_name string, timestamp long, mid_price double")
    assert rows_of(live.perp_prices(quotes), "currency", "price") == [("BTC", 10.0)]


def test_registry(spark):
    reg = registry.registry(spark)
    assert reg.count() == 19 and reg.select("strategy").distinct().count() == 6
    assert registry.with_priority(reg, "all").count() == 19
    assert {r.strategy_priority for r in registry.with_priority(reg, ["P2"]).collect()} == {"P2"}
    assert registry.cells(reg.filter("strategy = 'synthetic_covered_call' and data_type = 'funding_rate'")).count() == 9
    assert [r.strategy for r in registry.unknown(spark, reg, ["collar", "nope"]).collect()] == ["nope"]


def test_latest_after_many_batches(spark, tmp_path):
    """Batch 11 is newer than batch 9, though its name sorts before it."""
    for b in (1, 2, 9, 10, 11):
        spark.createDataFrame([("I", b * 1.0)], "instrument_name string, price double").write.parquet(f"{tmp_path}/out/batch={b}")
    assert [r.price for r in live.read_latest(spark, f"{tmp_path}/out", ["instrument_name"]).collect()] == [11.0]


def test_reader_bound_cuts_a_backlog_into_batches(spark, tmp_path):
    schema = "instrument_name string, arrival long"
    for k in range(4):
        spark.createDataFrame([("I", k), ("J", k)], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = live.file_stream(spark, schema, f"{tmp_path}/in", max_bytes=1)
    query = live.write_state(live.latest_quotes(stream), f"{tmp_path}/out", f"{tmp_path}/c", ["instrument_name"], availableNow=True)
    run(query)
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 4
    assert {(r.instrument_name, r.arrival) for r in live.read_state(spark, f"{tmp_path}/out").collect()} == {("I", 3), ("J", 3)}


def test_market_cycle_has_basis_and_surface_of_all_contracts(spark, tmp_path):
    schema = "seq long, ccy string, instrument_name string, underlying_price double, mark_iv double, bid_price double, ask_price double"
    now = 1_767_225_600_000  # 2026-01-01
    first = [(1, "BTC", "BTC-26JUN26-100000-C", 100_000.0, 0.5, 0.1, 0.2)]
    second = [(2, "BTC", "BTC-25SEP26-100000-C", 100_000.0, 0.6, 0.1, 0.2)]
    spot = spark.createDataFrame([("BTCUSDT", 1, 100.0)], "symbol string, timestamp long, price double")
    perp = spark.createDataFrame([("BTC", 1, 101.0)], "currency string, timestamp long, price double")
    mapping = spark.createDataFrame([("BTCUSDT", "BTC")], "symbol string, currency string")
    for i, rows in enumerate((first, second)):
        live.market_batch(spark.createDataFrame(rows, schema), i, str(tmp_path), ["ccy"], "seq", now, spot, perp, mapping)
    surface = {int(r.batch): r.term_structure for r in spark.read.parquet(f"{tmp_path}/vol_surface").collect()}
    assert len(surface[0]) == 1 and len(surface[1]) == 2
    assert spark.read.parquet(f"{tmp_path}/options_greeks").count() == 2
    assert spark.read.parquet(f"{tmp_path}/basis").filter("basis = 1.0").count() == 2


def test_counters_flush(spark, tmp_path):
    listener = live.CollectorMetrics()
    for k in range(3):
        listener.batches.append((k, 10, k, 0.5))
        assert listener.flush(spark, f"{tmp_path}/m").count() == k + 1 and listener.batches == []
