import os
import shutil

import pytest
from pyspark.sql import functions as F

from quoteloom.operators import quality, tables
from quoteloom.schemas import MARK_PRICE, OHLCV, conform
from quoteloom.session import shared_dir
from quoteloom.sinks import store
from quoteloom.sources import candles, margin, naming, option_feed, prices

T0 = 1_700_000_000_000


def ticks(spark, first, last, price=1.0, day=0):
    rows = [(T0 + day * store.DAY_MS + i * 1000, "binance", "spot", "BTCUSDT", price, i) for i in range(first, last)]
    return store.with_date(spark.createDataFrame(rows, "timestamp long, exchange string, data_type string, symbol string, price double, seq long"))


def test_upsert_overlap_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    store.upsert(ticks(spark, 0, 5), path)
    store.upsert(ticks(spark, 0, 7, 2.0), path)
    store.upsert(ticks(spark, 0, 7, 2.0), path)
    out = spark.read.parquet(path)
    assert out.count() == 7 and {r.price for r in out.collect()} == {2.0}
    assert not [f for f in os.listdir(shared_dir(spark).removeprefix("file:")) if f.startswith("staged-")]


def test_upsert_keep_first_and_first_write_dedupes(spark, tmp_path):
    path = str(tmp_path / "t")
    store.upsert(ticks(spark, 0, 5).union(ticks(spark, 0, 5)), path, keep="first")
    store.upsert(ticks(spark, 3, 8, 9.0), path, keep="first")
    out = spark.read.parquet(path)
    assert out.count() == 8 and out.filter("price = 9").count() == 3


def test_upsert_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    store.upsert(ticks(spark, 0, 3).union(ticks(spark, 0, 3, day=1)), path)
    kept = {r["path"] for r in store.files_of(spark, path).collect() if "2023-11-14" in r["path"]}
    store.upsert(ticks(spark, 2, 6, day=1), path)
    after = {r["path"] for r in store.files_of(spark, path).collect()}
    assert kept and kept <= after
    assert spark.read.parquet(path).count() == 9


def test_hot_partition_is_split(spark, tmp_path):
    """The rebalance before the write spreads one large partition over several files."""
    path = str(tmp_path / "t")
    rows = spark.range(400_000).select(
        (F.lit(T0) + F.col("id")).alias("timestamp"), F.lit("x").alias("exchange"), F.lit("d").alias("data_type"),
        F.lit("s").alias("symbol"), F.rand(1).alias("price"), F.lit("2023-11-14").alias("date"), F.col("id").alias("seq"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        store.overwrite_partitions(rows.repartition(8), path, store.PARTITIONS, ["timestamp"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert store.files_of(spark, path).count() > 2
    assert spark.read.parquet(path).count() == 400_000


def test_upsert_empty_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    store.upsert(ticks(spark, 0, 5).limit(0), path)
    assert not store.table_exists(spark, path)
    store.upsert(ticks(spark, 0, 5), path)
    store.upsert(ticks(spark, 0, 5).limit(0), path)
    assert store.read_table(spark, path).count() == 5


def test_upsert_reads_only_touched_dates(spark, tmp_path):
    """A broken file in a date that the batch doesn't touch is never opened."""
    path = str(tmp_path / "t")
    store.upsert(ticks(spark, 0, 3).union(ticks(spark, 0, 3, day=3)), path)
    far = tmp_path / "t" / "exchange=binance" / "data_type=spot" / "symbol=BTCUSDT" / "date=2023-11-14"
    (far / "broken.parquet").write_bytes(b"not parquet")
    store.upsert(ticks(spark, 2, 6, day=3), path)
    assert store.read_table(spark, path).filter("date > '2023-11-15'").count() == 6


def test_failed_upsert_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    store.upsert(ticks(spark, 0, 5), path)
    real = store.overwrite_partitions

    def fail(*args):
        raise OSError("lost")

    monkeypatch.setattr(store, "overwrite_partitions", fail)
    with pytest.raises(OSError):
        store.upsert(ticks(spark, 3, 8, 2.0), path)
    monkeypatch.setattr(store, "overwrite_partitions", real)
    assert store.read_table(spark, path).count() == 5
    store.upsert(ticks(spark, 7, 9, 3.0), path)
    got = {r.seq: r.price for r in store.read_table(spark, path).collect()}
    assert got == {0: 1.0, 1: 1.0, 2: 1.0, 3: 2.0, 4: 2.0, 5: 2.0, 6: 2.0, 7: 3.0, 8: 3.0}
    assert not os.listdir(tmp_path / "_staged-t")


def test_upsert_undated_rows_and_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = ticks(spark, 0, 2).withColumn("date", F.lit(None).cast("string"))
    store.upsert(rows, path)
    store.upsert(ticks(spark, 1, 4).withColumn("date", F.lit(None).cast("string")).withColumn("note", F.lit("n")), path)
    got = store.read_table(spark, path).orderBy("seq").collect()
    assert [(r.seq, r.note) for r in got] == [(0, None), (1, "n"), (2, "n"), (3, "n")]


def test_no_silent_limits(spark):
    rows = spark.range(3000).select(F.lit("I").alias("instrument_name"), F.col("id").alias("timestamp"))
    assert store.query_rows(rows).count() == 3000 and store.query_rows(rows, limit=7).count() == 7
    listing = spark.range(200).select(
        F.concat(F.lit("I"), "id").alias("instrument_name"), F.lit(False).alias("is_active"), F.col("id").alias("expiration_timestamp")
    )
    assert option_feed.select_instruments(listing, -1, 1000, include_expired=True).count() == 200


def test_shared_dir_needs_a_name_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        shared_dir(Session())


def test_reads_prune_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    store.upsert(ticks(spark, 0, 3).union(ticks(spark, 0, 3, day=1)).union(ticks(spark, 0, 3, day=2)), path)
    table = spark.read.parquet(path)
    one = store.load_range(table, "2023-11-15", "2023-11-15", "BTCUSDT", "symbol")
    assert one.count() == 3
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert {str(r.date) for r in store.load_latest_day(table.withColumn("date", F.col("date").cast("string")), ["symbol"], "2023-11-30").collect()} == {"2023-11-16"}
    assert store.load_latest_day(table.withColumn("date", F.col("date").cast("string")), ["symbol"], "2024-03-30").count() == 0
    assert store.load_latest_day(table.withColumn("date", F.col("date").cast("string")), ["symbol"], "2024-03-30", None).count() == 3


def test_prune(spark, tmp_path):
    path = str(tmp_path / "t")
    store.upsert(ticks(spark, 0, 3).union(ticks(spark, 0, 3, day=20)), path)
    dry = {str(r.date): r.action for r in store.prune(spark, path, "2023-12-10").collect()}
    assert dry == {"2023-11-14": "WOULD_DELETE", "2023-12-04": "KEEP"}
    assert spark.read.parquet(path).count() == 6
    done = {str(r.date): r.action for r in store.prune(spark, path, "2023-12-10", execute=True).collect()}
    assert done["2023-11-14"] == "DELETE"
    assert spark.read.parquet(path).count() == 3


def test_unreadable_and_epoch_zero_files(spark, tmp_path):
    path = str(tmp_path / "t")
    store.upsert(ticks(spark, 0, 3), path)
    zero = tmp_path / "t" / "exchange=binance" / "data_type=spot" / "symbol=BTCUSDT" / "date=1970-01-01"
    zero.mkdir()
    (zero / "bad.parquet").write_bytes(b"not parquet")
    checks = store.file_checks(spark, path)
    assert {(str(r.date), r.errors, r.rows) for r in checks.collect()} == {("1970-01-01", 2, 0), ("2023-11-14", 0, 3)}
    status = quality.source_status(checks, ["exchange", "data_type", "symbol"]).first()
    assert (status.status, status.total_rows, status.errors) == ("ERROR", 3, 2)


def test_footers_by_ranged_reads(spark, tmp_path):
    """A broken file beyond 2 GB, which no row could hold, an empty table's file, odd folder names."""
    whole, none = tmp_path / "exchange=a b" / "whole", tmp_path / "date=50%" / "none"
    spark.range(7).coalesce(1).write.parquet(str(whole))
    spark.range(7).filter("id < 0").coalesce(1).write.parquet(str(none))
    with open(tmp_path / "huge.parquet", "wb") as f:
        f.truncate(3 << 30)  # sparse, takes no disk
    found = store.footers(spark, str(tmp_path))
    got = sorted((r.path.rpartition("/")[2] == "huge.parquet", r.rows, r.error) for r in found.collect())
    assert [x[:2] for x in got] == [(False, 0), (False, 7), (True, 0)]
    assert [x[2] is None for x in got] == [True, True, False]
    assert "content:" not in found._jdf.queryExecution().sparkPlan().toString()  # as read from the files


def test_incremental_plan_skips_current(spark):
    universe = spark.createDataFrame([("new",), ("old",), ("done",)], "symbol string")
    now = T0 + 10 * store.DAY_MS
    stats = spark.createDataFrame([("old", T0), ("done", now - 1000)], "symbol string, end_time long")
    got = {r.symbol: (r.start_ms, r.end_ms) for r in store.incremental_plan(universe, stats, ["symbol"], now).collect()}
    assert got == {"new": (now - store.DAY_MS, now), "old": (T0 + store.DAY_MS, now)}


def test_unique_keys(spark):
    trades = spark.createDataFrame([("I", "1", 1, 1.0), ("I", "1", 2, 2.0), ("J", "1", 1, 3.0)], "instrument_name string, trade_id string, seq long, price double")
    for keep, want in (("last", {2.0, 3.0}), ("first", {1.0, 3.0})):
        assert {r.price for r in tables.dedupe(trades, tables.UNIQUE_KEYS["trades"], ["seq"], keep).collect()} == want


def test_conform(spark):
    df = spark.createDataFrame([(1, "x", "y", 2)], "timestamp int, exchange string, symbol string, mark_price int")
    out = conform(df, MARK_PRICE)
    assert [f.name for f in out.schema] == [f.name for f in MARK_PRICE] and out.first().basis is None
    with pytest.raises(ValueError, match="close"):
        conform(df, OHLCV)


# -- payload edge cases the oracle tables do not contain -------------------------------


def texts(spark, *payloads, **more):
    cols = {"symbol": "S", "ingest_ms": 5, "seq": 0, **more}
    return spark.createDataFrame([(p, *cols.values()) for p in payloads], "payload string, symbol string, ingest_ms long, seq long")


def test_bad_payloads_are_dropped(spark):
    bad = texts(spark, "{", "", "null", "[]", '{"error": 1}')
    assert candles.klines(bad).count() == 0
    assert candles.chart_arrays(bad).count() == 0
    assert candles.candle_objects(bad).count() == 0
    assert prices.funding_deribit(bad).count() == 0
    assert prices.mark_deribit(bad).count() == 0
    assert prices.spot_mid(bad).count() == 0
    assert option_feed.trades(bad).count() == 0


def test_chart_pads_but_mark_stops(spark):
    body = texts(spark, '{"result": {"ticks": [1, 2], "open": [1.5], "high": [], "low": [1], "close": [7]}}')
    rows = candles.chart_arrays(body).orderBy("timestamp").collect()
    assert [(r.open, r.high, r.close, r.volume) for r in rows] == [(1.5, 0.0, 7.0, 0.0), (0.0, 0.0, 0.0, 0.0)]
    assert [r.mark_price for r in prices.mark_deribit(body).collect()] == [7.0]


def test_book_level_forms(spark):
    body = texts(spark, '{"instrument_name":"I","timestamp":1,"bids":[[1.5,2,3],{"price":1.25,"amount":4},[1.0, 9]],"asks":[]}')
    row = option_feed.books(body, pushed=True).first()
    assert [(b.price, b.amount, b.order_count) for b in row.bids] == [(1.5, 2.0, 3), (1.25, 4.0, 0), (1.0, 9.0, 0)]
    assert row.asks == [] and row.current_best_bid is None


def test_message_routing_order(spark):
    for channel, kind in (("ticker.book.x", "tickers"), ("book.trades", "books"), ("trades.X", "trades"), ("markprice.options", "mark_prices"), ("greeks.X", "greeks"), ("other", None)):
        raw = spark.createDataFrame([('{"method":"subscription","params":{"channel":"%s","data":{}}}' % channel,)], "value string")
        assert option_feed.messages(raw).first().record_type == kind


def test_margin_unknown_currency_uses_default_tier(spark):
    rows = spark.createDataFrame([("SOL", 30_000.0), ("ETH", 30_000.0), ("BTC", 9e9)], "currency string, notional double")
    got = {r.currency: r.tier_upper_bound for r in margin.tier_for_notional(rows, "currency", "notional").collect()}
    assert got == {"SOL": 50_000.0, "ETH": 125_000.0, "BTC": None}


def test_names(spark):
    df = spark.createDataFrame([("deribit", "ETH-PERPETUAL", "6h"), ("binance", "X", "6h"), ("hyperliquid", "kPEPE", "6h")], "e string, s string, t string")
    got = df.select(naming.unified_symbol(F.col("e"), F.col("s")).alias("u"), naming.venue_timeframe(F.col("e"), F.col("t")).alias("r")).collect()
    assert [(r.u, r.r) for r in got] == [("ETH", "1D"), ("X", "6h"), ("PEPE", "1d")]


def test_candle_update_and_next_ranges(spark, tmp_path):
    from quoteloom.plans import candles as plan

    path = str(tmp_path / "c")
    day = store.DAY_MS
    rows = [
        ("klines", "binance_spot", "BTCUSDT", "1d", f'[[{T0},"1","2","0.5","1.5","10",0,"15"],[{T0 + day},"1","2","0.5","1.5","10"]]'),
        ("chart", "deribit", "BTC-PERPETUAL", "1d", '{"result":{"ticks":[%d],"open":[1],"high":[2],"low":[1],"close":[2],"volume":[3]}}' % T0),
        ("objects", "hyperliquid", "kPEPE", "1d", '[{"t":%d,"o":"1","h":"1","l":"1","c":"1","v":"4","n":0}]' % T0),
    ]
    landed = spark.createDataFrame(rows, "form string, exchange string, symbol string, timeframe string, payload string")
    plan.update(landed, path)
    changed = landed.withColumn("payload", F.replace("payload", F.lit('"1.5"'), F.lit('"9.5"'))).filter("form = 'klines'")
    plan.update(changed, path)
    stored = store.read_table(spark, path, [*plan.SERIES, "date"])
    assert {r.timeframe for r in stored.collect()} == {"1d"}
    assert stored.count() == 4 and stored.filter("close = 9.5").count() == 0
    assert {(r.exchange, r.symbol) for r in stored.collect()} == {("binance_spot", "BTC"), ("deribit", "BTC"), ("hyperliquid", "PEPE")}
    universe = stored.select(*plan.SERIES).union(spark.createDataFrame([("deribit", "ETH", "1d")], "e string, s string, t string"))
    now = T0 + 2 * day
    got = {(r.exchange, r.symbol): r.start_ms for r in plan.next_ranges(universe, stored, now).collect()}
    assert got == {("deribit", "BTC"): T0 + day, ("hyperliquid", "PEPE"): T0 + day, ("deribit", "ETH"): now - day}


def test_failure_without_success_files(spark, tmp_path, monkeypatch):
    """The old partitions are gone and the stage is the only copy: it must come back, also
    where the cluster writes no success files."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        path = str(tmp_path / "t")
        store.upsert(ticks(spark, 0, 16), path)
        real = store.overwrite_partitions

        def lose(df, path, parts, order):
            df.count()
            for name in os.listdir(path):
                if "=" in name:
                    shutil.rmtree(os.path.join(path, name))
            raise OSError("lost")

        monkeypatch.setattr(store, "overwrite_partitions", lose)
        with pytest.raises(OSError):
            store.upsert(ticks(spark, 3, 8, 2.0), path)
        monkeypatch.setattr(store, "overwrite_partitions", real)
        store.upsert(ticks(spark, 15, 17, 3.0), path)
        assert sorted(r.seq for r in store.read_table(spark, path).collect()) == list(range(17))
        # A stage that was never finished is dropped.
        half = f"{store._stage_root(spark, path)}/half"
        ticks(spark, 50, 60).write.parquet(half)
        store.upsert(ticks(spark, 16, 17, 4.0), path)
        assert store.read_table(spark, path).count() == 17 and not os.path.exists(half.removeprefix("file:"))
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_stage_beside_a_relative_path(spark, tmp_path):
    work = os.getcwd()
    for path in ("table", "a/table", "table/", f"{tmp_path}/t"):
        root = store._stage_root(spark, path)
        want = os.path.join(os.path.dirname(os.path.join(work, path.rstrip("/"))), f"_staged-{os.path.basename(path.rstrip('/'))}")
        assert root.removeprefix("file:") == want


def test_latest_day_of_a_null_key(spark):
    rows = spark.createDataFrame([(None, "2026-01-01", 1), (None, "2026-01-02", 2), ("a", "2026-01-01", 3)], "k string, date string, n int")
    assert sorted(r.n for r in store.load_latest_day(rows, ["k"], "2026-01-05").collect()) == [2, 3]
