"""Verification kept up to date against the report over the whole table."""

import glob
import random


from quoteloom.plans import verification
from quoteloom.sinks import store
from quoteloom.streaming import state

KEYS = ["exchange", "data_type", "symbol"]
SCHEMA = "seq long, timestamp long, exchange string, data_type string, symbol string, mark_price double, bid_price double"
DAY = store.DAY_MS


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*KEYS, "check", "status", "detail").collect()), key=str)


def upserted(spark, rows, path, version):
    batch = store.with_date(spark.createDataFrame(rows, SCHEMA))
    store.upsert(batch, f"{path}/t", keys=["seq"], order_by=["seq"])
    verification.refresh(batch, f"{path}/t", f"{path}/s", version, KEYS, "seq")


def test_summaries_equal_the_whole_table(spark, tmp_path):
    rng, rows = random.Random(2), []
    sources = [("binance", "mark_price", "A"), ("binance", "mark_price", None), ("deribit", "options_greeks", "B"), ("x", "unknown", "C"), ("fred", "risk_free_rate", "D")]
    for n, source in enumerate(sources):
        t = 20_000 * DAY + n * 1000
        for k in range(120):
            t += rng.choice([0, 1000, 30_000, 3 * DAY if rng.random() < 0.05 else 60_000, -5000 if n == 2 else 20_000])
            rows.append((n * 1000 + k, t, *source, rng.choice([None, 1.0]), None if n == 3 else 2.0))
    rows.append((9000, 5, "x", "unknown", "C", 1.0, 1.0))  # epoch zero
    for version in range(3):
        part = [r for r in rows if r[0] % 3 == version or rng.random() < 0.2]
        upserted(spark, part, str(tmp_path), version)
    upserted(spark, rows, str(tmp_path), 3)
    table = store.read_table(spark, f"{tmp_path}/t")
    want = rows_of(verification.report(table, KEYS, "seq"))
    assert rows_of(verification.report_from(state.read(spark, f"{tmp_path}/s"), KEYS)) == want
    assert {r[2] for r in want} >= {None, "A"} and {r[4] for r in want} >= {"OK", "WARNING", "ERROR", "LOW"}


def test_order_between_dates(spark, tmp_path):
    """Each date is in order by itself; the later date arrived first."""
    rows = [(k, 20_001 * DAY + k * 1000, "binance", "mark_price", "A", 1.0, 1.0) for k in range(5)]
    rows += [(k, 20_000 * DAY + k * 1000, "binance", "mark_price", "A", 1.0, 1.0) for k in range(10, 15)]
    upserted(spark, rows, str(tmp_path), 0)
    found = verification.merged(state.read(spark, f"{tmp_path}/s"), KEYS).first()
    assert not found.monotonic and found.max_gap_ms == DAY - 14_000 and found.max_gap_at == 20_000 * DAY + 14_000


def test_old_dates_stay_unread(spark, tmp_path):
    rows = [(k, (20_000 + k // 3) * DAY + k, "binance", "mark_price", "A", 1.0, 1.0) for k in range(12)]
    upserted(spark, rows, str(tmp_path), 0)
    for name in glob.glob(f"{tmp_path}/t/**/date=2024-10-0[45]/*.parquet", recursive=True):
        with open(name, "wb") as file:
            file.write(b"gone")
    batch = store.with_date(spark.createDataFrame([(50, 20_003 * DAY + 50, "binance", "mark_price", "A", 1.0, 1.0)], SCHEMA))
    verification.refresh(batch, f"{tmp_path}/t", f"{tmp_path}/s", 1, KEYS, "seq")
    assert verification.merged(state.read(spark, f"{tmp_path}/s"), KEYS).first().total_rows == 12
