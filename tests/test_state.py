"""State tables by deltas, and operators with state per key."""

import os
import random

import pytest
from pyspark.sql import functions as F

from quoteloom.operators import metrics
from quoteloom.streaming import keyed, live, state

HOUR = 3_600_000


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def run(query):
    query.awaitTermination()
    assert query.exception() is None


def written(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, files in os.walk(path) for f in files if f.endswith(".parquet"))


def test_state_is_the_newest_row_of_every_key(spark, tmp_path):
    rng, want, path = random.Random(1), {}, str(tmp_path / "s")
    for b in range(12):
        rows = [(rng.choice([None, *range(40)]), b * 100 + k, k) for k in range(rng.choice([0, 1, 3, 40]))]
        for key, value, _ in rows:
            want[key] = value
        batch = spark.createDataFrame(rows, "k long, v long, o int")
        for _ in range(2):  # a repeated batch changes nothing
            state.put(batch, b, path, ["k"], ["o"])
        if want:
            assert {r.k: r.v for r in state.read(spark, path).collect()} == want
        sizes = [r["rows"] for r in state.manifest(spark, path).runs]
        assert all(a > state.RATIO * b for a, b in zip(sizes, sizes[1:]))
    assert state.manifest(spark, path).last_batch == 11
    named = {r["name"] for v in state._versions(spark, path) for r in state._load(spark, path, v).runs}
    assert set(os.listdir(f"{path}/runs")) == named and len(state._versions(spark, path)) == 2


def test_a_small_batch_writes_little(spark, tmp_path):
    path = str(tmp_path / "s")
    state.put(spark.range(100_000).withColumn("v", F.rand(1)), 0, path, ["id"])
    large = written(f"{path}/runs")
    state.put(spark.range(10).withColumn("v", F.lit(2.0)), 1, path, ["id"])
    assert written(f"{path}/runs") - large < large / 100
    got = state.read(spark, path)
    assert got.count() == 100_000 and got.where("v = 2.0").count() == 10


def test_new_columns_and_failed_batches(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    state.put(spark.range(5), 0, path, ["id"])
    state.put(spark.range(3, 4).withColumn("v", F.lit("x")), 1, path, ["id"])
    monkeypatch.setattr(state, "_commit", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        state.put(spark.range(9).withColumn("v", F.lit("y")), 2, path, ["id"])
    monkeypatch.undo()
    assert {r.id: r.v for r in state.read(spark, path).collect()} == {0: None, 1: None, 2: None, 3: "x", 4: None}
    state.put(spark.range(1).withColumn("v", F.lit("z")), 2, path, ["id"])
    assert {r.id: r.v for r in state.read(spark, path).collect()}[0] == "z"
    with pytest.raises(FileNotFoundError):
        state.read(spark, str(tmp_path / "none"))


QUOTES = "instrument_name string, timestamp long, price double, arrival long"
STEP = 60_000


def stream_of(spark, folder, batches, schema):
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_filled_snapshots(spark, tmp_path):
    rng, t0 = random.Random(3), 1_700_000_000_000
    rows = [(rng.choice("ABC"), t0 + k * 7_000 + rng.randint(0, 5_000), rng.choice([None, float(k)]), k) for k in range(400)]
    rows = [r for r in rows if r[0] != "C" or r[1] < t0 + 600_000]  # C falls silent
    rows += [(r[0], r[1], -1.0, r[3] + 1000) for r in rows[::7]]  # equal times
    rows.sort(key=lambda r: r[1])
    batches = [rows[k : k + 60] for k in range(0, len(rows), 60)]
    stream = stream_of(spark, f"{tmp_path}/in", batches, QUOTES)
    shots = keyed.filled_snapshot_stream(stream, ["price"], step_ms=STEP, watermark="20 seconds")
    run(live.write_changes(shots, f"{tmp_path}/out", f"{tmp_path}/c", "append", availableNow=True))
    got = {(r.instrument_name, r.timestamp): (r.price, r.age_ms) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    passed = max(r[1] for r in rows) - 20_000
    want = {}
    for name in "ABC":
        own = sorted(((t, o, p) for n, t, p, o in rows if n == name))
        for at in range(-(-own[0][0] // STEP) * STEP, passed, STEP):
            t, _, p = max(q for q in own if q[0] <= at)
            want[name, at] = (p, at - t)
    assert got == want and max(age for _, age in got.values()) > 10 * STEP
    batch = metrics.filled_snapshots(spark.createDataFrame(rows, QUOTES), ["instrument_name"], ["price"], STEP, seq="arrival")
    twin = {(r.instrument_name, r.timestamp): (r.price, r.price_age_ms) for r in batch.collect()}
    # The batch form takes a missing price as no quote's age; both agree wherever it has one.
    assert all(got[k] == v for k, v in twin.items() if k in got and v[0] is not None)


def test_silent_keys_end(spark, tmp_path):
    t0 = 1_700_000_040_000
    batches = [[("A", t0, 1.0, 0), ("B", t0, 2.0, 1)], [("B", t0 + 30 * STEP, 3.0, 2)], [("A", t0 + 60 * STEP, 4.0, 3)], [("B", t0 + 90 * STEP, 5.0, 4)]]
    stream = stream_of(spark, f"{tmp_path}/in", batches, QUOTES)
    shots = keyed.filled_snapshot_stream(stream, ["price"], step_ms=STEP, watermark="0 seconds", keep_for_ms=5 * STEP)
    run(live.write_changes(shots, f"{tmp_path}/out", f"{tmp_path}/c", "append", availableNow=True))
    got = rows_of(spark.read.parquet(f"{tmp_path}/out").where("instrument_name = 'A'"), "timestamp", "price")
    assert got == [(t0 + k * STEP, 1.0) for k in range(6)] + [(t0 + k * STEP, 4.0) for k in range(60, 66)]


def test_flush_by_rows_and_age(spark, tmp_path):
    schema = "k string, n long, v double"
    batches = [[("a", i, 0.5) for i in range(25)] + [("b", 100, None), (None, 200, 1.0)], [("a", i, 0.5) for i in range(25, 31)], [("b", 101, 1.5)]]
    stream = stream_of(spark, f"{tmp_path}/in", batches, schema)
    flushed = keyed.flush_stream(stream, ["k"], max_rows=10, max_age_ms=1, order_by="n")
    with keyed.rocksdb(spark):
        query = live.write_changes(flushed, f"{tmp_path}/out", f"{tmp_path}/c", "append", processingTime="0 seconds")
    try:
        for _ in range(120):
            if os.path.isdir(f"{tmp_path}/out"):
                got = rows_of(spark.read.schema(flushed.schema).parquet(f"{tmp_path}/out"), "k", "n", "v", "flush", "reason")
                if len(got) == 34:
                    break
            query.awaitTermination(1)
    finally:
        query.stop()
    assert sorted(r[1] for r in got) == [*range(31), 100, 101, 200]
    full = [r for r in got if r[4] == "rows"]
    assert [sum(r[3] == f for r in full) for f in sorted({r[3] for r in full})] == [10] * (len(full) // 10)
    assert len([r for r in full if r[3] in (0, 1)]) == 20
    assert {r[0] for r in got if r[4] == "age"} >= {"b", None}
    by_flush = {}
    for r in got:
        by_flush.setdefault((r[0], r[3]), []).append(r[1])
    assert all(len(v) <= 10 for v in by_flush.values())


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_failures_with_open_runs(spark, tmp_path, keys):
    rng = random.Random(8)
    rows = [(n, rng.choice(["x", "x", "y", None]), rng.random() < 0.35) for n in range(300)]
    rows += [(300 + k, "x", False) for k in range(5)]
    schema = "n long, k string, ok boolean"
    for i, first in enumerate(range(0, 305, 34)):
        batch = spark.createDataFrame(rows[first : first + 34], schema)
        for _ in range(2):
            keyed.failure_batch(batch, i, f"{tmp_path}/t", F.col("ok"), "n", 3, keys)
        so_far = metrics.failure_streaks(spark.createDataFrame(rows[: first + 34], schema), F.col("ok"), "n", 3, keys)
        columns = [*keys, "first_failure", "last_failure", "failures", "alert"]
        if i in (0, 4, 8):
            assert rows_of(state.read(spark, f"{tmp_path}/t"), *columns) == rows_of(so_far, *columns)
    last = state.read(spark, f"{tmp_path}/t").where("open").collect()
    assert any(r.last_failure == 304 and r.alert for r in last)
