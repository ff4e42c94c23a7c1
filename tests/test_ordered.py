"""Ordered operators against pandas, with blocks far smaller than the data."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quoteloom.operators import asof, basis, continuity, gaps, metrics, outliers
from quoteloom.operators.blocks import row_numbers, with_position


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def pdf(df, *order):
    return df.toPandas().sort_values(list(order)).reset_index(drop=True)


def test_align_backward_known_values(spark):
    target = frame(spark, [(t,) for t in (1000, 2000, 3000, 4000, 5000)], "timestamp long")
    source = frame(spark, [(1000, 100.0), (3000, 102.0), (5000, 104.0)], "timestamp long, price double")
    out = pdf(asof.asof_join(target, source), "timestamp")
    assert out["price"].tolist() == [100, 100, 102, 102, 104]
    assert out["price_age_ms"].tolist() == [0, 1000, 0, 1000, 0]


def test_align_tolerance_is_inclusive(spark):
    target = frame(spark, [(6000,), (6001,), (50000,)], "timestamp long")
    source = frame(spark, [(1000, 1.0)], "timestamp long, price double")
    out = pdf(asof.asof_join(target, source, tolerance_ms=5000), "timestamp")
    assert out["price"].isna().tolist() == [False, True, True]
    assert out["price_age_ms"].isna().tolist() == [False, True, True]


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("tolerance", [None, 7, 250])
@pytest.mark.parametrize("keyed", [False, True])
def test_align_equals_pandas(spark, direction, tolerance, keyed):
    rng = np.random.default_rng(7)
    n = 300
    # Few distinct times, so that a third of the rows share one of them.
    def times(size):
        t = rng.integers(0, 2000, size)
        t[: size // 3] = 777
        return t

    left = pd.DataFrame({"id": range(n), "timestamp": times(n), "k": rng.integers(0, 3, n)})
    right = pd.DataFrame({"seq": range(n), "timestamp": times(n), "k": rng.integers(0, 3, n), "v": rng.random(n)})
    by = {"by": "k"} if keyed else {}
    want = pd.merge_asof(
        left.sort_values(["timestamp", "id"], kind="stable"),
        right.sort_values(["timestamp", "seq"], kind="stable")[["timestamp", "v", *(["k"] if keyed else [])]].assign(st=lambda x: x["timestamp"]),
        on="timestamp", direction=direction, tolerance=tolerance, **by,
    ).sort_values("id")
    got = asof.asof_join(
        spark.createDataFrame(left), spark.createDataFrame(right.drop(columns=[] if keyed else ["k"])), keys=["k"] if keyed else [],
        direction=direction, tolerance_ms=tolerance, columns=["v"], seq="seq", block_ms=50,
    )
    got = pdf(got, "id")
    assert len(got) == n
    np.testing.assert_allclose(got["v"].to_numpy(float), want["v"].to_numpy(float))
    np.testing.assert_allclose(got["v_age_ms"].to_numpy(float), (want["timestamp"] - want["st"]).to_numpy(float))


def test_slice_prefixes_colliding_columns(spark):
    base = frame(spark, [(1000,), (2000,)], "timestamp long")
    one = frame(spark, [(1000, 1.0)], "timestamp long, price double")
    two = frame(spark, [(2000, 2.0)], "timestamp long, price double")
    out = pdf(asof.strategy_slice(base, [asof.Source("a", one), asof.Source("b", two)]), "timestamp")
    assert list(out.columns) == ["timestamp", "price", "price_age_ms", "b_price", "b_price_age_ms"]
    assert out["price"].tolist() == [1.0, 1.0] and out["b_price"].tolist()[1] == 2.0


def test_gap_with_instruments(spark):
    rows = frame(spark, [(1000, "BTC"), (2000, "BTC"), (3000, "BTC"), (70000, "ETH"), (71000, "BTC")], "timestamp long, instrument string")
    out = gaps.detect_gaps(rows, block_ms=5000).collect()
    assert [(g.gap_start, g.gap_end, g.gap_duration_ms, g.affected_instruments) for g in out] == [(3000, 70000, 67000, ["BTC", "ETH"])]
    assert gaps.detect_gaps(rows.drop("instrument")).first().affected_instruments == []
    assert gaps.detect_gaps(rows.limit(0)).count() == 0


def test_fills_equal_pandas(spark):
    rng = np.random.default_rng(3)
    n = 400
    data = pd.DataFrame({"seq": np.cumsum(rng.integers(1, 4, n)), "close": rng.random(n), "mark": rng.random(n)})
    data.loc[rng.random(n) < 0.4, "close"] = np.nan
    data.loc[rng.random(n) < 0.4, "mark"] = np.nan
    data.loc[:4, "mark"] = np.nan
    data.loc[n - 5:, "mark"] = np.nan
    df = spark.createDataFrame(data).replace(float("nan"), None)
    got = pdf(gaps.fill_gaps(df, "seq", width=16), "seq")
    np.testing.assert_allclose(got["close"].to_numpy(float), data["close"].ffill().to_numpy())
    np.testing.assert_allclose(got["mark"].to_numpy(float), data["mark"].interpolate(method="linear").to_numpy())


def test_spike_is_flagged(spark):
    rows = frame(spark, [(i, 999.0 if i == 50 else 50.0) for i in range(101)], "seq long, mark_price double")
    out = outliers.outliers_only(rows, ["mark_price"], "seq", threshold=3.0, window=20)
    assert [r.seq for r in out.collect()] == [50]
    flat = outliers.flag_outliers(rows.filter("seq <> 50"), ["mark_price"], "seq")
    assert flat.filter("is_outlier").count() == 0
    assert outliers.flag_outliers(rows, ["absent"], "seq").filter("is_outlier").count() == 0


def test_outliers_equal_pandas_across_blocks(spark):
    rng = np.random.default_rng(5)
    data = pd.DataFrame({"seq": np.cumsum(rng.integers(1, 3, 500)), "v": rng.standard_t(2, 500)})
    roll = data["v"].rolling(20, min_periods=1)
    want = ((data["v"] - roll.mean()) / roll.std().replace(0, np.nan)).abs() > 2.5
    got = pdf(outliers.flag_outliers(spark.createDataFrame(data), ["v"], "seq", threshold=2.5, window=20, width=32), "seq")
    assert got["is_outlier"].tolist() == want.tolist() and want.sum() > 5


def test_row_numbers_are_dense_per_key(spark):
    rows = frame(spark, [(k, s) for k in ("a", "b") for s in range(0, 300, 3)], "k string, s long")
    got = pdf(row_numbers(rows, ["k"], "s", width=7), "k", "s")
    assert got["_rn"].tolist() == list(range(100)) * 2


def test_position_follows_order_and_splits_ties(spark):
    rows = frame(spark, [(5, i) for i in range(200)] + [(1, 500), (9, 501)], "ts long, id long").repartition(4)
    got = with_position(rows, ["ts", "id"]).toPandas().sort_values("position")
    assert got["position"].is_unique
    assert list(zip(got["ts"], got["id"])) == sorted(zip(got["ts"], got["id"]))


def test_continuity(spark):
    rows = frame(spark, [(0, 1000), (1, 2000), (2, 2000), (3, 9000), (4, 8000)], "arrival long, timestamp long")
    s = continuity.continuity_stats(rows, block_ms=1500).first()
    assert (s.total_rows, s.unique_ts, s.dup_count, s.max_gap_ms, s.max_gap_at) == (5, 4, 1, 6000, 2000)
    a = continuity.arrival_order(rows, "arrival", width=2).first()
    assert (a.backward_steps, a.monotonic) == (1, False)
    named = rows.withColumn("feed", F.lit("x"))
    both = continuity.continuity_stats(named, keys=["feed"]).join(continuity.arrival_order(named, "arrival", keys=["feed"]), "feed")
    assert len(continuity.continuity_issues(both, F.lit(1000)).first().issues) == 3


def test_streaks_across_blocks(spark):
    ok = [1, 0, 0, 0, 1, 1, 0, 0, 0, 0, 0, 1, 0]
    rows = frame(spark, list(enumerate(ok)), "n long, ok int")
    out = pdf(metrics.failure_streaks(rows, F.col("ok") == 1, "n", 4, width=3), "first_failure")
    assert out[["first_failure", "last_failure", "failures", "alert"]].values.tolist() == [[1, 3, 3, False], [6, 10, 5, True], [12, 12, 1, False]]


def test_basis_known_values(spark):
    spot = frame(spark, [(100, 100.0), (200, 101.0), (300, 102.0)], "timestamp long, price double")
    perp = frame(spark, [(100, 100.5), (200, 101.5), (300, 102.5)], "timestamp long, price double")
    out = pdf(basis.spot_perp(spot, perp, "BTC_USDT", 30), "timestamp")
    assert out["basis"].tolist() == [0.5, 0.5, 0.5]
    assert out["basis_pct"][0] == pytest.approx(0.5) and out["annualized_basis"][0] == pytest.approx(0.5 * 365 / 30)
    assert basis.spot_perp(spot, perp, "X", 0).first().annualized_basis is None
    cross = pdf(basis.cross_exchange(perp, spot), "timestamp")
    assert cross["basis"].tolist() == [0.5, 0.5, 0.5] and cross["spot_price"].tolist() == [100, 101, 102]


def test_synthetic_basis(spark):
    legs = frame(spark, [(10.0, 5.0, 100.0, 105.0, 30), (10.0, 5.0, 100.0, 105.0, 0)], "c double, p double, k double, perp double, days int")
    out = basis.synthetic(legs, "c", "p", "k", "perp", 0.05, "days").collect()
    forward = 5 + 100 * np.exp(-0.05 * 30 / 365)
    assert out[0].basis == pytest.approx(105 - forward) and out[0].basis_pct == pytest.approx((105 - forward) / 105 * 100)
    assert out[1].annualized_basis == 0.0


def test_sparse_order_keeps_the_last_window_small(spark):
    """Hourly rows under epoch milliseconds and no keys: a block per row, two superblocks."""
    from quoteloom.operators import blocks

    hour, n = 3_600_000, 3000
    df = spark.range(n).select((F.lit(1_700_000_000_000) + F.col("id") * hour).alias("t"), F.when(F.col("id") % 700 == 3, F.col("id").cast("double")).alias("v"))
    summary = df.groupBy(blocks.block_of(F.col("t"), blocks.BLOCK_ROWS).alias("_block")).agg(F.count("*").alias("_n"))
    assert summary.count() == n
    assert summary.select(blocks.block_of(F.col("_block"), blocks.SUPER_BLOCKS)).distinct().count() <= 2
    got = [r.v for r in gaps.forward_fill(df, ["v"], "t").orderBy("t").collect()]
    assert got == [None if i < 3 else float((i - 3) // 700 * 700 + 3) for i in range(n)]
    numbers = [r._rn for r in blocks.row_numbers(df, [], "t").orderBy("t").collect()]
    assert numbers == list(range(n))


def test_carried_over_small_superblocks(spark):
    from quoteloom.operators import blocks

    rows = [(k, b, float(b) if b % 3 == 0 else None, 1) for k in ("a", None) for b in range(-7, 12, 2)]
    summary = spark.createDataFrame(rows, "k string, _block long, v double, n long")
    got = blocks.carried(summary, ["k"], {"l": ("last", "v"), "x": ("next", "v"), "s": ("sum", "n")}, supers=4)
    ids = list(range(-7, 12, 2))
    for r in got.collect():
        before = [float(b) for b in ids if b < r._block and b % 3 == 0]
        after = [float(b) for b in ids if b > r._block and b % 3 == 0]
        assert (r.l, r.x, r.s) == (before[-1] if before else None, after[0] if after else None, ids.index(r._block))
    assert got.count() == len(rows)


def test_null_keys_carry(spark):
    rows = [(None, i, float(i) if i == 0 else None) for i in range(40)]
    df = spark.createDataFrame(rows, "k string, i long, v double")
    assert {r.v for r in gaps.forward_fill(df, ["v"], "i", ["k"], width=8).collect()} == {0.0}


def test_nan_is_missing(spark):
    nan = float("nan")
    rows = [(i, nan if i == 150 else 1.0 + (i % 7) * 0.01) for i in range(300)]
    df = spark.createDataFrame(rows, "i long, v double")
    flagged = outliers.flag_outliers(df, ["v"], "i")
    assert flagged.filter("is_outlier").count() == 0 and flagged.count() == 300
    spiked = df.withColumn("v", F.when(F.col("i") == 200, 50.0).otherwise(F.col("v")))
    assert [r.i for r in outliers.outliers_only(spiked, ["v"], "i").collect()] == [200]
    filled = {r.i: r.v for r in gaps.forward_fill(df, ["v"], "i").collect()}
    assert filled[150] == filled[149]
    line = {r.i: r.v for r in gaps.interpolate_linear(df, ["v"], "i").collect()}
    assert line[150] == pytest.approx((line[149] + line[151]) / 2)
    from quoteloom.operators import quality

    share = quality.null_ratio(df.withColumnRenamed("v", "price"), columns=["price"]).first()
    assert (share.null_rows, share.total_rows) == (1, 300)


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("tolerance", [500, None, 10_000_000])
def test_null_keys_match_in_asof_joins(spark, direction, tolerance):
    target = spark.createDataFrame([(None, 1000), ("a", 1000), ("b", 1000), (None, None)], "k string, timestamp long")
    source = spark.createDataFrame([(None, 900, 1.0), (None, 1100, 2.0), ("a", 900, 3.0), ("a", 1100, 4.0)], "k string, timestamp long, v double")
    got = asof.asof_join(target, source, keys=["k"], direction=direction, tolerance_ms=tolerance).collect()
    late = direction == "forward"
    want = {(None, 1000): 2.0 if late else 1.0, ("a", 1000): 4.0 if late else 3.0, ("b", 1000): None, (None, None): None}
    assert {(r.k, r.timestamp): r.v for r in got} == want


def test_admission_check(spark):
    rng = np.random.default_rng(4)
    keys = [None if k == 7 else f"k{k}" for k in (rng.zipf(1.4, 400) % 40).tolist()]
    rows = [(int(i) * 3, k) for i, k in enumerate(keys)]
    got = metrics.admission_check(frame(spark, rows, "seq long, key string"), "key", "seq", 9, 50).collect()
    seen, order = [], {}
    for i, k in rows:
        order.setdefault(k, len(order))
        seen.append((i, k, len(order), order[k] < 9))
    assert sorted((tuple(r) for r in got), key=lambda r: r[0]) == seen
