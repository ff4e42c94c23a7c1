"""Ranks in trailing windows against counting every pair."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quoteloom.operators import options, ranks

DAY = 86_400_000


@pytest.mark.parametrize("n", [0, 1, 2, 3, 8, 9, 500])
def test_earlier_and_lower(n):
    rng = np.random.default_rng(n)
    y, weight = rng.permutation(n), rng.integers(0, 3, n)
    want = [int(sum(weight[j] for j in range(i) if y[j] < y[i])) for i in range(n)]
    assert ranks.earlier_and_lower(y, weight).tolist() == want


def at_or_below(a, b):
    """As SQL orders doubles: NaN is the largest and equals itself; null is unknown."""
    return a is not None and b is not None and (b != b or (a == a and a <= b))


@pytest.mark.parametrize("bits", [5, 17])
def test_count_at_or_below(spark, bits):
    rng = random.Random(bits)
    value = lambda: rng.choice([None, 0.0, float("nan"), 1.5, 2.5, *[rng.random() for _ in range(6)]])
    when = lambda: rng.choice([None, *range(300)])
    past = [(rng.choice(["a", "a", "a", "b", None]), when(), value()) for _ in range(600)]
    now = [(rng.choice(["a", "a", "b", None, "c"]), when(), value()) for _ in range(150)]
    past += past[:20]
    now += now[:5]
    h, c = spark.createDataFrame(past, "s string, t long, p double"), spark.createDataFrame(now, "s string, t long, v double")
    for span in (50, None):
        since, until = (F.col("t") - span, F.col("t")) if span else (None, None)
        found = ranks.count_at_or_below(c, h, ["s"], "v", "p", since, until, "t", bits)
        want = []
        for s, t, v in now:
            inside = lambda w: span is None or (w is not None and t is not None and t - span < w <= t)
            window = [p for hs, w, p in past if hs == s and p is not None and inside(w)]
            want.append((s, t, v, sum(at_or_below(p, v) for p in window), len(window)))
        assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, want))


def test_empty_sides(spark):
    c = spark.createDataFrame([("a", 1, 0.5)], "s string, timestamp long, atm_iv double")
    h = spark.createDataFrame([("a", 1, 0.5)], "s string, timestamp long, iv double")
    keys = ["s", "timestamp"]
    assert options.iv_rank(c, h.limit(0), keys, lookback_days=1).first().iv_rank == 50
    assert options.iv_rank(c.limit(0), h, keys, lookback_days=1).count() == 0
    assert options.iv_rank(c, h, keys, lookback_days=1).first().iv_rank == 100
    assert options.iv_rank(c, h, keys).first().iv_rank == 100


def test_hundred_thousand_points_of_one_series(spark):
    n = 100_000
    points = spark.range(n).select(F.lit("BTC").alias("s"), (F.col("id") * 60_000).alias("timestamp"), F.rand(3).alias("atm_iv")).cache()
    history = points.withColumnRenamed("atm_iv", "iv")
    begun = time.time()
    got = options.iv_rank(points, history, ["s", "timestamp"], lookback_days=20).toPandas().sort_values("timestamp")
    assert time.time() - begun < 60  # pairs would be three billion
    v, width = got.atm_iv.to_numpy(), 20 * 1440
    for k in (0, 1, width - 1, width, width + 1, n // 2, n - 1):
        window = v[max(0, k - width + 1) : k + 1]
        assert got.iv_rank.iloc[k] == 100.0 * (window <= v[k]).sum() / len(window)


def test_no_pairs_in_the_plan(spark):
    c = spark.range(50).select(F.lit("a").alias("s"), F.col("id").alias("timestamp"), F.rand(1).alias("atm_iv"))
    plan = options.iv_rank(c, c.withColumnRenamed("atm_iv", "iv"), ["s", "timestamp"], lookback_days=1)
    text = plan._jdf.queryExecution().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
