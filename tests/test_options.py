import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quoteloom.functions.calendar import easter, is_trading_day
from quoteloom.functions.normal import norm_cdf
from quoteloom.functions.spline import any_knots, curvature_weights, fixed_knots
from quoteloom.operators import options, rates

NOW = 1_772_323_200_000  # 2026-03-01


def test_cdf_against_erfc(spark):
    xs = [i / 50 for i in range(-1900, 1901)]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", norm_cdf("x").alias("n")).collect()
    assert max(abs(r.n - 0.5 * math.erfc(-r.x / math.sqrt(2))) for r in got) < 1e-14


def test_names(spark):
    names = ["BTC-9MAY26-100000-C", "BTC-PERPETUAL", "invalid", "BTC-100000-C", "ETH-28MAR26-3000-P", "BTC-31FEB26-1-C", "BTC-9MAY26-0.5-C", "btc-9MAY26-1-C"]
    rows = options.parse_instruments(spark.createDataFrame([(n,) for n in names], "instrument_name string")).collect()
    assert [r.strike for r in rows] == [100000.0, None, None, None, 3000.0, 1.0, None, None]
    assert rows[0].currency == "BTC" and rows[0].expiry == "9MAY26" and rows[0].option_type == "C"
    assert rows[0].expiry_timestamp == 1_778_284_800_000
    assert rows[5].expiry_timestamp is None


def chain(spark, **change):
    base = dict(instrument_name="BTC-26JUN26-100000-C", bid_price=5000.0, ask_price=5200.0, mid_price=5100.0, underlying_price=103000.0, mark_iv=0.65, bid_iv=0.63, ask_iv=0.67, open_interest=100.0)
    base.update(change)
    cols = ", ".join(f"{k} {'string' if k == 'instrument_name' else 'double'}" for k in base)
    return spark.createDataFrame([tuple(base.values())], cols)


@pytest.mark.parametrize("side", ["C", "P"])
def test_greeks_against_closed_form(spark, side):
    row = options.greeks_batch(chain(spark, instrument_name=f"BTC-26JUN26-100000-{side}"), NOW, 0.03, as_float=False).first()
    s, k, v, r = 103000.0, 100000.0, 0.65, 0.03
    t = (1_782_432_000_000 - NOW) / (86_400_000 * 365.25)
    n = lambda x: 0.5 * math.erfc(-x / math.sqrt(2))
    d1 = (math.log(s / k) + (r + v * v / 2) * t) / (v * math.sqrt(t))
    d2 = d1 - v * math.sqrt(t)
    pdf = math.exp(-d1 * d1 / 2) / math.sqrt(2 * math.pi)
    call = side == "C"
    assert row.time_to_expiry_years == pytest.approx(t)
    assert row.delta == pytest.approx(n(d1) if call else n(d1) - 1)
    assert row.gamma == pytest.approx(pdf / (s * v * math.sqrt(t)))
    assert row.vega == pytest.approx(s * pdf * math.sqrt(t) / 100)
    flow = r * k * math.exp(-r * t) * (n(d2) if call else -n(-d2))
    assert row.theta == pytest.approx((-s * pdf * v / (2 * math.sqrt(t)) - flow) / 365.25)
    assert row.rho == pytest.approx(k * t * math.exp(-r * t) * (n(d2) if call else -n(-d2)) / 100)


def test_chain_filters_and_fallbacks(spark):
    def out(**change):
        return options.greeks_batch(chain(spark, **change), NOW).collect()

    assert out(bid_price=0.0, ask_price=0.0) == []
    assert len(out(bid_price=0.0)) == 1
    assert out(instrument_name="BTC-1JAN26-100000-C") == []
    assert out(underlying_price=50000.0) == []
    assert out(instrument_name="BTC-PERPETUAL") == []
    assert out(underlying_price=None) == []
    mid = out(mark_iv=None)[0]
    assert mid.iv == pytest.approx(0.65) and mid.iv_source == "rest_api"
    none = out(mark_iv=0.0, bid_iv=0.0, ask_iv=float("nan"))[0]
    assert none.iv == pytest.approx(0.5) and none.iv_source == "fallback"
    percent = options.greeks_batch(chain(spark, mark_iv=65.0), NOW, iv_scale=100.0).first()
    assert percent.iv == pytest.approx(0.65)
    assert dict(options.greeks_batch(chain(spark), NOW).dtypes)["delta"] == "float"


OPTS = [(0, "X", "A", 95.0, 100.0, 0.30, 0.25, 1), (1, "X", "A", 100.0, 100.0, 0.25, 0.5, 1), (2, "X", "B", 105.0, 100.0, 0.28, -0.25, 2)]
OPT_SCHEMA = "seq long, sym string, expiry string, strike double, underlying_price double, iv double, delta double, timestamp long"


def test_surface(spark):
    df = spark.createDataFrame(OPTS, OPT_SCHEMA)
    p = options.vol_surface(df, ["sym"], "seq").first()
    assert p.atm_iv == pytest.approx(0.25) and p.skew_25d == pytest.approx(0.02) and p.butterfly_25d == pytest.approx(0.04)
    assert p.term_structure == {"A": 0.25, "B": 0.28} and p.iv_rank == 50.0 and p.quality == "good" and p.timestamp == 2
    far = options.vol_surface(df.withColumn("underlying_price", F.lit(112.0)), ["sym"], "seq").first()
    assert far.atm_iv == pytest.approx(0.28)  # 105 lies in the 15 % band
    nothing = options.vol_surface(df.withColumn("iv", F.lit(0.0)), ["sym"], "seq").first()
    assert nothing.quality == "estimated"
    day = 86_400_000
    past = spark.createDataFrame([("X", 0.1, 2 - day), ("X", 0.5, 1), ("X", 0.2, 1), ("X", 0.01, 2 - 3 * day), ("X", 0.01, 3)], "sym string, iv double, timestamp long")
    points = options.vol_surface(df, ["sym", "timestamp"], "seq", history=past, lookback_days=2).collect()
    # 0.25 at time 1 and 0.28 at time 2, among 0.1, 0.5 and 0.2 each time
    assert {(r.timestamp, round(r.iv_rank, 6)) for r in points} == {(1, 66.666667), (2, 66.666667)}


def test_surface_without_deltas(spark):
    df = spark.createDataFrame(OPTS, OPT_SCHEMA)
    for bare in (df.drop("delta"), df.withColumn("delta", F.lit(None).cast("double"))):
        p = options.vol_surface(bare, ["sym"], "seq").first()
        assert (p.skew_25d, p.butterfly_25d, p.quality) == (0.0, 0.0, "good")
        flat = options.vol_surface(bare.withColumn("iv", F.lit(0.0)), ["sym"], "seq").first()
        assert (flat.atm_iv, flat.quality) == (0.0, "estimated")
        assert options.skew_25d(bare, ["sym"], "seq").first().skew_25d == 0.0
        assert options.butterfly_25d(bare, ["sym"], "seq").first().butterfly_25d == 0.0


def test_near_atm_widens(spark):
    df = spark.createDataFrame(OPTS, OPT_SCHEMA)
    assert options.near_atm(df, ["sym"]).count() == 3  # all within 5 %
    assert [r.strike for r in options.near_atm(df.withColumn("iv", F.expr("if(strike = 105, iv, 0)")), ["sym"]).collect()] == [105.0]
    assert options.near_atm(df.withColumn("iv", F.lit(0.0)), ["sym"]).count() == 3


def test_iv_rank(spark):
    hist = spark.createDataFrame([("a", v) for v in (0.10, 0.15, 0.20, 0.25, 0.30)], "k string, iv double")
    cur = spark.createDataFrame([("a", 0.20), ("b", 0.2)], "k string, atm_iv double")
    got = {r.k: r.iv_rank for r in options.iv_rank(cur, hist, ["k"]).collect()}
    assert got == {"a": pytest.approx(60.0), "b": 50.0}
    low = options.iv_rank(spark.createDataFrame([("a", 0.05)], "k string, atm_iv double"), hist, ["k"]).first()
    assert low.iv_rank == 0.0
    dated = hist.withColumn("timestamp", F.lit(0))
    late = options.iv_rank(cur.withColumn("timestamp", F.lit(86_400_000 * 300)), dated, ["k"], lookback_days=252)
    assert {r.iv_rank for r in late.collect()} == {50.0}


def test_main_contracts_ties(spark):
    rows = [(i, f"N{i}", "call" if i % 2 else "put", 100.0 + 10 * (i % 3), 1_782_432_000_000, float(oi)) for i, oi in enumerate([5, 5, 9, 1, None or 0, 7, 7])]
    df = spark.createDataFrame(rows, "seq long, instrument_name string, option_type string, strike double, expiration_timestamp long, open_interest double")
    m = options.main_contracts(df, F.lit(105.0), "seq", top_n=4).first()
    assert m.expiry == "2026-06-26" and m.calls == ["N5"] and m.puts == ["N2", "N6", "N0"]
    assert m.total_oi == 28.0 and m.atm_strike == 100.0


def test_trading_days(spark):
    days = {"2026-01-01": False, "2026-12-25": False, "2026-01-05": True, "2026-01-04": False, "2021-12-31": False, "2022-12-26": False, "2026-04-03": False, "2026-05-25": False, "2026-11-26": False, "2026-07-03": False}
    rows = spark.createDataFrame([(d,) for d in days], "d string").select("d", is_trading_day(F.col("d").cast("date")).alias("t")).collect()
    assert {r.d: r.t for r in rows} == days


def test_easter(spark):
    known = {1954: "04-18", 1981: "04-19", 1999: "04-04", 2000: "04-23", 2008: "03-23", 2011: "04-24", 2019: "04-21", 2024: "03-31", 2038: "04-25", 2049: "04-18"}
    rows = spark.createDataFrame([(y, f"{y}-06-01") for y in known], "y int, d string").select("y", easter(F.col("d").cast("date")).cast("string").alias("e")).collect()
    assert {r.y: r.e[5:] for r in rows} == known


def test_curve_fill_and_fallback(spark):
    obs = spark.createDataFrame([("DGS3MO", "2026-01-02", 0.045), ("DGS3MO", "2026-01-05", 0.046), ("DGS1", "2026-01-05", 0.0)], "series_id string, d string, rate double").withColumn("obs_date", F.col("d").cast("date"))
    filled = {(r.series_id, str(r.date)): r.rate for r in rates.calendar_fill(obs).collect()}
    assert filled[("DGS3MO", "2026-01-03")] == filled[("DGS3MO", "2026-01-04")] == 0.045
    assert ("DGS3MO", "2026-01-01") not in filled and filled[("DGS3MO", "2026-12-31")] == 0.046
    curve = {(str(r.date), r.series_id): r for r in rates.yield_curve(obs).collect()}
    assert len(curve) == 365 * 8
    assert curve[("2026-01-01", "DGS3MO")].rate_annual == 0.05
    assert curve[("2026-01-06", "DGS1")].rate_annual == 0.05
    assert curve[("2026-01-06", "DGS3MO")].rate_continuous == pytest.approx(math.log(1.046))
    strict = rates.yield_curve(obs, strict_zero=True).filter("series_id = 'DGS1' and date = '2026-01-06'").first()
    assert strict.rate_annual == 0.0


XS = list(rates.SERIES_TENORS.values())
YS = [0.04, 0.042, 0.043, 0.045, 0.046, 0.048, 0.05, 0.055]


def spline(t):
    x, y = np.array(XS), np.array(YS)
    m = curvature_weights(x) @ y
    i = int(np.clip(np.searchsorted(x, t) - 1, 0, len(x) - 2))
    h, a, b = x[i + 1] - x[i], x[i + 1] - t, t - x[i]
    return (m[i] * a**3 + m[i + 1] * b**3) / (6 * h) + (y[i] / h - m[i] * h / 6) * a + (y[i + 1] / h - m[i + 1] * h / 6) * b


def test_spline_properties():
    x, y = np.array(XS), np.array(YS)
    m = curvature_weights(x) @ y
    assert m[0] == m[-1] == 0
    for i in range(1, len(x) - 1):  # first derivatives meet at the inner knots
        h0, h1 = x[i] - x[i - 1], x[i + 1] - x[i]
        left = (y[i] - y[i - 1]) / h0 + h0 * (2 * m[i] + m[i - 1]) / 6
        right = (y[i + 1] - y[i]) / h1 - h1 * (2 * m[i] + m[i + 1]) / 6
        assert left == pytest.approx(right)


@pytest.mark.parametrize("how", ["const", "cubic"])
def test_spline_columns(spark, how):
    at = [0.01, 1 / 12, 0.3, 1.0, 4.2, 17.0, 30.0, 45.0]
    df = spark.createDataFrame([(t, XS, YS) for t in at], "t double, xs array<double>, ys array<double>")
    got = df.select("t", fixed_knots(XS, [F.lit(y) for y in YS], F.col("t"), how).alias("f"), any_knots(F.col("xs"), F.col("ys"), F.col("t"), how).alias("a")).collect()
    for row in got:
        inside = XS[0] < row.t < XS[-1]
        want = spline(row.t) if inside or how == "cubic" else (YS[0] if row.t <= XS[0] else YS[-1])
        assert row.f == pytest.approx(want) and row.a == pytest.approx(want)
    empty = spark.createDataFrame([([], [], 1.0)], "xs array<double>, ys array<double>, t double")
    assert empty.select(any_knots(F.col("xs"), F.col("ys"), F.col("t"))).first()[0] == 0.0


def test_null_group_keys(spark):
    """A null key is a group of its own: its band, its strike at the money, its price."""
    rows = [(None, 100.0, 100.0, 0.5, 1), (None, 140.0, 100.0, 0.6, 2), ("a", 100.0, 100.0, 0.5, 3), ("a", 140.0, 100.0, 0.6, 4)]
    df = spark.createDataFrame(rows, "k string, strike double, underlying_price double, iv double, seq long")
    assert sorted(r.seq for r in options.near_atm(df, ["k"]).collect()) == [1, 3]
    assert {r.underlying_price for r in options.first_underlying(df, ["k"], "seq").collect()} == {100.0}
    listed = df.withColumns({"expiration_timestamp": F.lit(1_767_225_600_000), "open_interest": F.lit(1.0), "instrument_name": F.col("seq").cast("string"), "option_type": F.lit("call")})
    found = options.main_contracts(listed, F.col("underlying_price"), "seq", ["k"]).collect()
    assert {r.k: r.atm_strike for r in found} == {None: 100.0, "a": 100.0}


def test_any_knots_without_python(spark):
    import numpy as np

    from quoteloom.functions import spline

    rng = np.random.default_rng(3)
    rows = [([], [], 1.0), ([2.0], [0.3], 9.0), ([1.0, 2.0], [0.1, 0.4], 1.5), ([1.0, 3.0], [0.1, 0.4], None), (None, None, 1.0)]
    for n in (3, 4, 8, 20):
        for t in (-1.0, 0.4, 5.0, 11.0):
            x = np.sort(rng.choice(np.arange(0.0, 10.0, 0.25), n, replace=False))
            rows.append((x.tolist(), rng.random(n).tolist(), t))
        rows.append((x.tolist(), rng.random(n).tolist(), float(x[1])))
    df = spark.createDataFrame(rows, "x array<double>, y array<double>, t double")
    for kind in ("const", "cubic"):
        out = df.withColumn("v", spline.any_knots(F.col("x"), F.col("y"), F.col("t"), kind))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
        for x, y, t, v in out.collect():
            if not x:
                assert v == 0.0
            elif len(x) == 1:
                assert v == y[0]
            elif t is None:
                assert v is None
            elif kind == "const" and not x[0] < t < x[-1]:
                assert v == (y[0] if t <= x[0] else y[-1])
            else:
                m = spline.curvature_weights(np.array(x)) @ np.array(y)
                i = min(max(int(np.searchsorted(x, t)) - 1, 0), len(x) - 2)
                want = spline._segment(x[i], x[i + 1], y[i], y[i + 1], m[i], m[i + 1], t)
                assert abs(v - want) < 1e-9 * max(1, abs(want))
