"""Option chains, Greeks, surface, basis, rates."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from quoteloom.functions import text
from quoteloom.functions.normal import norm_cdf, norm_pdf
from quoteloom.functions.spline import any_knots
from quoteloom.operators import basis, options, rates
from quoteloom.plans import market as plans
from quoteloom.sources.prices import rate_observations

from .base import NOW_MS, cdf_sql, greeks_ctes, oracle_with, query, r, rounded, table, view

LATER_MS = 1_775_001_600_000  # 2026-04-01: one of the expiries has passed


def _chain(spark, d):
    return view(spark, d, "chain")


def _priced(spark, d, extra=("seq", "ccy")):
    return options.greeks_batch(_chain(spark, d), NOW_MS, extra=list(extra), as_float=False)


@query("norm_pdf", f"SELECT l_orderkey, l_linenumber, l_partkey, {r('exp(-x * x / 2) / sqrt(2 * pi())', 12)} AS pdf FROM (SELECT *, (l_quantity - 25) / 5 AS x FROM lineitem)")
def norm_pdf_query(spark, d):
    x = (F.col("l_quantity") - 25) / 5
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", norm_pdf(x).alias("pdf"))
    return rounded(rows, "pdf", digits=12)


@query("norm_cdf", f"SELECT l_orderkey, l_linenumber, l_partkey, {r(cdf_sql('x'), 12)} AS cdf FROM (SELECT *, (l_extendedprice - 50000) / 6000 AS x FROM lineitem)")
def norm_cdf_query(spark, d):
    rows = table(spark, d, "lineitem").withColumn("x", (F.col("l_extendedprice") - 50000) / 6000)
    return rounded(rows.select("l_orderkey", "l_linenumber", "l_partkey", norm_cdf("x").alias("cdf")), "cdf", digits=12)


@query(
    "parse_instrument",
    f"""{oracle_with('chain')}, n AS (SELECT seq, CASE WHEN seq % 5 = 0 THEN ccy || '-PERPETUAL' WHEN seq % 7 = 0 THEN lower(instrument_name)
  WHEN seq % 11 = 0 THEN replace(instrument_name, '-C', '.5-C') ELSE instrument_name END AS instrument_name FROM chain),
p AS (SELECT *, regexp_extract(instrument_name, '^([A-Z]+)-([0-9]{{1,2}}[A-Z]{{3}}[0-9]{{2}})-([0-9]+)-([CP])$', ['a', 'b', 'c', 'd']) AS m FROM n)
SELECT seq, instrument_name, nullif(m.a, '') AS currency, nullif(m.b, '') AS expiry, cast(nullif(m.c, '') AS double) AS strike, nullif(m.d, '') AS option_type,
  CASE WHEN m.b <> '' THEN epoch_us(strptime(m.b, '%d%b%y')) // 1000 END AS expiry_timestamp FROM p""",
)
def parse_instrument(spark, d):
    name = (
        F.when(F.col("seq") % 5 == 0, F.concat("ccy", F.lit("-PERPETUAL")))
        .when(F.col("seq") % 7 == 0, F.lower("instrument_name"))
        .when(F.col("seq") % 11 == 0, F.replace("instrument_name", F.lit("-C"), F.lit(".5-C")))
        .otherwise(F.col("instrument_name"))
    )
    return options.parse_instruments(_chain(spark, d).select("seq", name.alias("instrument_name")))


@query("time_to_expiry", f"{oracle_with('chain')}, {greeks_ctes(LATER_MS)} SELECT seq, {r('t', 9)} AS time_to_expiry_years FROM aged")
def time_to_expiry(spark, d):
    rows = options.parse_instruments(_chain(spark, d).drop("strike"))
    return rounded(options.time_to_expiry(rows, LATER_MS).select("seq", "time_to_expiry_years"), "time_to_expiry_years", digits=9)


@query("zombie_filter", f"{oracle_with('chain')}, {greeks_ctes(LATER_MS)} SELECT seq, instrument_name FROM alive")
def zombie_filter(spark, d):
    rows = options.time_to_expiry(options.parse_instruments(_chain(spark, d)), LATER_MS)
    return rows.filter(options.is_alive()).select("seq", "instrument_name")


@query(
    "iv_resolve",
    f"""{oracle_with('chain')} SELECT seq, {r("greatest(CASE WHEN mark_iv > 0 THEN mark_iv WHEN bid_iv + ask_iv > 0 THEN (bid_iv + ask_iv) / 2 ELSE 0.5 END, 0.001)")} AS iv,
  CASE WHEN mark_iv > 0 OR bid_iv + ask_iv > 0 THEN 'rest_api' ELSE 'fallback' END AS iv_source FROM chain""",
)
def iv_resolve(spark, d):
    return rounded(options.resolve_iv(_chain(spark, d)).select("seq", "iv", "iv_source"), "iv")


_OUT = ("delta", "gamma", "vega", "theta", "rho")


@query(
    "bs_greeks",
    f"{oracle_with('chain')}, {greeks_ctes()} SELECT seq, {', '.join(r(c) + ' AS ' + c for c in _OUT)} FROM g",
)
def bs_greeks(spark, d):
    return rounded(_priced(spark, d).select("seq", *_OUT), *_OUT)


@query(
    "greeks_batch",
    f"""{oracle_with('chain')}, {greeks_ctes()} SELECT seq, ccy, now_ms AS timestamp, instrument_name, 'deribit' AS exchange, underlying_price, cast(strike AS double) AS strike,
  expiry, {r('t')} AS time_to_expiry_years, option_type, {r('iv')} AS iv, iv_source, {', '.join(r(c) + ' AS ' + c for c in _OUT)},
  0.0 AS mid_price, {r('bid_price')} AS bid_price, {r('ask_price')} AS ask_price FROM g""".replace("0.0 AS mid_price", "cast(0 AS double) AS mid_price"),
)
def greeks_batch(spark, d):
    return rounded(_priced(spark, d), "time_to_expiry_years", "iv", *_OUT, "bid_price", "ask_price")


@query(
    "float32_columns",
    f"{oracle_with('chain')} SELECT seq, cast(cast(bid_price AS float) AS double) AS bid_price, cast(cast(mark_iv AS float) AS double) AS mark_iv FROM chain",
)
def float32_columns(spark, d):
    from quoteloom.sinks.store import narrow

    rows = narrow(_chain(spark, d).select("seq", "bid_price", "mark_iv"), ["bid_price", "mark_iv"])
    return rows.select("seq", *[F.col(c).cast("double").alias(c) for c in ("bid_price", "mark_iv")])


_NEAR = """dist AS (SELECT *, abs(strike - underlying_price) AS dd, abs(strike - underlying_price) / underlying_price AS mny FROM g),
bands AS (SELECT {key}, CASE WHEN count(*) FILTER (mny <= 0.05 AND iv > 0) > 0 THEN 0.05 WHEN count(*) FILTER (mny <= 0.15 AND iv > 0) > 0 THEN 0.15
   WHEN count(*) FILTER (mny <= 0.5 AND iv > 0) > 0 THEN 0.5 END AS band FROM dist GROUP BY ALL)"""


@query(
    "near_atm",
    f"""{oracle_with('chain')}, {greeks_ctes()}, {_NEAR.format(key='ccy, expiry')}
SELECT seq, dist.ccy, dist.expiry, instrument_name FROM dist JOIN bands USING (ccy, expiry) WHERE band IS NULL OR (mny <= band AND iv > 0)""",
)
def near_atm(spark, d):
    return options.near_atm(_priced(spark, d), ["ccy", "expiry"]).select("seq", "ccy", "expiry", "instrument_name")


@query(
    "near_atm_null_key",
    f"""{oracle_with('chain')}, {greeks_ctes()}, k AS (SELECT * REPLACE (nullif(ccy, 'ETH') AS ccy) FROM g), d AS (SELECT *, abs(strike - underlying_price) / underlying_price AS mny FROM k),
bands AS (SELECT ccy, CASE WHEN count(*) FILTER (mny <= 0.05 AND iv > 0) > 0 THEN 0.05 WHEN count(*) FILTER (mny <= 0.15 AND iv > 0) > 0 THEN 0.15
   WHEN count(*) FILTER (mny <= 0.5 AND iv > 0) > 0 THEN 0.5 END AS band FROM d GROUP BY ALL)
SELECT d.seq, d.ccy FROM d JOIN bands ON d.ccy IS NOT DISTINCT FROM bands.ccy WHERE band IS NULL OR (mny <= band AND iv > 0)""",
)
def near_atm_null_key(spark, d):
    priced = _priced(spark, d).withColumn("ccy", F.nullif("ccy", F.lit("ETH")))
    return options.near_atm(priced, ["ccy"]).select("seq", "ccy")


_ATM = "arg_min(iv, (abs(strike - underlying_price), seq))"
_C25, _P25 = "arg_min(iv, (abs(delta - 0.25), seq))", "arg_min(iv, (abs(delta + 0.25), seq))"


@query("atm_iv", f"{oracle_with('chain')}, {greeks_ctes()} SELECT ccy, {r(_ATM)} AS atm_iv FROM g GROUP BY 1")
def atm_iv(spark, d):
    return rounded(options.atm_iv(_priced(spark, d), ["ccy"], "seq"), "atm_iv")


@query("skew_25d", f"{oracle_with('chain')}, {greeks_ctes()} SELECT ccy, expiry, {r(f'{_C25} - {_P25}')} AS skew_25d FROM g GROUP BY 1, 2")
def skew_25d(spark, d):
    return rounded(options.skew_25d(_priced(spark, d), ["ccy", "expiry"], "seq"), "skew_25d")


@query("butterfly_25d", f"{oracle_with('chain')}, {greeks_ctes()} SELECT ccy, expiry, {r(f'({_C25} + {_P25}) / 2 - {_ATM}')} AS butterfly_25d FROM g GROUP BY 1, 2")
def butterfly_25d(spark, d):
    return rounded(options.butterfly_25d(_priced(spark, d), ["ccy", "expiry"], "seq"), "butterfly_25d")


@query("term_structure", f"{oracle_with('chain')}, {greeks_ctes()} SELECT ccy, expiry, {r(_ATM)} AS atm_iv FROM g GROUP BY 1, 2")
def term_structure(spark, d):
    return rounded(options.term_structure(_priced(spark, d), ["ccy"], "seq"), "atm_iv")


@query(
    "iv_rank",
    f"""{oracle_with('chain')}, h AS (SELECT ccy, mark_iv AS iv FROM chain), cur AS (SELECT ccy, arg_max(mark_iv, seq) AS atm_iv FROM chain GROUP BY 1)
SELECT ccy, {r('any_value(atm_iv)')} AS atm_iv, {r('100e0 * count(*) FILTER (h.iv <= cur.atm_iv) / count(*)')} AS iv_rank FROM h JOIN cur USING (ccy) GROUP BY 1""",
)
def iv_rank(spark, d):
    chain = _chain(spark, d)
    current = chain.groupBy("ccy").agg(F.max_by("mark_iv", "seq").alias("atm_iv"))
    return rounded(options.iv_rank(current, chain.select("ccy", F.col("mark_iv").alias("iv")), ["ccy"]), "atm_iv", "iv_rank")


_SURFACE = f"""{oracle_with('chain')}, {greeks_ctes()}, {_NEAR.format(key='ccy')},
atm AS (SELECT ccy, arg_min(iv, (dd, seq)) AS atm_iv FROM dist JOIN bands USING (ccy) WHERE band IS NULL OR (mny <= band AND iv > 0) GROUP BY 1),
wing AS (SELECT ccy, {_C25} - {_P25} AS skew_25d, ({_C25} + {_P25}) / 2 - {_ATM} AS butterfly_25d FROM g GROUP BY 1),
term AS (SELECT ccy, string_agg(expiry || '=' || printf('%.4f', a), ',' ORDER BY expiry) AS term_structure FROM (SELECT ccy, expiry, {_ATM} AS a FROM g GROUP BY 1, 2) GROUP BY 1),
rank AS (SELECT atm.ccy, 100e0 * count(*) FILTER (chain.mark_iv <= atm.atm_iv) / count(*) AS iv_rank FROM atm JOIN chain USING (ccy) GROUP BY 1)
SELECT ccy, cast({NOW_MS} AS bigint) AS timestamp, {r('atm_iv')} AS atm_iv, {r('skew_25d')} AS skew_25d, {r('butterfly_25d')} AS butterfly_25d, {r('iv_rank')} AS iv_rank,
  term_structure, CASE WHEN atm_iv = 0 AND skew_25d = 0 AND butterfly_25d = 0 THEN 'estimated' ELSE 'good' END AS quality
FROM atm JOIN wing USING (ccy) JOIN term USING (ccy) JOIN rank USING (ccy)"""


@query("vol_surface", _SURFACE)
def vol_surface(spark, d):
    history = _chain(spark, d).select("ccy", F.col("mark_iv").alias("iv"))
    point = plans.surface_from_chain(_chain(spark, d), ["ccy"], "seq", NOW_MS, history=history, as_float=False)
    pairs = F.transform(F.map_entries("term_structure"), lambda e: F.concat(e["key"], F.lit("="), F.format_string("%.4f", e["value"])))
    flat = point.withColumn("term_structure", F.array_join(F.array_sort(pairs), ","))
    return rounded(flat, "atm_iv", "skew_25d", "butterfly_25d", "iv_rank")


@query("surface_no_delta", f"""{oracle_with('chain')}, {greeks_ctes()}
SELECT ccy, 0e0 AS skew_25d, 0e0 AS butterfly_25d, 'good' AS quality FROM g GROUP BY 1""")
def surface_no_delta(spark, d):
    greeks = options.greeks_batch(_chain(spark, d), NOW_MS, extra=["ccy", "seq"]).drop("delta")
    return options.vol_surface(greeks, ["ccy"], "seq").select("ccy", "skew_25d", "butterfly_25d", "quality")


_DAYS = 3


@query(
    "iv_rank_history",
    f"""{oracle_with('ticks')}, now AS (SELECT instrument, timestamp // 3600000 * 3600000 AS timestamp, max(price) AS atm_iv FROM ticks GROUP BY 1, 2)
SELECT now.instrument, now.timestamp, now.atm_iv, {r('100e0 * count(*) FILTER (t.price <= now.atm_iv) / nullif(count(t.price), 0)')} AS iv_rank
FROM now LEFT JOIN ticks t ON t.instrument = now.instrument AND t.timestamp <= now.timestamp AND t.timestamp > now.timestamp - {_DAYS * 86_400_000}
GROUP BY 1, 2, 3 HAVING count(t.price) > 0 UNION ALL SELECT instrument, timestamp, atm_iv, 50e0 FROM now n
WHERE NOT EXISTS (SELECT 1 FROM ticks t WHERE t.instrument = n.instrument AND t.timestamp <= n.timestamp AND t.timestamp > n.timestamp - {_DAYS * 86_400_000} AND t.price IS NOT NULL)""",
)
def iv_rank_history(spark, d):
    """Every hour's value among the three days before it."""
    ticks = view(spark, d, "ticks")
    hour = F.col("timestamp") - F.pmod("timestamp", F.lit(3_600_000))
    current = ticks.groupBy("instrument", hour.alias("timestamp")).agg(F.max("price").alias("atm_iv"))
    past = ticks.select("instrument", "timestamp", F.col("price").alias("iv"))
    return rounded(options.iv_rank(current, past, ["instrument", "timestamp"], lookback_days=_DAYS), "iv_rank")


def _instruments(spark, d):
    # Some expiries and open interests are missing, as in a real listing.
    return _chain(spark, d).select(
        "seq", "ccy", "instrument_name", "strike", "underlying_price",
        F.when(F.col("cp") == "C", "call").otherwise("put").alias("option_type"),
        F.when(F.col("seq") % 23 != 0, text.expiry_ms(F.col("expiry_str"))).alias("expiration_timestamp"),
        F.when(F.col("seq") % 3 != 0, F.col("open_interest")).alias("open_interest"),
        (F.col("seq") % 9 != 0).alias("is_active"),
    )


_LISTING = """inst AS (SELECT seq, ccy, instrument_name, strike, underlying_price, CASE WHEN cp = 'C' THEN 'call' ELSE 'put' END AS option_type,
 CASE WHEN seq % 23 <> 0 THEN CASE expiry_str WHEN '28MAR26' THEN '2026-03-28' WHEN '26JUN26' THEN '2026-06-26' WHEN '9MAY26' THEN '2026-05-09' ELSE '2026-12-25' END END AS expiry,
 CASE WHEN seq % 3 <> 0 THEN open_interest ELSE 0 END AS oi, seq % 9 <> 0 AS is_active FROM chain)"""


@query(
    "main_contracts",
    f"""{oracle_with('chain')}, {_LISTING}, k AS (SELECT *, row_number() OVER (PARTITION BY ccy, expiry ORDER BY oi DESC, seq) AS rn FROM inst WHERE expiry IS NOT NULL)
SELECT ccy, expiry, coalesce(string_agg(instrument_name, ',' ORDER BY rn) FILTER (rn <= 5 AND option_type = 'call'), '') AS calls,
 coalesce(string_agg(instrument_name, ',' ORDER BY rn) FILTER (rn <= 5 AND option_type = 'put'), '') AS puts,
 cast(arg_min(strike, (abs(strike - underlying_price), strike)) AS double) AS atm_strike, sum(oi) FILTER (rn <= 5) AS total_oi FROM k GROUP BY 1, 2""",
)
def main_contracts(spark, d):
    out = options.main_contracts(_instruments(spark, d), F.col("underlying_price"), "seq", ["ccy"])
    return out.withColumns({"calls": F.array_join("calls", ","), "puts": F.array_join("puts", ",")})


@query(
    "select_instruments",
    f"""{oracle_with('chain')}, {_LISTING}, w AS (SELECT DISTINCT instrument_name FROM chain WHERE seq % 4 <> 1)
SELECT seq, instrument_name, is_active FROM inst WHERE is_active AND instrument_name IN (FROM w)
UNION ALL SELECT seq, instrument_name, is_active FROM inst WHERE NOT is_active AND expiry > '2026-03-28' AND expiry < '2026-12-25' AND instrument_name IN (FROM w)""",
)
def select_instruments(spark, d):
    from quoteloom.sources.option_feed import select_instruments as pick

    listing = _instruments(spark, d)
    allowed = _chain(spark, d).filter(F.col("seq") % 4 != 1).select("instrument_name")
    out = pick(listing, 1774656000000, 1798156800000, include_expired=True, whitelist=allowed)
    return out.select("seq", "instrument_name", "is_active")


# -- basis ---------------------------------------------------------------------------


def _prices(spark, d, name, *more):
    return view(spark, d, "ticks").filter(F.col("instrument") == name).select("seq", "timestamp", "price", *more)


def _basis_sql(base: str, other: str, kind: str, days: int, symbol: str) -> str:
    """``base``/``other`` name the target side 'v' price or the matched price 'm'."""
    pair = {"v": "price", "m": "click_price"}
    a, b = pair[base], pair[other]
    from .ordered import _pair_sql

    pct = f"CASE WHEN {a} = 0 THEN 0 ELSE ({b} - {a}) / {a} * 100 END"
    return f"""{_pair_sql(False, 'nearest', None)} SELECT seq, timestamp, '{symbol}' AS symbol, '{kind}' AS basis_type, {a} AS spot_price, {b} AS perp_price,
  {r(f'{b} - {a}')} AS basis, {r(pct, 4)} AS basis_pct, {r(f'({pct}) * 365e0 / {days}', 4)} AS annualized_basis, cast({days} AS integer) AS days_to_expiry FROM k"""


def _basis_out(df):
    return rounded(rounded(df, "basis"), "basis_pct", "annualized_basis", digits=4)


@query("basis_spot_perp", _basis_sql("v", "m", "spot_perp", 365, "BTC_USDT"))
def basis_spot_perp(spark, d):
    return _basis_out(basis.spot_perp(_prices(spark, d, "view"), _prices(spark, d, "click"), "BTC_USDT", seq="seq", carry=["seq"]))


@query("basis_cross_exchange", _basis_sql("m", "v", "cross_exchange", 30, "CROSS_EXCHANGE"))
def basis_cross_exchange(spark, d):
    out = basis.cross_exchange(_prices(spark, d, "view"), _prices(spark, d, "click"), days_to_expiry=30, seq="seq", carry=["seq"])
    return _basis_out(out)


@query(
    "basis_synthetic",
    f"""{oracle_with('chain')}, legs AS (SELECT ccy, expiry_str AS expiry, strike, arg_max((bid_price + ask_price) / 2, seq) FILTER (cp = 'C') AS c,
  arg_max((bid_price + ask_price) / 2, seq) FILTER (cp = 'P') AS p, any_value(underlying_price) AS u FROM chain GROUP BY ALL),
x AS (SELECT *, c - p + strike * exp(-0.05e0 * 30 / 365) AS f, u * 1.001e0 AS perp FROM legs WHERE c IS NOT NULL AND p IS NOT NULL)
SELECT ccy, expiry, strike, 'SYNTHETIC' AS symbol, 'synthetic' AS basis_type, {r('f')} AS spot_price, {r('perp')} AS perp_price, {r('perp - f')} AS basis,
  {r('(perp - f) / perp * 100')} AS basis_pct, {r('(perp - f) / perp * 100 * (365e0 / 30)')} AS annualized_basis, cast(30 AS integer) AS days_to_expiry FROM x""",
)
def basis_synthetic(spark, d):
    chain = _chain(spark, d).withColumns(
        {"mid_price": (F.col("bid_price") + F.col("ask_price")) / 2, "expiry": F.col("expiry_str"), "option_type": F.col("cp")}
    )
    spot = chain.groupBy("ccy").agg(F.first("underlying_price").alias("_u"))
    legs = basis.call_put_legs(chain, ["ccy"], "seq").join(spot, "ccy").withColumns({"perp": F.col("_u") * 1.001, "days": F.lit(30)})
    out = basis.synthetic(legs, "call_mid", "put_mid", "strike", "perp", 0.05, "days", ["ccy", "expiry", "strike"])
    return rounded(out, "spot_price", "perp_price", "basis", "basis_pct", "annualized_basis")


@query(
    "live_basis",
    f"""{oracle_with('ticks')}, m AS (SELECT * FROM (VALUES ('BTCUSDT', 'BTC'), ('ETHUSDT', 'ETH')) t(symbol, currency)),
s AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'BTCUSDT' ELSE 'ETHUSDT' END AS symbol, arg_max(price, (timestamp, seq)) AS sp FROM ticks WHERE instrument = 'view' GROUP BY 1),
p AS (SELECT CASE WHEN user_id % 2 = 0 THEN 'BTC' ELSE 'ETH' END AS currency, arg_max(price, (timestamp, seq)) AS pp FROM ticks WHERE instrument = 'click' GROUP BY 1)
SELECT cast({NOW_MS} AS bigint) AS timestamp, currency || '_USDT' AS symbol, 'spot_perp' AS basis_type, sp AS spot_price, pp AS perp_price, {r('pp - sp')} AS basis,
 {r('(pp - sp) / sp * 100')} AS basis_pct, {r('(pp - sp) / sp * 100')} AS annualized_basis, cast(365 AS integer) AS days_to_expiry FROM s JOIN m USING (symbol) JOIN p USING (currency) WHERE sp > 0""",
)
def live_basis(spark, d):
    even = F.col("user_id") % 2 == 0
    spot = _prices(spark, d, "view", F.when(even, "BTCUSDT").otherwise("ETHUSDT").alias("symbol"))
    perp = _prices(spark, d, "click", F.when(even, "BTC").otherwise("ETH").alias("currency"))
    mapping = spark.createDataFrame([("BTCUSDT", "BTC"), ("ETHUSDT", "ETH")], "symbol string, currency string")
    return rounded(basis.live_basis(spot, perp, mapping, NOW_MS, seq="seq"), "basis", "basis_pct", "annualized_basis")


# -- rates ---------------------------------------------------------------------------


def _observations(spark, d):
    return rate_observations(view(spark, d, "fred"))


_CLEAN = "obs AS (SELECT series_id, obs_date, try_cast(value AS double) / 100 AS rate FROM fred WHERE try_cast(value AS double) IS NOT NULL)"
_FILL = f"""{_CLEAN}, yrs AS (SELECT DISTINCT year(obs_date) AS y FROM fred),
days AS (SELECT cast(unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), INTERVAL 1 DAY)) AS date) AS date FROM yrs),
names AS (SELECT * FROM (VALUES ('DGS1MO', 1 / 12e0), ('DGS3MO', 0.25e0), ('DGS6MO', 0.5e0), ('DGS1', 1e0), ('DGS2', 2e0), ('DGS5', 5e0), ('DGS10', 10e0), ('DGS30', 30e0)) t(series_id, tenor_years)),
grid AS (SELECT series_id, tenor_years, date, last_value(rate IGNORE NULLS) OVER (PARTITION BY series_id, year(date) ORDER BY date ROWS UNBOUNDED PRECEDING) AS rate
  FROM days, names LEFT JOIN obs USING (series_id) WHERE false),
filled AS (SELECT series_id, tenor_years, date, last_value(rate IGNORE NULLS) OVER (PARTITION BY series_id, year(date) ORDER BY date ROWS UNBOUNDED PRECEDING) AS rate
  FROM (SELECT names.*, days.date FROM days, names) g LEFT JOIN (SELECT series_id, obs_date AS date, rate FROM obs) o USING (series_id, date))"""
_FILL = _FILL.replace(_FILL[_FILL.index("grid AS"):_FILL.index("filled AS")], "")


@query("fred_clean", f"{oracle_with('fred')}, {_CLEAN} SELECT series_id, cast(obs_date AS varchar) AS obs_date, {r('rate')} AS rate FROM obs")
def fred_clean(spark, d):
    rows = _observations(spark, d).select("series_id", F.col("obs_date").cast("string").alias("obs_date"), "rate")
    return rounded(rows, "rate")


@query("calendar_ffill", f"{oracle_with('fred')}, {_FILL} SELECT series_id, cast(date AS varchar) AS date, {r('rate')} AS rate FROM filled WHERE rate IS NOT NULL")
def calendar_ffill(spark, d):
    out = rates.calendar_fill(_observations(spark, d))
    return rounded(out.withColumn("date", F.col("date").cast("string")), "rate")


# The movable feast is tabulated here, independently of the library's arithmetic.
_GOOD_FRIDAYS = "'1992-04-17','1993-04-09','1994-04-01','1995-04-14','1996-04-05','1997-03-28','1998-04-10','1999-04-02','2000-04-21','2001-04-13','2002-03-29','2003-04-18','2004-04-09','2005-03-25'"
_TRADING = f"""isodow(date) <= 5 AND cast(date AS varchar) NOT IN ({_GOOD_FRIDAYS}) AND NOT EXISTS (SELECT 1 FROM (VALUES (1, 1), (6, 19), (7, 4), (12, 25)) h(m, dd)
  WHERE (month(date) = m AND day(date) = dd) OR (isodow(date) = 1 AND month(date - 1) = m AND day(date - 1) = dd) OR (isodow(date) = 5 AND month(date + 1) = m AND day(date + 1) = dd))
  AND NOT (isodow(date) = 1 AND ((month(date) IN (1, 2) AND day(date) BETWEEN 15 AND 21) OR (month(date) = 5 AND day(date) >= 25) OR (month(date) = 9 AND day(date) <= 7)))
  AND NOT (isodow(date) = 4 AND month(date) = 11 AND day(date) BETWEEN 22 AND 28)"""


@query(
    "trading_days",
    f"""WITH yrs AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders), days AS (SELECT cast(unnest(generate_series(make_date(y, 1, 1), make_date(y, 12, 31), INTERVAL 1 DAY)) AS date) AS date FROM yrs)
SELECT cast(date AS varchar) AS date, {_TRADING} AS is_trading_day FROM days""",
)
def trading_days(spark, d):
    days = rates.calendar_days(table(spark, d, "orders"), "o_orderdate")
    return days.withColumn("date", F.col("date").cast("string"))


@query(
    "yield_curve",
    f"""{oracle_with('fred')}, {_FILL} SELECT cast(date AS varchar) AS date, series_id, {r('tenor_years')} AS tenor_years, {r('coalesce(nullif(rate, 0), 0.05)')} AS rate_annual,
  {r('ln(1 + coalesce(nullif(rate, 0), 0.05))')} AS rate_continuous, {_TRADING} AS is_trading_day FROM filled""",
)
def yield_curve(spark, d):
    out = rates.yield_curve(_observations(spark, d))
    return rounded(out.withColumn("date", F.col("date").cast("string")), "tenor_years", "rate_annual", "rate_continuous")


def _spline_weights(t: float) -> np.ndarray:
    """Weights of the knot heights in the natural spline at t, from one dense solve for
    all polynomial coefficients (the library solves for second derivatives instead)."""
    x = np.array(list(rates.SERIES_TENORS.values()))
    n = len(x) - 1
    a, b = np.zeros((4 * n, 4 * n)), np.zeros((4 * n, n + 1))
    row = 0
    for i in range(n):
        h = x[i + 1] - x[i]
        a[row, 4 * i] = 1; b[row, i] = 1; row += 1
        a[row, 4 * i:4 * i + 4] = [1, h, h**2, h**3]; b[row, i + 1] = 1; row += 1
        if i < n - 1:
            a[row, 4 * i:4 * i + 4] = [0, 1, 2 * h, 3 * h**2]; a[row, 4 * i + 5] = -1; row += 1
            a[row, 4 * i:4 * i + 4] = [0, 0, 2, 6 * h]; a[row, 4 * i + 6] = -2; row += 1
    a[row, 2] = 2; row += 1
    h = x[-1] - x[-2]
    a[row, 4 * n - 4:4 * n] = [0, 0, 2, 6 * h]
    c = np.linalg.solve(a, b)
    i = min(int(np.searchsorted(x, t, side="right")) - 1, n - 1)
    u = t - x[i]
    return np.array([1, u, u**2, u**3]) @ c[4 * i:4 * i + 4]


_TARGETS = (0.01, 0.125, 0.75, 1.5, 3.0, 7.0, 20.0, 40.0)


def _weights_sql() -> str:
    names = list(rates.SERIES_TENORS)
    rows = []
    for t in _TARGETS:
        held = "DGS1MO" if t <= 1 / 12 else "DGS30" if t >= 30 else None
        w = [1.0 if n == held else 0.0 for n in names] if held else _spline_weights(t)
        rows += [f"({t!r}e0, '{n}', {float(v)!r}::double)" for n, v in zip(names, w)]
    return "w AS (SELECT * FROM (VALUES " + ", ".join(rows) + ") t(tenor_years, series_id, weight))"


@query(
    "rate_for_tenor",
    f"""{oracle_with('fred')}, {_FILL}, {_weights_sql()}, y AS (SELECT date, w.tenor_years, sum(w.weight * coalesce(nullif(rate, 0), 0.05)) AS annual FROM filled JOIN w USING (series_id) GROUP BY 1, 2)
SELECT cast(date AS varchar) AS date, tenor_years, {r('annual')} AS rate_annual, {r('ln(1 + annual)')} AS rate_continuous FROM y""",
)
def rate_for_tenor(spark, d):
    wide = rates.curve_columns(rates.yield_curve(_observations(spark, d)))
    targets = wide.withColumn("tenor_years", F.explode(F.array(*[F.lit(t) for t in _TARGETS])))
    out = rates.rate_for_tenor(targets, F.col("tenor_years"))
    return rounded(out.select(F.col("date").cast("string").alias("date"), "tenor_years", "rate_annual", "rate_continuous"), "rate_annual", "rate_continuous")


@query(
    "interpolate_curve",
    f"""{oracle_with('fred')}, {_FILL}, {_weights_sql()}, y AS (SELECT date, w.tenor_years, sum(w.weight * coalesce(nullif(rate, 0), 0.05)) AS annual FROM filled JOIN w USING (series_id) GROUP BY 1, 2)
SELECT cast(date AS varchar) AS date, tenor_years, {r('annual')} AS rate_annual FROM y""",
)
def interpolate_curve(spark, d):
    """The same through the form that takes any knots from array columns."""
    wide = rates.curve_columns(rates.yield_curve(_observations(spark, d)))
    knots = F.array(*[F.lit(t) for t in rates.SERIES_TENORS.values()])
    heights = F.array(*[F.col(s) for s in rates.SERIES_TENORS])
    at = wide.select("date", knots.alias("xs"), heights.alias("ys"), F.explode(F.array(*[F.lit(t) for t in _TARGETS])).alias("tenor_years"))
    out = at.select(F.col("date").cast("string").alias("date"), "tenor_years", any_knots(F.col("xs"), F.col("ys"), F.col("tenor_years")).alias("rate_annual"))
    return rounded(out, "rate_annual")


@query(
    "greeks_with_curve",
    f"""{oracle_with('chain', 'fred')}, {_FILL}, rate3 AS (SELECT date, ln(1 + coalesce(nullif(rate, 0), 0.05)) AS rr FROM filled WHERE series_id = 'DGS3MO'),
dated AS (SELECT chain.*, cast(date '1997-06-01' + cast(seq % 900 AS integer) AS date) AS as_of FROM chain), src AS (SELECT dated.*, coalesce(rr, 0.05) AS rr FROM dated LEFT JOIN rate3 ON as_of = date),
{greeks_ctes(rate='rr', source='src')}
SELECT seq, {r('r')} AS risk_free_rate, {', '.join(r(c) + ' AS ' + c for c in _OUT)} FROM g""",
)
def greeks_with_curve(spark, d):
    curve = rates.yield_curve(_observations(spark, d))
    dated = _chain(spark, d).withColumn("as_of", F.date_add(F.lit("1997-06-01").cast("date"), (F.col("seq") % 900).cast("int")))
    out = plans.greeks_with_curve(dated, curve, "as_of", F.lit(NOW_MS), ["seq"], as_float=False)
    return rounded(out.select("seq", "risk_free_rate", *_OUT), "risk_free_rate", *_OUT)
