"""Registration of queries and shared SQL fragments."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quoteloom.fixtures import NOW_MS, oracle_with, table, view  # noqa: F401
from quoteloom.functions.normal import DENOMINATOR, NUMERATOR, SPLIT

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a query under ``name``; without SQL only its rows are counted."""

    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return add


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round doubles the way ``r`` does in SQL, so that both sides hash alike."""
    return df.withColumns({c: F.round(F.col(c).cast("double"), digits) for c in columns})


def r(expr: str, digits: int = 6) -> str:
    """Rounded double in SQL; adding zero removes the sign of a negative zero."""
    return f"(round(cast({expr} AS double), {digits}) + 0.0)"


def _horner(coefficients, z: str) -> str:
    out = repr(coefficients[0])
    for c in coefficients[1:]:
        out = f"({out} * {z} + {c!r})"
    return out


def tail_sql(x: str) -> str:
    """P(X > |x|) as SQL, same approximation as the Column form."""
    z = f"abs({x})"
    weight = f"exp(-({z}) * ({z}) / 2e0)"
    frac = f"({z} + 0.65e0)"
    for k in (4, 3, 2, 1):
        frac = f"({z} + {k}e0 / {frac})"
    near = f"{weight} * {_horner(NUMERATOR, z)} / {_horner(DENOMINATOR, z)}"
    return f"CASE WHEN {z} < {SPLIT!r} THEN {near} ELSE {weight} / ({frac} * {math.sqrt(2 * math.pi)!r}) END"


def cdf_sql(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN 1 - ({tail_sql(x)}) ELSE {tail_sql(x)} END"


YEAR_MS = 365.25 * 86_400_000


def greeks_ctes(now_ms: str | int = NOW_MS, rate: str = "0.05e0", carry: str = "", source: str = "chain") -> str:
    """CTEs ``alive`` (filtered, with iv) and ``g`` (with Greeks) over chain rows.

    ``now_ms`` and ``rate`` may name columns of ``source``; ``carry`` lists more columns.
    """
    more = f", {carry}" if carry else ""
    return f"""
aged AS (SELECT *, ({now_ms}) AS now_ms, ({rate}) AS r, ((epoch_us(cast(CASE expiry_str WHEN '28MAR26' THEN '2026-03-28'
    WHEN '26JUN26' THEN '2026-06-26' WHEN '9MAY26' THEN '2026-05-09' ELSE '2026-12-25' END AS timestamp)) // 1000)
    - ({now_ms})) / {YEAR_MS!r} AS t FROM {source}),
alive AS (SELECT *, CASE WHEN mark_iv > 0 THEN mark_iv WHEN (bid_iv + ask_iv) / 2 > 0 THEN (bid_iv + ask_iv) / 2 ELSE 0.5e0 END AS iv,
    CASE WHEN mark_iv > 0 OR (bid_iv + ask_iv) / 2 > 0 THEN 'rest_api' ELSE 'fallback' END AS iv_source
  FROM aged WHERE (bid_price > 0 OR ask_price > 0) AND t > {5.0 / (365.25 * 24 * 60)!r}
    AND abs(strike - underlying_price) / greatest(underlying_price, 1e0) < 0.5e0),
d1s AS (SELECT *, (ln(underlying_price / strike) + (r + iv * iv * 0.5e0) * t) / (iv * sqrt(t)) AS d1 FROM alive),
d2s AS (SELECT *, d1 - iv * sqrt(t) AS d2 FROM d1s),
ns AS (SELECT *, {cdf_sql('d1')} AS n1, {cdf_sql('d2')} AS n2, {cdf_sql('(-d2)')} AS m2,
   exp(-d1 * d1 / 2e0) / {math.sqrt(2 * math.pi)!r} AS pdf, strike * exp(-r * t) AS pv FROM d2s),
g AS (SELECT seq, ccy, instrument_name, expiry_str AS expiry, cp AS option_type, underlying_price, strike, t, iv, iv_source,
   bid_price, ask_price, now_ms, r{more},
   CASE WHEN cp = 'C' THEN n1 ELSE n1 - 1 END AS delta, pdf / (underlying_price * iv * sqrt(t)) AS gamma,
   underlying_price * pdf * sqrt(t) / 100 AS vega,
   (-underlying_price * pdf * iv / (2 * sqrt(t)) + CASE WHEN cp = 'C' THEN -r * pv * n2 ELSE r * pv * m2 END) / 365.25e0 AS theta,
   CASE WHEN cp = 'C' THEN pv * t * n2 ELSE -pv * t * m2 END / 100 AS rho FROM ns)"""
