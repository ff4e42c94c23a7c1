"""Black-Scholes sensitivities as staged projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .normal import norm_pdf, upper_tail

DAYS_PER_YEAR = 365.25
MS_PER_DAY = 86_400_000
MIN_YEARS = 1e-10

GREEKS = ("delta", "gamma", "vega", "theta", "rho")


def years_to_expiry(expiry_ms: Column, now_ms: Column) -> Column:
    return (expiry_ms - now_ms) / F.lit(MS_PER_DAY * DAYS_PER_YEAR)


def with_greeks(
    df: DataFrame,
    rate: float | Column,
    spot: str = "underlying_price",
    strike: str = "strike",
    years: str = "time_to_expiry_years",
    iv: str = "iv",
    side: str = "option_type",
) -> DataFrame:
    """Add delta, gamma, vega (per 1 %), theta (per day) and rho (per 1 %).

    Each stage names the values the next one uses more than once, so the generated
    code computes them once.
    """
    r = rate if isinstance(rate, Column) else F.lit(float(rate))
    s, k, sigma = F.col(spot), F.col(strike), F.col(iv)
    is_call = F.col(side) == "C"
    staged = df.withColumns({"_t": F.greatest(F.col(years), F.lit(MIN_YEARS)), "_r": r})
    staged = staged.withColumns({"_rt": F.sqrt("_t"), "_vol": sigma * F.sqrt("_t")})
    staged = staged.withColumn(
        "_d1", (F.ln(s / k) + (F.col("_r") + sigma * sigma * 0.5) * F.col("_t")) / F.col("_vol")
    )
    staged = staged.withColumn("_d2", F.col("_d1") - F.col("_vol"))
    staged = staged.withColumns(
        {
            "_pdf": norm_pdf(F.col("_d1")),
            "_tail1": upper_tail("_d1"),
            "_tail2": upper_tail("_d2"),
            "_pv": k * F.exp(-F.col("_r") * F.col("_t")),
        }
    )
    staged = staged.withColumns(
        {
            "_n1": F.when(F.col("_d1") > 0, 1 - F.col("_tail1")).otherwise(F.col("_tail1")),
            # N(d2) for a call, N(-d2) for a put: the tail with the fitting sign.
            "_n2": F.when(
                (F.col("_d2") > 0) == is_call, 1 - F.col("_tail2")
            ).otherwise(F.col("_tail2")),
            "_sign": F.when(is_call, 1.0).otherwise(-1.0),
        }
    )
    carry = F.col("_sign") * F.col("_pv") * F.col("_n2")
    staged = staged.withColumns(
        {
            "delta": F.when(is_call, F.col("_n1")).otherwise(F.col("_n1") - 1),
            "gamma": F.col("_pdf") / (s * F.col("_vol")),
            "vega": s * F.col("_pdf") * F.col("_rt") / 100,
            "theta": (-s * F.col("_pdf") * sigma / (F.col("_rt") * 2) - F.col("_r") * carry)
            / F.lit(DAYS_PER_YEAR),
            "rho": carry * F.col("_t") / 100,
        }
    )
    scratch = ("_t", "_r", "_rt", "_vol", "_d1", "_d2", "_pdf", "_tail1", "_tail2", "_pv", "_n1", "_n2", "_sign")
    return staged.drop(*scratch)
