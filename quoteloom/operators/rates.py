"""Risk-free rates: calendar fill, yield curve, rate at any tenor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.calendar import is_trading_day
from ..functions.spline import fixed_knots

# Published constant-maturity series and their tenors in years.
SERIES_TENORS = {
    "DGS1MO": 1 / 12,
    "DGS3MO": 3 / 12,
    "DGS6MO": 6 / 12,
    "DGS1": 1.0,
    "DGS2": 2.0,
    "DGS5": 5.0,
    "DGS10": 10.0,
    "DGS30": 30.0,
}
FALLBACK_RATE = 0.05


def continuous(annual: Column) -> Column:
    return F.log1p(annual)


def _days_of(year: Column) -> Column:
    return F.sequence(F.make_date(year, F.lit(1), F.lit(1)), F.make_date(year, F.lit(12), F.lit(31)))


def calendar_fill(obs: DataFrame, series: str = "series_id", day: str = "obs_date", value: str = "rate") -> DataFrame:
    """Each series on every day of its years, the last value carried forward.

    A year starts empty: days before its first observation are absent.  Groups are
    (series, year), so none holds more than 366 rows.
    """
    daily = obs.groupBy(series, F.col(day).alias("date")).agg(F.max(value).alias(value))
    spine = (
        daily.select(series, F.year("date").alias("_year"))
        .distinct()
        .select(series, "_year", F.explode(_days_of(F.col("_year"))).alias("date"))
    )
    order = Window.partitionBy(series, "_year").orderBy("date")
    return (
        spine.join(daily, [series, "date"], "left")
        .withColumn(value, F.last(value, ignorenulls=True).over(order))
        .filter(F.col(value).isNotNull())
        .select(series, "date", value)
    )


def calendar_days(dates: DataFrame, day: str) -> DataFrame:
    """All days of the years that occur in ``day``, each with its trading flag."""
    return (
        dates.select(F.year(day).alias("_year"))
        .filter(F.col("_year").isNotNull())
        .distinct()
        .select(F.explode(_days_of(F.col("_year"))).alias("date"))
        .withColumn("is_trading_day", is_trading_day(F.col("date")))
    )


def yield_curve(
    obs: DataFrame,
    series: str = "series_id",
    day: str = "obs_date",
    value: str = "rate",
    strict_zero: bool = False,
) -> DataFrame:
    """One row per day and tenor.  A tenor without a value takes the fallback rate; so
    does one at exactly zero, unless ``strict_zero``."""
    tenors = F.array(
        *[F.struct(F.lit(s).alias("series"), F.lit(t).alias("tenor")) for s, t in SERIES_TENORS.items()]
    )
    filled = calendar_fill(obs, series, day, value)
    grid = calendar_days(obs, day).withColumn("_t", F.explode(tenors))
    rate = F.col(value) if strict_zero else F.nullif(F.col(value), F.lit(0.0))
    return (
        grid.select("date", "is_trading_day", F.col("_t.series").alias(series), F.col("_t.tenor").alias("tenor_years"))
        .join(filled, [series, "date"], "left")
        .withColumn("rate_annual", F.coalesce(rate, F.lit(FALLBACK_RATE)))
        .select(
            "date", series, "tenor_years", "rate_annual",
            continuous(F.col("rate_annual")).alias("rate_continuous"), "is_trading_day",
        )
    )


def curve_columns(curve: DataFrame, series: str = "series_id") -> DataFrame:
    """One row per day with the annual rate of every tenor as a column."""
    return curve.groupBy("date").agg(
        *[F.max(F.when(F.col(series) == s, F.col("rate_annual"))).alias(s) for s in SERIES_TENORS]
    )


def rate_for_tenor(wide: DataFrame, tenor: Column, extrapolate: str = "const", name: str = "rate") -> DataFrame:
    """Add the annual and the continuous rate at ``tenor`` from the day's curve columns."""
    knots = list(SERIES_TENORS.values())
    annual = fixed_knots(knots, [F.col(s) for s in SERIES_TENORS], tenor, extrapolate)
    return wide.withColumn(f"{name}_annual", annual).withColumn(
        f"{name}_continuous", continuous(F.col(f"{name}_annual"))
    )


def three_month_rate(curve: DataFrame, series: str = "series_id") -> DataFrame:
    """Continuous three-month rate per day, as the pricing of options uses it."""
    return curve.filter(F.col(series) == "DGS3MO").select("date", F.col("rate_continuous").alias("risk_free_rate"))
