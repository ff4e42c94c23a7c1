"""Continuity of a time series: gaps, order, duplicates, coverage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import BLOCK_MS, BLOCK_ROWS, HOUR_MS, across, block_of, carried, inside, join_keys

GAP_TOLERANCE = 3.0
COVERAGE_OK = 50.0


def continuity_stats(
    df: DataFrame,
    on: str = "timestamp",
    keys: list[str] | None = None,
    block_ms: int = BLOCK_MS,
) -> DataFrame:
    """Per key: rows, first and last time, distinct times, repeats, largest gap and where
    it starts (the earliest of equal ones)."""
    keys = list(keys or [])
    instants = (
        df.filter(F.col(on).isNotNull())
        .groupBy(*keys, F.col(on).cast("long").alias("_ts"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_block", block_of(F.col("_ts"), block_ms))
    )
    stepped = instants.withColumn("_prev", F.lag("_ts").over(inside(keys, "_ts")))
    step = F.col("_ts") - F.col("_prev")
    blocks = stepped.groupBy(*keys, "_block").agg(
        F.sum("_n").alias("_n"),
        F.count(F.lit(1)).alias("_u"),
        F.min("_ts").alias("_lo"),
        F.max("_ts").alias("_hi"),
        F.max(F.when(step.isNotNull(), F.struct(step.alias("gap"), (-F.col("_prev")).alias("at")))).alias("_in"),
    )
    edge = F.col("_lo") - F.lag("_hi").over(across(keys))
    joined = blocks.select(
        "*",
        F.when(edge.isNotNull(), F.struct(edge.alias("gap"), (-F.lag("_hi").over(across(keys))).alias("at"))).alias("_x"),
    )
    return (
        joined.groupBy(*keys)
        .agg(
            F.sum("_n").cast("long").alias("total_rows"),
            F.sum("_u").cast("long").alias("unique_ts"),
            F.min("_lo").alias("ts_min"),
            F.max("_hi").alias("ts_max"),
            F.max(F.greatest("_in", "_x")).alias("_gap"),
        )
        .select(
            *keys,
            "total_rows",
            "unique_ts",
            (F.col("total_rows") - F.col("unique_ts")).alias("dup_count"),
            "ts_min",
            "ts_max",
            F.coalesce("_gap.gap", F.lit(0).cast("long")).alias("max_gap_ms"),
            F.when(F.col("_gap.gap") > 0, -F.col("_gap.at")).alias("max_gap_at"),
        )
    )


def arrival_order(
    df: DataFrame,
    arrival: str,
    on: str = "timestamp",
    keys: list[str] | None = None,
    width: int = BLOCK_ROWS,
) -> DataFrame:
    """Per key: number of rows earlier than the row that arrived just before, and
    ``monotonic`` = there is none.  ``arrival`` is an integer unique within the keys."""
    return _steps(df, arrival, on, list(keys or []), width, lambda a, b: a < b, "backward_steps", "monotonic")


def _steps(
    df: DataFrame, arrival: str, on: str, keys: list[str], width: int,
    breaks: Callable[[Column, Column], Column], count: str, flag: str,
) -> DataFrame:
    """Number of neighbouring rows (in order of arrival) whose times break the order."""
    blocked = df.select(
        *keys, F.col(on).alias("_ts"), F.col(arrival).alias("_a"), block_of(F.col(arrival), width).alias("_block")
    )
    stepped = blocked.withColumn("_prev", F.lag("_ts").over(inside(keys, "_a")))
    blocks = stepped.groupBy(*keys, "_block").agg(
        F.count_if(breaks(F.col("_ts"), F.col("_prev"))).alias("_bad"),
        F.min_by("_ts", "_a").alias("_first"),
        F.max_by("_ts", "_a").alias("_last"),
    )
    # The row before a block stands at the end of the block before, null or not.
    ends = blocks.withColumn("_end", F.struct("_last"))
    before_it = carried(ends, keys, {"_prior": ("last", "_end")})
    crossed = join_keys(blocks, before_it, [*keys, "_block"]).withColumn(
        "_x", F.when(breaks(F.col("_first"), F.col("_prior._last")), 1).otherwise(0)
    )
    bad = F.sum(F.col("_bad") + F.col("_x")).cast("long")
    return crossed.groupBy(*keys).agg(bad.alias(count), (bad == 0).alias(flag))


def non_increasing_steps(
    df: DataFrame, arrival: str, on: str = "timestamp", keys: list[str] | None = None, width: int = BLOCK_ROWS
) -> DataFrame:
    """Per key: rows whose time is not after that of the row before, and whether the
    series is strictly increasing.  ``arrival`` as in ``arrival_order``."""
    return _steps(df, arrival, on, list(keys or []), width, lambda a, b: a <= b, "bad_steps", "strictly_increasing")


def continuity_issues(stats: DataFrame, expected_ms: Column, tolerance: float = GAP_TOLERANCE) -> DataFrame:
    """Add the list of issues to the joined output of the two operators above."""
    found = F.array(
        F.when(
            F.col("max_gap_ms") > expected_ms * tolerance,
            F.concat(
                F.lit("Max gap "), F.round(F.col("max_gap_ms") / 1000).cast("long").cast("string"), F.lit("s")
            ),
        ),
        F.when(~F.col("monotonic"), F.lit("Timestamps not monotonically increasing")),
        F.when(
            F.col("dup_count") > 0,
            F.concat(F.col("dup_count").cast("string"), F.lit(" duplicate timestamps")),
        ),
    )
    return stats.withColumn("issues", F.array_compact(found))


def coverage(stats: DataFrame, expected_sec: Column, multi_instrument: Column) -> DataFrame:
    """Observed share of the expected intervals in percent; OK above one half."""
    hours = (F.col("ts_max") - F.col("ts_min")) / F.lit(float(HOUR_MS))
    expected = hours * 3600 / expected_sec
    seen = F.when(multi_instrument, F.col("unique_ts")).otherwise(F.col("total_rows"))
    return (
        stats.withColumns({"hours": hours, "intervals": seen})
        .withColumn(
            "coverage_pct",
            F.when(expected > 0, F.try_divide(seen, expected) * 100).otherwise(F.lit(0.0)),
        )
        .withColumn("coverage_status", F.when(F.col("coverage_pct") > COVERAGE_OK, "OK").otherwise("LOW"))
    )


def ohlc_violations(df: DataFrame) -> DataFrame:
    """Candles whose high or low contradicts the other prices."""
    ok = (
        (F.col("high") >= F.col("open"))
        & (F.col("high") >= F.col("close"))
        & (F.col("high") >= F.col("low"))
        & (F.col("low") <= F.col("open"))
        & (F.col("low") <= F.col("close"))
    )
    return df.filter(~ok)
