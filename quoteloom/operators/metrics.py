"""Counters and alerts over record streams at rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .asof import asof_join
from .blocks import BLOCK_MS, BLOCK_ROWS, HOUR_MS, block_of, carried, inside, join_keys, row_numbers, upto
from .gaps import detect_gaps, forward_fill
from .tables import dedupe

# Upper bounds of the flush-size and duration histograms.
FLUSH_SIZE_BOUNDS = (1.0, 10.0, 50.0, 100.0, 500.0, 1000.0, 5000.0)
DURATION_BOUNDS = (0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0)


def record_counts(df: DataFrame, kind: str, keys: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(keys or []), kind).agg(F.count(F.lit(1)).alias("records"))


def histogram_le(df: DataFrame, value: str, bounds: Sequence[float], keys: list[str] | None = None) -> DataFrame:
    """Cumulative counts per upper bound, the infinite one last (as null)."""
    keys = list(keys or [])
    agg = df.groupBy(*keys).agg(
        *[F.count_if(F.col(value) <= b).alias(f"_le{i}") for i, b in enumerate(bounds)],
        F.count(value).alias("_all"),
        F.sum(value).alias("_sum"),
    )
    packed = F.array(
        *[F.struct(F.lit(float(b)).alias("le"), F.col(f"_le{i}").alias("observations")) for i, b in enumerate(bounds)],
        F.struct(F.lit(None).cast("double").alias("le"), F.col("_all").alias("observations")),
    )
    return agg.select(*keys, F.inline(packed))


def _one_per(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; between differing copies their values decide, so that the result
    does not depend on the order of arrival."""
    return dedupe(df, keys, [c for c in df.columns if c not in keys], "first")


def dataset_profile(tickers: DataFrame, books: DataFrame, trades: DataFrame) -> DataFrame:
    """One row over the three record types; each is deduplicated on its key first."""
    t = _one_per(tickers, ["instrument_name", "timestamp"]).agg(
        F.count(F.lit(1)).alias("ticker_records"),
        F.countDistinct("instrument_name").alias("ticker_instruments"),
        F.count_if(F.col("underlying_price") > 0).alias("valid_underlying"),
        F.min("mark_iv").alias("mark_iv_min"),
        F.max("mark_iv").alias("mark_iv_max"),
        F.avg("mark_iv").alias("mark_iv_mean"),
        F.sum("open_interest").alias("total_open_interest"),
    )
    b = _one_per(books, ["instrument_name", "timestamp"]).agg(
        F.count(F.lit(1)).alias("book_records"), F.avg("bid_levels").alias("avg_bid_levels")
    )
    d = _one_per(trades, ["trade_id"]).agg(
        F.count(F.lit(1)).alias("trade_records"),
        F.min("price").alias("price_min"),
        F.max("price").alias("price_max"),
        F.count_if(F.col("direction") == "buy").alias("buy_orders"),
        F.count_if(F.col("direction") == "sell").alias("sell_orders"),
    )
    parts = t.unionByName(b, allowMissingColumns=True).unionByName(d, allowMissingColumns=True)
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns])


def feed_silence(
    df: DataFrame, feed: str, threshold_ms: int, now_ms: int | None = None, on: str = "timestamp", block_ms: int = BLOCK_MS
) -> DataFrame:
    """Silences of a feed longer than the threshold: when each began, when the alert was
    due and when data came back (null for a silence that lasts until ``now_ms``)."""
    gaps = detect_gaps(df, threshold_ms, on, [feed], instrument="", block_ms=block_ms).select(
        feed,
        F.col("gap_start").alias("silent_from"),
        (F.col("gap_start") + threshold_ms).alias("alert_at"),
        F.col("gap_end").alias("resumed_at"),
        F.col("gap_duration_ms").alias("silence_ms"),
    )
    if now_ms is None:
        return gaps
    last = F.max(on).cast("long")
    open_end = (
        df.groupBy(feed)
        .agg(last.alias("silent_from"))
        .filter(F.lit(now_ms) - F.col("silent_from") > threshold_ms)
        .select(
            feed,
            "silent_from",
            (F.col("silent_from") + threshold_ms).alias("alert_at"),
            F.lit(None).cast("long").alias("resumed_at"),
            (F.lit(now_ms) - F.col("silent_from")).alias("silence_ms"),
        )
    )
    return gaps.unionByName(open_end)


def failure_streaks(
    df: DataFrame, ok: Column, order_by: str, threshold: int, keys: list[str] | None = None, width: int = BLOCK_ROWS
) -> DataFrame:
    """Runs of failures between successes: first and last position, length, and whether
    the length reaches the alert threshold."""
    keys = list(keys or [])
    marked = df.select(*keys, order_by, F.when(ok, F.col(order_by)).alias("_ok"))
    filled = forward_fill(
        marked.withColumn("_run", F.col("_ok")), ["_run"], order_by, keys, width
    ).filter(F.col("_ok").isNull())
    return (
        filled.groupBy(*keys, "_run")
        .agg(
            F.min(order_by).alias("first_failure"),
            F.max(order_by).alias("last_failure"),
            F.count(F.lit(1)).alias("failures"),
        )
        .withColumn("alert", F.col("failures") >= threshold)
        .drop("_run")
    )


def snapshots(df: DataFrame, keys: list[str], step_ms: int = 1000, on: str = "timestamp", seq: str | None = None) -> DataFrame:
    """Latest row per key within each step that has one."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(F.col(on), *([F.col(seq)] if seq else []))
    picked = df.groupBy(*keys, (block_of(F.col(on), step_ms) * step_ms).alias("snapshot_ts")).agg(
        F.max_by(F.struct(*rest), rank).alias("_row")
    )
    return picked.select(*keys, "snapshot_ts", *[F.col(f"_row.{c}").alias(c) for c in rest])


def filled_snapshots(
    df: DataFrame, keys: list[str], columns: list[str], step_ms: int = 1000, on: str = "timestamp",
    seq: str | None = None, block_ms: int = BLOCK_MS,
) -> DataFrame:
    """The state at every step from a key's first to its last row: an unchanged value is
    repeated, with its age.

    The steps are laid out hour by hour from the hours a key spans, so no single row
    expands into its whole history.
    """
    span = df.groupBy(*keys).agg(F.min(on).cast("long").alias("_lo"), F.max(on).cast("long").alias("_hi"))
    chunk = max(step_ms, (HOUR_MS // step_ms) * step_ms)
    first = block_of(F.col("_lo") - 1, step_ms) + 1  # first step at or after the first row
    hours = span.withColumn("_h", F.explode(F.sequence(block_of(F.col("_lo"), chunk), block_of(F.col("_hi"), chunk))))
    # Spread the hours before they expand: a key with a long history must not expand in
    # the one task that knows its span.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hours = hours.repartition(tasks, *keys, "_h")
    low = F.greatest(F.col("_h") * chunk, first * step_ms)
    high = F.least(F.col("_h") * chunk + chunk - 1, F.col("_hi"))
    spine = hours.filter(low <= high).select(
        *keys, F.explode(F.sequence(low, high, F.lit(step_ms).cast("long"))).alias(on)
    )
    return asof_join(spine, df, on, keys, "backward", None, columns, seq, block_ms=block_ms)


def admission_check(df: DataFrame, key: str, order_by: str, limit: int, width: int = BLOCK_ROWS) -> DataFrame:
    """What a cap of ``limit`` keys would have admitted: rows with ``keys_seen``, the distinct
    keys up to the row, and ``admitted``, whether its key is among the first ``limit`` to
    arrive.  Nothing is dropped.

    First arrivals come from one aggregation per key; the running count is that of the blocks
    before plus that inside the block.  ``order_by`` is a unique integer; a null key is a key.
    """
    first = df.groupBy(key).agg(F.min(order_by).alias("_first"))
    ranked = row_numbers(first, [], "_first", width).withColumnRenamed("_rn", "_rank")
    marked = join_keys(df, ranked, [key]).withColumns(
        {"_new": (F.col(order_by) == F.col("_first")).cast("long"), "_block": block_of(F.col(order_by), width)}
    )
    sizes = marked.groupBy("_block").agg(F.sum("_new").alias("_n"))
    earlier = carried(sizes, [], {"_before": ("sum", "_n")})
    inner = F.sum("_new").over(upto(inside([], order_by)))
    counted = join_keys(marked.withColumn("_inner", inner), earlier, [], plain=("_block",))
    seen = F.col("_inner") + F.coalesce("_before", F.lit(0))
    return counted.select(*df.columns, seen.cast("long").alias("keys_seen"), (F.col("_rank") < limit).alias("admitted"))
