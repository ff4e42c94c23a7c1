"""Gaps in a time series, and filling of holes in its columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .blocks import BLOCK_MS, BLOCK_ROWS, across, block_of, carried, inside, join_keys, row_numbers, upto

# These columns are forward-filled, other numeric ones interpolated.
FORWARD_FILLED = ("open", "high", "low", "close", "volume")
_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def present(df: DataFrame, columns: list[str]) -> DataFrame:
    """NaN as null in the listed columns: to Spark a NaN is a value above all others."""
    kinds = dict(df.dtypes)
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in columns if kinds[c] in ("float", "double")})


def detect_gaps(
    df: DataFrame,
    threshold_ms: int = 60_000,
    on: str = "timestamp",
    keys: list[str] | None = None,
    instrument: str = "instrument",
    seq: str | None = None,
    block_ms: int = BLOCK_MS,
) -> DataFrame:
    """Consecutive rows more than ``threshold_ms`` apart, with the distinct instruments
    of the two rows around the gap (empty when there is no such column)."""
    keys = list(keys or [])
    named = instrument in df.columns
    order = F.struct(F.col(seq) if seq else F.lit(0), *([F.col(instrument)] if named else []))
    instants = (
        df.filter(F.col(on).isNotNull())
        .groupBy(*keys, F.col(on).cast("long").alias("_ts"))
        .agg(
            (F.min_by(instrument, order) if named else F.lit(None).cast("string")).alias("_first"),
            (F.max_by(instrument, order) if named else F.lit(None).cast("string")).alias("_last"),
        )
        .withColumn("_block", block_of(F.col("_ts"), block_ms))
    )
    local = inside(keys, "_ts")
    near = instants.select(
        *keys,
        F.lag("_ts").over(local).alias("gap_start"),
        F.col("_ts").alias("gap_end"),
        F.lag("_last").over(local).alias("_from"),
        F.col("_first").alias("_to"),
    )
    edges = instants.groupBy(*keys, "_block").agg(
        F.min("_ts").alias("_lo"),
        F.max("_ts").alias("_hi"),
        F.min_by("_first", "_ts").alias("_first"),
        F.max_by("_last", "_ts").alias("_last"),
    )
    far = edges.select(
        *keys,
        F.lag("_hi").over(across(keys)).alias("gap_start"),
        F.col("_lo").alias("gap_end"),
        F.lag("_last").over(across(keys)).alias("_from"),
        F.col("_first").alias("_to"),
    )
    gap = F.col("gap_end") - F.col("gap_start")
    affected = (
        F.array_distinct(F.array("_from", "_to")) if named else F.array().cast("array<string>")
    )
    return (
        near.unionByName(far)
        .filter(gap > threshold_ms)
        .select(
            *keys,
            "gap_start",
            "gap_end",
            gap.alias("gap_duration_ms"),
            affected.alias("affected_instruments"),
        )
    )


def forward_fill(
    df: DataFrame,
    columns: list[str],
    order_by: str,
    keys: list[str] | None = None,
    width: int = BLOCK_ROWS,
) -> DataFrame:
    """Replace nulls (and NaN, which is a missing value) by the last earlier value; leading
    ones stay null.

    ``order_by`` is an integer that is unique within the keys.
    """
    keys = list(keys or [])
    blocked = present(df, columns).withColumn("_block", block_of(F.col(order_by), width))
    ends = blocked.groupBy(*keys, "_block").agg(
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order_by))).alias(f"_end_{c}")
            for c in columns
        ]
    )
    carry = carried(ends, keys, {f"_carry_{c}": ("last", f"_end_{c}") for c in columns})
    local = upto(inside(keys, order_by))
    filled = blocked.withColumns({c: F.last(c, ignorenulls=True).over(local) for c in columns})
    return (
        join_keys(filled, carry, [*keys, "_block"])
        .withColumns({c: F.coalesce(c, f"_carry_{c}") for c in columns})
        .select(*df.columns)
    )


def interpolate_linear(
    df: DataFrame,
    columns: list[str],
    order_by: str,
    keys: list[str] | None = None,
    width: int = BLOCK_ROWS,
) -> DataFrame:
    """Fill nulls and NaN on the straight line between the neighbouring values, by row
    position.

    Leading nulls stay, trailing ones take the last value.  The result is double.
    """
    keys = list(keys or [])
    numbered = row_numbers(present(df, columns), keys, order_by, width).withColumn(
        "_block", block_of(F.col("_rn"), width)
    )

    def known(c: str) -> Column:
        return F.when(
            F.col(c).isNotNull(), F.struct(F.col("_rn").alias("n"), F.col(c).cast("double").alias("v"))
        )

    edges = numbered.groupBy(*keys, "_block").agg(
        *[F.min(known(c)).alias(f"_head_{c}") for c in columns],
        *[F.max(known(c)).alias(f"_tail_{c}") for c in columns],
    )
    carry = carried(
        edges,
        keys,
        {f"_cb_{c}": ("last", f"_tail_{c}") for c in columns} | {f"_ca_{c}": ("next", f"_head_{c}") for c in columns},
        supers=None,
    )
    forth, back = upto(inside(keys, "_rn")), upto(inside(keys, "_rn", reverse=True))
    around = numbered.withColumns(
        {
            **{f"_b_{c}": F.last(known(c), ignorenulls=True).over(forth) for c in columns},
            **{f"_a_{c}": F.last(known(c), ignorenulls=True).over(back) for c in columns},
        }
    )
    around = join_keys(around, carry, [*keys, "_block"])
    around = around.withColumns(
        {
            **{f"_b_{c}": F.coalesce(f"_b_{c}", f"_cb_{c}") for c in columns},
            **{f"_a_{c}": F.coalesce(f"_a_{c}", f"_ca_{c}") for c in columns},
        }
    )

    def on_line(c: str) -> Column:
        b, a = F.col(f"_b_{c}"), F.col(f"_a_{c}")
        share = (F.col("_rn") - b["n"]) / F.nullif(a["n"] - b["n"], F.lit(0).cast("long"))
        return (
            F.when(F.col(c).isNotNull(), F.col(c).cast("double"))
            .when(b.isNull(), F.lit(None).cast("double"))
            .when(a.isNull(), b["v"])
            .otherwise(b["v"] + (a["v"] - b["v"]) * share)
        )

    return around.withColumns({c: on_line(c) for c in columns}).select(*df.columns)


def fill_gaps(
    df: DataFrame, order_by: str, keys: list[str] | None = None, width: int = BLOCK_ROWS
) -> DataFrame:
    """Forward-fill the candle columns and interpolate every other numeric column."""
    keys = list(keys or [])
    steps = [c for c in df.columns if c in FORWARD_FILLED]
    lines = [
        c
        for c, kind in df.dtypes
        if kind in _NUMERIC and c not in (*steps, *keys, order_by)
    ]
    out = forward_fill(df, steps, order_by, keys, width) if steps else df
    return interpolate_linear(out, lines, order_by, keys, width) if lines else out
