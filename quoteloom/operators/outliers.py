"""Rolling z-score outlier flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import BLOCK_ROWS, block_of, inside, row_numbers, upto
from .gaps import present


def _moments(c: str, frame) -> Column:
    """Count, mean and sum of squared deviations of the non-null values in a frame."""
    n = F.count(c).over(frame).cast("double")
    return F.struct(
        n.alias("n"),
        F.coalesce(F.avg(c).over(frame), F.lit(0.0)).alias("mean"),
        F.coalesce(F.var_pop(c).over(frame) * n, F.lit(0.0)).alias("dev"),
    )


def flag_outliers(
    df: DataFrame,
    columns: list[str],
    order_by: str,
    keys: list[str] | None = None,
    threshold: float = 5.0,
    window: int = 100,
    width: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``is_outlier``: |z| above ``threshold`` in any of ``columns``, where z uses the
    mean and sample deviation of the last ``window`` rows including the current one.

    Absent columns are skipped, null and NaN values count in no window.  Rows are numbered per key; each block of numbers also
    receives the ``window - 1`` rows before it, so no window crosses a block edge.

    A sliding frame would visit ``window`` rows for every row.  Instead the numbers are
    cut into runs of ``window`` rows: the last ``window`` rows are the head of the
    current run up to here and the tail of the run before from ``window - 1`` rows ago.
    Heads and tails are running frames, and two sets of moments add up exactly (Chan,
    Golub and LeVeque), without the cancellation of differences of prefix sums.
    """
    keys = list(keys or [])
    used = [c for c in columns if c in df.columns]
    if not used:
        return df.withColumn("is_outlier", F.lit(False))
    width = -(-max(width, window) // window) * window  # runs must not straddle blocks
    # NaN is a missing value here: to Spark it is above every threshold.
    clean = present(df.withColumns({f"_v_{c}": F.col(c) for c in used}), [f"_v_{c}" for c in used])
    numbered = row_numbers(clean, keys, order_by, width)
    home = block_of(F.col("_rn"), width)
    lent = F.pmod(F.col("_rn"), F.lit(width)) >= width - (window - 1)
    spread = (
        numbered.withColumn(
            "_block", F.explode(F.when(lent, F.array(home, home + 1)).otherwise(F.array(home)))
        )
        .repartition(*keys, "_block")  # serves all three windows below
        .withColumn("_run", block_of(F.col("_rn"), window))
    )
    run = Window.partitionBy(*keys, "_block", "_run")
    tail = upto(run.orderBy(F.desc("_rn")))
    head = upto(run.orderBy("_rn"))
    staged = spread.withColumns({f"_tail_{c}": _moments(f"_v_{c}", tail) for c in used})
    staged = staged.withColumns({f"_head_{c}": _moments(f"_v_{c}", head) for c in used})
    staged = staged.withColumns(
        {f"_tail_{c}": F.lag(f"_tail_{c}", window - 1).over(inside(keys, "_rn")) for c in used}
    )
    whole_run = F.pmod(F.col("_rn"), F.lit(window)) == window - 1

    def extreme(c: str) -> Column:
        def part(name: str) -> Column:
            return F.when(whole_run, 0.0).otherwise(F.coalesce(F.col(f"_tail_{c}.{name}"), F.lit(0.0)))

        h = F.col(f"_head_{c}")
        n = h["n"] + part("n")
        apart = part("mean") - h["mean"]
        mean = h["mean"] + apart * F.try_divide(part("n"), n)
        dev = h["dev"] + part("dev") + apart * apart * F.try_divide(h["n"] * part("n"), n)
        # With an empty side its mean means nothing: take the other side as it is.
        mean = F.when(part("n") == 0, h["mean"]).when(h["n"] == 0, part("mean")).otherwise(mean)
        dev = F.when(part("n") == 0, h["dev"]).when(h["n"] == 0, part("dev")).otherwise(dev)
        deviation = F.when(n > 1, F.nullif(F.sqrt(dev / F.nullif(n - 1, F.lit(0.0))), F.lit(0.0)))
        return F.coalesce(F.abs((F.col(f"_v_{c}") - mean) / deviation) > threshold, F.lit(False))

    flag = extreme(used[0])
    for c in used[1:]:
        flag = flag | extreme(c)
    return (
        staged.withColumn("is_outlier", flag)
        .filter(F.col("_block") == home)
        .select(*df.columns, "is_outlier")
    )


def outliers_only(df: DataFrame, columns: list[str], order_by: str, **options) -> DataFrame:
    return flag_outliers(df, columns, order_by, **options).filter("is_outlier")
