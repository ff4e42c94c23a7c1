"""Ordered computations without funnelling a key through one task.

A window over a whole key (or over no key at all) puts that key's rows into one task.
The operators here cut the order axis into blocks of fixed width instead, work inside
(keys, block), and pass what crosses a block edge through a summary of one row per block.

The size of a (keys, block) group is bounded by the block width wherever the order
column is a unique integer within its keys: a width of W holds at most W distinct
integers.  Operators on event time first reduce to one row per (keys, timestamp), which
gives the same bound; operators on row position take such an integer as ``order_by``,
and ``with_position`` makes one where the data has none.

Where the order is sparse (epoch milliseconds of hourly rows), a block holds a row or two
and the summary is as long as the table.  So the summary is cut into superblocks of blocks
in the same way (``carried``), and only one row per superblock and key meets in one window:
2**40 units of the order each, which is 35 years of milliseconds.  Null keys are a key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir

HOUR_MS = 3_600_000
# Ten minutes: at most 600 000 distinct times per key and block, and about fifty thousand
# summary rows per key and year.
BLOCK_MS = 600_000
BLOCK_ROWS = 1 << 18
SUPER_BLOCKS = 1 << 22


def block_of(order: Column, width: int) -> Column:
    """Floor division that stays in integers (also for negative and very large values)."""
    order = order.cast("long")
    return F.call_function("div", order - F.pmod(order, F.lit(width)), F.lit(width))


def inside(keys: list[str], order_by: str, block: str = "_block", reverse: bool = False):
    """Window inside one block.  To look at later rows, walk the block in reverse with the
    frame ``upto``: a frame that starts at the current row and runs to the end would be
    evaluated from scratch for every row."""
    return Window.partitionBy(*keys, block).orderBy(F.desc(order_by) if reverse else F.asc(order_by))


def across(keys: list[str], block: str = "_block", reverse: bool = False):
    """Window over a summary with one row per block; with no keys it has no partition,
    which is fine for a summary and only for a summary."""
    spec = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    return spec.orderBy(F.desc(block) if reverse else F.asc(block))


def before(spec):
    return spec.rowsBetween(Window.unboundedPreceding, -1)


def upto(spec):
    return spec.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def join_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", plain: tuple[str, ...] = ()) -> DataFrame:
    """Equi-join on ``keys`` in which null meets null; the left side's keys stay.  ``plain``
    are further columns to join on, in which a null meets nothing."""
    named = right.withColumnsRenamed({k: f"_key_{k}" for k in (*keys, *plain)})
    tests = [left[k].eqNullSafe(named[f"_key_{k}"]) for k in keys] + [left[k] == named[f"_key_{k}"] for k in plain]
    same = reduce(lambda a, b: a & b, tests, F.lit(True))
    return left.join(named, same, how).drop(*[f"_key_{k}" for k in (*keys, *plain)])


def carried(summary: DataFrame, keys: list[str], values: dict[str, tuple[str, str]], supers: int | None = SUPER_BLOCKS) -> DataFrame:
    """Per (keys, _block): what the other blocks of the key hand over.

    ``values`` maps a new column to (kind, column of the summary): ``sum`` adds up the earlier
    blocks, ``last`` is the last non-null value before, ``next`` the first non-null after.
    Where blocks are cut from dense row numbers, a superblock would hold 2**40 rows of a key;
    without ``supers`` the summary is read once, in one window per key.
    """

    def over(kind: str, c: str, by: list[str], order: str) -> Column:
        if kind == "sum":
            return F.sum(c).over(before(inside(by[:-1], order, by[-1]) if by else across(keys, order)))
        reverse = kind == "next"
        spec = inside(by[:-1], order, by[-1], reverse) if by else across(keys, order, reverse)
        return F.last(c, ignorenulls=True).over(before(spec))

    if supers is None:
        handed = {n: over(kind, c, [], "_block") for n, (kind, c) in values.items()}
        return summary.select(*keys, "_block", *[(F.coalesce(x, F.lit(0)) if values[n][0] == "sum" else x).alias(n) for n, x in handed.items()])

    cut = summary.withColumn("_super", block_of(F.col("_block"), supers))
    whole = {"sum": lambda c: F.sum(c), "last": lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_block"))), "next": lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("_block")))}
    tops = cut.groupBy(*keys, "_super").agg(*[whole[kind](c).alias(f"_t_{n}") for n, (kind, c) in values.items()])
    tops = tops.select(*keys, "_super", *[over(kind, f"_t_{n}", [], "_super").alias(f"_o_{n}") for n, (kind, _) in values.items()])
    near = cut.select(*keys, "_block", "_super", *[over(kind, c, [*keys, "_super"], "_block").alias(n) for n, (kind, c) in values.items()])
    both = join_keys(near, tops, [*keys, "_super"])

    def merged(n: str, kind: str) -> Column:
        if kind == "sum":
            return (F.coalesce(n, F.lit(0)) + F.coalesce(f"_o_{n}", F.lit(0))).alias(n)
        return F.coalesce(n, f"_o_{n}").alias(n)

    return both.select(*keys, "_block", *[merged(n, kind) for n, (kind, _) in values.items()])


def row_numbers(
    df: DataFrame, keys: list[str], order_by: str, width: int = BLOCK_ROWS, name: str = "_rn"
) -> DataFrame:
    """Add the dense 0-based row number per key: block-local number + rows before it."""
    blocked = df.withColumn("_block", block_of(F.col(order_by), width))
    sizes = blocked.groupBy(*keys, "_block").agg(F.count(F.lit(1)).alias("_n"))
    offsets = carried(sizes, keys, {"_offset": ("sum", "_n")})
    local = blocked.withColumn(name, F.row_number().over(inside(keys, order_by)))
    return (
        join_keys(local, offsets, [*keys, "_block"])
        .withColumn(name, (F.coalesce("_offset", F.lit(0)) + F.col(name) - 1).cast("long"))
        .drop("_block", "_offset")
    )


def with_position(df: DataFrame, order_by: list[str], name: str = "position") -> DataFrame:
    """Add a unique integer that follows ``order_by`` (name enough columns to break ties).

    The rows are range-partitioned by the whole order, so no value or key can make a
    partition large, and the numbered table is checkpointed once in the shared folder:
    every later reader sees the same numbers even after executors are lost.  Numbers
    grow by one inside a partition and jump between partitions.
    """
    shared_dir(df.sparkSession)
    return df.orderBy(*order_by).withColumn(name, F.monotonically_increasing_id()).checkpoint()
