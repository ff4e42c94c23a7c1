"""How many past values lie at or below each asked one, in a window of time, without pairs.

The count in a window is the count up to its end less the count up to its start, so every
asked row puts two questions of one kind: how many history rows come before this event both
in time and in value.  Everything is an event with two places, one in the order by time and
one in the order by value, and both orders start with the series: rows of other series count
alike for both questions and cancel out.

Each order is cut into blocks of at most 2**17 places.  For an event the rows before it in
both orders are

* those of its own time block, counted inside that block;
* those of its own value block and of earlier time blocks, counted inside that value block;
* those of earlier blocks in both, which is the same question about the cells of the grid of
  blocks, with the rows of a cell as its weight: far fewer events, asked in the same way.

Places are unique, so neither a value, a time nor a series that holds most of the rows makes
a block larger.  A row is sorted twice and dealt twice, whatever the window holds.  The grid
of a series has the square of its blocks as cells, at most its rows: far less than the rows
for series of up to some 2**33 of them, beyond which ``bits`` should be raised.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir
from .blocks import across, before, with_position

BLOCK_BITS = 17

# id and sign are null in history rows; weight is 0 in questions.
_EVENT = ["id", "sign", "weight", "x", "y"]
_COUNTED = "id long, below long"


def earlier_and_lower(y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """For rows in the order of x: the weight of all earlier rows with a smaller y.

    One pass per bit of the place in x: the rows that agree in the higher bits and have this
    bit unset lie before those that have it set.
    """
    n = len(y)
    place = np.argsort(y, kind="stable")  # places in x, by rising y
    total = np.zeros(n, np.int64)
    for bit in range(max(n - 1, 0).bit_length()):
        by_node = np.argsort(place >> (bit + 1), kind="stable")
        at = place[by_node]
        later = (at >> bit) & 1 == 1
        running = np.cumsum(np.where(later, 0, weight[at]))
        node = at >> (bit + 1)
        starts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        base = np.repeat(np.concatenate([[0], running])[starts], np.diff(np.append(starts, n)))
        total[at[later]] += (running - base)[later]
    return total


def _questions(events: pa.Table, below: np.ndarray) -> pa.Table:
    sign = events.column("sign").to_numpy(zero_copy_only=False)
    asked = ~np.isnan(sign.astype(float))
    ids = events.column("id").filter(pa.array(asked))
    signed = below[asked] * sign[asked].astype(np.int64)
    return pa.table({"id": ids.cast(pa.int64()), "below": pa.array(signed, pa.int64())})


def _columns(events: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(events.column(c).to_numpy() for c in ("x", "y", "weight"))


def _inside_time_block(events: pa.Table) -> pa.Table:
    events = events.sort_by("x")
    _, y, weight = _columns(events)
    return _questions(events, earlier_and_lower(y, weight))


def _inside_value_block(bits: int):
    def count(events: pa.Table) -> pa.Table:
        x, y, weight = _columns(events)
        # Rows of the same time block are counted there: questions stand before them.
        events = events.take(pa.array(np.lexsort((weight > 0, x >> bits))))
        _, y, weight = _columns(events)
        return _questions(events, earlier_and_lower(y, weight))

    return count


def _block(place: str, bits: int) -> Column:
    return F.shiftright(place, bits)


def _placed(events: DataFrame, x: list, y: list) -> DataFrame:
    """Events with their places in both orders."""
    by_x = with_position(events, x, "x")
    return with_position(by_x, y, "y").select(*_EVENT)


def _dominated(events: DataFrame, bits: int) -> DataFrame:
    """(id, below): per question the signed weight of the rows before it in both orders; an id
    may have several rows."""
    if events.limit((1 << bits) + 1).count() <= 1 << bits:
        return events.withColumn("tb", F.lit(0)).groupBy("tb").applyInArrow(_inside_time_block, _COUNTED)
    blocked = events.withColumns({"tb": _block("x", bits), "vb": _block("y", bits)})
    near = blocked.groupBy("tb").applyInArrow(_inside_time_block, _COUNTED)
    aside = blocked.groupBy("vb").applyInArrow(_inside_value_block(bits), _COUNTED)

    asked = F.col("sign").isNotNull()
    full = blocked.where(~asked).groupBy("tb", "vb").agg(F.sum("weight").alias("weight"))
    cells = blocked.where(asked).select("tb", "vb").distinct().withColumn("id", F.monotonically_increasing_id())
    cells = cells.checkpoint()  # the numbers are used twice
    points = cells.withColumns({"sign": F.lit(1), "weight": F.lit(0).cast("long")}).unionByName(full, allowMissingColumns=True)
    # Only earlier blocks count, so a question stands before the rows of its own block.
    first = F.col("sign").isNull()
    points = _placed(points.withColumn("kind", first), ["tb", "kind"], ["vb", "kind"])
    far = _dominated(points, bits).groupBy("id").agg(F.sum("below").alias("below"))
    far = far.join(cells, "id").select("tb", "vb", "below")
    far = blocked.where(asked).select("id", "sign", "tb", "vb").join(far, ["tb", "vb"]).select("id", (F.col("sign") * F.col("below")).alias("below"))
    return near.unionByName(aside).unionByName(far)


def _in_window(events: DataFrame, bits: int) -> DataFrame:
    """(id, total): per asked row the signed number of history rows before its questions in
    time alone: rows of earlier blocks by a running sum over the blocks, then inside."""
    blocked = events.withColumn("tb", _block("x", bits))
    sizes = blocked.groupBy("tb").agg(F.sum("weight").alias("rows"))
    bases = sizes.withColumn("base", F.coalesce(F.sum("rows").over(before(across([], "tb"))), F.lit(0)))

    def count(own: pa.Table) -> pa.Table:
        own = own.sort_by("x")
        return _questions(own, np.cumsum(own.column("weight").to_numpy()))

    inside = blocked.groupBy("tb").applyInArrow(count, _COUNTED).select("id", F.col("below").alias("total"))
    asked = blocked.where(F.col("sign").isNotNull()).select("id", "sign", "tb")
    return inside.unionByName(asked.join(bases, "tb").select("id", (F.col("sign") * F.col("base")).alias("total")))


def count_at_or_below(
    current: DataFrame, history: DataFrame, series: list[str], value: str, past: str, since: Column | None, until: Column | None,
    on: str, bits: int = BLOCK_BITS,
) -> DataFrame:
    """``current`` with ``_below`` and ``_total``: history rows of its series with a time in
    (since, until], those at or below ``value`` and all.

    ``since`` and ``until`` are expressions over ``current``; None leaves the window open on
    that side.  A null bound, or a null ``value`` for ``_below``, gives 0.  History rows
    without a value count nowhere; those without a time only where both sides are open.
    Null series are series like any other.  ``current`` is written to the shared folder once
    and numbered there; ``history`` is read once.
    """
    shared_dir(current.sparkSession)
    numbered = current.withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    past_rows = history.where(F.col(past).isNotNull())
    if since is None and until is None:
        when = F.lit(0).cast("long")
    else:
        when = F.col(on).cast("long")
        past_rows = past_rows.where(F.col(on).isNotNull())
    least, most = -(1 << 63), (1 << 63) - 1
    bounds = F.array(
        F.struct(F.lit(1).alias("sign"), (F.lit(most) if until is None else until.cast("long")).alias("_when")),
        F.struct(F.lit(-1).alias("sign"), (F.lit(least) if since is None else since.cast("long")).alias("_when")),
    )
    whole = F.lit(True)
    for bound in (since, until):
        whole = whole & (F.lit(True) if bound is None else bound.isNotNull())
    asked = numbered.where(whole).select(
        *series, F.col(value).cast("double").alias("_value"), F.col("_id").alias("id"), F.lit(0).cast("long").alias("weight"), F.inline(bounds)
    )
    rows = past_rows.select(
        *series, F.col(past).cast("double").alias("_value"), F.lit(1).cast("long").alias("weight"), when.alias("_when")
    )
    # At equal times and values history rows stand before the questions, which count them.
    both = asked.unionByName(rows, allowMissingColumns=True).withColumn("_asked", F.col("sign").isNotNull())
    both = both.select("id", "sign", "weight", "_when", "_value", "_asked", *[F.col(k).alias(f"_s{i}") for i, k in enumerate(series)])
    own = [f"_s{i}" for i in range(len(series))]
    events = _placed(both, [*own, "_when", "_asked"], [*own, "_value", "_asked"])
    below = _dominated(events, bits).withColumn("total", F.lit(0).cast("long"))
    total = _in_window(events, bits).withColumn("below", F.lit(0).cast("long"))
    sums = below.unionByName(total).groupBy("id").agg(F.sum("below").alias("_below"), F.sum("total").alias("_total"))
    out = numbered.join(sums.withColumnRenamed("id", "_id"), "_id", "left").drop("_id")
    return out.withColumns({c: F.coalesce(c, F.lit(0).cast("long")) for c in ("_below", "_total")})
