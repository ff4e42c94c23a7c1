"""Extendible hashing: shards that fit a byte limit, found by splitting only what doesn't.

A row's address is a bit string: the hash of its key, then the hash of its position in the
table, so that even one key with a third of the rows can be split.  A shard is a prefix of
addresses.  The directory grows in rounds of a few bits: only addresses in buckets that are
still too large are counted on the next bits, and the shortest prefix that fits closes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged

KEY_BITS, ADDRESS_BITS = 32, 60
ROUND_BITS = 8
MAX_BYTES = 1 << 20


def _prefix(depth: int) -> Column:
    return F.shiftright("address", ADDRESS_BITS - depth)


def addressed(docs: DataFrame, key: list[str], id_col: str, text_col: str, carry: bool) -> DataFrame:
    """doc_id, n_bytes and the 60-bit address of every row, in the shared folder; with
    ``carry`` also the row itself, as one address can't be worked out a second time."""
    name = F.concat_ws("\x1f", *[F.coalesce(F.col(k).cast("string"), F.lit("\x00")) for k in key])
    by_key = F.conv(F.substring(F.md5(name), 1, KEY_BITS // 4), 16, 10).cast("long")
    rest = ADDRESS_BITS - KEY_BITS
    by_place = F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - rest)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        F.shiftleft(by_key, rest).bitwiseOR(by_place).alias("address"),
        *([F.struct(*[docs[c] for c in docs.columns]).alias("row")] if carry else []),
    )
    return staged(rows, "addresses")


def assign(
    docs: DataFrame, max_bytes: int = MAX_BYTES, key: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text",
    carry: bool = True,
) -> DataFrame:
    """doc_id, n_bytes, shard, depth, shard_bytes, shard_docs of every row; with ``carry`` also
    row, all its columns, which ``write_sharded`` needs.

    ``shard`` spells the prefix in bits (the empty string is the whole table).  Every shard
    holds at most ``max_bytes`` of text, or a single row that is larger by itself; its sibling
    prefix would not fit together with it.  Rows of one key share a shard unless they exceed
    one together.  Null keys are one key, null texts have no bytes, repeated rows count each,
    an empty table has no shards.  Only sums per prefix are shuffled: at most 2**8 for each
    bucket that is too large.
    """
    rows = addressed(docs, key or [id_col], id_col, text_col, carry)
    depth, open_cells, closed = 0, None, []
    while True:
        upto = min(depth + ROUND_BITS, ADDRESS_BITS)
        mine = rows.withColumn("cell", _prefix(upto))
        if open_cells is not None:
            mine = mine.withColumn("parent", _prefix(depth)).join(open_cells, "parent")
        cells = staged(mine.groupBy("cell").agg(F.sum("n_bytes").alias("b"), F.count("*").alias("n")), "cells")
        levels = F.sequence(F.lit(0 if depth == 0 else depth + 1), F.lit(upto))
        spread = cells.withColumn("depth", F.explode(levels)).withColumn(
            "prefix", F.expr(f"shiftright(cell, {upto} - depth)")
        )
        fits = spread.groupBy("depth", "prefix").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_docs"))
        fits = fits.where((F.col("shard_bytes") <= max_bytes) | (F.col("shard_docs") == 1) | (F.col("depth") == ADDRESS_BITS))
        shortest = spread.select("cell", "depth", "prefix").join(fits, ["depth", "prefix"])
        shortest = shortest.groupBy("cell").agg(
            F.min(F.struct("depth", "prefix", "shard_bytes", "shard_docs")).alias("s")
        )
        placed = staged(cells.select("cell").join(shortest, "cell", "left"), "directory")
        closed.append((upto, placed.where("s IS NOT NULL").select("cell", "s.*")))
        open_cells = placed.where("s IS NULL").select(F.col("cell").alias("parent"))
        depth = upto
        if depth == ADDRESS_BITS or open_cells.isEmpty():
            break
    bits = F.when(F.col("depth") == 0, "").otherwise(F.expr("lpad(bin(prefix), depth, '0')"))
    found = [rows.withColumn("cell", _prefix(d)).join(directory, "cell") for d, directory in closed]
    return reduce(DataFrame.unionByName, found).select(
        "doc_id", "n_bytes", bits.alias("shard"), "depth", "shard_bytes", "shard_docs", *(["row"] if carry else [])
    )


def write_sharded(docs: DataFrame, shards: DataFrame, path: str) -> None:
    """The rows of ``docs`` in one folder per shard; rows of a shard meet in one task.

    ``shards`` is what ``assign`` made of ``docs``.  Every row goes where its own address
    does, once, whatever its id: ids can be null or stand in several shards.
    """
    if "row" not in shards.columns:
        raise ValueError("assign the shards with carry=True: ids can't tell rows apart")
    rows = shards.select("shard", *[F.col("row")[c].alias(c) for c in docs.columns])
    rows.repartition("shard").write.partitionBy("shard").parquet(path)
