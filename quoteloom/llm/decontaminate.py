"""Benchmark decontamination by spaced seeds, in DataFrame functions only.

A mask such as ``11101011`` looks at the words under its ones and ignores the rest, so a
substituted word spoils only the placements that look at it.  Hashes of all placements are
joined between benchmark and documents; a hit fixes a diagonal (document position minus item
position), and the item is compared word by word along it.  An overlap is a window of
``WINDOW`` words of which at least ``NEEDED`` agree in place; of a shorter item four fifths of
its words must.  The masks together hit every such agreement (a test tries all), so nothing
is lost by seeding.  Items of fewer than ``SHORTEST`` words are met by whole texts only.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keyed_texts, staged

WINDOW = 13
SIMILARITY = 0.8
NEEDED = math.ceil(WINDOW * SIMILARITY)
MASKS = ("11101011", "110100111")
# For items shorter than a window; each length takes as many from the left as it needs.
SHORT_MASKS = ("1111", "11011", "10111", "11101")
SHORTEST = 5
MAX_BROADCAST = 1_000_000


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(parts, lambda w: w != ""), lambda w: F.xxhash64(w))


def needed_of(words: int) -> int:
    """Agreeing words that make an overlap with an item of so many words, below a window."""
    return -(-4 * words // 5)


def hits_all(masks: tuple[str, ...], words: int, lost: int) -> bool:
    """Whether, whichever ``lost`` words of so many are substituted, a placement sees none."""
    seen = [
        {at + k for k, c in enumerate(m) if c == "1"} for m in masks for at in range(words - len(m) + 1)
    ]
    return all(any(not p & set(gone) for p in seen) for gone in itertools.combinations(range(words), lost))


def masks_of(words: int) -> tuple[str, ...]:
    """The masks that a short item needs."""
    lost = words - needed_of(words)
    return next(SHORT_MASKS[:k] for k in range(1, len(SHORT_MASKS) + 1) if hits_all(SHORT_MASKS[:k], words, lost))


def _placements(x: Column, mask: str, tag: int) -> Column:
    """(at, h) of each placement of a mask."""
    ones = [k for k, c in enumerate(mask) if c == "1"]
    last = F.size(x) - len(mask)
    every = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.struct(i.alias("at"), F.xxhash64(F.lit(tag), *[F.get(x, i + k) for k in ones]).alias("h")),
    )
    return F.when(last >= 0, every).otherwise(F.array().cast("array<struct<at:int,h:bigint>>"))


def overlaps(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """One row per document and benchmark item that overlap.

    Columns: doc_id, item_id, matched (agreeing words in the best window), windows
    (qualifying ones), first_word (in the document, from 0, of the first of them).  Of items of
    5 to 12 words four fifths must stand in a document in place; shorter ones must be all the
    words of a text.  Items without words or without an id are left out.  Rows without a
    doc_id are reported under the null id, rows that share an id as one document; either
    table may be empty.
    The seeds are broadcast up to ``max_broadcast`` rows (about 40 MB), and so are the hits;
    beyond that both joins shuffle.
    """
    texts = keyed_texts(docs, id_col, text_col)
    items = benchmark.select(F.col(item_col).alias("item_id"), word_hashes(F.col(item_text)).alias("y"))
    items = staged(items.where(F.col("item_id").isNotNull() & (F.size("y") > 0)), "items")
    lengths = [r[0] for r in items.where(F.size("y") < WINDOW).select(F.size("y")).distinct().collect()]
    used = [m for n in lengths if n >= SHORTEST for m in masks_of(n)]
    short = [(m, len(MASKS) + k) for k, m in enumerate(SHORT_MASKS) if m in used]
    masks = list(zip(MASKS, range(len(MASKS))))
    tiny = items.where(F.size("y") < SHORTEST)
    items = items.where(F.size("y") >= SHORTEST)

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.count() <= max_broadcast else df

    y = F.col("y")
    own_seeds = [F.when(F.size(y) >= WINDOW, _placements(y, m, t)) for m, t in masks]
    own_seeds += [F.when(F.size(y) < WINDOW, _placements(y, m, t)) for m, t in short]
    seeds = F.concat(*[F.coalesce(s, F.array().cast("array<struct<at:int,h:bigint>>")) for s in own_seeds])
    # inline() would add a filter on its argument, pushed below the projection that makes the
    # words and so repeated for every place; the outer form has none, and joins drop its nulls.
    seeds = staged(items.select("item_id", F.inline_outer(seeds)).withColumnRenamed("at", "item_at"), "seeds")

    hashed = texts.select("doc_id", word_hashes(F.col("text")).alias("x"))
    placed = hashed.select("doc_id", F.concat(*[_placements(F.col("x"), m, t) for m, t in masks + short]).alias("p"))
    hits = placed.select("doc_id", F.inline_outer("p")).join(small(seeds), "h")
    hits = hits.select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("diagonal")).distinct()
    hits = staged(hits, "hits").withColumnRenamed("doc_id", "hit_id")

    found = texts.join(small(hits), F.col("doc_id").eqNullSafe(F.col("hit_id"))).join(items, "item_id")
    found = found.select("doc_id", "item_id", "diagonal", "y", word_hashes(F.col("text")).alias("x"))
    x, diagonal = F.col("x"), F.col("diagonal")

    def agree(j: Column) -> Column:
        inside = (j + diagonal >= 0) & (j + diagonal < F.size(x))
        return F.when(inside & (F.get(x, F.greatest(j + diagonal, F.lit(0))) == F.get(y, j)), 1).otherwise(0)

    found = found.withColumns({
        "same": F.transform(F.sequence(F.lit(0), F.size(y) - 1), agree),
        "span": F.least(F.size(y), F.lit(WINDOW)),
    })
    counts = F.transform(
        F.sequence(F.lit(0), F.size("same") - F.col("span")),
        lambda s: F.struct(
            F.aggregate(F.slice("same", s + 1, F.col("span")), F.lit(0), lambda a, v: a + v).alias("n"), s.alias("s")
        ),
    )
    needed = F.ceil(F.col("span") * 4 / F.lit(5))
    found = found.select("doc_id", "item_id", "diagonal", F.filter(counts, lambda c: c["n"] >= needed).alias("good"))
    # Filtered after the aggregation: a filter on the array would be pushed down and repeat it.
    rows = found.groupBy("doc_id", "item_id").agg(
        F.max(F.array_max("good")["n"]).alias("matched"),
        F.sum(F.size("good")).alias("windows"),
        F.min(F.get(F.col("good"), F.lit(0))["s"] + diagonal).cast("long").alias("first_word"),
    )
    rows = rows.where("windows > 0")
    if not any(n < SHORTEST for n in lengths):
        return rows
    # A text of as few words as such an item, and the same ones.
    few = hashed.where(F.size("x").between(1, SHORTEST - 1)).withColumn("h", F.xxhash64("x"))
    same = few.join(tiny.withColumn("h", F.xxhash64("y")), "h").where(F.col("x") == F.col("y"))
    whole = same.groupBy("doc_id", "item_id").agg(
        F.max(F.size("x")).alias("matched"), F.count(F.lit(1)).alias("windows"), F.lit(0).cast("long").alias("first_word")
    )
    return rows.unionByName(whole)


def decontaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` (all their columns) whose document overlaps no benchmark item;
    rows without an id can't be named and stay."""
    bad = overlaps(docs, benchmark, id_col, **options).select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(staged(bad, "contaminated"), id_col, "left_anti")
