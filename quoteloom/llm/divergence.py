"""Source divergence by count-level bitmaps.

Terms of a language are numbered so that those of similar frequency stand together, and
every (group, count) keeps a bitmap of the terms that occur that often in the group, cut into
words of 64 terms.  For two groups the AND of two bitmaps and its popcount is one cell of
their joint table of counts; times the divergence of such a pair of counts it is the cell's
share.  Only counts above zero are stored: the cells with a zero follow by complement, from
the sizes of the levels and of the vocabulary.

With f(p, q) = (p - q)**2 div q, p0 for a count of zero, and levels A of a and B of b,

    value(a, b) = V f(a0, b0) + sum over A of |A| (f(pA, b0) - f(a0, b0))
                + sum over B of |B| (f(a0, pB) - f(a0, b0))
                + sum over A, B of |A and B| (f(pA, pB) - f(pA, b0) - f(a0, pB) + f(a0, b0))
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .cells import key_runs
from .common import arrow_schema, slices, staged

MIN_DOCS = 3
TOP_TERMS = 200
SCALE = 1_000_000_000
COUNTED = "lang string, source string, term string, n long, docs long"
SHARES = "lang string, source string, item string, value long"
HELD_TERMS = 400_000  # entries that a counting task holds before it emits them
HELD_PAIRS = 200_000
PIECE = 4 << 20
SALTS = 32

_TERM = re.compile(rb"[a-z\x80-\xff]+")


def _terms(data: bytes) -> Iterator[list[bytes]]:
    """Terms of one text, a few megabytes at a time; a piece ends where a term does."""
    at = 0
    while at < len(data):
        end = at + PIECE
        cut = _TERM.match(data, end)
        end = cut.end() if cut else end
        yield _TERM.findall(data, at, end)
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): partial counts, several rows a term.  Counted in the
    task, so what is shuffled is vocabularies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow_schema(COUNTED)
        n, docs = defaultdict(Counter), defaultdict(Counter)

        def emit():
            for (lang, source), own in n.items():
                seen = docs[lang, source]
                terms = pa.array(own, pa.binary()).cast(pa.string())
                counts = [pa.array(own.values(), pa.int64()), pa.array(map(seen.__getitem__, own), pa.int64())]
                arrays = [*(pa.repeat(pa.scalar(c, pa.string()), len(own)) for c in (lang, source)), terms, *counts]
                yield from slices([pa.RecordBatch.from_arrays(arrays, schema=schema)], 50_000)
            n.clear()
            docs.clear()

        size = 0
        for batch in slices(batches, 256):
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                own, seen = n[lang, source], set()
                size -= len(own)
                for terms in _terms(text.encode().lower()):
                    own.update(terms)
                    seen.update(terms)
                size += len(own)
                docs[lang, source].update(seen)
            if size > HELD_TERMS:
                yield from emit()
                size = 0
        yield from emit()

    return docs.mapInArrow(run, COUNTED)


def _share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(10**9 (n + 1) / (total + v)), exact; 1 where there is no vocabulary."""
    wide = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)")
    whole = F.call_function("div", wide, (total + v).cast("decimal(19,0)"))
    return F.when(v > 0, 1 + whole).otherwise(F.lit(1)).cast("long")


def _f(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _joint(levels: DataFrame) -> DataFrame:
    """Shares of the cells in which both counts are above zero, summed over a task's words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, sums = arrow_schema(SHARES), {}

        def emit():
            rows = [(*pair, int(value)) for pair, value in sums.items()]
            columns = zip(*rows) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            sums.clear()

        def meet(rows: pa.Table) -> None:
            """A word may hold terms of two languages; their bits never meet."""
            number: dict[tuple[str, str], int] = {}
            groups = zip(rows.column("lang").to_pylist(), rows.column("source").to_pylist())
            s = np.array([number.setdefault(g, len(number)) for g in groups], np.int64)
            names = list(number)
            bits, p, zero = (rows.column(c).to_numpy() for c in ("bits", "p", "p0"))
            bits = bits.view(np.uint64)  # a popcount of a signed number is that of its absolute value
            step = max(1, (1 << 22) // len(bits))
            for at in range(0, len(bits), step):
                cells = np.bitwise_count(bits[at : at + step, None] & bits[None, :])
                a, b = np.nonzero(cells)
                w = cells[a, b].astype(np.int64)
                a += at
                other = s[a] != s[b]
                a, b, w = a[other], b[other], w[other]

                def f(x, y):
                    return (x - y) * (x - y) // y

                pa_, pb, a0, b0 = p[a], p[b], zero[a], zero[b]
                value = w * (f(pa_, pb) - f(pa_, b0) - f(a0, pb) + f(a0, b0))
                keys, place = np.unique(s[a] * len(names) + s[b], return_inverse=True)
                total = np.zeros(len(keys), np.int64)
                np.add.at(total, place, value)
                for key, t in zip(keys.tolist(), total.tolist()):
                    pair = *names[key // len(names)], names[key % len(names)][1]
                    sums[pair] = sums.get(pair, 0) + t

        at, held = None, []
        for key, piece in key_runs(batches, ["word"]):
            if key != at:
                if held:
                    meet(pa.Table.from_batches(held))
                if len(sums) > HELD_PAIRS:
                    yield from emit()
                at, held = key, []
            held.append(piece)
        if held:
            meet(pa.Table.from_batches(held))
        yield from emit()

    dealt = levels.select("word", "lang", "source", "bits", "p", "p0").sortWithinPartitions("word")
    return dealt.mapInArrow(run, SHARES)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """How far the sources of a language differ, and in which terms each leaves the language.

    Columns: lang, source, part, item, value, rank.  Part ``pair``: item is another source of
    the language, value the divergence summed over all kept terms.  Part ``term``: the terms
    that the source has and uses more than its language, the first ``top_terms``.  Ranks go by
    falling value, then item in byte order.

    Null lang, source and text count as empty strings; a repeated row is one more document;
    a group without terms has its pairs; an empty table gives no rows; other columns are not
    read.  A term's rows, one per source, meet in one task, as do the levels of 64 terms; a
    group never does.
    """
    docs = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    # Dealt once: both aggregations read the same exchange, which has to hold the same columns.
    words = term_counts(docs).repartition("lang", "term")
    kept = words.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.count("source").alias("parts"))
    kept = kept.where((F.col("docs") >= min_docs) & (F.col("parts") > 0)).select("lang", "term", "total")
    in_group = words.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")).where("docs > 0")
    # Most terms are rare and fall out here: the kept ones are looked up, nothing is sorted.
    kept_rows = in_group.join(kept.hint("shuffle_hash"), ["lang", "term"]).select("lang", "term", "source", "n", "total")
    kept_rows = staged(kept_rows, "group-terms")
    ordered = kept_rows.select("lang", "term", "total").distinct().repartitionByRange("lang", F.desc("total"), "term")
    numbered = ordered.sortWithinPartitions("lang", F.desc("total"), "term").withColumn("id", F.monotonically_increasing_id())
    # The numbers depend on the partitions of this very run: hence written before they are used.
    terms = staged(numbered, "vocabulary")
    per_group = staged(kept_rows.join(terms.select("lang", "term", "id").hint("shuffle_hash"), ["lang", "term"]), "numbered")

    sizes = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_total"))
    sums = per_group.groupBy("lang", "source").agg(F.sum("n").alias("group_total"))
    groups = (
        docs.select("lang", "source").distinct().join(sizes, "lang", "left").join(sums, ["lang", "source"], "left")
        .na.fill(0, ["v", "lang_total", "group_total"])
        .withColumn("p0", _share(F.lit(0), F.col("group_total"), F.col("v")))
    )
    groups = staged(groups, "groups")

    rows = per_group.join(groups, ["lang", "source"]).withColumn("p", _share(F.col("n"), F.col("group_total"), F.col("v")))
    word, bit = F.shiftrightunsigned("id", 6), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("id").bitwiseAND(63).cast("int"))
    levels = (
        rows.select("lang", "source", "n", "p", "p0", word.alias("word"), bit.alias("bit")).repartition("word")
        .groupBy("word", "lang", "source", "n", "p", "p0").agg(F.bit_or("bit").alias("bits"))
    )

    # Levels of every group, and the whole vocabulary as level zero, against the other groups.
    sizes_of = rows.groupBy("lang", "source", "n", "p", "p0").agg(F.count("*").alias("size"))
    zero = groups.select("lang", "source", F.lit(0).cast("long").alias("n"), F.col("p0").alias("p"), "p0", F.col("v").alias("size"))
    salt = F.pmod(F.xxhash64("source", "n"), F.lit(SALTS)).cast("int")
    own = sizes_of.unionByName(zero).withColumn("salt", salt)
    others = groups.select(
        "lang", F.col("source").alias("other"), F.col("p0").alias("o0"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    met = own.join(others, ["lang", "salt"]).where("source <> other")
    p, p0, o0, size = F.col("p"), F.col("p0"), F.col("o0"), F.col("size")
    none, is_zero = F.lit(0).cast("long"), F.col("n") == 0
    there = F.struct(
        F.col("source"), F.col("other").alias("item"), F.when(is_zero, none).otherwise(size * (_f(p, o0) - _f(p0, o0))).alias("value")
    )
    back = F.struct(
        F.col("other").alias("source"), F.col("source").alias("item"), (size * F.when(is_zero, _f(o0, p0)).otherwise(_f(o0, p) - _f(o0, p0))).alias("value")
    )
    edges = met.select("lang", F.inline(F.array(there, back)))
    pairs = edges.unionByName(_joint(levels)).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    q = _share(F.col("total"), F.col("lang_total"), F.col("v"))
    over = rows.select("lang", "source", F.col("term").alias("item"), "p", q.alias("q")).where("p > q")
    over = over.select("lang", "source", "item", _f(F.col("p"), F.col("q")).alias("value"))

    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = lambda df, part: df.withColumns({"part": F.lit(part), "rank": place})
    both = ranked(pairs, "pair").unionByName(ranked(over, "term").where(F.col("rank") <= top_terms))
    return both.select("lang", "source", "part", "item", "value", "rank")
