"""Concatenate and cut: documents as one stream of tokens, cut into windows.

Pass one encodes every text once, adds the end token, and writes the ids to the shared folder
together with the task that read the row and the tokens before it in that task.  The totals
of the tasks (one row each) give every task's global offset by a prefix sum.  Pass two reads
the ids back and cuts them at the multiples of the window; each piece is a boundary record.
Only the totals meet in one place, and no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_schema, keyed_texts, slices, staged
from .tokens import encoder

CODED = "doc_id long, part long, local long, doc_tokens long, ids binary"
PIECE = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


@dataclass
class Stream:
    """Encoded documents (``coded``, in the shared folder) and one row per task (``bases``:
    part, tokens, base)."""

    coded: DataFrame
    bases: DataFrame


def encode(docs: DataFrame, path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> Stream:
    """Pass one.  A null text counts as empty, so every row has at least its end token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, schema = encoder(path), arrow_schema(CODED)
        part, local = TaskContext.get().partitionId(), 0
        end = np.array([end_id], coder.dtype).tobytes()
        for batch in slices(batches, 256):
            ids = [coder.ids(text or "") + end for text in batch.column("text").to_pylist()]
            sizes = np.array([len(b) // coder.dtype.itemsize for b in ids], np.int64)
            starts = local + np.cumsum(sizes) - sizes
            local += int(sizes.sum())
            columns = [batch.column("doc_id"), np.full(len(ids), part), starts, sizes, ids]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    texts = keyed_texts(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    coded = staged(texts.mapInArrow(run, CODED), "tokens", level=9)
    totals = coded.groupBy("part").agg(F.sum("doc_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return Stream(coded, totals.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)).cast("long")))


def cut(stream: Stream, path: str, window: int = 1024) -> DataFrame:
    """Pass two: the pieces, each with its ids as little-endian unsigned 32-bit integers.

    ``bases`` has one row of 24 bytes per task of pass one, which bounds what is broadcast:
    a million tasks are 24 MB.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype, schema = encoder(path).dtype, arrow_schema(PIECE)
        for batch in slices(batches, 64):
            rows = {f.name: [] for f in schema}
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], dtype).astype("<u4")
                at, size = row["base"] + row["local"], len(ids)
                edges = [0, *range(window - at % window, size, window), size]
                for a, b in zip(edges, edges[1:]):
                    piece = (row["doc_id"], a, b - a, size, (at + a) // window, (at + a) % window, ids[a:b].tobytes())
                    for column, value in zip(rows.values(), piece):
                        column.append(value)
            yield pa.RecordBatch.from_pydict(rows, schema=schema)

    placed = stream.coded.join(F.broadcast(stream.bases.select("part", "base")), "part")
    return placed.select("doc_id", "ids", "local", "base").mapInArrow(run, PIECE)


def pack(
    docs: DataFrame, path: str, window: int = 1024, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of all documents in sequences of ``window`` tokens.

    Columns: doc_id, start (the document's ids before the piece), length, doc_tokens,
    sequence_id, offset, ids.  Every sequence but the last is full; a document may cross as
    many sequences as it needs.  Null ids and repeated rows are packed like any other row,
    an empty table gives no rows, other columns are not read.
    """
    return cut(encode(docs, path, end_id, id_col, text_col), path, window)


def sequences(pieces: DataFrame, window: int = 1024, pad_id: int = 0) -> DataFrame:
    """One row per sequence: ids padded to the window, and the boundaries inside it.

    A group holds at most ``window`` tokens, so it can't grow with the data.
    """

    def join(ids, starts):
        whole = np.full(window, pad_id, "<u4")
        for b, at in zip(ids, starts):
            part = np.frombuffer(b, "<u4")
            whole[at : at + len(part)] = part
        return whole.astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.int64())
        for batch in slices(batches, 256):
            whole = [join(i, o) for i, o in zip(batch.column("ids").to_pylist(), batch.column("starts").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("sequence_id"), pa.array(whole, kind), batch.column("starts").cast(kind), batch.column("tokens")],
                names=["sequence_id", "input_ids", "boundaries", "tokens"],
            )

    grouped = pieces.groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "length", "ids"))).alias("p")
    )
    flat = grouped.select(
        "sequence_id", F.col("p.ids").alias("ids"), F.col("p.offset").alias("starts"),
        F.aggregate("p.length", F.lit(0).cast("long"), lambda a, x: a + x).alias("tokens"),
    )
    return flat.mapInArrow(run, "sequence_id long, input_ids array<long>, boundaries array<long>, tokens long")
