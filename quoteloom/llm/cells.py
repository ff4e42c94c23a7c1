"""Blocks of rows against blocks of probes: the common part of the two searches.

A search first deals rows and probes to *cells*.  Here a cell of more than ``chunk_rows`` rows
is cut into chunks (a hot cell takes many) and its probes go to each chunk.  A task reads one
chunk's rows, at most about ``chunk_rows``, and then its probes batch by batch, so memory is
bounded by the chunk whatever a cell holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Stretches of equal keys in sorted batches; a long one comes in several pieces."""
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changed = np.zeros(batch.num_rows, bool)
        for c in columns:
            changed[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(changed).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield tuple(c[a].item() for c in columns), batch.slice(a, b - a)


def scan(
    rows: DataFrame, probes: DataFrame, chunk_rows: int, id_col: str,
    meet: Callable[[pa.Table, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str,
) -> DataFrame:
    """``meet(chunk, probes)`` over every chunk and the probes of its cell.

    Both tables have ``cell`` and the same further columns; ``id_col`` (unique in a cell)
    decides the chunk.
    """
    sizes = rows.groupBy("cell").agg(F.ceil(F.count("*") / chunk_rows).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64(id_col), F.col("chunks")).cast("int")
    stored = rows.join(sizes, "cell").withColumns({"chunk": chunk, "kind": F.lit(0)}).drop("chunks")
    asked = probes.join(sizes, "cell").withColumns(
        {"chunk": F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)), "kind": F.lit(1)}
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def pieces():
            """Runs of (cell, chunk, kind); keeps the rows of the current chunk."""
            nonlocal at, held
            for (cell, chunk, kind), piece in key_runs(batches, ["cell", "chunk", "kind"]):
                if (cell, chunk) != at:
                    at, held = (cell, chunk), []
                if kind == 0:
                    held.append(piece)
                else:
                    yield at, piece

        waiting = pieces()
        pending = next(waiting, None)
        while pending is not None:
            here, stored_here = pending[0], held

            def own():
                nonlocal pending
                while pending is not None and pending[0] == here:
                    yield pending[1]
                    pending = next(waiting, None)

            if stored_here:
                yield from meet(pa.Table.from_batches(stored_here), own())
            for _ in own():  # a chunk can be empty
                pass

    both = stored.unionByName(asked.drop("chunks"))
    dealt = both.repartition("cell", "chunk").sortWithinPartitions("cell", "chunk", "kind")
    return dealt.mapInArrow(run, schema)
