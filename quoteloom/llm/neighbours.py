"""Approximate nearest neighbours by multiprobe p-stable hashing.

A table hashes a vector by a few Gaussian projections, each cut into slots of a fixed width.
The difference of two vectors at distance d is normal with deviation d in every projection,
which gives the chance that a neighbour lies in each slot around the query's own.  A query
visits buckets in falling order of the product of these chances until their sum reaches the
wished success; candidates of all tables are ranked by exact inner products.  Largest inner
products become smallest distances by one more component that fills every vector up to the
largest norm.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .cells import scan
from .common import arrow_schema, slices, staged

TABLES, PROJECTIONS, REACH = 2, 6, 3
SUCCESS = 0.96
SLOT = 1.3
CHUNK_ROWS = 16384
SAMPLE_ROWS, SAMPLE_QUERIES = 16384, 64
FIRST_PROBES = 4096
HASHED = "cell long, id long, buckets array<long>, vector binary"
SCORED = "query_id long, vec_id long, score double"


@dataclass
class Index:
    """What every task needs to hash: a few kilobytes, whatever the table holds."""

    dims: int
    norm: float
    distance: float
    width: float
    planes: np.ndarray  # tables x (dims + 1) x projections
    shifts: np.ndarray
    cells: int

    def project(self, vectors: np.ndarray, is_query: bool) -> np.ndarray:
        """Slot coordinates, tables x rows x projections."""
        lengths = np.sqrt((vectors * vectors).sum(axis=1))
        unit = vectors / (lengths[:, None] if is_query else self.norm)
        fill = np.zeros(len(unit)) if is_query else np.sqrt(np.maximum(0, 1 - (unit * unit).sum(axis=1)))
        full = np.concatenate([unit, fill[:, None]], axis=1)
        return (np.einsum("nd,tdp->tnp", full, self.planes) + self.shifts[:, None, :]) / self.width

    def bucket(self, slots: np.ndarray, table: int) -> np.ndarray:
        """A 64-bit name for slot numbers (last axis) that tells its table; a clash of names
        only adds candidates."""
        code = np.full(slots.shape[:-1], table + 1, np.uint64)
        for j in range(slots.shape[-1]):
            code = (code ^ slots[..., j].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            code ^= code >> np.uint64(31)
        tables = np.uint64(len(self.planes))
        return (code // tables * tables + np.uint64(table)).view(np.int64)

    def cell(self, buckets: np.ndarray) -> np.ndarray:
        """``cells`` for each table, so a row stands once in a cell."""
        names, tables = buckets.view(np.uint64), np.uint64(len(self.planes))
        return ((names >> np.uint64(17)) % np.uint64(self.cells) * tables + names % tables).astype(np.int64)


def _normal(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.vectorize(math.erf, otypes=[float])(z / math.sqrt(2)))


def probes(index: Index, vectors: np.ndarray, success: float) -> list[np.ndarray]:
    """The buckets each query visits, over all tables."""
    place = index.project(vectors, True)
    per_table = 1 - (1 - success) ** (1 / len(index.planes))
    steps = np.arange(-REACH, REACH + 1)
    scale = index.width / index.distance
    out: list[list[np.ndarray]] = [[] for _ in vectors]
    for table, at in enumerate(place):
        base = np.floor(at)
        low = (steps - (at - base)[..., None]) * scale
        chance = _normal(low + scale) - _normal(low)  # rows x projections x steps
        half = at.shape[1] // 2
        for k in range(len(vectors)):
            sides = []
            for own in (chance[k, :half], chance[k, half:]):
                p, move = np.ones(1), np.zeros((1, 0), np.int64)
                for c in own:
                    p = (p[:, None] * c).ravel()
                    move = np.concatenate([np.repeat(move, len(steps), axis=0), np.tile(steps, len(move))[:, None]], axis=1)
                sides.append((p, move))
            (pa_, ma), (pb, mb) = sides
            joint = np.outer(pa_, pb).ravel()
            wished = min(per_table, joint.sum() * (1 - 1e-9))
            first = min(FIRST_PROBES, len(joint))
            best = np.argpartition(-joint, first - 1)[:first]
            if joint[best].sum() < wished:  # more than a few thousand buckets are needed
                best = np.arange(len(joint))
            best = best[np.argsort(-joint[best], kind="stable")]
            best = best[: int(np.searchsorted(np.cumsum(joint[best]), wished)) + 1]
            moves = np.concatenate([ma[best // len(pb)], mb[best % len(pb)]], axis=1)
            out[k].append(index.bucket(base[k] + moves, table))
    return [np.unique(np.concatenate(b)) for b in out]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, dims)


def _nearest(table: pa.Table, asked: Iterator[pa.RecordBatch], dims: int, k: int) -> Iterator[pa.RecordBatch]:
    """The best ``k`` of one chunk for each query, among the buckets that it probes (all of
    them where it names none)."""
    vectors = _matrix(table.column("vector").combine_chunks(), dims)
    ids = table.column("id").to_numpy()
    home = table.column("buckets").combine_chunks().values.to_numpy()
    order = np.lexsort((ids, home))
    vectors, ids, home = vectors[order], ids[order], home[order]
    k *= int(np.unique(ids, return_counts=True)[1].max())  # an id may come with several vectors
    names, first, sizes = np.unique(home, return_index=True, return_counts=True)
    for batch in slices(asked, 256):
        queries, query_ids = _matrix(batch.column("vector"), dims), batch.column("id").to_numpy()
        seen = np.zeros((len(queries), len(names)), bool)
        for r, wanted in enumerate(batch.column("buckets")):
            wanted = wanted.values.to_numpy()
            if len(wanted):
                at = np.searchsorted(names, wanted)
                at = np.minimum(at, len(names) - 1)
                seen[r, at[names[at] == wanted]] = True
            else:
                seen[r] = True
        used = np.flatnonzero(seen.any(axis=0))
        if not len(used):
            continue
        rows = np.concatenate([np.arange(first[u], first[u] + sizes[u]) for u in used])
        own, own_ids = vectors[rows], ids[rows]
        rough = queries @ own.T
        rough[~np.repeat(seen[:, used], sizes[used], axis=1)] = -np.inf
        rough[query_ids[:, None] == own_ids[None, :]] = -np.inf
        out_q, out_v, out_s = [], [], []
        for r in range(len(queries)):
            live = int((rough[r] > -np.inf).sum())
            if not live:
                continue
            # Matrix products may differ in the last bit by position: take all that could
            # tie with the last one, then sum them alike.
            edge = np.partition(rough[r], -min(k, live))[-min(k, live)]
            slack = 1e-9 * (1 + np.abs(edge))
            near = np.flatnonzero(rough[r] >= max(edge - slack, np.finfo(float).min))
            exact = (own[near] * queries[r]).sum(axis=1)
            best = np.lexsort((own_ids[near], -exact))[:k]
            out_q.append(np.full(len(best), query_ids[r]))
            out_v.append(own_ids[near][best])
            out_s.append(exact[best])
        if out_q:
            columns = [pa.array(np.concatenate(c)) for c in (out_q, out_v, out_s)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow_schema(SCORED))


def usable(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and vector (doubles) of the rows that can take part: with an id, finite and not
    zero, and as long as most vectors are."""
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("v") == (common["n"] if common else 0))


def _norm(column: str):
    return F.sqrt(F.aggregate(column, F.lit(0.0), lambda a, x: a + x * x))


def build(rows: DataFrame, k: int, tables: int = TABLES, projections: int = PROJECTIONS, chunk_rows: int = CHUNK_ROWS, seed: int = 11) -> Index | None:
    """Fit the hashing: the largest norm and the number of rows come from all rows, the
    distance to look out for from a sample of at most ``SAMPLE_ROWS`` rows chosen by hash.

    The k-th neighbour in a sample is no nearer than in the table, so recall doesn't suffer
    where the sample is thin; the search only visits more.
    """
    total = rows.agg(F.count("*").alias("n"), F.max(_norm("v")).alias("norm"), F.first(F.size("v")).alias("dims")).first()
    if not total["n"]:
        return None
    share = -(-total["n"] // SAMPLE_ROWS)
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(share)) == 0).select("v").limit(2 * SAMPLE_ROWS).toArrow()
    vectors = np.array(sample.column("v").to_pylist(), float).reshape(-1, total["dims"])
    asked = vectors[:: max(1, len(vectors) // SAMPLE_QUERIES)][:SAMPLE_QUERIES]
    distance = 1.0
    if len(vectors):
        cosine = np.sort(asked @ vectors.T / (total["norm"] * np.sqrt((asked * asked).sum(axis=1)))[:, None], axis=1)
        # One more than k, for a query finds itself in the sample.
        distance = float(np.quantile(np.sqrt(np.maximum(1e-4, 2 - 2 * cosine[:, -min(k + 1, len(vectors))])), 0.9))
    rng = np.random.default_rng(seed)
    width = SLOT * distance
    planes = rng.normal(size=(tables, total["dims"] + 1, projections))
    cells = -(-total["n"] // chunk_rows)
    return Index(total["dims"], total["norm"], distance, width, planes, rng.uniform(0, width, (tables, projections)), cells)


def nearest(
    table: DataFrame, queries: DataFrame, k: int = 20, success: float = SUCCESS, chunk_rows: int = CHUNK_ROWS,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` largest inner products found.

    ``queries`` are rows like the table's; a row whose id is the query's is no candidate.
    Ties go to the smaller id.  Vectors null, zero, of unusual length or with a null or
    non-finite component take no part, nor do null ids; rows that share an id count as one
    with the better score.  A query that the probed buckets leave with fewer than ``k`` though
    the table has them is searched in all buckets.  Every row is hashed into every table; a
    query goes once to each cell of buckets that it probes, a cell's rows are met in chunks of
    ``chunk_rows``, and no more than ``k`` candidates of a chunk are shuffled for a query.
    """
    rows = usable(table, id_col, vector_col)
    index = build(rows, k, chunk_rows=chunk_rows)
    if index is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = usable(queries, id_col, vector_col).where(F.size("v") == index.dims)
    tables, kinds = len(index.planes), arrow_schema("cell long, id long, buckets array<long>, vector binary")

    def batches_of(batches, rows_at_once):
        for batch in slices(batches, rows_at_once):
            if batch.num_rows:
                column = batch.column("v")
                yield batch.column("id"), column.flatten().to_numpy(zero_copy_only=False).reshape(-1, index.dims)

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, vectors in batches_of(batches, 4096):
            slots = np.floor(index.project(vectors, False))
            raw = pa.array([v.tobytes() for v in vectors], pa.binary())
            for t in range(tables):
                bucket = index.bucket(slots[t], t)
                columns = [pa.array(index.cell(bucket)), ids, pa.array(list(bucket[:, None]), pa.list_(pa.int64())), raw]
                yield pa.RecordBatch.from_arrays(columns, schema=kinds)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, vectors in batches_of(batches, 64):
            out = ([], [], [], [])
            for name, vector, wanted in zip(ids.to_pylist(), vectors, probes(index, vectors, success)):
                cells = index.cell(wanted)
                for cell in np.unique(cells):
                    for column, value in zip(out, (cell, name, wanted[cells == cell], vector.tobytes())):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, kinds)], schema=kinds)

    def meet(chunk, probing):
        return _nearest(chunk, probing, index.dims, k)

    stored = rows.mapInArrow(store, HASHED)
    found = staged(scan(stored, asked.mapInArrow(ask, HASHED), chunk_rows, "id", meet, SCORED), "neighbours")

    enough = min(k, rows.select("id").distinct().limit(k + 1).count() - 1)
    met = found.groupBy("query_id").agg(F.count_distinct("vec_id").alias("met"))
    short = asked.join(met, asked["id"] == met["query_id"], "left").where(F.coalesce("met", F.lit(0)) < enough)
    short = staged(short.select("id", "v"), "short")
    if not short.isEmpty():
        whole = short.withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(index.cells * tables - 1).cast("long"))))

        def ask_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                raw = [np.array(v, float).tobytes() for v in batch.column("v").to_pylist()]
                columns = [batch.column("cell"), batch.column("id"), pa.array([[]] * len(raw), pa.list_(pa.int64())), pa.array(raw, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=kinds)

        found = found.unionByName(scan(stored, whole.mapInArrow(ask_all, HASHED), chunk_rows, "id", meet, SCORED))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
