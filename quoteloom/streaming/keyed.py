"""Operators with state per key and timers: repeated snapshots, bounded flushes; and failure
streaks over batches."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import metrics
from ..operators.blocks import join_keys
from . import state as tables
from .live import FLUSH_EVERY, WATERMARK

_QUOTE = "key string, ts long, o long, row string"
_HELD = "step long, ts long, row string, steps array<long>, times array<long>, orders array<long>, rows array<string>"
_SHOT = "key string, at long, ts long, row string"
_EMIT_ROWS = 50_000


def filled_snapshot_stream(
    quotes: DataFrame, columns: list[str], key: str = "instrument_name", step_ms: int = 1000, on: str = "timestamp",
    seq: str = "arrival", watermark: str = WATERMARK, keep_for_ms: int | None = None,
) -> DataFrame:
    """The state of every key at every step, repeated with its age while no quote comes: the
    stream of which ``metrics.filled_snapshots`` is the batch form.

    A key's steps begin at the first one at or after its first quote.  A step is emitted once
    the watermark has passed it, by a timer, whether or not the key has a new quote.  Among
    quotes up to a step the latest counts, ``seq`` deciding between equal times; a quote
    behind the watermark is dropped.  ``keep_for_ms`` ends a key that long after its last
    quote (an expired contract); without it every key repeats for ever.  Columns: key, ``on`` (the
    step), ``columns``, age_ms.

    The state of a key is its last quote and one quote for each step that the watermark has
    not passed; before the shuffle every task keeps one row per key and step.
    """

    def reduce(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            step = -(-rows["ts"] // step_ms)
            ordered = rows.assign(step=step).sort_values(["ts", "o"], kind="stable")
            yield ordered.drop_duplicates(["key", "step"], keep="last").drop(columns="step")

    def fill(key: tuple, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        step, ts, row = None, None, None
        pending: dict[int, tuple[int, int, str]] = {}
        if held.exists:
            step, ts, row, *lists = held.get
            pending = {s: (t, o, r) for s, t, o, r in zip(*lists)}
        if not held.hasTimedOut:
            for rows in batches:
                for t, o, r in zip(rows["ts"].tolist(), rows["o"].tolist(), rows["row"].tolist()):
                    at = -(-t // step_ms) * step_ms
                    if at not in pending or (t, o) >= pending[at][:2]:
                        pending[at] = (t, o, r)
        passed = held.getCurrentWatermarkMs()
        ahead = sorted(pending)
        if step is None:
            step = ahead[0]
        # Pieces between two quotes: from one step with a new quote to the next one.
        edges = [s for s in ahead if s < passed]
        for a, b in zip([step, *edges], [*edges, None]):
            if a in pending:
                ts, _, row = pending.pop(a)
            end = passed if b is None else min(b, passed)
            if keep_for_ms is not None and ts is not None:
                end = min(end, ts + keep_for_ms + 1)
            if ts is None or a >= end:
                continue
            steps = np.arange(a, end, step_ms)
            for k in range(0, len(steps), _EMIT_ROWS):
                own = steps[k : k + _EMIT_ROWS]
                yield pd.DataFrame({"key": key[0], "at": own, "ts": ts, "row": row})
        step = max(step, -(-passed // step_ms) * step_ms) if passed > 0 else step
        if keep_for_ms is not None and not pending and ts is not None and step > ts + keep_for_ms:
            held.remove()
            return
        ahead = sorted(pending)
        held.update((step, ts, row, ahead, *([pending[s][i] for s in ahead] for i in range(3))))
        # The timer fires when the watermark is past it; a key's first step may lie ahead.
        held.setTimeoutTimestamp(max(step, passed + 1))

    narrow = quotes.select(
        F.col(key).cast("string").alias("key"), F.col(on).cast("long").alias("ts"),
        F.coalesce(F.col(seq).cast("long"), F.lit(-1)).alias("o"), F.to_json(F.struct(*columns)).alias("row"),
    ).where(F.col("ts").isNotNull())
    shots = (
        narrow.mapInPandas(reduce, _QUOTE)
        .withColumn("event_time", F.timestamp_millis("ts"))
        .withWatermark("event_time", watermark)
        .groupBy("key")
        .applyInPandasWithState(fill, _SHOT, _HELD, "append", GroupStateTimeout.EventTimeTimeout)
    )
    values = F.from_json("row", T.StructType([quotes.schema[c] for c in columns]))
    return shots.select(
        F.col("key").alias(key), F.col("at").alias(on), values.alias("_v"), (F.col("at") - F.col("ts")).alias("age_ms")
    ).select(key, on, "_v.*", "age_ms")


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside keep their state in RocksDB, as timers with lists need."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


class _Buffer(StatefulProcessor):
    """Rows of a key until there are enough of them, or the first one is old enough."""

    def __init__(self, max_rows: int, max_age_ms: int):
        self.max_rows, self.max_age_ms = max_rows, max_age_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", T.StructType().add("row", T.StringType()))
        self.count = handle.getValueState("count", T.StructType().add("rows", T.LongType()).add("flushes", T.LongType()))

    def _sizes(self) -> tuple[int, int]:
        return tuple(self.count.get()) if self.count.exists() else (0, 0)

    def _out(self, key, flush: int, rows: list[str], reason: str) -> Iterator[pd.DataFrame]:
        """Rows of one flush or of several whole ones that follow each other."""
        for at in range(0, len(rows), _EMIT_ROWS):
            own = rows[at : at + _EMIT_ROWS]
            numbers = flush + np.arange(at, at + len(own)) // self.max_rows
            yield pd.DataFrame({"key": key[0], "flush": numbers, "reason": reason, "row": own})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held, flushes = self._sizes()
        fresh: list[str] = []
        first = held == 0
        for batch in rows:
            fresh += batch["row"].tolist()
            full = (held + len(fresh)) // self.max_rows
            if full:
                take = full * self.max_rows - held
                old = [r[0] for r in self.rows.get()] if held else []
                yield from self._out(key, flushes, old + fresh[:take], "rows")
                if held:  # calls of the state store cost more than rows: none for a flush that it never saw
                    self.rows.clear()
                    self._untime()
                fresh, held, flushes, first = fresh[take:], 0, flushes + full, True
        if fresh:
            self.rows.appendList([(r,) for r in fresh])
            if first:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.max_age_ms)
        self.count.update((held + len(fresh), flushes))

    def _untime(self) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, flushes = self._sizes()
        if held:
            yield from self._out(key, flushes, [r[0] for r in self.rows.get()], "age")
            self.rows.clear()
            self.count.update((0, flushes + 1))

    def close(self) -> None:
        pass


def flush_stream(
    records: DataFrame, keys: list[str], max_rows: int = 100_000, max_age_ms: int = 300_000, order_by: str | None = None
) -> DataFrame:
    """Records in flushes of their key: of exactly ``max_rows`` rows as soon as there are so
    many, of fewer once the first of them has waited ``max_age_ms`` of processing time.

    Columns: those of ``records``, flush (numbered per key from 0) and reason (rows, age).
    With ``order_by`` the rows that a batch brings for a key go in by it.  Waiting rows are a
    list in the state store, to which a batch only appends; a key never holds more than
    ``max_rows``.  Start the query inside ``rocksdb``, and with a
    ``processingTime`` trigger: as its timers never end, nor would ``availableNow``.  Null keys
    are a key.
    """
    key = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    order = F.col(order_by).cast("long") if order_by else F.lit(0).cast("long")
    # The order goes first in the text, so that a batch's rows can be put in order by it.
    rows = records.select(key.alias("key"), order.alias("o"), F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"}).alias("row"))

    class Ordered(_Buffer):
        def handleInputRows(self, key, rows, timerValues):
            whole = pd.concat(list(rows)).sort_values("o", kind="stable")
            return super().handleInputRows(key, iter([whole]), timerValues)

    out = rows.groupBy("key").transformWithStateInPandas(
        statefulProcessor=(Ordered if order_by else _Buffer)(max_rows, max_age_ms),
        outputStructType="key string, flush long, reason string, row string",
        outputMode="append",
        timeMode="ProcessingTime",
    )
    return out.select(F.from_json("row", records.schema).alias("_v"), "flush", "reason").select("_v.*", "flush", "reason")


# -- failure streaks ----------------------------------------------------------------------


def failure_batch(batch: DataFrame, batch_id: int, path: str, ok: Column, order_by: str, threshold: int, keys: list[str] | None = None) -> None:
    """Merge one batch of outcomes into the table of failure runs.

    Runs inside the batch come from the batch operator, which cuts a long key into blocks.
    The run at a key's start goes on where the stored open one of that key stopped; an open
    run whose key comes with a success first is closed.  Batches follow each other in
    ``order_by``.
    """
    spark, keys = batch.sparkSession, list(keys or [])
    now = tables.manifest(spark, path)
    if batch_id <= now.last_batch or batch.isEmpty():
        return
    runs = metrics.failure_streaks(batch, ok, order_by, threshold, keys)
    one = F.lit(0).alias("_all")  # without keys everything is one series
    by = keys or ["_all"]
    runs = runs.select("*", one)
    ends = batch.select("*", one).groupBy(*by).agg(F.min(order_by).alias("_lo"), F.max(order_by).alias("_hi"), F.min(F.when(ok, F.col(order_by))).alias("_ok"))
    runs = join_keys(runs, ends, by).withColumn("open", F.col("last_failure") == F.col("_hi"))
    fresh = runs.select(*by, "first_failure", "last_failure", "failures", "open", (F.col("first_failure") == F.col("_lo")).alias("_leading"))
    if now.runs:
        stored = tables.read(spark, path).where("open").select(*keys, *([] if keys else [one]), "first_failure", "last_failure", "failures")
        before = stored.withColumnsRenamed({"first_failure": "_first", "failures": "_n"}).drop("last_failure").withColumn("_leading", F.lit(True))
        fresh = join_keys(fresh, before, [*by, "_leading"])
        fresh = fresh.withColumns(
            {"first_failure": F.coalesce("_first", "first_failure"), "failures": F.col("failures") + F.coalesce("_n", F.lit(0))}
        ).drop("_first", "_n")
        ended = join_keys(stored, ends.where("_ok = _lo"), by, "inner").select(*stored.columns, F.lit(False).alias("open"))
        fresh = fresh.unionByName(ended, allowMissingColumns=True)
    rows = fresh.select(*keys, "first_failure", "last_failure", "failures", (F.col("failures") >= threshold).alias("alert"), "open")
    tables.put(rows, batch_id, path, [*keys, "first_failure"])


def write_failures(outcomes: DataFrame, path: str, checkpoint: str, ok: Column, order_by: str, threshold: int, keys: list[str] | None = None, **trigger):
    """Failure runs as a stream: a run is in the table with its alert while it is still open.
    ``live.read_state`` reads it: keys, first_failure, last_failure, failures, alert, open."""
    return (
        outcomes.writeStream.foreachBatch(lambda batch, i: failure_batch(batch, i, path, ok, order_by, threshold, keys))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": FLUSH_EVERY}))
        .start()
    )
