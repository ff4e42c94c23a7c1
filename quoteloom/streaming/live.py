"""Live operators as Structured Streaming.

Late data: event-time operators keep a watermark of one minute by default, the same span
the as-of joins tolerate.  Every ``foreachBatch`` sink is idempotent per batch, so a
restarted query repeats a batch without changing the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators import basis, options
from ..operators.blocks import join_keys
from ..operators.tables import UNIQUE_KEYS, latest_per_key
from ..plans.market import surface_from_chain
from ..sinks.store import COMPRESSION, upsert, with_date
from ..sources import option_feed
from . import state

WATERMARK = "60 seconds"
FLUSH_EVERY = "300 seconds"
FLUSH_BYTES = 200 * 1024 * 1024

Table = DataFrame | Callable[[], DataFrame] | None


def event_time(df: DataFrame, on: str = "timestamp") -> DataFrame:
    return df.withColumn("event_time", F.timestamp_millis(F.col(on)))


def file_stream(spark: SparkSession, schema, path: str, max_bytes: int = FLUSH_BYTES, **options) -> DataFrame:
    """Landed files as a stream whose batches stay near ``max_bytes`` (at least one file), so
    a restart after a long pause works through the backlog in steps."""
    return spark.readStream.schema(schema).options(maxBytesPerTrigger=max_bytes, **options).parquet(path)


# -- state ---------------------------------------------------------------------------


def latest_quotes(quotes: DataFrame, key: str = "instrument_name", arrival: str = "arrival") -> DataFrame:
    """Latest quote per instrument by arrival, for update mode.  The state is one row per
    instrument, reduced on the map side first."""
    rest = [c for c in quotes.columns if c != key]
    picked = quotes.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(arrival)).alias("_q"))
    return picked.select(key, "_q.*")


def snapshot_stream(
    quotes: DataFrame, key: str = "instrument_name", step: str = "1 second", seq: str = "arrival",
    on: str = "timestamp", watermark: str = WATERMARK,
) -> DataFrame:
    """Last quote per instrument and step, emitted once the watermark passes the step."""
    rest = [c for c in quotes.columns if c != key]
    picked = (
        event_time(quotes, on)
        .withWatermark("event_time", watermark)
        .groupBy(key, F.window("event_time", step))
        .agg(F.max_by(F.struct(*rest), F.struct(on, seq)).alias("_q"))
    )
    return picked.select(key, F.unix_millis("window.start").alias("snapshot_ts"), "_q.*")


def distinct_records(records: DataFrame, keys: list[str], on: str = "timestamp", watermark: str = WATERMARK) -> DataFrame:
    """Drop repeats of a key that arrive within the watermark; the keyed upsert at the
    sink catches any later ones."""
    return (
        event_time(records, on)
        .withWatermark("event_time", watermark)
        .dropDuplicatesWithinWatermark(keys)
        .drop("event_time")
    )


# -- sinks ---------------------------------------------------------------------------


def write_changes(changes: DataFrame, path: str, checkpoint: str, mode: str = "update", **trigger):
    """Write each batch to its own folder ``batch=<id>``, replaced if the batch is redone."""

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{path}/batch={batch_id}")

    return (
        changes.writeStream.outputMode(mode)
        .foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": FLUSH_EVERY}))
        .start()
    )


def read_latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Current state from the written changes: the newest batch's row of every key."""
    changes = spark.read.parquet(path).withColumn("batch", F.col("batch").cast("long"))
    return latest_per_key(changes, keys, "batch").drop("batch")


def write_state(changes: DataFrame, path: str, checkpoint: str, keys: list[str], mode: str = "update", **trigger):
    """Keep one row per key: each batch adds a small run to the table, so a batch costs what
    it changes and a reader sees the current state, not every batch since the start."""
    return (
        changes.writeStream.outputMode(mode)
        .foreachBatch(lambda batch, batch_id: state.put(batch, batch_id, path, keys))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": FLUSH_EVERY}))
        .start()
    )


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return state.read(spark, path)


def write_table(
    records: DataFrame, path: str, checkpoint: str, keys: list[str] | None = None, keep: str = "last",
    order_by: list[str] | None = None, **trigger,
):
    """Buffered sink: every interval the batch is merged into the dated table.

    Batches are bounded by the interval and by the reader (``file_stream``), which replaces
    the in-memory buffer's age and size limits.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        upsert(with_date(batch), path, keys=keys, keep=keep, order_by=order_by)

    return (
        records.writeStream.foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": FLUSH_EVERY}))
        .start()
    )


_PARSERS: dict[str, Callable[..., DataFrame]] = {
    "tickers": option_feed.tickers,
    "books": option_feed.books,
    "trades": option_feed.trades,
    "mark_prices": option_feed.mark_prices,
    "greeks": option_feed.greeks,
}
_TABLE_KEYS = {**UNIQUE_KEYS, "books": UNIQUE_KEYS["orderbook"]}


def route_batch(batch: DataFrame, root: str, raw: str = "value", arrival: str = "arrival") -> None:
    """Split pushed messages by channel, parse each kind and merge it into its table,
    partitioned by instrument-independent date so that hot instruments spread out."""
    routed = option_feed.messages(batch, raw).persist()
    try:
        for kind, parser in _PARSERS.items():
            rows = parser(
                routed.filter(F.col("record_type") == kind).withColumnRenamed("data", "payload"),
                pushed=True,
                extra=[arrival],
            )
            dated = rows.withColumn("date", F.date_format("timestamp", "yyyy-MM-dd"))
            if not dated.isEmpty():
                upsert(dated, f"{root}/{kind}", keys=_TABLE_KEYS[kind], parts=["date"], order_by=[arrival])
    finally:
        routed.unpersist()


def write_routed(messages: DataFrame, root: str, checkpoint: str, raw: str = "value", arrival: str = "arrival", **trigger):
    return (
        messages.writeStream.foreachBatch(lambda batch, _: route_batch(batch, root, raw, arrival))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": FLUSH_EVERY}))
        .start()
    )


def _opened(table: Table) -> DataFrame | None:
    """A table as of now: a DataFrame keeps the file list of when it was made."""
    return table() if callable(table) else table


def market_batch(
    chain: DataFrame, batch_id: int, root: str, keys: list[str], seq: str, now_ms: int,
    spot: Table = None, perp: Table = None, mapping: Table = None, name: str = "instrument_name",
) -> None:
    """One cycle: Greeks of the batch, the surface over the latest row of every contract seen
    so far, and the live basis.  Contracts are kept in a state table."""
    spark, kept = chain.sparkSession, f"{root}/chain_state"
    chain = chain.persist()
    state.put(chain, batch_id, kept, [*keys, name], [seq])
    out = {
        "options_greeks": options.greeks_batch(chain, now_ms, extra=[*keys, seq]),
        "vol_surface": surface_from_chain(state.read(spark, kept), keys, seq, now_ms),
    }
    sides = _opened(spot), _opened(perp), _opened(mapping)
    if all(side is not None for side in sides):
        out["basis"] = basis.live_basis(*sides, now_ms)
    try:
        for kind, rows in out.items():
            rows.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{root}/{kind}/batch={batch_id}")
    finally:
        chain.unpersist()


def write_market(
    chain: DataFrame, root: str, checkpoint: str, keys: list[str], seq: str, clock: Callable[[int], int],
    spot: Table = None, perp: Table = None, mapping: Table = None, **trigger,
):
    """Continuous Greeks, surface and basis; ``clock`` gives the pricing time of a batch.
    ``spot``, ``perp`` and ``mapping`` are tables that stand still, or functions that open
    them: those are called in every cycle, so the basis follows what is written meanwhile."""
    return (
        chain.writeStream.foreachBatch(
            lambda batch, i: market_batch(batch, i, root, keys, seq, clock(i), spot, perp, mapping)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


CHAIN, SPOT, PERP = "chain", "spot", "perp"


def market_stream(
    chain: DataFrame, spot: DataFrame, perp: DataFrame, keys: list[str], seq: str = "seq", name: str = "instrument_name",
    symbol: str = "symbol", currency: str = "currency",
) -> DataFrame:
    """Chain rows, spot and perpetual prices as one stream of the latest row of each, for
    update mode: a batch holds what changed, tagged by ``kind``.

    The state is one row per contract, spot symbol and perpetual, reduced on the map side
    first; ``seq`` decides which is the latest, so a row that comes late changes nothing.
    """

    def tagged(kind: str, rows: DataFrame, by: list[str]) -> DataFrame:
        key = F.array(*[F.col(c).cast("string") for c in by])
        return rows.select(F.lit(kind).alias("kind"), key.alias("key"), F.col(seq).cast("long").alias("_o"), F.struct(*rows.columns).alias(kind))

    both = tagged(CHAIN, chain, [*keys, name])
    both = both.unionByName(tagged(SPOT, spot, [symbol]), allowMissingColumns=True)
    both = both.unionByName(tagged(PERP, perp, [currency]), allowMissingColumns=True)
    latest = both.groupBy("kind", "key").agg(F.max_by(F.struct(CHAIN, SPOT, PERP), F.col("_o")).alias("_row"))
    return latest.select("kind", "key", f"_row.{CHAIN}", f"_row.{SPOT}", f"_row.{PERP}")


def live_market_batch(
    changes: DataFrame, batch_id: int, root: str, keys: list[str], mapping: Table, now_ms: int, seq: str = "seq"
) -> None:
    """One cycle over what changed: Greeks of the contracts, surfaces of the groups they belong
    to (over all their contracts), and the basis of the pairs one of whose sides moved."""
    spark, kept = changes.sparkSession, f"{root}/state"
    changes = changes.persist()
    try:
        state.put(changes, batch_id, kept, ["kind", "key"])
        whole = state.read(spark, kept)

        def rows(df: DataFrame, kind: str) -> DataFrame:
            return df.where(F.col("kind") == kind).select(f"{kind}.*")

        chain, moved = rows(changes, CHAIN), rows(whole, CHAIN)
        moved = join_keys(moved, chain.select(*keys).distinct(), keys, "left_semi")
        pairs = _opened(mapping)
        spots = rows(changes, SPOT).select("symbol").join(pairs, "symbol").select("symbol", "currency")
        perps = rows(changes, PERP).select("currency").join(pairs, "currency").select("symbol", "currency")
        touched = spots.unionByName(perps).distinct()
        out = {
            "options_greeks": options.greeks_batch(chain, now_ms, extra=[*keys, seq]),
            "vol_surface": surface_from_chain(moved, keys, seq, now_ms, as_float=False),
            "basis": basis.live_basis(rows(whole, SPOT), rows(whole, PERP), touched, now_ms, seq=seq),
        }
        for kind, found in out.items():
            found.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{root}/{kind}/batch={batch_id}")
    finally:
        changes.unpersist()


def write_live_market(
    chain: DataFrame, spot: DataFrame, perp: DataFrame, mapping: Table, root: str, checkpoint: str, keys: list[str],
    clock: Callable[[int], int], seq: str = "seq", **trigger,
):
    """Continuous Greeks, surfaces and basis from three streams: chain rows (``keys``,
    instrument_name, ...), spot (symbol, timestamp, price) and perpetual prices (currency,
    timestamp, price), each with ``seq``.  Outputs lie in ``root`` per batch; ``read_latest``
    gives the current ones."""
    changes = market_stream(chain, spot, perp, keys, seq)
    return (
        changes.writeStream.outputMode("update")
        .foreachBatch(lambda batch, i: live_market_batch(batch, i, root, keys, mapping, clock(i), seq))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "5 seconds"}))
        .start()
    )


def perp_prices(quotes: DataFrame, name: str = "instrument_name") -> DataFrame:
    """Perpetual quotes as (currency, mid price)."""
    return quotes.filter(F.contains(F.col(name), F.lit("PERPETUAL"))).select(
        F.split(name, "-").getItem(0).alias("currency"), "timestamp", F.col("mid_price").alias("price")
    )


# -- alerts --------------------------------------------------------------------------

_ALERT = "feed string, silent_from long, alert_at long, resumed_at long, silence_ms long"


def silence_alerts(
    records: DataFrame, feed: str, threshold_ms: int, on: str = "timestamp", watermark: str = WATERMARK
) -> DataFrame:
    """Silences of each feed beyond the threshold, as they end, and one open alert when the
    watermark passes the threshold without data.

    Before the shuffle every task keeps only the first and last time per feed and
    half-threshold cell: a longer silence always lies between two cells, so nothing is
    lost and a busy feed sends a handful of rows.
    """
    cell = max(1, threshold_ms // 2)

    def ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            grouped = rows.groupby(["feed", rows["ts"] // cell], sort=False)["ts"].agg(["min", "max"])
            flat = grouped.reset_index(level=0)
            both = pd.concat([flat[["feed", "min"]].set_axis(["feed", "ts"], axis=1), flat[["feed", "max"]].set_axis(["feed", "ts"], axis=1)])
            yield both.drop_duplicates()

    def watch(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, announced = state.get if state.exists else (None, False)
        found = []
        if state.hasTimedOut:
            if last is not None and not announced:
                found.append((key[0], last, last + threshold_ms, None, None))
            state.update((last, True))
        else:
            parts = [b["ts"].to_numpy() for b in batches]
            ts = np.unique(np.concatenate(parts)) if parts else np.empty(0, dtype="int64")
            fresh = ts if last is None else np.concatenate([[last], ts[ts > last]])
            for i in np.flatnonzero(np.diff(fresh) > threshold_ms):
                a, b = int(fresh[i]), int(fresh[i + 1])
                found.append((key[0], a, a + threshold_ms, b, b - a))
            newest = int(fresh[-1]) if len(fresh) else last
            state.update((newest, False if newest != last else announced))
            if newest is not None:
                due = newest + threshold_ms
                if due > state.getCurrentWatermarkMs():
                    state.setTimeoutTimestamp(due)
        yield pd.DataFrame(found, columns=["feed", "silent_from", "alert_at", "resumed_at", "silence_ms"]).astype(
            {c: "Int64" for c in ("silent_from", "alert_at", "resumed_at", "silence_ms")}
        )

    narrow = records.select(F.col(feed).cast("string").alias("feed"), F.col(on).cast("long").alias("ts"))
    return (
        narrow.mapInPandas(ends, "feed string, ts long")
        .withColumn("event_time", F.timestamp_millis("ts"))
        .withWatermark("event_time", watermark)
        .groupBy("feed")
        .applyInPandasWithState(
            watch, _ALERT, "last long, announced boolean", "append", GroupStateTimeout.EventTimeTimeout
        )
    )


# -- counters ------------------------------------------------------------------------


def with_counters(records: DataFrame, name: str = "collector", on: str = "timestamp") -> DataFrame:
    """Attach per-batch counters (records, newest time) to a stream."""
    return records.observe(name, F.count(F.lit(1)).alias("records"), F.max(on).alias("newest"))


_COUNTERS = "batch_id long, flush_size long, newest long, duration_sec double"


class CollectorMetrics(StreamingQueryListener):
    """One small row per finished batch: records, newest time, duration.

    Rows wait here until ``flush`` appends them to a table; call it as often as the table is
    read, and the driver holds only the rows since the last call.
    """

    def __init__(self, name: str = "collector") -> None:
        self.name = name
        self.batches: list[tuple] = []
        self.failures = 0

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(self.name)
        if seen is not None:
            self.batches.append(
                (progress.batchId, int(seen["records"]), seen["newest"], float(progress.batchDuration) / 1000.0)
            )

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.failures += event.exception is not None

    def table(self, spark: SparkSession) -> DataFrame:
        """What waits to be flushed."""
        return spark.createDataFrame(list(self.batches), _COUNTERS)

    def flush(self, spark: SparkSession, path: str) -> DataFrame:
        """Append the waiting rows to the table at ``path`` and return the whole table."""
        waiting, self.batches = self.batches, []
        try:
            spark.createDataFrame(waiting, _COUNTERS).coalesce(1).write.mode("append").parquet(path)
        except Exception:
            self.batches = waiting + self.batches
            raise
        return spark.read.schema(_COUNTERS).parquet(path)
