"""Data-quality tables, counters, registry."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quoteloom.operators import metrics, quality
from quoteloom.plans import registry, verification
from quoteloom.session import shared_dir
from quoteloom.sinks import store
from quoteloom.streaming import state

from .base import NOW_MS, ORACLE, oracle_with, query, r, rounded, table, view
from .ordered import _STATS

CELL = ["exchange", "data_type", "symbol"]


def _landed(spark, d):
    return view(spark, d, "landed")


_UNPIVOT = " UNION ALL ".join(
    "SELECT data_type, '{0}' AS column_name, count(*) AS total_rows, count(*) - count({0}) AS null_rows, {1} AS null_share, count({0}) < count(*) * 0.5 AS warning FROM landed GROUP BY 1".format(
        c, r(f"(count(*) - count({c})) / count(*)")
    )
    for c in quality.NULL_CHECKED
)


@query("null_ratio", f"{oracle_with('landed')} {_UNPIVOT}")
def null_ratio(spark, d):
    return rounded(quality.null_ratio(_landed(spark, d), ["data_type"]), "null_share")


_SHIFTED = "(SELECT *, CASE WHEN user_id % 50 = 0 THEN seq ELSE timestamp END AS ts2 FROM ticks)"


@query("epoch_zero", f"{oracle_with('ticks')} SELECT instrument, count(*) FILTER (ts2 < 86400000) AS epoch_zero_rows, count(*) FILTER (ts2 < 86400000) > 0 AS is_error FROM {_SHIFTED} t GROUP BY 1")
def epoch_zero(spark, d):
    rows = view(spark, d, "ticks").withColumn("timestamp", F.when(F.col("user_id") % 50 == 0, F.col("seq")).otherwise(F.col("timestamp")))
    return quality.epoch_zero(rows, ["instrument"])


@query(
    "source_status",
    f"""{oracle_with('landed')}, f AS (SELECT exchange, data_type, symbol, timestamp // 86400000 AS day, count(*) AS n, cast(count(mark_price) < count(*) * 0.5 AS bigint) AS w,
  cast(min(user_id) = 0 AND symbol = 'BTC' AS bigint) AS e FROM landed GROUP BY 1, 2, 3, 4)
SELECT exchange, data_type, symbol, count(*) AS files, cast(sum(n) AS bigint) AS total_rows, cast(sum(w) AS bigint) AS warnings, cast(sum(e) AS bigint) AS errors,
  CASE WHEN sum(e) > 0 THEN 'ERROR' WHEN sum(n) = 0 THEN 'MISSING' WHEN sum(w) > 0 THEN 'WARNING' ELSE 'OK' END AS status FROM f GROUP BY 1, 2, 3""",
)
def source_status(spark, d):
    day = F.floor(F.col("timestamp") / 86_400_000).alias("day")
    files = _landed(spark, d).groupBy(*CELL, day).agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count("mark_price") < F.count(F.lit(1)) * 0.5).cast("long").alias("warnings"),
        ((F.min("user_id") == 0) & (F.col("symbol") == "BTC")).cast("long").alias("errors"),
    )
    return quality.source_status(files, CELL)


@query(
    "file_status",
    f"""{oracle_with('landed')}, f AS (SELECT exchange, data_type, symbol, timestamp // 86400000 AS day, count(*) AS n, count(mark_price) < count(*) * 0.5 AS w, min(user_id) = 0 AS e FROM landed GROUP BY 1, 2, 3, 4)
SELECT status, count(*) AS files FROM (SELECT CASE WHEN e THEN 'ERROR' WHEN n = 0 OR w THEN 'WARNING' ELSE 'OK' END AS status FROM f) s GROUP BY 1""",
)
def file_status(spark, d):
    day = F.floor(F.col("timestamp") / 86_400_000).alias("day")
    files = _landed(spark, d).groupBy(*CELL, day).agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count("mark_price") < F.count(F.lit(1)) * 0.5).cast("long").alias("warnings"),
        (F.min("user_id") == 0).cast("long").alias("errors"),
    )
    status = quality.file_status(F.col("errors"), F.col("rows"), F.col("warnings"))
    return files.select(status.alias("status")).groupBy("status").agg(F.count(F.lit(1)).alias("files"))


_TICKER = """tk AS (SELECT instrument_name, CASE WHEN seq % 31 = 0 THEN -1 ELSE underlying_price END AS underlying_price, CASE WHEN seq % 37 = 0 THEN NULL ELSE bid_iv * 8 END AS bid_iv,
  mark_iv * 8 AS mark_iv, CASE WHEN seq % 41 = 0 THEN -1 ELSE open_interest END AS open_interest, ccy FROM chain)"""


def _tickers(spark, d):
    seq = F.col("seq")
    return view(spark, d, "chain").select(
        "instrument_name",
        F.when(seq % 31 == 0, -1.0).otherwise(F.col("underlying_price")).alias("underlying_price"),
        F.when(seq % 37 != 0, F.col("bid_iv") * 8).alias("bid_iv"),
        (F.col("mark_iv") * 8).alias("mark_iv"),
        F.when(seq % 41 == 0, -1.0).otherwise(F.col("open_interest")).alias("open_interest"),
        "ccy",
    )


_HAVE = ("instrument_name", "underlying_price", "bid_iv", "mark_iv", "open_interest")


@query(
    "field_presence",
    f"{oracle_with('chain')}, {_TICKER} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS field, {str(c in _HAVE).lower()} AS present, {'count(' + c + ')' if c in _HAVE else 'cast(0 AS bigint)'} AS non_null, count(*) AS total_rows FROM tk" for c in quality.TICKER_FIELDS
    ),
)
def field_presence(spark, d):
    return quality.field_presence(_tickers(spark, d))


@query(
    "completeness",
    f"{oracle_with('chain')}, {_TICKER} "
    + " UNION ALL ".join(
        f"SELECT ccy, '{c}' AS field, {r('count(' + c + ') * 100e0 / count(*)') if c in _HAVE else 'cast(NULL AS double)'} AS completeness_pct FROM tk GROUP BY 1" for c in quality.TICKER_FIELDS
    ),
)
def completeness(spark, d):
    return rounded(quality.completeness(_tickers(spark, d), ["ccy"]), "completeness_pct")


@query(
    "value_rules",
    f"""{oracle_with('chain')}, {_TICKER}
SELECT ccy, 'underlying_price_positive' AS rule, count(*) AS total_rows, true AS applies, count(*) FILTER (underlying_price <= 0) AS invalid_rows FROM tk GROUP BY 1
UNION ALL SELECT ccy, 'bid_iv_range', count(*), true, count(*) FILTER (bid_iv IS NULL OR bid_iv < 0 OR bid_iv > 5) FROM tk GROUP BY 1
UNION ALL SELECT ccy, 'mark_iv_range', count(*), true, count(*) FILTER (mark_iv IS NULL OR mark_iv < 0 OR mark_iv > 5) FROM tk GROUP BY 1
UNION ALL SELECT ccy, 'open_interest_not_negative', count(*), true, count(*) FILTER (open_interest < 0) FROM tk GROUP BY 1""",
)
def value_rules(spark, d):
    return quality.value_rules(_tickers(spark, d), ["ccy"])


_NOW = 1_704_672_000_000  # 2024-01-08 UTC, inside the range of the events


@query("future_ts", f"{oracle_with('ticks')} SELECT instrument, count(*) FILTER (timestamp > {_NOW} + 3600000) AS future_rows, count(*) AS total_rows FROM ticks GROUP BY 1")
def future_ts(spark, d):
    return quality.future_rows(view(spark, d, "ticks"), _NOW, ["instrument"])


_KINDS = ("view", "click", "purchase", "signup", "error")


@query(
    "counts_by_instrument",
    f"{oracle_with('ticks')} SELECT user_id, " + ", ".join(f"count(*) FILTER (instrument = '{k}') AS {k}" for k in _KINDS) + ", count(*) AS total_records FROM ticks GROUP BY 1",
)
def counts_by_instrument(spark, d):
    return quality.counts_by_type(view(spark, d, "ticks"), ["user_id"], "instrument", _KINDS)


@query(
    "log_classify",
    f"""{oracle_with('ticks')} SELECT CASE instrument WHEN 'error' THEN 'error' WHEN 'signup' THEN 'warning' WHEN 'view' THEN 'greeks_cycle' WHEN 'click' THEN 'surface_build'
    ELSE CASE WHEN seq % 10 = 0 THEN 'epoch_zero_flush' WHEN seq % 10 = 1 THEN 'other' ELSE 'flush' END END AS line_class,
  CASE WHEN instrument IN ('view', 'click') THEN CASE user_id % 3 WHEN 0 THEN 'BTC' WHEN 1 THEN 'ETH' END END AS currency, count(*) AS lines FROM ticks GROUP BY 1, 2""",
)
def log_classify(spark, d):
    cur = F.when(F.col("user_id") % 3 == 0, "BTC").when(F.col("user_id") % 3 == 1, "ETH").otherwise("SOL")
    tail = F.col("seq") % 10
    line = (
        F.when(F.col("instrument") == "error", F.concat(F.lit("2026 ERROR failed wrote rows "), cur))
        .when(F.col("instrument") == "signup", F.concat(F.lit("WARNING ERROR lag "), cur))
        .when(F.col("instrument") == "view", F.concat(F.lit("INFO computed 12 Greeks ["), cur, F.lit("]")))
        .when(F.col("instrument") == "click", F.concat(F.lit("INFO Surface built for "), cur, F.lit(" [good]:")))
        .when(tail == 0, F.lit("INFO wrote 5 rows to date=1970-01-01"))
        .when(tail == 1, F.lit("INFO started"))
        .otherwise(F.lit("INFO wrote 5 rows to date=2026-01-01"))
    )
    return quality.log_summary(view(spark, d, "ticks").select(line.alias("value")))


@query("record_counts", f"{oracle_with('landed')} SELECT exchange, data_type, count(*) AS records FROM landed GROUP BY 1, 2")
def record_counts(spark, d):
    return metrics.record_counts(_landed(spark, d), "data_type", ["exchange"])


_BOUNDS = (*metrics.FLUSH_SIZE_BOUNDS, None)


@query(
    "histogram_le",
    f"{oracle_with('ticks')} SELECT instrument, le, count(*) FILTER (le IS NULL OR price <= le) AS observations FROM ticks, (VALUES "
    + ", ".join(f"({b}::double)" if b is not None else "(NULL)" for b in _BOUNDS)
    + ") b(le) GROUP BY 1, 2",
)
def histogram_le(spark, d):
    return metrics.histogram_le(view(spark, d, "ticks"), "price", metrics.FLUSH_SIZE_BOUNDS, ["instrument"])


@query(
    "dataset_profile",
    f"""{oracle_with('chain', 'ticks')}, b AS (SELECT count(*) AS n, avg(user_id % 7) AS a FROM (SELECT DISTINCT user_id, timestamp FROM ticks)),
tr AS (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2)
SELECT count(*) AS ticker_records, count(DISTINCT instrument_name) AS ticker_instruments, count(*) FILTER (underlying_price > 0) AS valid_underlying, min(mark_iv) AS mark_iv_min, max(mark_iv) AS mark_iv_max,
  {r('avg(mark_iv)')} AS mark_iv_mean, {r('sum(open_interest)')} AS total_open_interest, (SELECT n FROM b) AS book_records, {r('(SELECT a FROM b)')} AS avg_bid_levels, (SELECT count(*) FROM tr) AS trade_records,
  (SELECT min(l_orderkey * 1e0 + l_linenumber) FROM tr) AS price_min, (SELECT max(l_orderkey * 1e0 + l_linenumber) FROM tr) AS price_max,
  (SELECT count(*) FILTER (l_linenumber % 2 = 0) FROM tr) AS buy_orders, (SELECT count(*) FILTER (l_linenumber % 2 = 1) FROM tr) AS sell_orders FROM chain""",
)
def dataset_profile(spark, d):
    tickers = view(spark, d, "chain").withColumn("timestamp", F.col("seq"))
    books = view(spark, d, "ticks").select(F.col("user_id").alias("instrument_name"), "timestamp", (F.col("user_id") % 7).alias("bid_levels"))
    odd = F.col("l_linenumber") % 2 == 1
    trades = table(spark, d, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("trade_id"),
        (F.col("l_orderkey") * 1.0 + F.col("l_linenumber")).alias("price"),
        F.when(odd, "sell").otherwise("buy").alias("direction"),
    )
    return rounded(metrics.dataset_profile(tickers, books, trades), "mark_iv_mean", "total_open_interest", "avg_bid_levels")


# -- registry ------------------------------------------------------------------------

_REQ = """req AS (SELECT * FROM (VALUES
 ('short_strangle', 'P0', 0, 'options_greeks', 'deribit', 'BTC ETH', '5s', 0), ('short_strangle', 'P0', 1, 'mark_price', 'deribit', 'BTC-PERPETUAL ETH-PERPETUAL', '1s', 0),
 ('short_strangle', 'P0', 2, 'funding_rate', 'binance deribit', 'BTCUSDT BTC-PERPETUAL', '8h', 2), ('short_strangle', 'P0', 3, 'margin_params', 'deribit', 'BTC ETH', '1d', 2),
 ('synthetic_covered_call', 'P0', 0, 'options_greeks', 'deribit', 'BTC ETH', '5s', 0), ('synthetic_covered_call', 'P0', 1, 'mark_price', 'deribit', 'BTC-PERPETUAL ETH-PERPETUAL', '1m', 1),
 ('synthetic_covered_call', 'P0', 2, 'funding_rate', 'binance deribit hyperliquid', 'BTCUSDT BTC-PERPETUAL BTC', '8h', 2),
 ('collar', 'P0', 0, 'options_greeks', 'deribit', 'BTC ETH', '5s', 0), ('collar', 'P0', 1, 'mark_price', 'deribit', 'BTC-PERPETUAL', '1m', 1),
 ('funding_arb', 'P1', 0, 'funding_rate', 'binance deribit hyperliquid', 'BTCUSDT BTC-PERPETUAL BTC', '8h', 0), ('funding_arb', 'P1', 1, 'mark_price', 'binance deribit', 'BTCUSDT BTC-PERPETUAL', '1m', 1),
 ('funding_arb', 'P1', 2, 'options_greeks', 'deribit', 'BTC', '5s', 2), ('funding_arb', 'P1', 3, 'basis', 'binance deribit', 'BTCUSDT BTC-PERPETUAL', '1m', 1),
 ('gamma_scalping', 'P1', 0, 'options_greeks', 'deribit', 'BTC ETH', '5s', 0), ('gamma_scalping', 'P1', 1, 'mark_price', 'deribit', 'BTC-PERPETUAL', '1s', 0), ('gamma_scalping', 'P1', 2, 'margin_params', 'deribit', 'BTC', '1d', 2),
 ('vol_term_structure', 'P2', 0, 'options_greeks', 'deribit', 'BTC ETH', '5s', 0), ('vol_term_structure', 'P2', 1, 'vol_surface', 'deribit', 'BTC ETH', '10s', 1), ('vol_term_structure', 'P2', 2, 'risk_free_rate', 'fred', 'USD', '1d', 2)
) t(strategy, level, requirement, data_type, exchanges, symbols, frequency, priority)),
cells AS (SELECT strategy, level, requirement, data_type, exchange, unnest(string_split(symbols, ' ')) AS symbol, frequency, priority FROM (SELECT *, unnest(string_split(exchanges, ' ')) AS exchange FROM req)),
counts AS (SELECT exchange, data_type, symbol, count(*) AS rows FROM landed GROUP BY 1, 2, 3)"""


@query(
    "registry_plan",
    f"""{oracle_with('landed')}, {_REQ} SELECT strategy, requirement, data_type, exchange, symbol, frequency, priority, cast({NOW_MS} - 86400000 AS bigint) AS start_ms, cast({NOW_MS} AS bigint) AS end_ms, rows
FROM cells LEFT JOIN counts USING (exchange, data_type, symbol)""",
)
def registry_plan(spark, d):
    planned = registry.plan(registry.registry(spark), NOW_MS)
    out = planned.join(registry.landed_counts(_landed(spark, d)), CELL, "left").orderBy("strategy", "priority")
    return out.select("strategy", "requirement", "data_type", "exchange", "symbol", "frequency", "priority", "start_ms", "end_ms", "rows")


@query(
    "registry_filter",
    f"""{oracle_with('landed')}, {_REQ} SELECT strategy, level AS strategy_priority, cast(coalesce(sum(rows), 0) AS bigint) AS rows FROM cells LEFT JOIN counts USING (exchange, data_type, symbol) WHERE level IN ('P0', 'P1') GROUP BY 1, 2""",
)
def registry_filter(spark, d):
    kept = registry.cells(registry.with_priority(registry.registry(spark), "P0,P1"))
    return (
        kept.join(registry.landed_counts(_landed(spark, d)), CELL, "left")
        .groupBy("strategy", "strategy_priority")
        .agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"))
    )


_END, _DAYS = 1_706_745_600_000, 20  # 2024-02-01 UTC


@query(
    "strategy_run",
    f"""{oracle_with('landed')}, {_REQ}, inrange AS (SELECT exchange, data_type, symbol, count(*) AS rows FROM landed WHERE timestamp >= {_END} - {_DAYS} * 86400000 AND timestamp < {_END} GROUP BY 1, 2, 3)
SELECT strategy, data_type, cast(coalesce(sum(rows), 0) AS bigint) AS rows FROM cells LEFT JOIN inrange USING (exchange, data_type, symbol) GROUP BY 1, 2""",
)
def strategy_run(spark, d):
    planned = registry.plan(registry.registry(spark), _END, _DAYS)
    return registry.run_counts(planned, _landed(spark, d), _END, _DAYS)


@query(
    "strategy_rows",
    f"""{oracle_with('landed')}, {_REQ} SELECT seq, timestamp, exchange, data_type, symbol FROM landed WHERE timestamp >= {_END} - {_DAYS} * 86400000 AND timestamp < {_END}
  AND (exchange, data_type, symbol) IN (SELECT (exchange, data_type, symbol) FROM cells WHERE strategy = 'funding_arb')""".replace("IN (SELECT (exchange, data_type, symbol) FROM", "IN (SELECT exchange, data_type, symbol FROM"),
)
def strategy_rows(spark, d):
    planned = registry.plan(registry.registry(spark).filter("strategy = 'funding_arb'"), _END, _DAYS)
    return registry.run_rows(planned, _landed(spark, d)).select("seq", "timestamp", *CELL)


@query(
    "strategy_store",
    f"""{oracle_with('landed')}, {_REQ}, picked AS (SELECT seq, timestamp, exchange, data_type, symbol FROM landed WHERE timestamp >= {_END} - {_DAYS} * 86400000 AND timestamp < {_END}
  AND (exchange, data_type, symbol) IN (SELECT exchange, data_type, symbol FROM cells WHERE strategy = 'funding_arb'))
SELECT *, strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d') AS date FROM picked QUALIFY row_number() OVER (PARTITION BY exchange, data_type, symbol, timestamp ORDER BY seq DESC) = 1""",
)
def strategy_store(spark, d):
    """A strategy's run into a table of its own, twice: the second run changes nothing."""
    path = f"{shared_dir(spark)}/strategy-{uuid.uuid4().hex}"
    planned = registry.plan(registry.registry(spark).filter("strategy = 'funding_arb'"), _END, _DAYS)
    landed = _landed(spark, d).select("seq", "timestamp", *CELL)
    for _ in range(2):
        registry.run_into_store(planned, landed, path, _END, _DAYS, ["seq"])
    return store.read_table(spark, path)


@query(
    "unknown_strategies",
    f"""{oracle_with('landed')} SELECT DISTINCT data_type AS strategy FROM landed WHERE data_type NOT IN ('short_strangle', 'synthetic_covered_call', 'collar', 'funding_arb', 'gamma_scalping', 'vol_term_structure')""",
)
def unknown_strategies(spark, d):
    """Names found in the data that no strategy has; the known ones among them go."""
    names = _landed(spark, d).select(F.col("data_type").alias("strategy")).distinct()
    reg = registry.registry(spark)
    return registry.unknown(spark, reg, names.unionByName(reg.select("strategy").distinct()))


@query(
    "strategy_completeness",
    f"""{oracle_with('landed')}, {_REQ}, m AS (SELECT cells.*, rows FROM cells LEFT JOIN counts USING (exchange, data_type, symbol))
SELECT strategy, count(*) AS cells, count(*) FILTER (rows IS NULL) AS missing, CASE WHEN count(*) FILTER (rows IS NULL) = 0 THEN 'ALL MET' ELSE 'INCOMPLETE' END AS strategy_status FROM m GROUP BY 1""",
)
def strategy_completeness(spark, d):
    return registry.strategy_status(registry.completeness(registry.registry(spark), _landed(spark, d)))


_KEYED = _STATS.replace("steps AS (SELECT {key}", "l2 AS (SELECT *, exchange || '/' || data_type || '/' || symbol AS k FROM landed), steps AS (SELECT {key}").format(key="k", src="l2")


@query(
    "verification_report",
    f"""{oracle_with('landed')}, {_KEYED}, expd AS (SELECT * FROM (VALUES ('binance/mark_price', 30), ('deribit/mark_price', 30), ('deribit/options_greeks', 5), ('binance/basis', 10), ('deribit/vol_surface', 10),
  ('binance/funding_rate', 28800), ('deribit/funding_rate', 28800), ('hyperliquid/funding_rate', 28800), ('fred/risk_free_rate', 86400), ('deribit/margin_params', 86400)) t(src, sec)),
w AS (SELECT k, any_value(exchange) AS exchange, any_value(data_type) AS data_type, any_value(symbol) AS symbol, count(*) AS n,
  count(mark_price) < count(*) * 0.5 OR count(funding_rate) < count(*) * 0.5 OR count(bid_price) < count(*) * 0.5 OR count(ask_price) < count(*) * 0.5 AS warn FROM l2 GROUP BY 1),
j AS (SELECT w.*, c.*  EXCLUDE (k), sec FROM w JOIN c USING (k) LEFT JOIN expd ON src = exchange || '/' || data_type),
cov AS (SELECT *, CASE WHEN data_type = 'options_greeks' THEN unique_ts ELSE total_rows END / ((ts_max - ts_min) / 1000e0 / sec) * 100 AS pct FROM j WHERE sec IS NOT NULL)
SELECT exchange, data_type, symbol, 'status' AS "check", CASE WHEN warn THEN 'WARNING' ELSE 'OK' END AS status, n || ' rows' AS detail FROM j
UNION ALL SELECT exchange, data_type, symbol, 'continuity', CASE WHEN max_gap_ms > sec * 3000 OR dup_count > 0 THEN 'WARNING' ELSE 'OK' END,
  concat_ws('; ', CASE WHEN max_gap_ms > sec * 3000 THEN 'Max gap ' || cast(cast(round(max_gap_ms / 1000e0) AS bigint) AS varchar) || 's' END, CASE WHEN dup_count > 0 THEN dup_count || ' duplicate timestamps' END) FROM cov
UNION ALL SELECT exchange, data_type, symbol, 'coverage', CASE WHEN pct > 50 THEN 'OK' ELSE 'LOW' END, printf('%.1f%%', pct) FROM cov""",
)
def verification_report(spark, d):
    return verification.report(_landed(spark, d), CELL, "seq")


@query("verification_incremental", ORACLE["verification_report"])
def verification_incremental(spark, d):
    """The report from summaries kept over three upserts that overlap and come out of order."""
    landed = store.with_date(_landed(spark, d))
    top = landed.agg(F.max("seq")).first()[0]
    folder = f"{shared_dir(spark)}/verified-{uuid.uuid4().hex}"
    table, summaries = f"{folder}/table", f"{folder}/summaries"
    for version, (a, b) in enumerate(((0.0, 0.5), (0.7, 1.1), (0.4, 0.8))):
        batch = landed.where((F.col("seq") >= top * a) & (F.col("seq") < top * b))
        store.upsert(batch, table, keys=["seq"], order_by=["seq"])
        verification.refresh(batch, table, summaries, version, CELL, "seq")
    return verification.report_from(state.read(spark, summaries), CELL)


@query(
    "admission_check",
    f"""{oracle_with('ticks')}, f AS (SELECT user_id, min(seq) AS first FROM ticks GROUP BY 1), k AS (SELECT user_id, first, row_number() OVER (ORDER BY first) AS n FROM f)
SELECT seq, user_id, count(*) FILTER (seq = first) OVER (ORDER BY seq) AS keys_seen, n <= 50 AS admitted FROM ticks JOIN k USING (user_id)""",
)
def admission_check(spark, d):
    return metrics.admission_check(view(spark, d, "ticks").select("seq", "user_id"), "user_id", "seq", 50, 1000)
