"""As-of joins, gaps, fills, outliers, continuity, silence."""

from __future__ import annotations

from pyspark.sql import functions as F

from quoteloom.operators import asof, continuity, gaps, metrics, outliers

from .base import oracle_with, query, r, rounded, view

MIN5, MIN10, HOUR = 300_000, 600_000, 3_600_000


def _feed(spark, d, name, *columns):
    return view(spark, d, "ticks").filter(F.col("instrument") == name).select(*columns)


def _pair_sql(keyed: bool, direction: str, tolerance: int | None, digits: bool = True) -> str:
    key = "user_id, " if keyed else ""
    eq = "v.user_id = {0}.user_id AND " if keyed else ""
    back = f"b AS (SELECT {key}timestamp, arg_max(price, seq) AS price FROM ticks WHERE instrument = 'click' GROUP BY ALL)"
    ahead = f"f AS (SELECT {key}timestamp, arg_min(price, seq) AS price FROM ticks WHERE instrument = 'click' GROUP BY ALL)"
    within = (lambda gap: f"{gap} <= {tolerance}") if tolerance is not None else (lambda gap: f"{gap} IS NOT NULL")
    return f"""{oracle_with('ticks')}, {back}, {ahead}, v AS (SELECT * FROM ticks WHERE instrument = 'view'),
m AS (SELECT v.*, b.timestamp AS bt, b.price AS bp FROM v ASOF LEFT JOIN b ON {eq.format('b')}v.timestamp >= b.timestamp),
n AS (SELECT v.seq, f.timestamp AS ft, f.price AS fp FROM v ASOF LEFT JOIN f ON {eq.format('f')}v.timestamp <= f.timestamp),
j AS (SELECT m.*, n.ft, n.fp, coalesce({within('m.timestamp - m.bt')}, false) AS bok, coalesce({within('n.ft - m.timestamp')}, false) AS fok FROM m JOIN n USING (seq)),
k AS (SELECT seq, user_id, timestamp, price, {_choice(direction)} FROM j)"""


def _choice(direction: str) -> str:
    if direction == "backward":
        side = "CASE WHEN bok THEN 'b' END"
    elif direction == "forward":
        side = "CASE WHEN fok THEN 'f' END"
    else:
        side = "CASE WHEN bok AND (NOT fok OR timestamp - bt <= ft - timestamp) THEN 'b' WHEN fok THEN 'f' END"
    return (
        f"CASE {side} WHEN 'b' THEN bp WHEN 'f' THEN fp END AS click_price, "
        f"CASE {side} WHEN 'b' THEN timestamp - bt WHEN 'f' THEN timestamp - ft END AS click_price_age_ms"
    )


def _asof_query(name: str, direction: str, tolerance: int | None, keyed: bool):
    sql = _pair_sql(keyed, direction, tolerance) + " SELECT * FROM k"

    @query(name, sql)
    def run(spark, d):
        key = ["user_id"] if keyed else []
        target = _feed(spark, d, "view", "seq", "user_id", "timestamp", "price")
        source = _feed(spark, d, "click", *key, "seq", "timestamp", "price")
        return asof.asof_join(
            target, source, keys=key, direction=direction, tolerance_ms=tolerance, columns=["price"],
            seq="seq", rename={"price": "click_price"},
        )

    return run


_asof_query("asof_backward", "backward", MIN5, False)
_asof_query("asof_forward", "forward", MIN5, False)
_asof_query("asof_nearest", "nearest", None, False)
_asof_query("asof_nearest_tolerance", "nearest", MIN10, False)
_asof_query("asof_backward_by_key", "backward", 24 * HOUR, True)
_asof_query("asof_forward_by_key", "forward", 24 * HOUR, True)


@query(
    "strategy_slice",
    f"""{oracle_with('ticks')}, base AS (SELECT seq, timestamp FROM ticks WHERE instrument = 'view'),
a AS (SELECT timestamp, arg_max(price, seq) AS price FROM ticks WHERE instrument = 'purchase' GROUP BY 1),
b AS (SELECT timestamp, arg_max(price, seq) AS price FROM ticks WHERE instrument = 'signup' GROUP BY 1),
x AS (SELECT base.*, a.timestamp AS ta, a.price AS ap FROM base ASOF LEFT JOIN a ON base.timestamp >= a.timestamp),
y AS (SELECT x.*, b.timestamp AS tb, b.price AS bp FROM x ASOF LEFT JOIN b ON x.timestamp >= b.timestamp)
SELECT seq, timestamp, CASE WHEN timestamp - ta <= {MIN5} THEN ap END AS price_a,
  CASE WHEN timestamp - ta <= {MIN5} THEN timestamp - ta END AS price_a_age_ms,
  CASE WHEN timestamp - tb <= 60000 THEN bp END AS price_b,
  CASE WHEN timestamp - tb <= 60000 THEN timestamp - tb END AS price_b_age_ms FROM y""",
)
def strategy_slice(spark, d):
    base = _feed(spark, d, "view", "seq", "timestamp")
    sources = [
        asof.Source("a", _feed(spark, d, "purchase", "seq", "timestamp", F.col("price").alias("price_a")), tolerance_ms=MIN5, seq="seq"),
        asof.Source("b", _feed(spark, d, "signup", "seq", "timestamp", F.col("price").alias("price_b")), seq="seq"),
    ]
    return asof.strategy_slice(base, sources)


_GAPS = """SELECT {key} lag(timestamp) OVER w AS gap_start, timestamp AS gap_end, timestamp - lag(timestamp) OVER w AS gap_duration_ms,
  lag(instrument) OVER w AS was, instrument AS becomes FROM ticks WINDOW w AS ({part} ORDER BY timestamp, seq)"""


@query(
    "detect_gaps",
    f"""{oracle_with('ticks')}, s AS ({_GAPS.format(key='', part='')})
SELECT gap_start, gap_end, gap_duration_ms, CASE WHEN was = becomes THEN was ELSE was || ',' || becomes END AS affected
FROM s WHERE gap_duration_ms > {MIN10}""",
)
def detect_gaps(spark, d):
    found = gaps.detect_gaps(view(spark, d, "ticks"), MIN10, seq="seq")
    return found.withColumn("affected", F.array_join("affected_instruments", ",")).drop("affected_instruments")


@query(
    "detect_gaps_by_key",
    f"""{oracle_with('ticks')}, s AS ({_GAPS.format(key='user_id,', part='PARTITION BY user_id')})
SELECT user_id, gap_start, gap_end, gap_duration_ms, CASE WHEN was = becomes THEN was ELSE was || ',' || becomes END AS affected
FROM s WHERE gap_duration_ms > {24 * HOUR}""",
)
def detect_gaps_by_key(spark, d):
    found = gaps.detect_gaps(view(spark, d, "ticks"), 24 * HOUR, keys=["user_id"], seq="seq")
    return found.withColumn("affected", F.array_join("affected_instruments", ",")).drop("affected_instruments")


_HOLES = "holes AS (SELECT *, CASE WHEN seq % 7 IN (0, 1) THEN NULL ELSE price END AS close FROM ticks)"


def _holes(spark, d):
    hole = F.col("seq") % 7
    return view(spark, d, "ticks").withColumn("close", F.when(~hole.isin(0, 1), F.col("price")))


@query(
    "ffill",
    f"""{oracle_with('ticks')}, {_HOLES} SELECT seq, instrument,
  last_value(close IGNORE NULLS) OVER (PARTITION BY instrument ORDER BY seq ROWS UNBOUNDED PRECEDING) AS close FROM holes""",
)
def ffill(spark, d):
    rows = _holes(spark, d).select("seq", "instrument", "close")
    return gaps.forward_fill(rows, ["close"], "seq", ["instrument"])


@query(
    "interpolate_linear",
    f"""{oracle_with('ticks')}, {_HOLES}, n AS (SELECT *, row_number() OVER (ORDER BY seq) AS rn FROM holes),
e AS (SELECT seq, close, rn, last_value(CASE WHEN close IS NOT NULL THEN rn END IGNORE NULLS) OVER p AS bn, last_value(close IGNORE NULLS) OVER p AS bv,
 first_value(CASE WHEN close IS NOT NULL THEN rn END IGNORE NULLS) OVER q AS an, first_value(close IGNORE NULLS) OVER q AS av FROM n
 WINDOW p AS (ORDER BY seq ROWS UNBOUNDED PRECEDING), q AS (ORDER BY seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT seq, {r("CASE WHEN close IS NOT NULL THEN close WHEN bn IS NULL THEN NULL WHEN an IS NULL THEN bv ELSE bv + (av - bv) * ((rn - bn) / (an - bn)) END")} AS value FROM e""",
)
def interpolate_linear(spark, d):
    rows = _holes(spark, d).select("seq", F.col("close").alias("value"))
    return rounded(gaps.interpolate_linear(rows, ["value"], "seq"), "value")


@query(
    "fill_gaps",
    f"""{oracle_with('ticks')}, {_HOLES}, n AS (SELECT *, CASE WHEN close IS NULL THEN NULL ELSE price * 2 END AS mark, row_number() OVER (ORDER BY seq) AS rn FROM holes),
e AS (SELECT *, last_value(CASE WHEN mark IS NOT NULL THEN rn END IGNORE NULLS) OVER p AS bn, last_value(mark IGNORE NULLS) OVER p AS bv, last_value(close IGNORE NULLS) OVER p AS fc,
 first_value(CASE WHEN mark IS NOT NULL THEN rn END IGNORE NULLS) OVER q AS an, first_value(mark IGNORE NULLS) OVER q AS av FROM n
 WINDOW p AS (ORDER BY seq ROWS UNBOUNDED PRECEDING), q AS (ORDER BY seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT seq, fc AS close, {r("CASE WHEN mark IS NOT NULL THEN mark WHEN bn IS NULL THEN NULL WHEN an IS NULL THEN bv ELSE bv + (av - bv) * ((rn - bn) / (an - bn)) END")} AS mark FROM e""",
)
def fill_gaps(spark, d):
    rows = _holes(spark, d).select("seq", "close", F.when(F.col("close").isNotNull(), F.col("price") * 2).alias("mark"))
    return rounded(gaps.fill_gaps(rows, "seq"), "mark")


_Z = """z AS (SELECT *, avg(price) OVER w AS m, stddev_samp(price) OVER w AS s FROM ticks
  WINDOW w AS ({part} ORDER BY seq ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)),
o AS (SELECT *, coalesce(abs((price - m) / nullif(s, 0)) > {t}, false) AS is_outlier FROM z)"""


@query("outlier_flag", f"{oracle_with('ticks')}, {_Z.format(part='', t='3.0')} SELECT seq, price, is_outlier FROM o")
def outlier_flag(spark, d):
    rows = view(spark, d, "ticks").select("seq", "price")
    return outliers.flag_outliers(rows, ["price", "not_there"], "seq", threshold=3.0)


@query(
    "outliers_only",
    f"{oracle_with('ticks')}, {_Z.format(part='PARTITION BY instrument', t='5.0')} SELECT seq, instrument, price, is_outlier FROM o WHERE is_outlier",
)
def outliers_only(spark, d):
    rows = view(spark, d, "ticks").select("seq", "instrument", "price")
    return outliers.outliers_only(rows, ["price"], "seq", keys=["instrument"])


_STATS = """steps AS (SELECT {key}, timestamp, lag(timestamp) OVER (PARTITION BY {key} ORDER BY timestamp) AS prev FROM (SELECT DISTINCT {key}, timestamp FROM {src})),
big AS (SELECT {key}, max(timestamp - prev) AS g, arg_min(prev, (-(timestamp - prev), prev)) AS g_at FROM steps GROUP BY ALL),
stats AS (SELECT {key}, count(*) AS total_rows, count(DISTINCT timestamp) AS unique_ts, count(*) - count(DISTINCT timestamp) AS dup_count,
  min(timestamp) AS ts_min, max(timestamp) AS ts_max FROM {src} GROUP BY ALL),
c AS (SELECT stats.*, coalesce(big.g, 0) AS max_gap_ms, CASE WHEN big.g > 0 THEN big.g_at END AS max_gap_at FROM stats JOIN big USING ({key}))"""


@query("continuity_stats", f"{oracle_with('candles')}, {_STATS.format(key='symbol', src='candles')} SELECT * FROM c")
def continuity_stats(spark, d):
    return continuity.continuity_stats(view(spark, d, "candles"), keys=["symbol"])


@query(
    "arrival_order",
    f"""{oracle_with('candles')}, one AS (SELECT symbol, seq * 8 + seq2 AS arrival, min(timestamp) AS timestamp FROM candles GROUP BY 1, 2),
s AS (SELECT symbol, timestamp, lag(timestamp) OVER (PARTITION BY symbol ORDER BY arrival) AS prev FROM one)
SELECT symbol, count(*) FILTER (timestamp < prev) AS backward_steps, count(*) FILTER (timestamp < prev) = 0 AS monotonic FROM s GROUP BY 1""",
)
def arrival_order(spark, d):
    one = view(spark, d, "candles").groupBy("symbol", (F.col("seq") * 8 + F.col("seq2")).alias("arrival")).agg(
        F.min("timestamp").alias("timestamp")
    )
    return continuity.arrival_order(one, "arrival", keys=["symbol"])


@query(
    "strictly_increasing",
    f"""{oracle_with('candles')}, one AS (SELECT symbol, seq * 8 + seq2 AS arrival, min(timestamp) AS timestamp FROM candles GROUP BY 1, 2),
s AS (SELECT symbol, timestamp, lag(timestamp) OVER (PARTITION BY symbol ORDER BY arrival) AS prev FROM one)
SELECT symbol, count(*) FILTER (timestamp <= prev) AS bad_steps, count(*) FILTER (timestamp <= prev) = 0 AS strictly_increasing FROM s GROUP BY 1""",
)
def strictly_increasing(spark, d):
    one = view(spark, d, "candles").groupBy("symbol", (F.col("seq") * 8 + F.col("seq2")).alias("arrival")).agg(
        F.min("timestamp").alias("timestamp")
    )
    return continuity.non_increasing_steps(one, "arrival", keys=["symbol"])


_ORDER = """a AS (SELECT instrument, count(*) FILTER (timestamp < prev) = 0 AS monotonic FROM
  (SELECT instrument, timestamp, lag(timestamp) OVER (PARTITION BY instrument ORDER BY seq) AS prev FROM ticks) GROUP BY 1)"""


@query(
    "continuity_check",
    f"""{oracle_with('ticks')}, {_STATS.format(key='instrument', src='ticks')}, {_ORDER}
SELECT instrument, concat_ws('; ', CASE WHEN max_gap_ms > 3 * {MIN10} THEN 'Max gap ' || cast(cast(round(max_gap_ms / 1000e0) AS bigint) AS varchar) || 's' END,
  CASE WHEN NOT monotonic THEN 'Timestamps not monotonically increasing' END,
  CASE WHEN dup_count > 0 THEN cast(dup_count AS varchar) || ' duplicate timestamps' END) AS issues FROM c JOIN a USING (instrument)""",
)
def continuity_check(spark, d):
    ticks = view(spark, d, "ticks")
    stats = continuity.continuity_stats(ticks, keys=["instrument"]).join(
        continuity.arrival_order(ticks, "seq", keys=["instrument"]), "instrument"
    )
    found = continuity.continuity_issues(stats, F.lit(MIN10))
    return found.select("instrument", F.array_join("issues", "; ").alias("issues"))


@query(
    "coverage",
    f"""{oracle_with('ticks')}, {_STATS.format(key='instrument', src='ticks')}
SELECT instrument, total_rows, {r('(ts_max - ts_min) / 3600000e0')} AS hours,
  {r("CASE WHEN instrument = 'view' THEN unique_ts ELSE total_rows END / ((ts_max - ts_min) / 1000e0 / 1200) * 100")} AS coverage_pct,
  CASE WHEN CASE WHEN instrument = 'view' THEN unique_ts ELSE total_rows END / ((ts_max - ts_min) / 1000e0 / 1200) * 100 > 50 THEN 'OK' ELSE 'LOW' END AS coverage_status FROM c""",
)
def coverage(spark, d):
    stats = continuity.continuity_stats(view(spark, d, "ticks"), keys=["instrument"])
    out = continuity.coverage(stats, F.lit(1200), F.col("instrument") == "view")
    return rounded(out.select("instrument", "total_rows", "hours", "coverage_pct", "coverage_status"), "hours", "coverage_pct")


@query(
    "ohlc_integrity",
    f"""{oracle_with('candles')} SELECT symbol, seq, seq2, timestamp, {r('open')} AS open, {r('close')} AS close FROM candles
WHERE NOT (high >= open AND high >= close AND high >= low AND low <= open AND low <= close)""",
)
def ohlc_integrity(spark, d):
    bad = continuity.ohlc_violations(view(spark, d, "candles"))
    return rounded(bad.select("symbol", "seq", "seq2", "timestamp", "open", "close"), "open", "close")


@query(
    "feed_silence",
    f"""{oracle_with('ticks')}, s AS (SELECT instrument, lag(timestamp) OVER (PARTITION BY instrument ORDER BY timestamp, seq) AS p, timestamp AS t FROM ticks),
l AS (SELECT instrument, max(timestamp) AS m FROM ticks GROUP BY 1)
SELECT instrument, p AS silent_from, p + {2 * HOUR} AS alert_at, t AS resumed_at, t - p AS silence_ms FROM s WHERE t - p > {2 * HOUR}
UNION ALL SELECT instrument, m, m + {2 * HOUR}, NULL, 1772323200000 - m FROM l WHERE 1772323200000 - m > {2 * HOUR}""",
)
def feed_silence(spark, d):
    return metrics.feed_silence(view(spark, d, "ticks"), "instrument", 2 * HOUR, now_ms=1772323200000)


@query(
    "failure_streaks",
    f"""{oracle_with('ticks')}, x AS (SELECT seq, instrument, count(*) FILTER (instrument <> 'error') OVER (ORDER BY seq) AS run FROM ticks)
SELECT min(seq) AS first_failure, max(seq) AS last_failure, count(*) AS failures, count(*) >= 3 AS alert FROM x WHERE instrument = 'error' GROUP BY run""",
)
def failure_streaks(spark, d):
    return metrics.failure_streaks(view(spark, d, "ticks"), F.col("instrument") != "error", "seq", 3)


@query(
    "snapshot_1s",
    f"""{oracle_with('ticks')} SELECT instrument, timestamp // 1000 * 1000 AS snapshot_ts, max(timestamp) AS timestamp,
  arg_max(price, (timestamp, seq)) AS price, arg_max(seq, (timestamp, seq)) AS seq FROM ticks GROUP BY 1, 2""",
)
def snapshot_1s(spark, d):
    rows = view(spark, d, "ticks").select("instrument", "timestamp", "price", "seq")
    return metrics.snapshots(rows, ["instrument"], 1000, seq="seq")


@query(
    "snapshot_filled",
    f"""{oracle_with('ticks')}, b AS (SELECT instrument, min(timestamp) AS lo, max(timestamp) AS hi FROM ticks GROUP BY 1),
sp AS (SELECT instrument, unnest(range((lo + 599999) // 600000 * 600000, hi + 1, 600000)) AS timestamp FROM b),
s AS (SELECT instrument, timestamp, arg_max(price, seq) AS price FROM ticks GROUP BY 1, 2)
SELECT sp.instrument, sp.timestamp, s.price, sp.timestamp - s.timestamp AS price_age_ms FROM sp ASOF LEFT JOIN s ON sp.instrument = s.instrument AND sp.timestamp >= s.timestamp""",
)
def snapshot_filled(spark, d):
    rows = view(spark, d, "ticks").select("instrument", "timestamp", "price", "seq")
    return metrics.filled_snapshots(rows, ["instrument"], ["price"], MIN10, seq="seq")


_NULL_KEY = "nullif(user_id % 4, 0)"


@query(
    "asof_null_keys",
    f"""{oracle_with('ticks')}, v AS (SELECT seq, {_NULL_KEY} AS k, timestamp FROM ticks WHERE instrument = 'view'),
c AS (SELECT {_NULL_KEY} AS k, timestamp, arg_max(price, seq) AS price FROM ticks WHERE instrument = 'click' GROUP BY 1, 2)
SELECT v.seq, v.k, v.timestamp, c.price AS click_price, v.timestamp - c.timestamp AS click_price_age_ms
FROM v ASOF LEFT JOIN c ON coalesce(v.k, -1) = coalesce(c.k, -1) AND v.timestamp >= c.timestamp""",
)
def asof_null_keys(spark, d):
    """Rows without a key are aligned with sources without one."""
    rows = view(spark, d, "ticks").withColumn("k", F.expr(_NULL_KEY))
    target = rows.where("instrument = 'view'").select("seq", "k", "timestamp")
    source = rows.where("instrument = 'click'").select(F.col("seq").alias("s"), "k", "timestamp", F.col("price").alias("click_price"))
    return asof.asof_join(target, source, keys=["k"], tolerance_ms=None, seq="s")
