"""Option chains: filters, implied volatility, surface metrics, main contracts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from ..functions.black_scholes import DAYS_PER_YEAR, GREEKS, with_greeks, years_to_expiry
from .blocks import join_keys
from .ranks import count_at_or_below

# Fixed values of the chain filters.
MIN_YEARS_LEFT = 5.0 / (DAYS_PER_YEAR * 24 * 60)
MAX_MONEYNESS = 0.50
FALLBACK_IV = 0.5
IV_FLOOR = 0.001
DEFAULT_RATE = 0.05
# Share of the underlying within which the at-the-money search widens.
ATM_BANDS = (0.05, 0.15, 0.50)
WING_DELTA = 0.25
NO_HISTORY_RANK = 50.0

GREEKS_FLOATS = (
    "underlying_price", "strike", "time_to_expiry_years", "iv", "delta", "gamma", "vega",
    "theta", "rho", "mid_price", "bid_price", "ask_price",
)


def number(name: str) -> Column:
    """Numeric value of a column, 0 where it is missing or not a number."""
    value = F.col(name).try_cast("double")
    return F.coalesce(F.when(~F.isnan(value), value), F.lit(0.0))


def parse_instruments(df: DataFrame, name: str = "instrument_name") -> DataFrame:
    """Add currency, expiry, strike, side and expiry ms; all null for other names.

    The fields come out of a generator, so a later filter on them stays above it and the
    name is parsed once per row instead of once per use.
    """
    fields = ("currency", "expiry", "strike", "option_type", "expiry_timestamp")
    kept = [c for c in df.columns if c not in fields]
    staged = df.select(*kept, text.option_parts(F.col(name)).alias("_parts"))
    return staged.select(*kept, F.inline(F.array(text.option_fields(F.col("_parts")))))


def time_to_expiry(df: DataFrame, now_ms: int | Column, expiry: str = "expiry_timestamp") -> DataFrame:
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms)
    return df.withColumn("time_to_expiry_years", years_to_expiry(F.col(expiry), now))


def is_alive(
    bid: str = "bid_price",
    ask: str = "ask_price",
    years: str = "time_to_expiry_years",
    strike: str = "strike",
    spot: str = "underlying_price",
) -> Column:
    """Quoted on a side, more than five minutes left, strike within half the price."""
    s = number(spot)
    return (
        ((number(bid) > 0) | (number(ask) > 0))
        & (F.col(years) > MIN_YEARS_LEFT)
        & (F.abs(F.col(strike) - s) / F.greatest(s, F.lit(1.0)) < MAX_MONEYNESS)
    )


def resolve_iv(df: DataFrame, iv_scale: float = 1.0) -> DataFrame:
    """Add ``iv`` and ``iv_source``: mark, else mid of bid and ask, else the fallback."""
    mark, mid = number("mark_iv"), (number("bid_iv") + number("ask_iv")) / 2
    quoted = F.when(mark > 0, mark).when(mid > 0, mid)
    return df.withColumns(
        {
            "iv": F.greatest(
                F.coalesce(quoted / F.lit(float(iv_scale)), F.lit(FALLBACK_IV)), F.lit(IV_FLOOR)
            ),
            "iv_source": F.when(quoted.isNotNull(), "rest_api").otherwise("fallback"),
        }
    )


def greeks_batch(
    chain: DataFrame,
    now_ms: int | Column,
    rate: float | Column = DEFAULT_RATE,
    iv_scale: float = 1.0,
    extra: list[str] | None = None,
    as_float: bool = True,
) -> DataFrame:
    """Raw chain rows -> Greeks records: parse, age, filter, resolve volatility, price.

    One projection over the scan: no shuffle, any chain size.  ``extra`` columns pass
    through; ``as_float`` narrows the numbers to 32 bit as stored.
    """
    optional = [c for c in ("mid_price", "underlying_price", "mark_iv", "bid_iv", "ask_iv", "open_interest") if c not in chain.columns]
    full = chain.withColumns({c: F.lit(None).cast("double") for c in optional}) if optional else chain
    now = now_ms if isinstance(now_ms, Column) else F.lit(now_ms)
    parsed = parse_instruments(full.withColumn("timestamp", now.cast("long"))).filter(
        F.col("expiry_timestamp").isNotNull()
    )
    clean = time_to_expiry(parsed, F.col("timestamp")).filter(is_alive())
    clean = clean.withColumns(
        {c: number(c) for c in ("underlying_price", "bid_price", "ask_price", "mid_price")}
    )
    priced = with_greeks(resolve_iv(clean, iv_scale), rate)
    kind = "float" if as_float else "double"
    return priced.select(
        *(extra or []),
        "timestamp",
        "instrument_name",
        F.lit("deribit").alias("exchange"),
        *[F.col(c).cast(kind).alias(c) for c in ("underlying_price", "strike")],
        "expiry",
        F.col("time_to_expiry_years").cast(kind).alias("time_to_expiry_years"),
        "option_type",
        F.col("iv").cast(kind).alias("iv"),
        "iv_source",
        *[F.col(c).cast(kind).alias(c) for c in (*GREEKS, "mid_price", "bid_price", "ask_price")],
    )


# -- surface metrics ---------------------------------------------------------------


def _distance(spot: str) -> Column:
    return F.abs(F.col("strike") - F.col(spot))


def _closest(value: Column, distance: Column, seq: str, where: Column | None = None) -> Column:
    """Value of the row with the least distance, the first one on ties."""
    rank = F.struct(distance.alias("d"), F.col(seq).alias("s"))
    usable = distance.isNotNull() if where is None else distance.isNotNull() & where
    return F.min_by(value, F.when(usable, rank))


def _in_band(band: float, spot: str) -> Column:
    s = F.col(spot)
    return (s > 0) & (_distance(spot) / s <= band) & (F.col("iv") > 0)


def _band_of_group(spot: str) -> Column:
    """Tightest band that holds a usable row in the group; null where none does."""
    return F.coalesce(*[F.max(F.when(_in_band(b, spot), F.lit(b))) for b in ATM_BANDS])


def near_atm(df: DataFrame, keys: list[str], spot: str = "underlying_price") -> DataFrame:
    """Rows of the tightest band around the price that has a usable volatility; all rows
    of a group where no band has one."""
    bands = df.groupBy(*keys).agg(_band_of_group(spot).alias("_band"))
    joined = join_keys(df, bands, keys)
    keep = F.col("_band").isNull() | (
        (F.col("iv") > 0) & (F.col(spot) > 0) & (_distance(spot) / F.col(spot) <= F.col("_band"))
    )
    return joined.filter(keep).select(*df.columns)


def atm_iv(df: DataFrame, keys: list[str], seq: str, spot: str = "underlying_price") -> DataFrame:
    """Volatility at the strike closest to the price."""
    return df.groupBy(*keys).agg(_closest(F.col("iv"), _distance(spot), seq).alias("atm_iv"))


def _wing(delta: float, seq: str) -> Column:
    return _closest(F.col("iv"), F.abs(F.col("delta") - F.lit(delta)), seq)


def _with_delta(df: DataFrame) -> DataFrame:
    return df if "delta" in df.columns else df.withColumn("delta", F.lit(None).cast("double"))


def skew_25d(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """Volatility of the 25-delta call less that of the put; 0 without any delta."""
    skew = F.coalesce(_wing(WING_DELTA, seq) - _wing(-WING_DELTA, seq), F.lit(0.0))
    return _with_delta(df).groupBy(*keys).agg(skew.alias("skew_25d"))


def _butterfly(seq: str, spot: str) -> Column:
    wings = (_wing(WING_DELTA, seq) + _wing(-WING_DELTA, seq)) / 2
    return F.coalesce(wings - _closest(F.col("iv"), _distance(spot), seq), F.lit(0.0))


def butterfly_25d(df: DataFrame, keys: list[str], seq: str, spot: str = "underlying_price") -> DataFrame:
    """Mean of the 25-delta wings less the volatility at the money; 0 without any delta."""
    return _with_delta(df).groupBy(*keys).agg(_butterfly(seq, spot).alias("butterfly_25d"))


def term_structure(df: DataFrame, keys: list[str], seq: str, spot: str = "underlying_price") -> DataFrame:
    """At-the-money volatility per expiry, long form."""
    return atm_iv(df, [*keys, "expiry"], seq, spot)


def term_structure_map(df: DataFrame, keys: list[str], seq: str, spot: str = "underlying_price") -> DataFrame:
    """The same as one map per group; its size is the number of listed expiries."""
    pairs = F.sort_array(F.collect_list(F.struct("expiry", "atm_iv")))
    return (
        term_structure(df, keys, seq, spot)
        .groupBy(*keys)
        .agg(F.map_from_entries(pairs).alias("term_structure"))
    )


def iv_rank(
    current: DataFrame,
    history: DataFrame,
    keys: list[str],
    value: str = "atm_iv",
    past: str = "iv",
    lookback_days: int | None = None,
    on: str = "timestamp",
) -> DataFrame:
    """Percent of past values at or below the current one; 50 without history.

    Where ``on`` is one of the keys, the others name the series whose history counts.  With
    ``lookback_days`` only the days up to each row's time do.  Rows at many times are counted
    without pairing them with their history (``ranks``).  With one row per series, history
    is first counted per value on the map side (quoted volatilities repeat a lot), and a
    row's columns travel through the join, so ``current`` is read once.
    """
    series = [k for k in keys if k != on]
    if lookback_days or on in keys:
        until = F.col(on) if lookback_days else None
        since = until - lookback_days * 86_400_000 if lookback_days else None
        counted = count_at_or_below(current, history, series, value, past, since, until, on)
        rank = F.when(F.col("_total") > 0, F.col("_below") * 100.0 / F.col("_total"))
        return counted.select(*current.columns, F.coalesce(rank, F.lit(NO_HISTORY_RANK)).alias("iv_rank"))
    now = current.select(F.struct(*current.columns).alias("_row"), F.col(value).alias("_now"), *[F.col(k).alias(f"_k_{k}") for k in series])
    past_rows = history.groupBy(*series, F.col(past).alias("_past")).agg(F.count(F.lit(1)).alias("_n"))
    past_rows = past_rows.filter(F.col("_past").isNotNull())
    same = reduce(lambda a, b: a & b, [F.col(f"_k_{k}").eqNullSafe(past_rows[k]) for k in series], F.lit(True))
    met = now.join(past_rows, same, "left")
    below = F.sum(F.when(F.col("_past") <= F.col("_now"), F.col("_n")).otherwise(0))
    counted = met.groupBy(*[F.col(f"_row.{k}").alias(f"_g_{k}") for k in keys]).agg(
        F.any_value("_row").alias("_row"), (below * 100.0 / F.sum("_n")).alias("_rank")
    )
    return counted.select("_row.*", F.coalesce("_rank", F.lit(NO_HISTORY_RANK)).alias("iv_rank"))


def vol_surface(
    greeks: DataFrame,
    keys: list[str],
    seq: str,
    spot: str = "underlying_price",
    history: DataFrame | None = None,
    lookback_days: int | None = None,
) -> DataFrame:
    """One surface point per group: at-the-money volatility of the tightest usable band,
    skew and butterfly over all rows, volatility per expiry, rank, quality.

    With ``timestamp`` among the keys there is a point per time, each ranked in the history
    (iv, timestamp) of its series.  Without deltas skew and butterfly are 0, and a point that
    is 0 all over is "estimated".

    The rows are aggregated once, per expiry; the point is put together from those few
    results.
    """
    rows = _with_delta(greeks).select(
        *keys, "expiry", F.col("timestamp").alias("_latest"), "iv", F.col(seq).alias("_s"),
        _distance(spot).alias("_d"),
        F.abs(F.col("delta") - WING_DELTA).alias("_call"),
        F.abs(F.col("delta") + WING_DELTA).alias("_put"),
        *[_in_band(b, spot).alias(f"_in{i}") for i, b in enumerate(ATM_BANDS)],
    )

    def best(distance: str, where: str | None = None) -> Column:
        usable = F.col(distance).isNotNull() if where is None else F.col(distance).isNotNull() & F.col(where)
        return F.min(F.when(usable, F.struct(F.col(distance).alias("d"), F.col("_s").alias("s"), F.col("iv").alias("iv"))))

    picks = {"_all": best("_d"), "_c": best("_call"), "_p": best("_put")}
    picks.update({f"_atm{i}": best("_d", f"_in{i}") for i in range(len(ATM_BANDS))})
    by_expiry = rows.groupBy(*keys, "expiry").agg(
        F.max("_latest").alias("_latest"), *[c.alias(n) for n, c in picks.items()]
    )
    term = F.sort_array(F.collect_list(F.struct("expiry", F.col("_all.iv").alias("iv"))))
    point = by_expiry.groupBy(*keys).agg(
        F.max("_latest").alias("_latest"),
        F.map_from_entries(term).alias("term_structure"),
        *[F.min(n).alias(n) for n in picks],
    )
    wings = F.col("_c.iv"), F.col("_p.iv")
    point = point.withColumns(
        {
            "atm_iv": F.coalesce(*[F.col(f"_atm{i}.iv") for i in range(len(ATM_BANDS))], F.col("_all.iv")),
            "skew_25d": F.coalesce(wings[0] - wings[1], F.lit(0.0)),
            "butterfly_25d": F.coalesce((wings[0] + wings[1]) / 2 - F.col("_all.iv"), F.lit(0.0)),
        }
    )
    flat = (F.coalesce("atm_iv", F.lit(0.0)) == 0) & (F.col("skew_25d") == 0) & (F.col("butterfly_25d") == 0)
    point = point.withColumn("quality", F.when(flat, "estimated").otherwise("good"))
    if history is None:
        point = point.withColumn("iv_rank", F.lit(NO_HISTORY_RANK))
    else:
        point = iv_rank(point, history, keys, lookback_days=lookback_days)
    stamp = [] if "timestamp" in keys else [F.col("_latest").alias("timestamp")]
    return point.select(
        *keys, *stamp, "atm_iv", "skew_25d", "butterfly_25d", "iv_rank", "term_structure", "quality"
    )


def first_underlying(df: DataFrame, keys: list[str], seq: str, spot: str = "underlying_price") -> DataFrame:
    """Replace each row's underlying by that of the group's first row."""
    first = df.groupBy(*keys).agg(F.min_by(spot, seq).alias("_first"))
    return join_keys(df, first, keys).withColumn(spot, F.col("_first")).drop("_first")


def main_contracts(
    instruments: DataFrame,
    underlying: Column,
    seq: str,
    keys: list[str] | None = None,
    top_n: int = 5,
) -> DataFrame:
    """Per expiry day: the ``top_n`` contracts by open interest split into calls and
    puts, their total, and the strike closest to the price among all contracts.

    The row-number filter is pushed below the shuffle as a group limit, so each task
    sends at most ``top_n`` rows per expiry.
    """
    keys = list(keys or [])
    base = instruments.filter(F.col("expiration_timestamp").isNotNull()).withColumns(
        {
            "expiry": text.utc_day_string(F.col("expiration_timestamp")),
            "_oi": F.coalesce(F.col("open_interest").cast("double"), F.lit(0.0)),
            "_spot": underlying,
        }
    )
    group = [*keys, "expiry"]
    order = Window.partitionBy(*group).orderBy(F.desc("_oi"), F.asc(seq))
    ranked = base.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= top_n)
    is_call = F.col("option_type") == "call"

    def names(side: Column) -> Column:
        entry = F.when(side, F.struct(F.col("_rank"), F.col("instrument_name")))
        return F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["instrument_name"])

    top = ranked.groupBy(*group).agg(
        names(is_call).alias("calls"),
        names(~F.coalesce(is_call, F.lit(False))).alias("puts"),
        F.sum("_oi").alias("total_oi"),
    )
    rank = F.struct(F.abs(F.col("strike") - F.col("_spot")), F.col("strike"))
    atm = base.groupBy(*group).agg(
        F.coalesce(F.min_by("strike", F.when(F.col("strike").isNotNull(), rank)).cast("double"), F.lit(0.0)).alias("atm_strike")
    )
    return join_keys(top, atm, group).select(*group, "calls", "puts", "atm_strike", "total_oi")
