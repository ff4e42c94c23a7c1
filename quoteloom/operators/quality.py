"""Data-quality checks as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .gaps import present

DAY_MS = 86_400_000

# Columns watched for nulls, and fields a ticker must have.
NULL_CHECKED = ("mark_price", "funding_rate", "bid_price", "ask_price")
TICKER_FIELDS = (
    "instrument_name", "timestamp", "underlying_price", "mark_price", "bid_price", "ask_price",
    "bid_iv", "ask_iv", "mark_iv", "open_interest", "volume_24h", "settlement_period",
)
# Fixed values: (rule, column, condition, whether a null breaks the rule).
VALUE_RULES = (
    ("underlying_price_positive", "underlying_price", "> 0", False),
    ("bid_iv_range", "bid_iv", "between 0 and 5", True),
    ("mark_iv_range", "mark_iv", "between 0 and 5", True),
    ("open_interest_not_negative", "open_interest", ">= 0", False),
)
# Expected seconds between records per (exchange, data type).
EXPECTED_SECONDS = (
    ("binance", "mark_price", 30),
    ("deribit", "mark_price", 30),
    ("binance", "spot_price", 1),
    ("deribit", "options_ticker", 1),
    ("deribit", "options_greeks", 5),
    ("binance", "basis", 10),
    ("deribit", "vol_surface", 10),
    ("binance", "funding_rate", 28800),
    ("deribit", "funding_rate", 28800),
    ("hyperliquid", "funding_rate", 28800),
    ("fred", "risk_free_rate", 86400),
    ("deribit", "margin_params", 86400),
)
MULTI_INSTRUMENT = (("deribit", "options_greeks"),)


def _long(df: DataFrame, keys: list[str], entries: list[tuple[str, list[Column]]], names: list[str]) -> DataFrame:
    """Turn per-entry column lists of an aggregated row into rows (name, *values)."""
    packed = F.array(
        *[
            F.struct(F.lit(label).alias(names[0]), *[v.alias(n) for v, n in zip(values, names[1:])])
            for label, values in entries
        ]
    )
    return df.select(*keys, F.inline(packed))


def null_ratio(
    df: DataFrame, keys: list[str] | None = None, columns: Sequence[str] = NULL_CHECKED, limit: float = 0.5
) -> DataFrame:
    """Share of nulls (and NaN) per watched column, and whether it is above the limit."""
    keys = list(keys or [])
    used = [c for c in columns if c in df.columns]
    agg = present(df, used).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(f"_c_{c}") for c in used]
    )
    ratio = {c: F.try_divide(F.col("_n") - F.col(f"_c_{c}"), F.col("_n")) for c in used}
    return _long(
        agg, keys,
        [(c, [F.col("_n"), F.col("_n") - F.col(f"_c_{c}"), ratio[c], F.coalesce(ratio[c] > limit, F.lit(False))]) for c in used],
        ["column_name", "total_rows", "null_rows", "null_share", "warning"],
    )


def epoch_zero(df: DataFrame, keys: list[str] | None = None, on: str = "timestamp") -> DataFrame:
    """Rows stamped on 1970-01-01 per key, and whether there are any."""
    keys = list(keys or [])
    zero = F.count_if((F.col(on) >= 0) & (F.col(on) < DAY_MS))
    return df.groupBy(*keys).agg(zero.alias("epoch_zero_rows"), (zero > 0).alias("is_error"))


def source_flags(
    df: DataFrame, keys: list[str], on: str = "timestamp", columns: Sequence[str] = NULL_CHECKED, limit: float = 0.5
) -> DataFrame:
    """Rows, columns with too many nulls (warnings) and whether epoch-zero rows exist
    (errors) per key: ``null_ratio`` and ``epoch_zero`` in one aggregation."""
    used = [c for c in columns if c in df.columns]
    n = F.count(F.lit(1))
    over = [F.coalesce(F.try_divide(n - F.count(c), n) > limit, F.lit(False)).cast("long") for c in used]
    zero = F.count_if((F.col(on) >= 0) & (F.col(on) < DAY_MS)) > 0
    return present(df, used).groupBy(*keys).agg(
        n.alias("rows"), sum(over, F.lit(0).cast("long")).alias("warnings"), zero.cast("long").alias("errors")
    )


def file_status(errors: Column, rows: Column, warnings: Column) -> Column:
    return (
        F.when(errors > 0, "ERROR").when(rows == 0, "WARNING").when(warnings > 0, "WARNING").otherwise("OK")
    )


def source_status(files: DataFrame, keys: list[str]) -> DataFrame:
    """Per source over its files (rows, warnings, errors): totals and the status ladder."""
    agg = files.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("rows").cast("long").alias("total_rows"),
        F.sum("warnings").cast("long").alias("warnings"),
        F.sum("errors").cast("long").alias("errors"),
    )
    return agg.withColumn(
        "status",
        F.when(F.col("errors") > 0, "ERROR")
        .when(F.col("total_rows") == 0, "MISSING")
        .when(F.col("warnings") > 0, "WARNING")
        .otherwise("OK"),
    )


def field_presence(df: DataFrame, required: Sequence[str] = TICKER_FIELDS) -> DataFrame:
    """Per required field: whether the table has it and how many values it holds."""
    agg = df.agg(*[F.count(c).alias(f"_c_{c}") for c in required if c in df.columns], F.count(F.lit(1)).alias("_n"))
    return _long(
        agg, [],
        [
            (c, [F.lit(c in df.columns), F.col(f"_c_{c}") if c in df.columns else F.lit(0).cast("long"), F.col("_n")])
            for c in required
        ],
        ["field", "present", "non_null", "total_rows"],
    )


def completeness(df: DataFrame, keys: list[str] | None = None, fields: Sequence[str] = TICKER_FIELDS) -> DataFrame:
    """Percent of non-null values per field, null for a missing field."""
    keys = list(keys or [])
    used = [c for c in fields if c in df.columns]
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(f"_c_{c}") for c in used])
    return _long(
        agg, keys,
        [
            (c, [F.try_divide(F.col(f"_c_{c}"), F.col("_n")) * 100 if c in used else F.lit(None).cast("double")])
            for c in fields
        ],
        ["field", "completeness_pct"],
    )


def value_rules(df: DataFrame, keys: list[str] | None = None, rules: Sequence[tuple] = VALUE_RULES) -> DataFrame:
    """Rows that break each rule (rule, column, SQL condition, nulls break it).

    A rule applies only where its column has a value at all.
    """
    keys = list(keys or [])
    used = [r for r in rules if r[1] in df.columns]
    aggs = [F.count(F.lit(1)).alias("_n")]
    for rule, column, condition, nulls in used:
        holds = F.coalesce(F.expr(f"`{column}` {condition}"), F.lit(not nulls))
        aggs += [F.count(column).alias(f"_c_{rule}"), F.count_if(~holds).alias(f"_b_{rule}")]
    agg = df.groupBy(*keys).agg(*aggs)
    return _long(
        agg, keys,
        [
            (
                rule,
                [
                    F.col("_n"),
                    F.col(f"_c_{rule}") > 0,
                    F.when(F.col(f"_c_{rule}") > 0, F.col(f"_b_{rule}")).otherwise(F.lit(0).cast("long")),
                ],
            )
            for rule, *_ in used
        ],
        ["rule", "total_rows", "applies", "invalid_rows"],
    )


def future_rows(df: DataFrame, now_ms: int, keys: list[str] | None = None, on: str = "timestamp", slack_ms: int = 3_600_000) -> DataFrame:
    """Rows stamped more than an hour after ``now_ms``."""
    return df.groupBy(*(keys or [])).agg(
        F.count_if(F.col(on) > now_ms + slack_ms).alias("future_rows"), F.count(F.lit(1)).alias("total_rows")
    )


def counts_by_type(df: DataFrame, keys: list[str], kind: str, kinds: Sequence[str]) -> DataFrame:
    """Rows per key and record type, types as columns; all in one pass."""
    return df.groupBy(*keys).agg(
        *[F.count_if(F.col(kind) == k).alias(k) for k in kinds], F.count(F.lit(1)).alias("total_records")
    )


# Log lines.  ``{}`` takes the currency; the first pattern that fits decides.
GREEKS_LINE = "computed .*Greeks"
SURFACE_LINE = "Surface built for"
CURRENCIES = ("BTC", "ETH")


def classify_log(lines: DataFrame, column: str = "value", currencies: Sequence[str] = CURRENCIES, currency_pattern: str = r"\b{}\b") -> DataFrame:
    """Add ``line_class`` and ``currency`` (of computing lines that name one)."""
    line = F.col(column)
    named = F.lit(None).cast("string")
    for c in reversed(list(currencies)):
        named = F.when(F.rlike(line, F.lit(currency_pattern.format(c))), F.lit(c)).otherwise(named)
    kind = (
        F.when(F.contains(line, F.lit("WARNING")), "warning")
        .when(
            F.contains(line, F.lit("ERROR"))
            | (F.contains(line, F.lit("Exception")) & ~F.contains(line, F.lit("Traceback"))),
            "error",
        )
        .when(
            F.contains(line, F.lit("wrote")) & F.contains(line, F.lit("rows")),
            F.when(F.contains(line, F.lit("date=1970")), "epoch_zero_flush").otherwise("flush"),
        )
        .when(F.rlike(line, F.lit(GREEKS_LINE)), "greeks_cycle")
        .when(F.contains(line, F.lit(SURFACE_LINE)), "surface_build")
        .otherwise("other")
    )
    return lines.withColumn("line_class", kind).withColumn(
        "currency", F.when(F.col("line_class").isin("greeks_cycle", "surface_build"), named)
    )


def log_summary(lines: DataFrame, column: str = "value", **options) -> DataFrame:
    return classify_log(lines, column, **options).groupBy("line_class", "currency").agg(F.count(F.lit(1)).alias("lines"))
