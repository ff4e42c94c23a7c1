"""Names, channels and epoch conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: option names read CURRENCY-DDMonYY-STRIKE-C|P with a whole strike.
OPTION_NAME = r"^([A-Z]+)-(\d{1,2}[A-Z]{3}\d{2})-(\d+)-([CP])$"


def option_parts(name: Column) -> Column:
    """[currency, expiry, strike, side] of an option name, a single element otherwise.

    One pass of the pattern: the groups are joined by a character no name contains.
    """
    return F.split(F.regexp_replace(name, OPTION_NAME, "$1\u0001$2\u0001$3\u0001$4"), "\u0001")


def option_fields(parts: Column) -> Column:
    """Named fields of ``option_parts``; all null for other names."""
    expiry = F.get(parts, F.lit(1))
    return F.struct(
        F.when(expiry.isNotNull(), F.get(parts, F.lit(0))).alias("currency"),
        expiry.alias("expiry"),
        F.get(parts, F.lit(2)).cast("double").alias("strike"),
        F.get(parts, F.lit(3)).alias("option_type"),
        expiry_ms(expiry).alias("expiry_timestamp"),
    )


def expiry_ms(expiry: Column) -> Column:
    """``28MAR26`` -> epoch ms of UTC midnight; null where the day does not exist."""
    day = F.to_date(F.try_to_timestamp(expiry, F.lit("dMMMyy")))
    return F.unix_date(day).cast("long") * F.lit(86_400_000)


def channel_instrument(channel: Column) -> Column:
    """``ticker.BTC-PERPETUAL.100ms`` -> BTC-PERPETUAL, ``btcusdt@bookTicker`` -> BTCUSDT."""
    dotted = F.split(channel, r"\.")
    return F.when(
        F.contains(channel, F.lit("@")), F.upper(F.split(channel, "@").getItem(0))
    ).otherwise(F.try_element_at(dotted, F.lit(2)))


def path_safe(name: Column) -> Column:
    return F.translate(name, "/_", "--")


def utc_day(ms: Column) -> Column:
    """Epoch ms -> UTC date, without going through the session time zone."""
    return F.date_from_unix_date(F.floor(ms / F.lit(86_400_000)).cast("int"))


def utc_day_string(ms: Column) -> Column:
    return utc_day(ms).cast("string")


def utc_timestamp(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def unset_if_zero(x: Column) -> Column:
    return F.nullif(x, F.lit(0.0))
