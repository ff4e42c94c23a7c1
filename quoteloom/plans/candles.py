"""Candle update: what to collect next, and landed payloads into the candle table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import OHLCV, conform
from ..sinks import store
from ..sources import candles, naming

SERIES = ["exchange", "symbol", "timeframe"]
# A candle is stored once; later copies of it do not replace it.
UNIQUE = ["timestamp", "exchange", "symbol", "timeframe"]

_FORMS = {"klines": candles.klines, "chart": candles.chart_arrays, "objects": candles.candle_objects}


def normalised(landed: DataFrame, form: str = "form") -> DataFrame:
    """Landed payloads of all venues as candle records with unified symbols; ``form``
    tells how a payload is laid out (klines, chart, objects)."""
    parts = [
        conform(parse(landed.filter(F.col(form) == name)), OHLCV) for name, parse in _FORMS.items()
    ]
    return reduce(DataFrame.unionByName, parts).withColumn(
        "symbol", naming.unified_symbol(F.col("exchange"), F.col("symbol"))
    )


def update(landed: DataFrame, path: str) -> None:
    """Add the candles the table does not have yet; one rewrite per touched partition."""
    rows = store.with_date(normalised(landed))
    values = [f.name for f in OHLCV if f.name not in (*UNIQUE, "trades")]
    store.upsert(rows, path, keys=UNIQUE, parts=[*SERIES, "date"], order_by=values, keep="first")


def next_ranges(universe: DataFrame, stored: DataFrame, now_ms: int) -> DataFrame:
    """Ranges to collect per series of the universe, from what the table holds."""
    return store.incremental_plan(universe, store.store_stats(stored, SERIES), SERIES, now_ms)
