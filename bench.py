"""Seconds per headline query; one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py [query ...]

Every query is run to completion twice into the no-op sink: the first run warms the JVM
and the file cache, the second is reported.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import QUERIES  # noqa: E402
from quoteloom.session import get_session  # noqa: E402

HEADLINE = (
    "greeks_batch", "vol_surface", "greeks_with_curve", "near_atm", "main_contracts",
    "asof_backward", "asof_nearest", "asof_backward_by_key", "strategy_slice",
    "detect_gaps", "ffill", "interpolate_linear", "outlier_flag", "continuity_stats",
    "basis_spot_perp", "basis_cross_exchange", "yield_curve", "rate_for_tenor",
    "norm_klines", "norm_trades", "norm_books", "quote_enrich",
    "upsert_keep_last", "dedupe_trades", "latest_per_key",
    "upsert_table", "candle_update", "stream_table", "stream_l1_state",
    "null_ratio", "value_rules", "verification_report", "strategy_run", "ohlc_integrity",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(QUERIES)
    spark = get_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=str(cpus),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        for _ in range(2):
            begun = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - begun, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
