"""Physical plans: what reaches the scan, and that no ordered operator gathers its rows."""

import re

import pytest
from pyspark.sql import functions as F

from checks import QUERIES
from quoteloom.fixtures import NOW_MS, table, view
from quoteloom.operators import asof, options

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


KEYLESS = ("asof_backward", "asof_forward", "asof_nearest", "strategy_slice", "detect_gaps", "interpolate_linear", "fill_gaps", "outlier_flag", "basis_spot_perp", "failure_streaks")


@pytest.mark.parametrize("name", KEYLESS)
def test_only_summaries_meet_in_one_partition(spark, name):
    """Below every single-partition exchange lies an aggregate per block or superblock."""
    lines = plan(QUERIES[name](spark, SF_DIR)).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            depth = re.search(r"[A-Za-z]", line).start()
            below = []
            for later in lines[i + 1:]:
                if re.search(r"[A-Za-z]", later).start() <= depth:
                    break
                below.append(later)
            first = next(x for x in below if "Aggregate" in x or "Window" in x or "Join" in x or "Scan" in x)
            assert "Aggregate" in first and ("_block" in first or "_super" in first), f"{name}: {first}"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {n for n in QUERIES if n.startswith("stream") or n in ("upsert_table", "load_range", "load_latest_day", "retention_plan", "source_inventory", "file_checks", "storage_audit")}))
def test_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_greeks_need_no_shuffle(spark):
    text = plan(options.greeks_batch(view(spark, SF_DIR, "chain"), NOW_MS))
    assert "Exchange" not in text and "PythonUDF" not in text and "ArrowEval" not in text
    assert "ReadSchema: struct<p_partkey:bigint,p_size:int,p_retailprice:double>" in text
    # The name pattern runs once per row.
    assert text.count("regexp_replace") == 1


def test_filters_and_columns_reach_the_scan(spark):
    rows = table(spark, SF_DIR, "events").select(F.col("value").alias("price"), F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"), "event_type")
    text = plan(asof.asof_join(rows.filter("event_type = 'view'"), rows.filter("event_type = 'click'"), columns=["price"]))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in text
    assert "EqualTo(event_type,click)" in text
    assert "user_id" not in text and "props" not in text


def test_aggregates_combine_before_the_shuffle(spark):
    for name in ("atm_iv", "latest_per_key", "null_ratio", "store_stats", "asof_backward"):
        assert "partial_" in plan(QUERIES[name](spark, SF_DIR)), name


def test_top_n_is_limited_below_the_shuffle(spark):
    assert "WindowGroupLimit" in plan(QUERIES["main_contracts"](spark, SF_DIR))
