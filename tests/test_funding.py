"""Funding payloads with prices of 0."""

import duckdb

from checks import ORACLE, QUERIES
from quoteloom.sources import prices
from tests.compare import compare


def test_zero_prices_against_the_oracle(spark, tmp_path):
    """Every fifth row lacks the optional price; a price of 0 in another row is a value."""
    spark.sql(
        """SELECT id AS event_id, timestamp_ntz '2026-01-01' + make_dt_interval(0, 0, 0, id) AS ts, id % 7 AS user_id,
           'view' AS event_type, CASE WHEN id % 3 = 0 THEN 0D ELSE id / 4D END AS value, '' AS props FROM range(120)"""
    ).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert compare(spark, con, str(tmp_path), QUERIES["norm_funding"], ORACLE["norm_funding"]) == []


def test_zero_counts_as_missing_unless_told(spark):
    deribit = '{"result": [{"timestamp": 1, "interest_8h": 0.5, "index_price": 0}, {"timestamp": 2, "interest_8h": 0.5}]}'
    hyperliquid = '[{"time": 1, "fundingRate": "0.5", "premium": "0"}, {"time": 2, "fundingRate": "0.5"}]'
    rows = spark.createDataFrame([("S", deribit, hyperliquid)], "symbol string, deribit string, hyperliquid string")
    for parse, column, value in ((prices.funding_deribit, "deribit", "index_price"), (prices.funding_hyperliquid, "hyperliquid", "mark_price")):
        assert [r[value] for r in parse(rows, column).orderBy("timestamp").collect()] == [None, None]
        assert [r[value] for r in parse(rows, column, zero_is_missing=False).orderBy("timestamp").collect()] == [0.0, None]


def test_the_query_unsets_zero_prices(spark, tmp_path):
    """``norm_funding`` takes an index price or premium of 0 for a missing one, as its method says."""
    spark.sql(
        """SELECT id AS event_id, timestamp_ntz '2026-01-01' + make_dt_interval(0, 0, 0, id) AS ts, id % 7 AS user_id,
           'view' AS event_type, CASE WHEN id % 3 = 0 THEN 0D ELSE id / 4D END AS value, '' AS props FROM range(120)"""
    ).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    rows = QUERIES["norm_funding"](spark, str(tmp_path)).collect()
    for exchange, column in (("deribit", "index_price"), ("hyperliquid", "mark_price")):
        got = [r[column] for r in rows if r.exchange == exchange]
        assert len(got) == 30 and 0.0 not in got
        assert sum(v is None for v in got) == 14  # ten prices of 0 and six fifth rows, of which two are both
