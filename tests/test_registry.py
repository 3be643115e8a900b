"""Registered queries against their SQL on the smallest tables.

The ones here are quick and cover each family; tests/compare.py runs all of them.
"""

from pathlib import Path

import pytest

from compare import DATA, difference

FOLDER = str(DATA / "sf0.001")
QUICK = [
    "session_clean", "csv_roundtrip", "hourly_sessions", "hourly_deliveries", "wide_to_long",
    "lag_features", "queue_proxy", "session_overlap", "single_tariff", "utilization_change",
    "monthly_energy", "winsorised_energy", "util_cdf", "regression_metrics",
]


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
@pytest.mark.parametrize("name", QUICK)
def test_query_matches_sql(spark, name):
    from __spark_entry__ import oracle_sql, queries
    assert difference(queries()[name](spark, FOLDER), oracle_sql()[name], FOLDER) is None


def test_every_sql_has_a_query():
    from __spark_entry__ import oracle_sql, queries
    from chargelake.testbed.oracles import ORACLES
    from chargelake.testbed.queries import QUERIES
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")
@pytest.mark.parametrize("other", ["refund", None])
@pytest.mark.parametrize("name", ["wide_to_long", "hourly_grid"])
def test_event_types_outside_the_grids_fail(spark, tmp_path, name, other):
    from pyspark.sql import functions as F
    from __spark_entry__ import queries
    events = spark.read.parquet(f"{FOLDER}/events.parquet")
    odd = events.limit(1).withColumn("event_type", F.lit(other).cast("string"))
    events.unionByName(odd).write.parquet(f"{tmp_path}/events.parquet")
    spark.read.parquet(f"{FOLDER}/region.parquet").write.parquet(f"{tmp_path}/region.parquet")
    with pytest.raises(Exception, match=f"event type outside GRIDS: {other or 'null'}"):
        queries()[name](spark, str(tmp_path)).collect()
