from __spark_entry__ import entry, oracle_sql, queries
from fixwatch.catalog import ORACLE, QUERIES


def test_flagship_runs_on_the_smallest_tables(spark):
    df = entry(spark)
    assert {"network_id", "scope", "station_set", "window", "hor_p95", "n_stations"} <= set(df.columns)
    assert df.count() % 468 == 0


def test_every_query_has_its_sql():
    assert set(ORACLE) == set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())
