import os

import pytest

from spanwright.plans import registry

DATA = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no shared tables")


@needs_data
def test_entry_and_registered_queries(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == ["video", "start_seconds", "end_seconds"]
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    for file in os.listdir(DATA):
        connection.sql(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{DATA}/{file}'")
    return connection


def _sorted(rows):
    near = lambda x: round(x, 8) if isinstance(x, float) else x
    return sorted((tuple(map(near, row)) for row in rows), key=lambda row: [(x is None, str(x)) for x in row])


@needs_data
@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_queries_equal_their_sql(spark, duck, name):
    got = registry.QUERIES[name](spark, DATA)
    found = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(found.columns) == sorted(got.columns)
    want = found.select(*(f'"{c}"' for c in got.columns))
    assert _sorted(map(tuple, got.collect())) == _sorted(want.fetchall())


@needs_data
@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_queries_without_sql_run(spark, name):
    assert registry.QUERIES[name](spark, DATA).count() >= 0


def test_frame_names_of_long_numbers_equal_their_sql(spark, tmp_path):
    import duckdb

    ids = [0, 999_999, 1_000_000, 5_999_999, 322_580_646, -5, None]
    spark.createDataFrame([(i,) for i in ids], "event_id long").write.parquet(f"{tmp_path}/events.parquet")
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    got = registry.QUERIES["frame_names"](spark, str(tmp_path))
    assert _sorted(map(tuple, got.collect())) == _sorted(connection.sql(registry.ORACLE_SQL["frame_names"]).fetchall())
