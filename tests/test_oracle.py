"""Every registered query against its SQL on the driver tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from tallyforge.testbed import oracle, registry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
FOLDERS = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module", params=FOLDERS)
def data(request):
    if not Path(request.param).exists():
        pytest.skip("driver tables are not here")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{request.param}/{name}.parquet')"
        )
    yield request.param, connection
    connection.close()


def sortable(row):
    return tuple((value is None, str(type(value)), value if value is not None else 0) for value in row)


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-12)
    return type(a) is type(b) and a == b


def test_names_agree():
    """The optional parts that the entry adds have tests of their own."""
    assert set(registry.queries()) - set(oracle.oracle_sql()) == {"source_manifest"}
    assert set(oracle.oracle_sql()) <= set(registry.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_sql(spark, data, name):
    folder, connection = data
    frame = registry.queries()[name](spark, folder)
    columns = sorted(frame.columns)
    expected = connection.sql(f"SELECT * FROM ({oracle.oracle_sql()[name]})")
    assert sorted(expected.columns) == columns
    spark_types = dict(frame.dtypes)
    sql_types = dict(zip(expected.columns, (str(t) for t in expected.types)))
    assert {c: TYPES[spark_types[c]] for c in columns} == {c: sql_types[c] for c in columns}
    selection = ", ".join(f'"{c}"' for c in columns)
    want = sorted(
        connection.sql(f"SELECT {selection} FROM ({oracle.oracle_sql()[name]})").fetchall(),
        key=sortable,
    )
    got = sorted((tuple(r) for r in frame.select(*columns).collect()), key=sortable)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert all(same(a, b) for a, b in zip(g, w)), (columns, g, w)
