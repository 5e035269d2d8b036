"""Every query equals its SQL on the smallest tables."""

import duckdb
import oracle
import pytest

import __spark_entry__ as entry_module
import catalog

SF = "/root/testdata/sf0.001"
# Column types that mean the same in both engines.
SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, con, name):
    frame = entry_module.queries()[name](spark, SF)
    sql = entry_module.oracle_sql()[name]
    assert oracle.difference(frame, con, sql) is None
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    theirs = {row[0]: row[1] for row in described if row[1] != '"NULL"'}
    for field in frame.schema.fields:
        ours = SAME_TYPE[field.dataType.simpleString()]
        assert theirs.get(field.name, ours) == ours, field.name


def test_entry_returns_rows(spark):
    frame = entry_module.entry(spark)
    assert frame.count() > 0
    assert "internal_series_code" in frame.columns
    assert isinstance(duckdb.__version__, str)
