"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate), and the rows-only queries for non-empty, stable output."""

import pytest

import __spark_entry__ as E
from tabwatch.plans.registry import all_oracles, all_queries
from tabwatch.testing import compare_frames, duck_connect, forbidden_nodes

SF = "/root/testdata/sf0.01"
QUERIES = all_queries()
SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
             "boolean": "BOOLEAN"}
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert forbidden_nodes(df) == [], name      # no Python UDFs, no all-pairs joins
    rel = con.sql(ORACLES[name])
    duck_types = dict(zip(rel.columns, (str(t) for t in rel.types)))
    spark_types = {f.name: SQL_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString())
                   for f in df.schema.fields}
    assert spark_types == duck_types            # same names and types, column for column
    got = df.toPandas()
    exp = rel.df()
    ok, msg = compare_frames(got, exp)
    assert ok, msg


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert [f.name for f in df.schema.fields] == ["feature", "psi", "bins", "new_total"]
    assert df.count() == 4
