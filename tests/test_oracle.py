"""Every registered query against its DuckDB oracle on the smallest scale
factor (the driver repeats this at sf0.01). Queries without an oracle must
still run and return a stable schema."""
import os

import pytest

import __spark_entry__ as E
from tests.harness import compare, duck

SF = os.environ.get("ADPULSE_TEST_SF", "/root/testdata/sf0.001")
QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


_DUCK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
               "boolean": "BOOLEAN", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    pdf = df.toPandas()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, "pair-emitting join"
    if name not in ORACLE:
        assert list(pdf.columns) == df.columns
        return
    ok, msg = compare(pdf, con.execute(ORACLE[name]).fetchdf())
    assert ok, msg
    # same column types as the oracle, not only the same values
    spark_types = {f.name: _DUCK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString().upper())
                   for f in df.schema.fields}
    duck_types = {r[0]: r[1] for r in con.execute("DESCRIBE " + ORACLE[name]).fetchall()}
    assert spark_types == duck_types


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "roas" in df.columns
