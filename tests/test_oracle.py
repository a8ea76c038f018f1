"""Every registered query against its SQL, on whole tables."""

import pytest

from catalogue import ENTRIES
from catalogue.compare import connect, difference, spark_result, sql_result


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


# No all-pairs join, no Python in the data path.
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas")


@pytest.mark.parametrize("key", sorted(ENTRIES))
def test_same_as_sql(spark, sf_dir, con, key):
    entry = ENTRIES[key]
    df = entry.run(spark, sf_dir)
    ours = spark_result(df)
    assert entry.sql, f"{key} has no SQL"
    assert difference(ours, sql_result(con, entry.sql)) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in FORBIDDEN if operator in plan]


def test_entry_runs(spark):
    import __spark_entry__ as registry

    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert registry.entry(spark).limit(1).count() == 1
