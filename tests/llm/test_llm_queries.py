"""The registered queries with SQL against DuckDB, and the driver's entry."""

import pytest
from workloads.compare import bag, connect

from millrace.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    df, other = QUERIES[name](spark, SF), connect(SF).execute(ORACLE[name])
    columns = [d[0] for d in other.description]
    assert sorted(columns) == sorted(df.columns)
    assert bag(df.columns, df.collect()) == bag(columns, other.fetchall())


def test_registered():
    import __spark_entry__ as driver

    names = [n.split("_")[0] for n in QUERIES]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(driver.queries()) and set(ORACLE) <= set(driver.oracle_sql())
