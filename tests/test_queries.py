"""Each registered query against its SQL on DuckDB."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import differences
from checks.oracle import ORACLE_SQL as SQL
from checks.queries import QUERIES
from tests.conftest import SF


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_every_query_is_registered():
    assert QUERIES.items() <= queries().items() and SQL.items() <= oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    assert differences(df, duck, SQL[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoop", "Python", "Pandas"):
        assert word not in plan, f"the plan has {word}"


def test_entry_has_lines_of_all_postings(spark):
    seen = {row["posting"] for row in entry(spark).select("posting").distinct().collect()}
    assert seen == {
        "voucher",
        "ipc_paid_price",
        "ipt_paid_price",
        "commission_vat",
        "commission_revenue",
        "total",
    }
