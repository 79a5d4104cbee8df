"""Every registered query of the relay against its SQL, and the entry points."""

import pytest

import __spark_entry__ as entry
from sparkloom.plans import queries as relay

from .conftest import same_rows


@pytest.mark.parametrize("name", sorted(relay.QUERIES))
def test_sql(spark, sf, duck, name):
    same_rows(relay.QUERIES[name](spark, sf).toPandas(), duck.sql(relay.ORACLE_SQL[name]).df())


def test_entry(spark):
    row = entry.entry(spark).first()
    assert (row.discovered, row.eligible, row.total_synced, row.total_added, row.failed_count) == (50, 49, 1412, 0, 18)


def test_registration():
    assert set(relay.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_filter_reaches_the_scan(spark, sf):
    plan = relay.targets_eligible(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Not(EqualTo(page_id,0))" in plan and "html" not in plan


def test_texts_do_not_reach_the_join(spark, sf):
    plan = relay.relay_summary(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    joined = plan[plan.index("Join") :].splitlines()[1]
    assert "Contains" in joined
