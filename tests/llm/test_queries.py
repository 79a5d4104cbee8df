"""Every registered query of the subpackage against its SQL on all of a small table."""

import pytest

from sparkloom.llm import queries

from ..conftest import same_rows


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, sf, duck, name):
    same_rows(queries.QUERIES[name](spark, sf).toPandas(), duck.sql(queries.ORACLE_SQL[name]).df())
