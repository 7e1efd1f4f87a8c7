"""Every query with SQL gives DuckDB's rows."""

import oracle
import pytest

from sluicework import catalogue


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_matches_sql(spark, sf_dir, name):
    assert not oracle.compare(spark, sf_dir, catalogue.QUERIES[name], catalogue.ORACLE_SQL[name])
