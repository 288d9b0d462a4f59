import pytest

from civicspark.plans import catalog
from tests.oracle import SF_DIR, compare


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    compare(spark, catalog.QUERIES[name], catalog.ORACLE_SQL[name])


def test_every_query_has_sql():
    assert not set(catalog.QUERIES) - set(catalog.ORACLE_SQL)


def test_entry_runs(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert SF_DIR
