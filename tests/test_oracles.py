"""Every registered query of the library against its SQL."""

import pytest

from eventloom.plans import catalog
from tests.compare import SF, assert_same


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, name):
    df = catalog.QUERIES[name](spark, SF)
    if name in catalog.ORACLES:
        assert_same(df, catalog.ORACLES[name])
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
