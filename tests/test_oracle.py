"""Every registered query of the key-value engine agrees with its SQL."""

import pytest
from conftest import SMALL
from helpers import against_oracle

from strata.plans import catalog

assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query(spark, oracle, name):
    against_oracle(spark, oracle, catalog.QUERIES[name], catalog.ORACLE_SQL[name], SMALL)
