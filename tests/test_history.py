"""Queries on open transactions see the whole log, without the events that are locks."""

import pytest
from conftest import SMALL

from strata.operators import transactions
from strata.plans import catalog


@pytest.mark.parametrize(("name", "operator", "place"), [
    ("commit_errors", "commit_errors", 1), ("rollback_apply", "rollback", 1), ("txn_status", "txn_status", 1), ("batch_resolve_lock", "resolve_locks", 0), ("async_commit_recover", "async_commit_outcome", 2),
])
def test_history_reaches_the_operator(spark, monkeypatch, name, operator, place):
    seen = []
    real = getattr(transactions, operator)

    def spy(*args, **kwargs):
        seen.append(args[place])
        return real(*args, **kwargs)

    monkeypatch.setattr(transactions, operator, spy)
    catalog.QUERIES[name](spark, SMALL).collect()
    events = spark.read.parquet(f"{SMALL}/events.parquet").count()
    open_ones = 0 if name == "async_commit_recover" else catalog._locks(spark, SMALL).count()
    assert [v.count() for v in seen] == [events - open_ones]
