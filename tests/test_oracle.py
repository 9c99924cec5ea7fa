"""Every query with oracle SQL matches DuckDB (columns, types, rows) on the smallest fixture."""

import pytest

from conftest import SF_SMALL
from pulseward.plans.oracle import ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck_small, name):
    from pulseward.plans.compare import compare
    ok, msg = compare(spark, duck_small, name, SF_SMALL)
    assert ok, msg


def test_every_query_registered_and_oracle_keys_known():
    from pulseward.plans.catalog import QUERIES
    assert set(ORACLE) <= set(QUERIES)
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == {"score_texts", "score_texts_accuracy"}
