"""Every catalogue query against its DuckDB oracle, at the scale of the driver's gate."""

import pytest

from rillflow.plans.catalog import ORACLES, QUERIES

def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert len(QUERIES) >= 42


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(gate, name):
    results, _ = gate
    assert results[name].startswith("ok"), results[name]
