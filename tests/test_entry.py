"""The driver contract in __spark_entry__.py."""

import __spark_entry__ as E
from rillflow.plans.catalog import QUERIES


def test_entry_runs_flagship(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 11  # SURVEY §7.3 anchor at sf0.001: 4 below + 7 above
    assert {"contador", "anomaly_direction", "delta_count", "expected_water_l"} <= set(df.columns)


def test_every_query_has_oracle_sql():
    q, o = E.queries(), E.oracle_sql()
    assert set(QUERIES) <= set(q) and set(QUERIES) <= set(o) and len(QUERIES) >= 42
    assert all(isinstance(sql, str) and "SELECT" in sql.upper() for sql in o.values())
