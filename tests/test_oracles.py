"""Every registered query equals its SQL twin, in the plan used for big data."""

import __spark_entry__
import pytest
from compare import connect, difference, plan, sql_rows

from siltstone.registry.oracles import ORACLES
from siltstone.registry.queries import QUERIES

# One row per partition, a batch measured to be small, one row a heavy key, ten rows.
BOUNDED_BROADCAST = {
    "change_window_pages",
    "upsert_small_batch",
    "load_mode",
    "run_outcomes",
    "run_summary",
    "latest_runs",
    "watermark_decision",
    "watermark_advance",
}


@pytest.fixture(scope="module")
def database(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, database, no_auto_broadcast, name):
    result = QUERIES[name](spark, sf_dir)
    text = plan(result)
    assert "NestedLoop" not in text
    assert "CartesianProduct" not in text
    assert "Python" not in text
    assert "BroadcastExchange" not in text or name in BOUNDED_BROADCAST
    found = (result.columns, [tuple(row) for row in result.collect()])
    assert found[1], "A comparison of nothing proves nothing."
    assert difference(found, sql_rows(database, ORACLES[name])) is None


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(ORACLES) <= set(__spark_entry__.oracle_sql())


def test_entry(spark):
    result = __spark_entry__.entry(spark)
    assert result.columns[:3] == ["occ_month", "crime_type", "council_district"]
    assert result.count() > 0
