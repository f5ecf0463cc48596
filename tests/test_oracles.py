"""Named queries against their SQL twins on the smallest tables."""

from __future__ import annotations

import pytest

from compare import compare, connect
from shiplake.plans.oracles import ORACLES
from shiplake.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
# A thousand partition directories each; covered on a small fixture in test_sinks.
MANY_FILES = {"curated_round_trip", "curated_layout", "date_export_round_trip"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES and n not in MANY_FILES])
def test_query_equals_sql(spark, con, name):
    problem, _ = compare(QUERIES[name](spark, SF), con, ORACLES[name])
    assert not problem


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() == 6
