"""Every registered query against its SQL, and the contract's shape."""

from __future__ import annotations

import os

import pytest
from compare import difference

import __spark_entry__ as entry_points
from oracles import ORACLE
from tradewind.plans.on_tables import QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(
    not os.path.isdir(FOLDER), reason="the analytic tables are not here"
)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, name):
    assert difference(spark, name, FOLDER) is None


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).limit(1).count() == 1
