"""Every registered query against its independent SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import parity
from tidemark.catalog.oracle import ORACLE
from tidemark.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with parity.connect(SF) as opened:
        yield opened


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_and_sql_agree(spark, connection, name):
    frame, sql = QUERIES[name](spark, SF), ORACLE[name]
    assert parity.difference(frame, connection, sql) is None
    assert parity.type_difference(frame, connection, sql) == {}


def test_flagship(spark):
    changes = entry.entry(spark)
    assert changes.columns == ["snapshot_date", "line_id", "current_stage"]
    assert changes.count() > 0
