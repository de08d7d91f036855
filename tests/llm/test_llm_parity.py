"""Operators that SQL can express, against that SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import parity
from tidemark.llm.oracle import LLM_ORACLE
from tidemark.llm.queries import LLM_QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with parity.connect(SF) as opened:
        yield opened


def test_every_operator_is_registered():
    names = {name.split("_")[0] for name in LLM_QUERIES}
    assert names == {f"op{n}" for n in range(1, 14)}
    assert set(LLM_QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(LLM_ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_and_sql_agree(spark, connection, name):
    assert parity.difference(LLM_QUERIES[name](spark, SF), connection, LLM_ORACLE[name]) is None
