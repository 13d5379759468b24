"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from tallywake.plans.queries import QUERIES
from tallywake.plans.streams import STREAMS
from tests.compare import mismatch

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="no tables here")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    assert mismatch(spark, FOLDER, name, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_every_query_has_sql():
    """But for the training-data operators, which SQL mostly cannot express; their tests are in tests/llm."""
    assert set(QUERIES) | set(STREAMS) <= set(entry.oracle_sql()) <= set(entry.queries())
