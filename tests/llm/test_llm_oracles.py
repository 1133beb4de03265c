"""Registered training-data queries against their DuckDB forms."""

from __future__ import annotations

import os

import pytest

import harness
from hexvault.llm.oracles import ORACLES

SF = os.environ.get("HEXVAULT_TEST_SF", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    res = harness.compare(spark, name, SF, harness.duck(SF))
    assert res["status"] == "ok", res
