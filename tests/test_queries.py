"""A cross-section of the registered queries against their SQL checks, and the contract."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
import __spark_entry__ as contract  # noqa: E402
import oracle  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="needs the generic tables")
SAMPLE = ["lifecycle_status", "closable_firms", "asof_newest_partition", "eligibility", "job_family",
          "find_in_context", "html_clean_text", "resolve_employers", "merge_kept", "subscription_match",
          "sent_state", "detail_budget", "best_board", "robots_admission", "normalise_greenhouse",
          "normalise_portal"]


@pytest.fixture(scope="module")
def con():
    pytest.importorskip("duckdb")
    return oracle.connect(SF)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_check(spark, con, name):
    problem, rows = oracle.compare(spark, con, SF, contract.queries()[name], contract.oracle_sql()[name])
    assert problem is None and rows > 0, problem


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert contract.entry(spark).columns == ["status", "postings", "sightings"]
