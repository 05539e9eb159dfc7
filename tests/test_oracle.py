"""Every registered query against its SQL twin on the smallest tables."""
import pytest

import __spark_entry__ as entry
from compare import compare, connect
from ringlens.operators import ordered
from ringlens.plans import registry

SF = "/root/testdata/sf0.001"
MAY_BE_EMPTY = {"columns_filter"}  # its condition meets nothing in the smallest tables
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()
ORDERED = [
    "agg_median", "communication_number", "running_visits", "stage_before_failure",
    "lost_call_reaction", "hit_durations", "session_hits", "visitor_sessions", "tags_history",
    "state_history", "employee_stat", "person_timeline", "call_details", "chat_messages",
    "batch_cap", "attribution_window", "attribution_first", "attribution_last",
    "attribution_linear", "attribution_position", "last_session_asof", "attribution_paths",
    "attribution_chains", "session_communications", "session_summary", "visitor_sessions_nested",
    "deal_communications", "report_values", "open_sessions_stream", "ledgered_calls_stream",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    if name in ORACLES:
        assert compare(df, con, ORACLES[name]) in ((None, "EMPTY") if name in MAY_BE_EMPTY else (None,))
    else:
        assert df.count() > 0


@pytest.mark.parametrize("name", ORDERED)
def test_heavy_keys(spark, con, name, monkeypatch):
    """The same results when nearly every key is cut into buckets."""
    monkeypatch.setattr(ordered, "HEAVY_ROWS", 5)
    assert compare(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(ORACLES) <= set(QUERIES)
    assert sorted(set(QUERIES) - set(ORACLES)) == ["openapi_documents"]


def test_entry(spark):
    assert entry.entry(spark).columns == ["site_name", "campaign_name", "calls", "revenue"]
