"""Shape of the physical plans."""
import pytest

import __spark_entry__ as entry
from ringlens.operators import filters as flt
from ringlens.operators.joins import calls_legs
from ringlens.plans.registry import ENTRIES
from ringlens.sources import sinks
from ringlens.sources.model import Model

SF = "/root/testdata/sf0.001"
WRITES = {
    "visits_live_stream", "ingest_stream", "pages_stream", "catalog_scan", "catalog_openapi",
    "batch_report_file", "report_export", "bundle_conflicts", "bundle_output", "open_sessions_stream",
    "ended_sessions_stream", "ledgered_calls_stream", "stored_deals", "stored_deals_deleted", "stored_costs",
}


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(set(ENTRIES) - WRITES))
def test_no_pairing_of_all_rows(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark):
    m = Model(spark, SF)
    rows = flt.date_range(m.calls(), "start_time", "1996-01-01", "1996-06-30")
    text = plan(flt.select_fields(flt.where(rows, flt.Cond("status", "=", "F")), ["call_id"]))
    assert "EqualTo(o_orderstatus,F)" in text and "GreaterThanOrEqual(o_orderdate" in text
    assert "o_totalprice" not in text


def test_bucketed_facts_join_without_a_shuffle(spark, tmp_path):
    m = Model(spark, SF)
    try:
        sinks.write_fact(m.calls(), "t_calls", "call_id", 4, str(tmp_path / "c"))
        sinks.write_fact(m.legs(), "t_legs", "call_id", 4, str(tmp_path / "l"), "direction")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        joined = calls_legs(spark.table("t_calls"), spark.table("t_legs"))
        assert "Exchange" not in plan(joined)
        assert joined.count() == calls_legs(m.calls(), m.legs()).count()
        text = plan(spark.table("t_legs").filter("direction = 'O'"))
        assert "PartitionFilters" in text
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE IF EXISTS t_calls")
        spark.sql("DROP TABLE IF EXISTS t_legs")


def test_facts_shrink_before_the_join(spark):
    """The call table is aggregated below its join with the contacts."""
    text = plan(entry.queries()["report_rollup"](spark, SF)).split("(1) Scan")[0]
    assert text.count("HashAggregate") == 4


def test_page_is_a_top_k(spark):
    text = plan(entry.queries()["page_topk"](spark, SF))
    assert "TakeOrderedAndProject" in text and "Exchange rangepartitioning" not in text


def test_deep_page_keeps_no_heap(spark, monkeypatch):
    """Far down, only the key and the sort columns are put in place; the result is the same."""
    rows = spark.range(2000).selectExpr("id", "nullif(id % 37, 5) AS x", "repeat('p', 100) AS payload")
    want = [r.id for r in flt.page(rows, [("x", "desc")], ["id"], 50, 1500).collect()]
    monkeypatch.setattr(flt, "HEAP_ROWS", 100)
    deep = flt.page(rows, [("x", "desc")], ["id"], 50, 1500)
    assert deep.columns == rows.columns and [r.id for r in deep.collect()] == want
    assert "TakeOrderedAndProject" not in plan(deep)
    assert "TakeOrderedAndProject" not in plan(flt.page(rows, [("x", "desc")], ["id"], 50, 5_000_000))
    assert flt.page(rows, [("x", "desc")], ["id"], 50, 5_000_000).count() == 0


def test_values_of_reports_expand_nothing(spark):
    for name in ("report_values", "report_values_total"):
        assert "Expand" not in plan(entry.queries()[name](spark, SF))


@pytest.mark.parametrize(
    "name", ["campaign_match", "doc_request_params", "validate_records", "financial_legs"]
)
def test_row_work_needs_no_hash_shuffle(spark, name):
    assert "hashpartitioning" not in plan(entry.queries()[name](spark, SF))


def test_python_functions_stay_out_of_plans(spark):
    for name in ("doc_request_params", "attribution_linear", "openapi_documents"):
        text = plan(entry.queries()[name](spark, SF))
        assert "Python" not in text and "Pandas" not in text


@pytest.mark.parametrize(
    "name, most",
    [("attribution_window", 3), ("attribution_linear", 6), ("attribution_position", 6), ("running_visits", 2),
     ("visitor_sessions", 2), ("employee_stat", 2), ("person_details", 1), ("attribution_paths", 3)],
)
def test_inputs_are_read_once(spark, monkeypatch, name, most):
    """Scans of the events in everything that a query settles and in what is left to run."""
    from ringlens.operators import attribution, ordered

    plans, settle = [], ordered.settled

    def settled(df, purpose):
        plans.append(plan(df))
        return settle(df, purpose)

    monkeypatch.setattr(ordered, "settled", settled)
    monkeypatch.setattr(attribution, "settled", settled)
    plans.append(plan(entry.queries()[name](spark, SF)))
    assert sum(p.count("/events.parquet]") for p in plans) <= most


def test_coverage_expands_nothing(spark):
    assert "Expand" not in plan(entry.queries()["coverage"](spark, SF))
