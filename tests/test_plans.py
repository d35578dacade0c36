"""Plan-shape checks: the scale properties the README claims, asserted on
the physical plans of the registered queries."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
# queries that train models, iterate or run a stream while being built
RUNS_WHILE_BUILT = {
    "failure_model_runs",
    "doc_quality_model",
    "forecast_recursive",
    "near_duplicate_documents",
    "stream_daily_event_metrics",
    "stream_entity_extraction",
    "stream_lag_refresh",
}


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - RUNS_WHILE_BUILT))
def test_no_cartesian_nested_loop_or_row_udf(spark, name):
    p = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in p
    assert "BroadcastNestedLoopJoin" not in p
    assert "BatchEvalPython" not in p  # no row-at-a-time Python UDFs


def test_rank_limit_is_pushed_below_the_shuffle(spark):
    p = plan(QUERIES["bq5_repeat_purchase"](spark, SF))
    lines = [ln.strip() for ln in p.split("== Physical Plan ==")[1].splitlines() if "(" in ln]
    tree = "\n".join(lines[: lines.index(next(ln for ln in lines if ln.startswith("(1)")))])
    # a partial WindowGroupLimit sits under the first Exchange of the window
    assert re.search(r"Exchange.*\n.*WindowGroupLimit", tree), tree


def test_latest_per_key_is_an_aggregate_not_a_window(spark):
    p = plan(QUERIES["latest_order_per_customer"](spark, SF))
    assert "max_by" in p and "Window" not in p


def test_scans_read_only_needed_columns(spark):
    p = plan(QUERIES["bq1_holiday_growth"](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert any(s.startswith("l_partkey") and "l_comment" not in s and "l_tax" not in s for s in schemas), schemas
    assert all(len(s.split(",")) <= 5 for s in schemas), schemas


def test_time_filters_reach_the_scan(spark):
    p = plan(QUERIES["bq9_training_dataset"](spark, SF))
    pushed = [ln for ln in p.splitlines() if ln.startswith("PushedFilters:")]
    assert any("GreaterThanOrEqual(ts," in ln and "LessThan(ts," in ln for ln in pushed), pushed


def test_fixed_lexicon_is_broadcast(spark):
    p = plan(QUERIES["doc_language"](spark, SF))
    assert "BroadcastHashJoin" in p


def test_drift_query_reads_events_few_times(spark):
    """The daily series and the bin counts are written once; the rest reads what was written."""
    assert plan(QUERIES["bq12_drift_and_error"](spark, SF)).count("events.parquet") <= 4


def test_rag_prompts_are_computed_once(spark):
    for name in ("rag_retrieval", "rag_answers"):
        assert "documents.parquet" not in plan(QUERIES[name](spark, SF))  # the prompts were written


def test_no_temporary_folders_in_the_package():
    import pathlib

    import quarry

    for f in pathlib.Path(quarry.__file__).parent.rglob("*.py"):
        assert "tempfile" not in f.read_text(), f
        assert "localCheckpoint(" not in f.read_text(), f
