"""Physical-plan properties of every registered query (the scale contract):
no cartesian / nested-loop joins, no Python evaluation, the dedup limited
before its shuffle, filters pushed into the lineitem scan."""

from dataclasses import replace

import pytest

import __spark_entry__ as E
from helpers import SF_SMALL

# Queries whose construction writes files; their plans are covered by the
# model queries they read.
WRITERS = {"upsert", "ingest_raw", "stream_ingest", "stream_merge", "compact_partition", "compact_small_files", "stored_failures", "footer_checks",
           "quarantine", "declared_scan", "check_unique_digest", "bucketed_liquidity_risk", "bucketed_cashflow_forecast",
           "dq_check_results", "dq_summary", "assertion_events"}
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _scans(df):
    """(location, pushed filters, read schema) of every file scan."""
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves().iterator()
    out = []
    while leaves.hasNext():
        n = leaves.next()
        if n.getClass().getSimpleName() == "FileSourceScanExec":
            md = n.metadata()
            out.append((md.apply("Location"), md.apply("PushedFilters"), md.apply("ReadSchema")))
    return out


@pytest.mark.parametrize("name", sorted(set(E.queries()) - WRITERS))
def test_plan_shape(spark, name):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    df = E.queries()[name](spark, SF_SMALL)
    plan = _plan(df)
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op} in plan"
    if "row_number()" in plan:
        assert "WindowGroupLimit" in plan and "Partial" in plan, f"{name}: dedup not limited before shuffle"
    for location, pushed, schema in _scans(df):
        if "lineitem" in location and "l_linestatus" in schema:
            # the loan / deposit split reaches the parquet reader
            assert "EqualTo(l_linestatus" in pushed, (name, pushed)
        if "lineitem" in location:
            # column pruning: no derived feed needs all 11 lineitem columns
            assert schema.count(":") < 11, (name, schema)


def test_seed_joins_are_broadcast(spark):
    plan = _plan(E.queries()["nsfr"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_cashflow_window_reuses_aggregate_partitioning(spark):
    import re

    plan = _plan(E.queries()["cashflow_forecast"](spark, SF_SMALL))
    # one shuffle on (portfolio_id, partition_date) serves both the aggregate and the running-sum window
    assert len(re.findall(r"Exchange hashpartitioning\(portfolio_id#\d+, partition_date#\d+, \d+\)", plan)) == 1


def test_dq_history_scans_are_pruned_by_the_lazy_dates(spark, tmp_dir):
    from liqspark.operators import thresholds as th
    from liqspark.plans.models import Lineage
    from liqspark.sources import sinks

    L = Lineage.from_testdata(spark, SF_SMALL, store=tmp_dir + "/wh")
    book, dates = L.table("mart_positions"), sinks.partition_dates(spark, tmp_dir + "/wh/mart_positions")
    rules = [replace(r, lookback_business_days=5) for r in th.POSITION_RULES]
    df = th.agg_threshold_metrics(book, L.as_of, rules, dates)
    jobs = df._jdf.queryExecution()
    assert _plan(df).count("dynamicpruning") >= 4  # a filter on the partitions of each rule's scan
    df.collect()
    read, todo = [], [jobs.executedPlan()]
    while todo:  # scans inside the adaptive plan's finished stages
        n = todo.pop()
        kind = n.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(n.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(n.plan())
        elif kind == "FileSourceScanExec" and "mart_positions" in n.metadata().apply("Location"):
            read.append(n.metrics().apply("numPartitions").value())
        children = n.children().iterator()
        while children.hasNext():
            todo.append(children.next())
    assert read and set(read) <= {6, 12}  # dates, or dates by source system
