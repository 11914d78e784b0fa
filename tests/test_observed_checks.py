"""Checks counted while their table is written, and facts from file footers."""

import datetime as dt
import re

from pyspark.sql import Observation
from pyspark.sql import functions as F

from helpers import D0, SF_SMALL
from liqspark.operators import checks as ck
from liqspark.plans import queries as Q
from liqspark.plans.models import Lineage
from liqspark.plans.pipeline import run_daily
from liqspark.plans.suite import CheckSpec, build_checks, write_measures
from liqspark.sources import fixtures, sinks

NOW = dt.datetime(2024, 4, 2, 12)
SPECS = [CheckSpec("not_null", "t", "v"), CheckSpec("between", "t", "v", {"min_value": 0, "max_value": 5}),
         CheckSpec("accepted_values", "t", "k", {"values": ("a", "b")}),
         CheckSpec("accepted_values", "t", "s", {"values": ("x",)}), CheckSpec("row_count_between", "t", None, {"min_value": 9}),
         CheckSpec("recency", "t", "partition_date", {"interval_days": 2}), CheckSpec("unique", "t", "k"),
         CheckSpec("expression_is_true", "t", None, {"expression": "v < 3", "row_condition": "as_of"})]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, s string, partition_date date")


def _tally(results):
    return {r.check_id: (r.failures, r.status, r.message) for r in results.collect()}


def _write(spark, df, path):
    seen, measures = Observation(), write_measures("t", D0, NOW, SPECS)
    sinks.write_partitioned(df, path, observed=(seen, ck.measures_to_observe(measures)))
    return seen, measures


def test_observed_counts_equal_a_scan(spark, tmp_dir):
    day = dt.timedelta(days=1)
    df = _frame(spark, [("a", 1, "x", D0), ("b", None, "x", D0), ("c", 7, "x", D0 - day), ("d", -1, "x", None), ("c", 4, "x", D0)])
    seen, measures = _write(spark, df, tmp_dir + "/t")
    known = ck.observed_failures(seen, measures, sinks.stored_rows(spark, tmp_dir + "/t"))
    # the unique check, and different values where some fail, need the table
    assert set(known) == {s.check_id for s in SPECS} - {"unique__t__k", "accepted_values__t__k"}
    checks = build_checks({"t": sinks.read_table(spark, tmp_dir + "/t")}, D0, NOW, SPECS)
    assert _tally(ck.run_checks(spark, checks, known)) == _tally(ck.run_checks(spark, checks))


def test_empty_write_and_a_wrong_row_count(spark, tmp_dir):
    seen, measures = _write(spark, _frame(spark, []), tmp_dir + "/t")
    known = ck.observed_failures(seen, measures, 0)
    checks = build_checks({"t": sinks.read_table(spark, tmp_dir + "/t")}, D0, NOW, SPECS)
    assert _tally(ck.run_checks(spark, checks, known)) == _tally(ck.run_checks(spark, checks))
    seen, measures = _write(spark, _frame(spark, [("a", 1, "x", D0)]), tmp_dir + "/u")
    assert ck.observed_failures(seen, measures, 2) == {}


def test_suite_results_are_the_same_and_known_checks_are_not_scanned(spark, tmp_dir):
    L = Lineage.from_testdata(spark, SF_SMALL, store=tmp_dir + "/models",
                              measures=lambda name: write_measures(name, Q.AS_OF, Q.RECENCY_CLOCK))
    checks = build_checks(Q._tables(L), Q.AS_OF, Q.RECENCY_CLOCK)
    fast, plain = ck.run_checks(spark, checks, L.known), ck.run_checks(spark, checks)
    assert _tally(fast) == _tally(plain)
    row_checks = [c for c in checks if c.source is not None and c.table in L._cache]
    assert len(row_checks) > 60 and all(c.check_id in L.known for c in row_checks)
    # no stored table is read for a column that only row checks look at
    scans = lambda d: " ".join(re.findall(r"FileScan parquet \[([^\]]*)\]", d._jdf.queryExecution().executedPlan().toString()))  # noqa: E731,E501
    for column in ("position_qty", "projected_inflow", "close_price", "est_days_to_liquidate"):
        assert column in scans(plain) and column not in scans(fast)


def test_daily_run_counts_its_partition_while_writing(spark, tmp_dir):
    raw, now = fixtures.raw_feeds(spark, SF_SMALL), dt.datetime(2024, 3, 30)
    results = _tally(run_daily(spark, raw, fixtures.AS_OF, tmp_dir + "/wh", now=now, scope="partition"))
    again = _tally(run_daily(spark, raw, fixtures.AS_OF, tmp_dir + "/wh", now=now, scope="partition"))
    assert results == again == _tally(run_daily(spark, raw, fixtures.AS_OF, tmp_dir + "/wh2", now=now))


def test_footers_answer_counts_and_dates(spark, tmp_dir):
    path, day = tmp_dir + "/t", dt.timedelta(days=1)
    sinks.write_partitioned(_frame(spark, [("a", 1, "x", D0), ("b", None, "x", D0 - day), ("c", 7, "y", None)]), path)
    assert sinks.footer_facts(spark, path, ["v"]) == {"n_rows": 3, "min_v": 1, "max_v": 7, "max_partition": str(D0)}
    assert sinks.stored_rows(spark, path, D0) == 1 and sinks.stored_rows(spark, path, D0 + day) == 0
    counted = sinks.footer_frame(spark, path).where(F.col("partition_date") == F.lit(D0)).agg(F.count(F.lit(1)), F.max("v"))
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), MAX(v)]" in plan
    # the caller's session keeps its reader
    assert "BatchScan" not in sinks.read_table(spark, path)._jdf.queryExecution().executedPlan().toString()
    facts = sinks.footer_facts(spark, path)
    assert ck.row_count_of_facts(spark, facts, 3, 3).count() == 0 and ck.row_count_of_facts(spark, facts, 4).first()[0] == 3
    assert ck.recency_of_facts(spark, facts, 2, NOW).count() == 1 and ck.recency_of_facts(spark, facts, 9, NOW).count() == 0
