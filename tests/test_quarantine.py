"""Malformed raw values kept apart, and uniqueness by digest."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from helpers import D0
from liqspark.operators import checks as ck
from liqspark.operators import quarantine as qn
from liqspark.plans.cli import main
from liqspark.schemas import POSITION_COLUMNS, RAW_POSITIONS_SCHEMA
from liqspark.sources import sinks

HEADER = "portfolio_id,instrument_id,position_qty,notional_value,position_type,currency,maturity_date,interest_rate\n"
CLEAN = "PF1,INS1,10.5,1000.00,LONG,USD,2024-12-31,0.05\n"


def _feed(tmp_dir, name, *lines):
    path = f"{tmp_dir}/{name}.csv"
    with open(path, "w") as f:
        f.write(HEADER + "".join(lines))
    return path


def _load(spark, tmp_dir, feed, as_of=D0):
    kept = qn.ingest_checked(spark, feed, as_of, RAW_POSITIONS_SCHEMA, tmp_dir + "/raw", required=["portfolio_id"])
    values = qn.quarantined_values(spark, tmp_dir + "/raw").where(F.col("partition_date") == F.lit(as_of))
    return kept, sorted(((r.column_name, r.value, r.reason) for r in values.collect()), key=str)


def test_each_row_is_kept_or_set_apart_with_its_reasons(spark, tmp_dir):
    feed = _feed(tmp_dir, "day", CLEAN, CLEAN,  # a repeated row stays twice
                 "PF1,INS1,,,LONG,USD,,\n",  # nulls aren't malformed
                 "PF2,INS1,n/a,1e30,LONG,USD,31/12/2024,0.05\n",  # three values of one row
                 "PF3,INS1,NaN,1.005,LONG,USD,2024-12-31,  \n",
                 ",INS1,1,1,LONG,USD,2024-12-31,0.05\n")
    kept, values = _load(spark, tmp_dir, feed)
    assert kept.count() == 3 and "_issues" not in kept.columns
    assert values == sorted([("position_qty", "n/a", "not_a_number"), ("notional_value", "1e30", "does_not_fit"),
                             ("maturity_date", "31/12/2024", "not_a_date"), ("position_qty", "NaN", "not_a_number"),
                             ("interest_rate", "  ", "blank"), ("portfolio_id", None, "missing")], key=str)
    apart = qn.quarantined_rows(spark, tmp_dir + "/raw").collect()
    assert len(apart) == 3 and {r.instrument_id for r in apart} == {"INS1"}  # what could be cast is there
    assert all(r.file.endswith("day.csv") for r in qn.quarantined_values(spark, tmp_dir + "/raw").collect())


def test_unreadable_record_is_one_issue_with_its_text(spark, tmp_dir):
    kept, values = _load(spark, tmp_dir, _feed(tmp_dir, "short", CLEAN, "PF1,INS1,n/a\n"))
    assert kept.count() == 1 and values == [(None, "PF1,INS1,n/a", "unreadable_row")]


def test_json_feed(spark, tmp_dir):
    path = tmp_dir + "/day.json"
    with open(path, "w") as f:
        f.write('{"portfolio_id": "PF1", "position_qty": 3}\n{"portfolio_id": "PF2", "position_qty": "x"}\n{"portfolio_id"\n')
    kept = qn.ingest_checked(spark, path, D0, RAW_POSITIONS_SCHEMA, tmp_dir + "/raw", "json", ["portfolio_id"])
    assert [r.portfolio_id for r in kept.collect()] == ["PF1"]
    assert {r.reason for r in qn.quarantined_values(spark, tmp_dir + "/raw").collect()} == {"not_a_number", "unreadable_row"}


def test_rerun_replaces_both_branches_of_its_day_only(spark, tmp_dir):
    bad = _feed(tmp_dir, "bad", CLEAN, "PF2,INS1,n/a,1,LONG,USD,,\n")
    other = D0 - dt.timedelta(days=1)
    _load(spark, tmp_dir, bad, other)
    _load(spark, tmp_dir, bad)
    kept, values = _load(spark, tmp_dir, _feed(tmp_dir, "mended", CLEAN, CLEAN))
    assert kept.count() == 2 and values == []
    assert qn.quarantined_rows(spark, tmp_dir + "/raw").count() == 1  # of the other day
    kept, values = _load(spark, tmp_dir, _feed(tmp_dir, "empty"))
    assert kept.count() == 0 and values == []


def test_daily_run_command_reads_the_kept_rows(spark, tmp_dir):
    feed = _feed(tmp_dir, "day", CLEAN, "PF2,INS1,n/a,1,LONG,USD,,\n")
    main(["ingest", "--feed", "positions_loans", "--source-path", feed, "--partition-date", D0.isoformat(),
          "--target-table", tmp_dir + "/raw", "--format", "csv", "--quarantine"], spark)
    assert [r.portfolio_id for r in sinks.read_declared(spark, tmp_dir + "/raw", RAW_POSITIONS_SCHEMA).collect()] == ["PF1"]
    assert qn.quarantined_values(spark, tmp_dir + "/raw").count() == 1


def test_issues_are_found_in_the_pass_of_the_cast(spark, tmp_dir):
    raw = qn.read_text_feed(spark, _feed(tmp_dir, "one", CLEAN))
    plan = qn.branched(qn.typed_with_issues(raw, POSITION_COLUMNS))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan and "Union" not in plan


KEYS = ["a"] * 3 + ["b", "c", "c", None, None, "", ""]


@pytest.mark.parametrize("digest", [F.xxhash64, lambda c: F.length(c).cast("bigint"), lambda c: F.lit(1).cast("bigint")])
@pytest.mark.parametrize("few", [1_000_000, 0])
def test_unique_by_digest_tells_colliding_keys_apart(spark, monkeypatch, digest, few):
    monkeypatch.setattr(ck, "BROADCAST_DIGESTS", few)
    df = spark.createDataFrame([(k,) for k in KEYS], "k string")
    got = {tuple(r) for r in ck.unique_by_digest(df, "k", digest).collect()}
    assert got == {tuple(r) for r in ck.unique(df, "k").collect()} == {("a", 3), ("c", 2), ("", 2)}


def test_unique_by_digest_without_repeats_reads_keys_once(spark, tmp_dir):
    spark.range(100).select(F.sha1(F.col("id").cast("string")).alias("k")).write.parquet(tmp_dir + "/k")
    failing = ck.unique_by_digest(spark.read.parquet(tmp_dir + "/k"), "k")
    assert failing.count() == 0
    assert "FileScan" not in failing._jdf.queryExecution().executedPlan().toString()


def test_digests_travel_instead_of_keys(spark, capsys):
    keys = spark.range(100).select(F.sha1(F.col("id").cast("string")).alias("unique_field"))
    ck.digest_counts(keys.withColumn("_digest", F.xxhash64("unique_field"))).explain("formatted")
    exchange = re.search(r"\) Exchange *\nInput \[2\]: (.*)", capsys.readouterr().out).group(1)
    assert "_digest#" in exchange and "unique_field" not in exchange
