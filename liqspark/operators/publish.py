"""Publishing DQ results: a run summary and assertion events, as DataFrames.

Events are rows (written as JSON by the caller), not HTTP calls; nothing is
pulled to the driver.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import PARTITION_DATE


# Assertion-id prefixes, separators and result labels of the
# published events.
CHECK_ID_PREFIX = "dbt_"
RULE_ID_PREFIX = "dq_"
DIMS_HASH_CHARS = 12
SUCCESS, FAILURE = "SUCCESS", "FAILURE"


def dq_summary(results: DataFrame) -> DataFrame:
    """Totals of a check-result frame: all, passed, failed, warned (other
    statuses count only in the total)."""
    s = F.col("status")
    return results.agg(
        F.count(F.lit(1)).alias("total_tests"),
        F.count(F.when(s == "pass", F.lit(1))).alias("passed"),
        F.count(F.when(s == "fail", F.lit(1))).alias("failed"),
        F.count(F.when(s == "warn", F.lit(1))).alias("warned"),
    )


def _safe_id(c: Column, chars: str) -> Column:
    return F.translate(c, chars, "_" * len(chars))


def dims_hash(dims: Column) -> Column:
    """First 12 hex digits of sha1 of the dims JSON (``{}`` when null)."""
    return F.substring(F.sha1(F.coalesce(dims, F.lit("{}"))), 1, DIMS_HASH_CHARS)


def check_events(results: DataFrame, run_id: str, as_of: dt.date) -> DataFrame:
    """One event per check: SUCCESS only for ``pass`` (``warn`` is FAILURE)."""
    aid = F.concat(F.lit(CHECK_ID_PREFIX), _safe_id(F.col("check_id"), "."))
    return results.select(
        aid.alias("assertion_id"),
        F.concat(F.lit(run_id + "::"), aid).alias("run_id"),
        F.col("table_name").alias("assertee_table"),
        F.when(F.col("status") == "pass", F.lit(SUCCESS)).otherwise(F.lit(FAILURE)).alias("result_type"),
        F.lit(as_of).alias(PARTITION_DATE),
        F.lit(None).cast("string").alias("rule_name"),
        F.lit(None).cast("string").alias("dims_json"),
        F.to_json(F.create_map(F.lit("message"), F.coalesce(F.col("message"), F.lit("")),
                               F.lit("partition_date"), F.lit(as_of.isoformat()),
                               F.lit("failures"), F.col("failures").cast("string"),
                               F.lit("status"), F.col("status"))).alias("native_results"),
    )


NATIVE_FIELDS = ["group_by_cols", "filter_sql", "metric_expr", "current_value", "lower_threshold",
                 "upper_threshold", "hist_mean", "hist_stddev", "hist_n", "zscore", "stddev_multiplier",
                 "lookback_business_days", "min_history_days"]


def rule_events(metrics: DataFrame, run_id: str, as_of: dt.date, table: str = "mart_positions") -> DataFrame:
    """One event per (rule, dims) row of ``as_of``: FAILURE when flagged."""
    m = metrics.where(F.col(PARTITION_DATE) == F.lit(as_of))
    rule = F.coalesce(F.col("rule_name"), F.lit("unknown_rule"))
    h = dims_hash(F.col("dims_json"))
    aid = F.concat(F.lit(RULE_ID_PREFIX), F.regexp_replace(rule, " ", "_"), F.lit("__"), h)
    kv = []
    for f in NATIVE_FIELDS:
        kv += [F.lit(f), F.col(f).cast("string")]
    kv += [F.lit(PARTITION_DATE), F.col(PARTITION_DATE).cast("string"), F.lit("rule_name"), rule,
           F.lit("dims_json"), F.coalesce(F.col("dims_json"), F.lit("{}"))]
    kv += [F.lit("is_outlier"), F.when(F.col("is_outlier"), "True").otherwise("False")]
    return m.select(
        aid.alias("assertion_id"),
        F.concat(F.lit(run_id + "::dq::"), rule, F.lit("::"), h).alias("run_id"),
        F.lit(table).alias("assertee_table"),
        F.when(F.col("is_outlier"), F.lit(FAILURE)).otherwise(F.lit(SUCCESS)).alias("result_type"),
        F.col(PARTITION_DATE),
        rule.alias("rule_name"),
        F.coalesce(F.col("dims_json"), F.lit("{}")).alias("dims_json"),
        F.to_json(F.create_map(*kv)).alias("native_results"),
    )


def assertion_events(metrics: DataFrame, results: DataFrame, run_id: str, as_of: dt.date) -> DataFrame:
    """Check events and rule events in one frame."""
    return check_events(results, run_id, as_of).unionByName(rule_events(metrics, run_id, as_of))


def write_events(events: DataFrame, path: str) -> None:
    """Persist events as JSON lines, one folder per run date (re-runs replace)."""
    (events.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(PARTITION_DATE).json(path))
