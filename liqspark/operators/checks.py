"""Data-quality checks. Each check returns the DataFrame of failing rows and
passes when it is empty; :func:`run_checks` tallies a whole suite in ONE job
(a union of one-row global counts), never by collecting failing rows.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.frames import union_all
from ..schemas import DEPOSITS, LOANS, PARTITION_DATE
from ..session import ensure_checkpoint_dir


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once (nulls ignored)."""
    return (df.where(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records"))
            .where(F.col("n_records") > 1))


# Digests that may be broadcast, of 8 bytes each.
BROADCAST_DIGESTS = 1_000_000


def digest_counts(keys: DataFrame) -> DataFrame:
    """Rows of each ``_digest``; the keys beside it don't travel."""
    return keys.groupBy("_digest").agg(F.count(F.lit(1)).alias("n"))


def unique_by_digest(df: DataFrame, column: str, digest: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """:func:`unique` of a stored table's long keys: digests of 8 bytes are
    counted first, and keys are compared as a whole only where a digest repeats,
    so different keys with one digest are told apart. The first count is stored
    when this is called; without a repeated digest no key is read again. The
    keys themselves travel only if their digest repeats, unless more than
    ``BROADCAST_DIGESTS`` do."""
    keys = df.where(F.col(column).isNotNull()).select(F.col(column).alias("unique_field"),
                                                      digest(F.col(column)).alias("_digest"))
    ensure_checkpoint_dir(df.sparkSession)
    repeated = digest_counts(keys).where(F.col("n") > 1).select("_digest").checkpoint()
    n = repeated.count()
    if n == 0:
        keys = keys.where(F.lit(False))
    elif n <= BROADCAST_DIGESTS:
        keys = keys.join(F.broadcast(repeated), "_digest", "left_semi")
    else:
        keys = keys.join(repeated, "_digest", "left_semi")
    return unique(keys, "unique_field")


def accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the accepted list with their counts (nulls pass)."""
    return (df.where(~F.col(column).isin(list(values)))
            .groupBy(F.col(column).alias("value_field"))
            .agg(F.count(F.lit(1)).alias("n_records")))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Child rows whose non-null key has no parent row (left anti join)."""
    c = child.where(F.col(column).isNotNull()).select(F.col(column).alias("from_field"))
    # distinct first: duplicates of a hot parent key collapse map-side before
    # the shuffle instead of piling into one anti-join task.
    p = parent.select(F.col(field).alias("from_field")).distinct()
    return c.join(p, "from_field", "left_anti")


def between(df: DataFrame, column: str, min_value=None, max_value=None) -> DataFrame:
    """Rows outside [min, max]; either bound may be omitted; nulls pass."""
    c = F.col(column)
    bad = F.lit(False)
    if min_value is not None:
        bad = bad | (c < F.lit(min_value))
    if max_value is not None:
        bad = bad | (c > F.lit(max_value))
    return df.where(bad)


def row_count_between(df: DataFrame, min_value=None, max_value=None) -> DataFrame:
    """One row (the count) when the table size is outside the bounds."""
    n = df.agg(F.count(F.lit(1)).alias("row_count"))
    return between(n, "row_count", min_value, max_value)


def clock(now: dt.datetime, dtype: str = "timestamp") -> Column:
    """A wall-clock literal read in the session time zone (a Python datetime
    literal would be shifted by the driver process's own zone)."""
    return F.lit(now.replace(tzinfo=None).isoformat(sep=" ")).cast(dtype)


def recency(df: DataFrame, field: str, interval_days: int, now: dt.datetime) -> DataFrame:
    """One row when the newest ``field`` is older than ``now - interval``.

    The clock is an argument so runs are reproducible.
    """
    threshold = clock(now) - F.expr(f"INTERVAL {int(interval_days)} DAYS")
    m = df.agg(F.max(F.col(field)).alias("most_recent"))
    return (m.select("most_recent", threshold.alias("threshold"))
            .where(F.col("most_recent").isNull() | (F.col("most_recent").cast("timestamp") < F.col("threshold"))))


def row_count_of_facts(spark: SparkSession, facts: dict, min_value=None, max_value=None) -> DataFrame:
    """:func:`row_count_between` from a stored table's footers."""
    n = spark.createDataFrame([(facts["n_rows"],)], "row_count bigint")
    return between(n, "row_count", min_value, max_value)


def recency_of_facts(spark: SparkSession, facts: dict, interval_days: int, now: dt.datetime) -> DataFrame:
    """:func:`recency` of a table's partition date, from its folder names."""
    newest = spark.createDataFrame([(facts["max_partition"],)], "d string").select(F.col("d").cast("date").alias("d"))
    return recency(newest, "d", interval_days, now)


def expression_is_true(df: DataFrame, expression: str, row_condition: str | None = None) -> DataFrame:
    """Rows (under the row condition) where the expression is false."""
    base = df.where(F.expr(row_condition)) if row_condition else df
    return base.where(~F.expr(expression))


def positive_when_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull() & (F.col(column) <= 0)).select(F.col(column).alias("value_field"))


# Source freshness limits in hours.
FRESHNESS_WARN_HOURS = 24
FRESHNESS_ERROR_HOURS = 48


def freshness(df: DataFrame, loaded_at: str, now: dt.datetime,
              warn_hours: int = FRESHNESS_WARN_HOURS, error_hours: int = FRESHNESS_ERROR_HOURS) -> DataFrame:
    """One row: newest load time, its age in seconds and pass / warn / error."""
    m = df.agg(F.max(F.col(loaded_at)).alias("max_loaded_at"))
    now_c = clock(now, df.schema[loaded_at].dataType.simpleString())
    age = F.unix_timestamp(now_c) - F.unix_timestamp(F.col("max_loaded_at"))
    status = (F.when(F.col("max_loaded_at").isNull(), F.lit("error"))
              .when(age > error_hours * 3600, F.lit("error"))
              .when(age > warn_hours * 3600, F.lit("warn"))
              .otherwise(F.lit("pass")))
    return m.select("max_loaded_at", age.alias("age_seconds"), status.alias("status"))


def forecast_has_days(cashflow: DataFrame, days: int = 30, as_of: dt.date | None = None) -> DataFrame:
    """(portfolio, date) groups whose forecast does not have ``days`` rows."""
    src = cashflow if as_of is None else cashflow.where(F.col(PARTITION_DATE) == F.lit(as_of))
    return (src.groupBy("portfolio_id", PARTITION_DATE).agg(F.count(F.lit(1)).alias("forecast_days"))
            .where(F.col("forecast_days") != days))


EXPECTED_SOURCES = (LOANS, DEPOSITS)


def both_sources(book: DataFrame, as_of: dt.date | None = None,
                 expected: Sequence[str] = EXPECTED_SOURCES) -> DataFrame:
    """Expected source systems missing from the book.

    With ``as_of``: one row per missing system on that date. Without it: one
    row per (date, missing system) over every date present in the book,
    from one conditional aggregation per date (no date x system product).
    """
    if as_of is not None:
        spark = book.sparkSession
        exp = spark.createDataFrame([(s,) for s in expected], "expected_source string")
        present = (book.where(F.col(PARTITION_DATE) == F.lit(as_of))
                   .select(F.col("source_system").alias("expected_source")).distinct())
        return exp.join(present, "expected_source", "left_anti").select(
            F.col("expected_source").alias("missing_source_system"))
    counts = book.groupBy(PARTITION_DATE).agg(
        *[F.count(F.when(F.col("source_system") == s, F.lit(1))).alias(f"_n{i}") for i, s in enumerate(expected)])
    missing = F.array(*[F.when(F.col(f"_n{i}") == 0, F.lit(s)) for i, s in enumerate(expected)])
    return (counts.select(PARTITION_DATE, F.explode(missing).alias("missing_source_system"))
            .where(F.col("missing_source_system").isNotNull()))


def market_data_present(risk: DataFrame, market: DataFrame, as_of: dt.date | None = None) -> DataFrame:
    """Risk rows with no market row for (instrument, date) (left anti join)."""
    src = risk if as_of is None else risk.where(F.col(PARTITION_DATE) == F.lit(as_of))
    m = market.select("instrument_id", PARTITION_DATE).distinct()
    return src.select("risk_record_id", "instrument_id", PARTITION_DATE).join(
        m, ["instrument_id", PARTITION_DATE], "left_anti")


OUTLIER_COLUMNS = [
    PARTITION_DATE, "rule_name", "dims_json", "current_value", "hist_n", "hist_mean", "hist_stddev",
    "lower_threshold", "upper_threshold", "zscore", "stddev_multiplier", "lookback_business_days",
    "min_history_days", "metric_expr", "filter_sql", "group_by_cols",
]


def no_outliers(metrics: DataFrame, as_of: dt.date) -> DataFrame:
    """Rule rows of ``as_of`` flagged as outliers."""
    return metrics.where((F.col(PARTITION_DATE) == F.lit(as_of)) & F.col("is_outlier")).select(*OUTLIER_COLUMNS)


# --- suite runner ------------------------------------------------------------

SEVERITIES = ("warn", "error")


@dataclass(frozen=True)
class Check:
    """A named check on a table; ``failing`` is the lazy failing-row frame.

    Checks that one aggregation of their table can count also carry ``source``
    and ``measure`` (the number of failing rows as an aggregate);
    :func:`run_checks` counts all such checks of one table in a single scan.
    """

    check_id: str
    table: str
    failing: DataFrame
    severity: str = "warn"
    source: DataFrame | None = None
    measure: Column | None = None

    def __post_init__(self):
        if self.severity not in SEVERITIES:
            raise ValueError(f"severity must be one of {SEVERITIES}")


RESULT_SCHEMA = T.StructType([
    T.StructField("check_id", T.StringType()), T.StructField("table_name", T.StringType()),
    T.StructField("severity", T.StringType()), T.StructField("failures", T.LongType()),
    T.StructField("status", T.StringType()), T.StructField("message", T.StringType()),
])


def row_check(check_id: str, table: str, source: DataFrame, predicate: Column, severity: str = "warn") -> Check:
    """A check whose failing rows are ``source.where(predicate)``."""
    return Check(check_id, table, source.where(predicate), severity, source, F.count(F.when(predicate, F.lit(1))))


def accepted_values_measure(column: str, values: Sequence) -> Column:
    """How many different values aren't accepted."""
    return F.count_distinct(F.when(~F.col(column).isin(list(values)), F.col(column)))


def row_count_measure(min_value=None, max_value=None) -> Column:
    """1 when the number of rows is outside the bounds."""
    n, bad = F.count(F.lit(1)), F.lit(False)
    if min_value is not None:
        bad = bad | (n < min_value)
    if max_value is not None:
        bad = bad | (n > max_value)
    return bad.cast("bigint")


def recency_measure(field: str, interval_days: int, now: dt.datetime) -> Column:
    """1 when the newest value is missing or too old."""
    newest, oldest = F.max(F.col(field)), clock(now) - F.expr(f"INTERVAL {int(interval_days)} DAYS")
    return (newest.isNull() | (newest.cast("timestamp") < oldest)).cast("bigint")


@dataclass(frozen=True)
class WriteMeasure:
    """What is counted for a check while its table is written. If not
    ``exact``, only zero tells the number of failures."""
    check_id: str
    measure: Column
    exact: bool = True


OBSERVED_ROWS = "rows written"
METRICS_WAIT = 60.0  # seconds


def measures_to_observe(measures: Sequence[WriteMeasure]) -> list[Column]:
    """Aggregates to observe on a write: the measures, and the row count."""
    return [F.count(F.lit(1)).alias(OBSERVED_ROWS)] + [m.measure.cast("bigint").alias(m.check_id) for m in measures]


def observed_failures(observation: Observation, measures: Sequence[WriteMeasure], rows: int) -> dict[str, int]:
    """Failures of the checks counted during a write that wrote ``rows`` rows.

    Empty if the write reported nothing or another number of rows (Spark counts
    a row again where a stage is repeated in part): those checks are then
    counted by a scan.
    """
    with ThreadPoolExecutor(max_workers=1) as pool:
        got = pool.submit(lambda: observation.get)
        try:
            seen = got.result(METRICS_WAIT if rows else 1.0)
        except TimeoutError:  # no task wrote a row, so nothing was reported
            pool.shutdown(wait=False)
            return {}
    if seen.get(OBSERVED_ROWS) != rows:
        return {}
    return {m.check_id: seen[m.check_id] for m in measures if m.exact or seen[m.check_id] == 0}


def _fused_counts(source: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Failure counts of many checks on one table in one scan: a global
    aggregation, unpivoted to one row per check."""
    counts = source.agg(*[c.measure.cast("bigint").alias(f"_c{i}") for i, c in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(c.check_id).alias("check_id"), F.lit(c.table).alias("table_name"),
                              F.lit(c.severity).alias("severity"), F.col(f"_c{i}").alias("failures"))
                     for i, c in enumerate(checks)])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def run_checks(spark: SparkSession, checks: Sequence[Check], known: dict[str, int] | None = None) -> DataFrame:
    """One row per check: failure count and status (pass / warn / fail).

    Checks in ``known`` (failures by check id, as counted while their table was
    written) are not counted again. Those with a measure are counted together
    in one scan of their table; every other failing frame is reduced to a
    one-row global count. The union of those rows is the result, so one action
    runs the suite and no failing row reaches the driver.
    """
    if not checks:
        return spark.createDataFrame([], RESULT_SCHEMA)
    parts, known = [], known or {}
    given = [(c.check_id, c.table, c.severity, known[c.check_id]) for c in checks if c.check_id in known]
    if given:
        parts.append(spark.createDataFrame(given, "check_id string, table_name string, severity string, failures bigint"))
    groups: dict[int, tuple[DataFrame, list[Check]]] = {}
    for c in checks:
        if c.check_id in known:
            continue
        if c.source is not None and c.measure is not None:
            groups.setdefault(id(c.source), (c.source, []))[1].append(c)
        else:
            parts.append(c.failing.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit(c.check_id).alias("check_id"), F.lit(c.table).alias("table_name"),
                F.lit(c.severity).alias("severity"), F.col("failures")))
    parts += [_fused_counts(src, cs) for src, cs in groups.values()]
    counted = union_all(parts)
    n = F.col("failures")
    status = F.when(n == 0, F.lit("pass")).when(F.col("severity") == "error", F.lit("fail")) \
        .otherwise(F.lit("warn"))
    message = F.when(n > 0, F.concat(F.lit("Got "), n.cast("string"),
                                     F.when(n == 1, F.lit(" result")).otherwise(F.lit(" results")),
                                     F.lit(", configured to "), F.col("severity"), F.lit(" if != 0")))
    return counted.select("check_id", "table_name", "severity", "failures", status.alias("status"),
                          message.alias("message"))


STORE_JOBS = 8  # writes of failing rows at a time


def store_failures(checks: Sequence[Check], base_path: str, results: DataFrame | None = None) -> None:
    """Persist the failing rows of every check that fails, as ``results`` (of
    :func:`run_checks`) or else a count tells, under ``base_path/<check_id>``."""
    if not checks:
        return
    results = run_checks(checks[0].failing.sparkSession, checks) if results is None else results
    failing = {r["check_id"] for r in results.where(F.col("failures") > 0).select("check_id").collect()}
    with ThreadPoolExecutor(max_workers=STORE_JOBS) as pool:
        list(pool.map(lambda c: c.failing.write.mode("overwrite").parquet(f"{base_path}/{c.check_id}"),
                      [c for c in checks if c.check_id in failing]))
