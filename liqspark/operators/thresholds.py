"""Statistical data-quality rules: today's aggregate against the mean ± k·σ of
the same aggregate over the trailing N business dates.

Business dates come from the data (distinct Monday..Friday partition dates
before ``as_of``), not from a calendar. A group absent today yields no row; a
day without rows for a group is missing from its history, not zero.
"""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import dims_json, is_business_day, zscore
from ..functions.frames import union_all
from ..functions.keys import surrogate_key
from ..schemas import PARTITION_DATE


@dataclass(frozen=True)
class AggRule:
    """One rule: ``metric_expr`` (an aggregate in SQL) per ``group_by``."""

    name: str
    metric_expr: str
    group_by: tuple[str, ...] = field(default_factory=tuple)
    where: str = "1=1"
    stddev_multiplier: float = 3
    lookback_business_days: int = 60
    min_history_days: int = 20


# The shipped rules for the position book.
POSITION_RULES: tuple[AggRule, ...] = (
    AggRule("mart_positions__row_count__total", "count(*)", (), "1=1", 4, 60, 20),
    AggRule("mart_positions__notional__by_source_system", "sum(notional_value)", ("source_system",),
            "notional_value is not null", 3, 60, 20),
    AggRule("mart_positions__notional__by_position_type", "sum(notional_value)", ("position_type",),
            "notional_value is not null", 3, 60, 20),
    AggRule("mart_positions__notional__by_source_and_currency", "sum(notional_value)",
            ("source_system", "currency"), "currency is not null and notional_value is not null", 3, 60, 20),
)

METRIC_COLUMNS = [
    "dq_record_id", "rule_name", "dims_json", PARTITION_DATE, "current_value", "hist_n", "hist_mean",
    "hist_stddev", "lower_threshold", "upper_threshold", "zscore", "stddev_multiplier",
    "lookback_business_days", "min_history_days", "metric_expr", "filter_sql", "group_by_cols", "is_outlier",
]


def trailing_business_dates(book: DataFrame, as_of: dt.date, n: int) -> DataFrame:
    """(partition_date, rnk) of the last ``n`` distinct business dates before
    ``as_of`` present in ``book``; rnk 1 is the latest.

    The distinct is a partial aggregation on one date column; the ranking
    window runs on one partition, which is bounded by the number of calendar
    days in the table, never by its rows.
    """
    d = F.col(PARTITION_DATE).cast("date")
    dates = (book.select(d.alias(PARTITION_DATE))
             .where((F.col(PARTITION_DATE) < F.lit(as_of)) & is_business_day(F.col(PARTITION_DATE)))
             .distinct())
    ranked = dates.withColumn("rnk", F.dense_rank().over(Window.orderBy(F.col(PARTITION_DATE).desc())))
    return ranked.where(F.col("rnk") <= n)


def _on_dates(df: DataFrame, book_dates: DataFrame, rule: AggRule, as_of: dt.date) -> DataFrame:
    """Rows of ``df`` on the dates a rule looks at: ``as_of`` and the business
    dates of ``book_dates`` within its lookback (without a row of ``as_of`` one
    date more, which no group of that day will use).

    They are a broadcast of at most lookback + 1 rows, computed when the plan
    runs; over a stored table the semi-join is also a dynamic filter on the
    partitions to read. That needs a top-n and no equality: Spark gives the
    filter up where the dates come from a window, or where an inferred
    condition compares the partition date with ``=``.
    """
    d = F.col(PARTITION_DATE)
    days = book_dates.select(d.cast("date").alias(PARTITION_DATE)).where(
        (d <= F.lit(as_of)) & ((d >= F.lit(as_of)) | is_business_day(d)))
    back = days.distinct().orderBy(d.desc()).limit(int(rule.lookback_business_days) + 1)
    return df.join(F.broadcast(back), PARTITION_DATE, "left_semi")


def rule_metrics(book: DataFrame, rule: AggRule, as_of: dt.date, book_dates: DataFrame) -> DataFrame:
    """One rule's rows for ``as_of``: current value, history statistics,
    thresholds, z-score and outlier flag.

    ``book_dates`` has the book's dates. One scan serves the current day and the
    history: the book is joined with the trailing dates (so only their partitions
    of a stored book are read) and aggregated once per (date, dims). A second,
    tiny aggregation per dims then takes the current value and the history
    statistics with conditional aggregates, so no further join is needed;
    grouping keeps null dims together, as ``<=>`` does. Groups without a row
    today are dropped; groups without history get null statistics.
    """
    dims = list(rule.group_by)
    scoped = _on_dates(book.withColumn(PARTITION_DATE, F.col(PARTITION_DATE).cast("date")).where(F.expr(rule.where)),
                       book_dates, rule, as_of)
    daily = scoped.groupBy(PARTITION_DATE, *dims).agg(F.expr(rule.metric_expr).alias("metric_value"))

    today = F.col(PARTITION_DATE) == F.lit(as_of)
    v = F.col("metric_value")
    hist_v = F.when(~today, v)
    stats = daily.groupBy(*dims).agg(
        F.count(F.when(today, F.lit(1))).alias("_has_today"),
        F.max(F.when(today, v)).alias("current_value"),
        F.count(F.when(~today, F.lit(1))).alias("_hist_rows"),
        F.count(hist_v).alias("_hist_values"),
        F.sum(hist_v).alias("_hist_sum"),
        F.stddev_samp(hist_v.cast("double")).alias("hist_stddev"),
    ).where(F.col("_has_today") > 0)

    base = stats.select(*dims, F.lit(as_of).alias(PARTITION_DATE),
                        F.col("current_value").cast("double").alias("cur"), *_history("_hist_sum"), "hist_stddev")
    return _rule_rows(base, rule)


def _history(total: str) -> list[Column]:
    """History statistics: ``hist_n`` counts days with rows, whatever their
    value; the mean is over the days that have one."""
    rows, values = F.col("_hist_rows"), F.col("_hist_values")
    return [F.when(rows > 0, rows).alias("hist_n"),
            F.when(values > 0, F.col(total).cast("double") / values).alias("hist_mean")]


def _rule_rows(base: DataFrame, rule: AggRule) -> DataFrame:
    """Output rows of one rule from (dims, partition_date, cur, hist_n,
    hist_mean, hist_stddev): thresholds, z-score, outlier flag, rule
    metadata and the record key."""
    dims = list(rule.group_by)
    k = float(rule.stddev_multiplier)
    dj = F.col("dims_json") if "dims_json" in base.columns else dims_json(dims)
    cur, mean, sd, n = F.col("cur"), F.col("hist_mean"), F.col("hist_stddev"), F.col("hist_n")
    outlier = (F.when(n.isNull() | (n < rule.min_history_days), F.lit(False))
               .when(sd.isNull(), F.lit(False))
               .when(sd == 0, cur != mean)
               .otherwise(F.abs((cur - mean) / sd) > F.lit(k)))
    out = base.select(
        F.lit(rule.name).alias("rule_name"),
        dj.alias("dims_json"),
        PARTITION_DATE,
        cur.alias("current_value"),
        n.alias("hist_n"),
        mean.alias("hist_mean"),
        sd.alias("hist_stddev"),
        (mean - F.lit(k) * sd).alias("lower_threshold"),
        (mean + F.lit(k) * sd).alias("upper_threshold"),
        zscore(cur, mean, sd).alias("zscore"),
        F.lit(k).alias("stddev_multiplier"),
        F.lit(int(rule.lookback_business_days)).alias("lookback_business_days"),
        F.lit(int(rule.min_history_days)).alias("min_history_days"),
        F.lit(rule.metric_expr).alias("metric_expr"),
        F.lit(rule.where).alias("filter_sql"),
        F.lit(",".join(dims)).alias("group_by_cols"),
        outlier.alias("is_outlier"),
    )
    return out.select(
        surrogate_key("rule_name", "dims_json", F.col(PARTITION_DATE).cast("string")).alias("dq_record_id"),
        *out.columns)


def agg_threshold_metrics(book: DataFrame, as_of: dt.date, rules: Sequence[AggRule] = POSITION_RULES,
                          book_dates: DataFrame | None = None) -> DataFrame:
    """All rules for one run date, unioned (one row per rule x dims group).

    ``book_dates`` is any frame with the book's ``partition_date`` values, such
    as a stored book's folder names; without it they are taken from the book.
    Nothing is computed before the result is.
    """
    if not rules:
        raise ValueError("at least one rule is required")
    for r in rules:
        F.expr(r.metric_expr), F.expr(r.where)  # fail fast on malformed SQL text
    dates = book.select(PARTITION_DATE) if book_dates is None else book_dates
    return union_all([rule_metrics(book, r, as_of, dates) for r in rules])


def business_day_index(book: DataFrame) -> DataFrame:
    """Per distinct partition date: ``idx`` (1-based rank among business
    dates, null on weekends) and ``k`` (number of business dates before it).

    Both windows run over distinct dates only (bounded by the calendar).
    """
    d = book.select(F.col(PARTITION_DATE).cast("date").alias(PARTITION_DATE)).distinct()
    bd = is_business_day(F.col(PARTITION_DATE)).cast("int")
    w = Window.orderBy(PARTITION_DATE)
    before = F.coalesce(F.sum(bd).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return d.select(PARTITION_DATE,
                    F.when(bd == 1, before + 1).alias("idx"),
                    before.cast("long").alias("k"))


def daily_moments(book: DataFrame, rule: AggRule) -> DataFrame:
    """A rule's value per (date, dims group), as moments that add up over days:
    ``_rows`` (1), ``_values`` (1 if not null), ``_odd`` (1 if not finite),
    ``_s1`` and ``_s2`` (the value less ``_shift``, and its square).

    Integers and decimals of up to 28 digits and 4 places are summed exactly,
    others as doubles. ``_shift`` is the group's least finite value, so sums of
    squares hold deviations, not magnitudes.
    """
    dims = list(rule.group_by)
    daily = (book.where(F.expr(rule.where))
             .withColumn(PARTITION_DATE, F.col(PARTITION_DATE).cast("date"))
             .groupBy(PARTITION_DATE, *dims).agg(F.expr(rule.metric_expr).alias("metric_value")))
    kind, v = daily.schema["metric_value"].dataType, F.col("metric_value")
    exact = isinstance(kind, T.IntegralType) or isinstance(kind, T.DecimalType) and kind.precision <= 28 and kind.scale <= 4
    scale = kind.scale if isinstance(kind, T.DecimalType) else 0
    x = v.cast(f"decimal(28,{scale})") if exact else v.cast("double")
    odd = F.lit(False) if exact else F.isnan(x) | (F.abs(x) == float("inf"))
    group = Window.partitionBy(*dims) if dims else Window.partitionBy(F.lit(1))
    zero = F.lit(0).cast(f"decimal(28,{scale})" if exact else "double")
    shifted = daily.withColumn("_odd", F.coalesce(odd, F.lit(False)).cast("int")).withColumn(
        "_x", F.when(F.col("_odd") == 0, x)).withColumn("_shift", F.coalesce(F.min("_x").over(group), zero))
    y = F.coalesce(F.col("_x") - F.col("_shift"), zero)
    return shifted.select(PARTITION_DATE, *dims, "metric_value", "_shift", F.lit(1).alias("_rows"),
                          v.isNotNull().cast("int").alias("_values"), "_odd", y.alias("_s1"), (y * y).alias("_s2"))


MOMENTS = ("_rows", "_values", "_odd", "_s1", "_s2")


def rule_metrics_all_dates(book: DataFrame, rule: AggRule, index: DataFrame) -> DataFrame:
    """One rule for EVERY date of the book at once: each date's value against
    the trailing ``lookback`` business dates before that date.

    The book is scanned and aggregated once per (date, dims). On one ordering
    axis a business date's moments lie at ``2·idx``, and every date asks twice
    for the sum of all moments before a place: at ``2·k + 1`` (all business
    dates before it) and at ``2·(k - lookback) + 1``. Their difference is the
    moments of the trailing dates, so a row costs the same whatever the
    lookback. The window partitions by the rule's dims: 3 rows a date in each,
    however large the book.
    """
    dims, back = list(rule.group_by), int(rule.lookback_business_days)
    days = daily_moments(book, rule).join(F.broadcast(index), PARTITION_DATE)  # one row per calendar date
    asks = F.array(F.struct(F.lit(1).alias("_sign"), (F.col("k") * 2 + 1).alias("_pos")),
                   F.struct(F.lit(-1).alias("_sign"), ((F.col("k") - back) * 2 + 1).alias("_pos")),
                   F.struct(F.lit(0).alias("_sign"), (F.col("idx") * 2).cast("long").alias("_pos")))
    events = days.select("*", F.inline(asks)).where("_pos is not null")
    so_far = (Window.partitionBy(*dims) if dims else Window.partitionBy(F.lit(1))).orderBy("_pos").rangeBetween(
        Window.unboundedPreceding, Window.currentRow)
    running = events.select(*dims, PARTITION_DATE, "_sign", "metric_value", "_shift", *[
        F.sum(F.when(F.col("_sign") == 0, F.col(m))).over(so_far).alias(m) for m in MOMENTS])
    part = lambda m: (F.coalesce(F.sum(F.when(F.col("_sign") == 1, F.col(m))), F.lit(0))
                      - F.coalesce(F.sum(F.when(F.col("_sign") == -1, F.col(m))), F.lit(0)))
    stats = running.where("_sign <> 0").groupBy(*dims, PARTITION_DATE).agg(
        F.max("metric_value").alias("_cur"), F.max("_shift").alias("_shift"), *[part(m).alias(m) for m in MOMENTS])
    n, s1, s2 = F.col("_values"), F.col("_s1").cast("double"), F.col("_s2").cast("double")
    not_finite = F.lit(float("nan"))
    deviation = F.when(n < 2, F.lit(None)).when(F.col("_odd") > 0, not_finite).otherwise(
        F.sqrt(F.greatest(s2 - s1 * s1 / n, F.lit(0.0)) / (n - 1)))
    total = F.when(F.col("_odd") > 0, not_finite).otherwise((F.col("_s1") + n * F.col("_shift")).cast("double"))
    base = stats.select(*dims, PARTITION_DATE, F.col("_cur").cast("double").alias("cur"),
                        F.col("_rows").alias("_hist_rows"), n.alias("_hist_values"), total.alias("_hist_sum"),
                        deviation.alias("hist_stddev"))
    return _rule_rows(base.select(*dims, PARTITION_DATE, "cur", *_history("_hist_sum"), "hist_stddev"), rule)


def agg_threshold_metrics_all_dates(book: DataFrame, rules: Sequence[AggRule] = POSITION_RULES) -> DataFrame:
    """The metrics table as daily runs over the whole history would leave it:
    every rule for every partition date, in one plan."""
    index = business_day_index(book)
    return union_all([rule_metrics_all_dates(book, r, index) for r in rules])



# --- incremental form: stored daily values ------------------------------------

DAILY_KEY = ["rule_name", "definition", "dims_json", PARTITION_DATE]


def rule_definition(rule: AggRule) -> str:
    """Digest of what a rule's daily values depend on. Stored values of another
    definition are never read, so a changed rule doesn't mix with its past."""
    return hashlib.md5("\x1f".join([rule.metric_expr, rule.where, *rule.group_by]).encode()).hexdigest()


def _value_columns(v: Column, dtype) -> list[Column]:
    # Integers and decimals of up to 10 places keep exact sums; anything else is double.
    exact = isinstance(dtype, T.IntegralType) or isinstance(dtype, T.DecimalType) and dtype.scale <= 10
    return [(v.cast("decimal(38,10)") if exact else F.lit(None).cast("decimal(38,10)")).alias("metric_decimal"),
            (F.lit(None).cast("double") if exact else v.cast("double")).alias("metric_double")]


def daily_rule_values(book: DataFrame, rules: Sequence[AggRule] = POSITION_RULES) -> DataFrame:
    """Every rule's value per (date, dims group) of ``book``: the time series
    the thresholds are computed from. Feed it one day's partition in a daily
    run (one partition scanned) or the whole book once to backfill."""
    parts = []
    for rule in rules:
        dims = list(rule.group_by)
        daily = (book.where(F.expr(rule.where))
                 .withColumn(PARTITION_DATE, F.col(PARTITION_DATE).cast("date"))
                 .groupBy(PARTITION_DATE, *dims).agg(F.expr(rule.metric_expr).alias("v")))
        definition = F.lit(rule_definition(rule))
        parts.append(daily.select(
            surrogate_key(F.lit(rule.name), definition, dims_json(dims), F.col(PARTITION_DATE).cast("string"))
            .alias("dq_daily_id"),
            F.lit(rule.name).alias("rule_name"), definition.alias("definition"), dims_json(dims).alias("dims_json"),
            PARTITION_DATE, *_value_columns(F.col("v"), daily.schema["v"].dataType)))
    return union_all(parts)


def _wanted(rule: AggRule, ranked: Sequence[tuple[dt.date, int]], as_of: dt.date) -> list[dt.date]:
    return [day for day, rnk in ranked if rnk <= rule.lookback_business_days] + [as_of]


def _ranked(book_dates: DataFrame, as_of: dt.date, rules: Sequence[AggRule]) -> list[tuple[dt.date, int]]:
    n = max(r.lookback_business_days for r in rules)
    return [(r[PARTITION_DATE], r["rnk"]) for r in trailing_business_dates(book_dates, as_of, n).collect()]


def missing_daily_values(daily: DataFrame, book: DataFrame, book_dates: DataFrame, as_of: dt.date,
                         rules: Sequence[AggRule] = POSITION_RULES) -> DataFrame | None:
    """Daily values that the rules need and ``daily`` lacks (a new or changed
    rule, days that were never stored), from those partitions of ``book``
    alone; None if nothing is missing. A day without rows for a rule is looked
    at again each time."""
    ranked = _ranked(book_dates, as_of, rules)
    stored = {(r["rule_name"], r["definition"], r[PARTITION_DATE]) for r in
              daily.where(F.col(PARTITION_DATE).isin([d for d, _ in ranked] + [as_of])
                          & F.col("definition").isin([rule_definition(r) for r in rules]))
              .select("rule_name", "definition", PARTITION_DATE).distinct().collect()}  # rules x lookback rows
    parts = []
    for rule in rules:
        days = [d for d in _wanted(rule, ranked, as_of) if (rule.name, rule_definition(rule), d) not in stored]
        if days:
            parts.append(daily_rule_values(book.where(F.col(PARTITION_DATE).isin(days)), [rule]))
    return union_all(parts) if parts else None


def agg_threshold_metrics_from_daily(daily: DataFrame, book_dates: DataFrame, as_of: dt.date,
                                     rules: Sequence[AggRule] = POSITION_RULES) -> DataFrame:
    """The same rows as :func:`agg_threshold_metrics`, computed from stored
    daily values instead of re-aggregating the book's history: the run reads
    at most (lookback + 1) x groups small rows per rule, all of the rule's
    present definition. ``daily`` must hold what :func:`missing_daily_values`
    finds. ``book_dates`` is any frame with the book's ``partition_date``
    values, such as its folder names."""
    parts = []
    for rule in rules:
        rows = _on_dates(daily.where((F.col("rule_name") == rule.name) & (F.col("definition") == rule_definition(rule))),
                         book_dates, rule, as_of)
        v = F.coalesce(F.col("metric_decimal").cast("double"), F.col("metric_double"))
        today = F.col(PARTITION_DATE) == F.lit(as_of)
        exact_sum = F.sum(F.when(~today, F.col("metric_decimal")))
        dbl_sum = F.sum(F.when(~today, F.col("metric_double")))
        hist_v = F.when(~today, v)
        stats = rows.groupBy("dims_json").agg(
            F.count(F.when(today, F.lit(1))).alias("_has_today"),
            F.max(F.when(today, v)).alias("cur"),
            F.count(F.when(~today, F.lit(1))).alias("_hist_rows"),
            F.count(hist_v).alias("_hist_values"),
            F.coalesce(exact_sum.cast("double"), dbl_sum).alias("_hist_sum"),
            F.stddev_samp(hist_v).alias("hist_stddev"),
        ).where(F.col("_has_today") > 0)
        base = stats.select("dims_json", F.lit(as_of).alias(PARTITION_DATE), "cur", *_history("_hist_sum"),
                            "hist_stddev")
        parts.append(_rule_rows(base, rule))
    return union_all(parts)
