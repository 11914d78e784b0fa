"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator, each over the whole test tables (every partition date).

Outputs are finished for comparison: decimals become double after their
exact decimal computation and rounding, audit timestamps are left out.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..functions.frames import union_all
from ..functions.keys import surrogate_key
from ..operators import cashflow as cf
from ..operators import checks as ck
from ..operators import publish as pub
from ..operators import quarantine as qn
from ..operators import regulatory as reg
from ..operators import risk as rk
from ..operators import staging as stg
from ..operators import thresholds as th
from ..schemas import PARTITION_DATE, POSITION_KEYS, RAW_MARKET_SCHEMA, RAW_POSITIONS_SCHEMA
from ..session import ensure_checkpoint_dir
from ..sources import fixtures, seeds, sinks
from .models import MODEL_NAMES, PARTITIONING, Lineage
from .suite import build_checks, write_measures

AS_OF = fixtures.AS_OF
# Fixed clocks for the time-dependent checks (reproducible runs).
RECENCY_CLOCK = dt.datetime(2024, 4, 2, 12, 0, 0)
RUN_ID = "scheduled__2024-03-29T00:00:00+00:00"


def finish(df: DataFrame) -> DataFrame:
    """Decimals -> double (values are already rounded where the model rounds)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        cols.append(c.cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else c)
    return df.select(*cols)


def _lineage(spark: SparkSession, sf_dir: str) -> Lineage:
    return Lineage.from_testdata(spark, sf_dir)


def _model(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(_lineage(spark, sf_dir).table(name))
    run.__name__ = name
    return run


def q_liquidity_risk(spark, sf_dir):
    r = _lineage(spark, sf_dir).mart_liquidity_risk
    return finish(r.withColumn("est_days_to_liquidate", F.col("est_days_to_liquidate").cast("bigint")))


def q_liquidity_tier_summary(spark, sf_dir):
    s = rk.liquidity_tier_summary(_lineage(spark, sf_dir).mart_liquidity_risk)
    return finish(s.withColumn("max_days_to_liquidate", F.col("max_days_to_liquidate").cast("bigint")))


HQLA_TYPES = [r[0] for r in seeds.HQLA_CLASSIFICATION]


def q_lcr_instrument_master(spark, sf_dir):
    return finish(_lineage(spark, sf_dir).lcr(reg.hqla_type_by_instrument(HQLA_TYPES)))


def q_trailing_business_dates(spark, sf_dir):
    return th.trailing_business_dates(_lineage(spark, sf_dir).mart_positions, AS_OF, 60)


def report_metrics(m: DataFrame) -> DataFrame:
    """Reported precision of the rule rows: σ and z-score to 4 places, the
    operator's own thresholds to 2 (engines' stddev differ in the last bits).
    The outlier flag keeps the unrounded values."""
    places = {"hist_stddev": 4, "zscore": 4, "lower_threshold": 2, "upper_threshold": 2}
    return m.select(*[F.round(c, places[c]).alias(c) if c in places else F.col(c) for c in m.columns])


def q_agg_threshold_metrics(spark, sf_dir):
    return report_metrics(_lineage(spark, sf_dir).mart_positions_dq_metrics)


def q_agg_threshold_metrics_all_dates(spark, sf_dir):
    return report_metrics(th.agg_threshold_metrics_all_dates(_lineage(spark, sf_dir).mart_positions))


def q_surrogate_key(spark, sf_dir):
    b = _lineage(spark, sf_dir).mart_positions
    return b.select("position_id",
                    surrogate_key("portfolio_id", "instrument_id", "maturity_date").alias("maturity_key"),
                    surrogate_key("currency", F.col("interest_rate")).alias("rate_key"))


def q_cents_to_dollars(spark, sf_dir):
    li = fixtures.read_table(spark, sf_dir, "lineitem")
    return finish(li.select("l_orderkey", "l_linenumber",
                            C.cents_to_dollars("l_extendedprice").alias("extendedprice_dollars"),
                            C.cents_to_dollars("l_extendedprice", 4).alias("extendedprice_dollars_4")))


def q_maturity_bucket(spark, sf_dir):
    b = _lineage(spark, sf_dir).mart_positions
    fr = C.maturity_bucket("maturity_date", PARTITION_DATE)
    return b.select(
        "position_id", fr.alias("fr2052a_bucket"),
        C.maturity_bucket("maturity_date", PARTITION_DATE, C.NSFR_BUCKETS, C.NSFR_OPEN, C.NSFR_LAST).alias("nsfr_bucket"),
        C.bucket_order(fr).alias("bucket_order"))


def q_seed_lookup(spark, sf_dir):
    """Exposure by asset class: instrument INS<k> is mapped onto row k % 10
    of the instrument master (the fixture has no shared instrument ids)."""
    b = _lineage(spark, sf_dir).mart_positions
    ids = [r[0] for r in seeds.INSTRUMENT_REFERENCE]
    k = fixtures.instrument_number()
    mapped = b.withColumn("ref_instrument_id", F.element_at(F.array(*[F.lit(i) for i in ids]), k % len(ids) + 1))
    ref = seeds.load_seed(spark, "instrument_reference").withColumnRenamed("instrument_id", "ref_instrument_id")
    j = mapped.join(F.broadcast(ref.select("ref_instrument_id", "asset_class", "exchange")), "ref_instrument_id", "left")
    return finish(j.groupBy("asset_class", "exchange", PARTITION_DATE).agg(
        F.count(F.lit(1)).alias("position_count"), F.sum("notional_value").alias("total_notional")))


def _tables(L: Lineage) -> dict[str, DataFrame]:
    """The tables the declared suite checks (models stored first)."""
    from .suite import DECLARED

    t = L.materialize(names=[n for n in MODEL_NAMES if n in {s.table for s in DECLARED}])
    t["raw_market_data"] = L.raw["market_data"]
    t["raw_positions_loans"] = L.raw["positions_loans"]
    t["raw_positions_deposits"] = L.raw["positions_deposits"]
    for s in seeds.SEED_SCHEMAS:
        t[s] = L.seed(s)
    return t


def q_check_not_null(spark, sf_dir):
    r = _lineage(spark, sf_dir).mart_liquidity_risk
    return finish(ck.not_null(r, "market_value").select("risk_record_id", "portfolio_id", "instrument_id",
                                                         PARTITION_DATE))


def q_check_unique(spark, sf_dir):
    return ck.unique(_lineage(spark, sf_dir).mart_liquidity_risk, "risk_record_id")


def q_check_unique_digest(spark, sf_dir):
    """The stored risk table's keys, counted by digest first."""
    path = _scratch(spark, "digests")
    sinks.write_partitioned(_lineage(spark, sf_dir).mart_liquidity_risk.select("risk_record_id", PARTITION_DATE), path)
    return ck.unique_by_digest(sinks.read_table(spark, path), "risk_record_id")


def q_check_accepted_values(spark, sf_dir):
    return ck.accepted_values(_lineage(spark, sf_dir).mart_positions, "position_type", ["LONG", "SHORT", "HEDGE"])


def q_check_relationships(spark, sf_dir):
    L = _lineage(spark, sf_dir)
    return ck.relationships(L.mart_cashflow_forecast, "portfolio_id", L.mart_positions, "portfolio_id")


def q_check_between(spark, sf_dir):
    m = _lineage(spark, sf_dir).stg_market_data
    return finish(ck.between(m, "spread_bps", 0, 10000))


def q_check_row_count(spark, sf_dir):
    return ck.row_count_between(_lineage(spark, sf_dir).mart_positions, 1, None)


def q_footer_checks(spark, sf_dir):
    """Row count, recency and value range of the stored book, from its files'
    footers and folder names, with bounds that fail."""
    book = _lineage(spark, sf_dir).mart_positions
    path = _scratch(spark, "footers")
    sinks.write_partitioned(book, path, PARTITIONING["mart_positions"])
    facts = sinks.footer_facts(spark, path, ["maturity_date"])
    rows = ck.row_count_of_facts(spark, facts, MANY_ROWS, None).select(
        F.lit("row_count").alias("check_name"), F.col("row_count").cast("string").alias("value"))
    old = ck.recency_of_facts(spark, facts, 2, RECENCY_CLOCK).select(F.lit("recency"), F.col("most_recent").cast("string"))
    ends = spark.createDataFrame([(k, str(facts[k])) for k in ("min_maturity_date", "max_maturity_date")], rows.schema)
    return rows.union(old).union(ends)


def q_check_recency(spark, sf_dir):
    r = ck.recency(_lineage(spark, sf_dir).mart_liquidity_risk, PARTITION_DATE, 2, RECENCY_CLOCK)
    return r.select("most_recent", F.date_format("threshold", "yyyy-MM-dd HH:mm:ss").alias("threshold"))


def q_check_expression(spark, sf_dir):
    m = _lineage(spark, sf_dir).mart_positions_dq_metrics
    f = ck.expression_is_true(m, "not is_outlier", f"partition_date = DATE'{AS_OF.isoformat()}'")
    return f.select("dq_record_id", "rule_name", "dims_json")


def q_check_positive_when_not_null(spark, sf_dir):
    return finish(ck.positive_when_not_null(_lineage(spark, sf_dir).mart_positions, "position_qty"))


FRESHNESS_CLOCK = dt.datetime(2001, 11, 5, 12, 0, 0)


def q_check_freshness(spark, sf_dir):
    raw = _lineage(spark, sf_dir).raw
    parts = []
    for name in ("market_data", "positions_loans", "positions_deposits"):
        f = ck.freshness(raw[name], "_ingestion_ts", FRESHNESS_CLOCK)
        parts.append(f.select(F.lit(name).alias("source_table"),
                              F.date_format("max_loaded_at", "yyyy-MM-dd HH:mm:ss").alias("max_loaded_at"),
                              F.col("age_seconds").cast("bigint").alias("age_seconds"), "status"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_assert_forecast_30_days(spark, sf_dir):
    return ck.forecast_has_days(_lineage(spark, sf_dir).mart_cashflow_forecast, 30)


def q_assert_both_sources(spark, sf_dir):
    return ck.both_sources(_lineage(spark, sf_dir).mart_positions)


def q_assert_market_data_present(spark, sf_dir):
    L = _lineage(spark, sf_dir)
    return ck.market_data_present(L.mart_liquidity_risk, L.stg_market_data)


def q_assert_no_outliers(spark, sf_dir):
    return report_metrics(ck.no_outliers(_lineage(spark, sf_dir).mart_positions_dq_metrics, AS_OF))


def _results(spark, sf_dir):
    """The declared suite, run the way the daily job runs it: every model is
    first written as a partitioned table (shared checkpoint folder). What its
    checks can count row by row is counted by that write; the others scan the
    stored tables."""
    L = Lineage.from_testdata(spark, sf_dir, store=_scratch(spark, "models"),
                              measures=lambda name: write_measures(name, AS_OF, RECENCY_CLOCK))
    tables = _tables(L)
    return ck.run_checks(spark, build_checks(tables, AS_OF, RECENCY_CLOCK), L.known), L


def q_dq_check_results(spark, sf_dir):
    return _results(spark, sf_dir)[0]


def q_dq_summary(spark, sf_dir):
    return pub.dq_summary(_results(spark, sf_dir)[0])


def q_assertion_events(spark, sf_dir):
    res, L = _results(spark, sf_dir)
    ev = pub.assertion_events(L.mart_positions_dq_metrics, res, RUN_ID, AS_OF)
    native = [F.get_json_object("native_results", f"$.{f}").alias(f"native_{f}") for f in NATIVE_OUT]
    return ev.select(*[c for c in ev.columns if c != "native_results"], *native)


# Payload fields without floating-point text, which engines write differently.
NATIVE_OUT = ("partition_date", "rule_name", "dims_json", "message", "failures", "status", "group_by_cols", "filter_sql",
              "metric_expr", "hist_n", "lookback_business_days", "min_history_days", "is_outlier")


def _scratch(spark: SparkSession, name: str) -> str:
    """An unused path under the shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


BUCKETS = 2  # of the test data's small days


def _bucketed(spark: SparkSession, sf_dir: str) -> Lineage:
    """Book and market table stored in equal buckets of instruments."""
    return Lineage.from_testdata(spark, sf_dir, store=_scratch(spark, "bucketed"), buckets=BUCKETS)


def q_bucketed_liquidity_risk(spark, sf_dir):
    L = _bucketed(spark, sf_dir)
    r = rk.liquidity_risk(L.mart_positions, L.stg_market_data)
    return finish(r.withColumn("est_days_to_liquidate", F.col("est_days_to_liquidate").cast("bigint")))


def q_bucketed_cashflow_forecast(spark, sf_dir):
    L = _bucketed(spark, sf_dir)
    return finish(cf.cashflow_forecast(L.mart_positions, L.stg_market_data))


UPSERT_FROM = dt.date(2024, 3, 15)


def q_upsert(spark, sf_dir):
    """Book holding only loans, then a merge of the full book for the dates
    from 2024-03-15: those partitions gain the deposits."""
    book = _lineage(spark, sf_dir).mart_positions
    path = _scratch(spark, "upsert")
    sinks.write_partitioned(book.where(F.col("source_system") == "LOANS"), path + "/t")
    src = book.where(F.col(PARTITION_DATE) >= F.lit(UPSERT_FROM))
    sinks.upsert(spark, src, path + "/t", ["position_id"])
    return finish(sinks.read_table(spark, path + "/t").select(*book.columns))


def q_upsert_update(spark, sf_dir):
    """Merge of changed rows: the loans of the dates from 2024-03-15 get twice
    their notional, and the table has them and the untouched rows once."""
    book = _lineage(spark, sf_dir).mart_positions
    path = _scratch(spark, "upsert-update")
    sinks.write_partitioned(book, path, PARTITIONING["mart_positions"])
    new = book.where((F.col(PARTITION_DATE) >= F.lit(UPSERT_FROM)) & (F.col("source_system") == "LOANS"))
    new = new.withColumn("notional_value", (F.col("notional_value") * 2).cast("decimal(18,2)"))
    sinks.upsert(spark, new, path, ["position_id"], PARTITIONING["mart_positions"])
    return finish(sinks.read_table(spark, path).select(*book.columns))


NULL_DATE_INSTRUMENT = "INS7"


def q_upsert_null_partition(spark, sf_dir):
    """Rows of one instrument have no partition date; the deposits are merged
    into a table of the loans and no row of the null partition is lost."""
    book = _lineage(spark, sf_dir).mart_positions
    undated = F.when(F.col("instrument_id") != NULL_DATE_INSTRUMENT, F.col(PARTITION_DATE))
    book = book.withColumn(PARTITION_DATE, undated)
    path = _scratch(spark, "upsert-null")
    sinks.write_partitioned(book.where(F.col("source_system") == "LOANS"), path)
    sinks.upsert(spark, book.where(F.col("source_system") == "DEPOSITS"), path, ["position_id"])
    return finish(sinks.read_table(spark, path).select(*book.columns))


def q_schema_evolution(spark, sf_dir):
    """Dates before 2024-03-15 are written without the interest rate, later
    ones with it; two dates are compacted; the whole table is read back."""
    book = _lineage(spark, sf_dir).mart_positions
    path, by = _scratch(spark, "evolution"), PARTITIONING["mart_positions"]
    early = F.col(PARTITION_DATE) < F.lit(UPSERT_FROM)
    sinks.write_partitioned(book.where(early).drop("interest_rate"), path, by)
    sinks.upsert(spark, book.where(~early), path, ["position_id"], by)
    for day in (AS_OF, UPSERT_FROM - dt.timedelta(days=1)):
        sinks.compact_partition(spark, path, day, partition_by=by)
    return finish(sinks.read_table(spark, path).select(*book.columns))


def _ingest(spark, sf_dir, feed, schema, tag):
    """One day's drop of a feed, loaded twice; the second load replaces the first."""
    raw = _lineage(spark, sf_dir).raw[feed]
    path = _scratch(spark, f"ingest-{feed}")
    src = path + "/src"
    raw.where(F.col(PARTITION_DATE) == F.lit(AS_OF)).drop(PARTITION_DATE, "_ingestion_ts").write.parquet(src)
    for _ in range(2):
        out = sinks.ingest_raw(spark, src, AS_OF, schema, path + "/raw", source_system=tag)
    return finish(out.drop("_ingestion_ts"))


# Malformed texts put into the loan feed: (rows, column, text).
MALFORMED = (("instrument_id = 'INS9'", "position_qty", "n/a"),
             ("instrument_id = 'INS5' and position_type = 'LONG'", "notional_value", "9" * 25),
             ("instrument_id = 'INS6' and position_type = 'LONG'", "notional_value", " "),
             ("portfolio_id in ('PF3', 'PF4') and instrument_id in ('INS5', 'INS7')", "maturity_date", "31/12/2024"),
             ("instrument_id = 'INS8' and position_type <> 'SHORT'", "currency", None))


def q_quarantine(spark, sf_dir):
    """The loan feed of all dates as text with malformed values: rows kept, rows
    set apart, and each malformed value with its count, by date."""
    raw, path = _lineage(spark, sf_dir).raw["positions_loans"], _scratch(spark, "quarantine")
    text = {f.name: F.col(f.name).cast("string") for f in RAW_POSITIONS_SCHEMA.fields}
    for rows, column, value in MALFORMED:
        text[column] = F.when(F.expr(rows), F.lit(value).cast("string")).otherwise(text[column])
    raw.select(*[c.alias(n) for n, c in text.items()]).write.parquet(f"{path}/feed")
    qn.store_branches(qn.typed_with_issues(qn.read_text_feed(spark, f"{path}/feed", "parquet"), {
        f.name: f.dataType for f in RAW_POSITIONS_SCHEMA.fields}, POSITION_KEYS + ["currency"]), f"{path}/table")
    none = F.lit(None).cast("string")
    rows = lambda df, branch: df.groupBy(PARTITION_DATE).agg(
        F.lit(branch).alias("part"), none.alias("column_name"), none.alias("value"), none.alias("reason"),
        F.count(F.lit(1)).alias("n"), F.sum("notional_value").cast("double").alias("notional"))
    values = qn.quarantined_values(spark, f"{path}/table").where("file is not null").groupBy(
        PARTITION_DATE, F.lit("value").alias("part"), "column_name", "value", "reason").agg(
        F.count(F.lit(1)).alias("n"), F.lit(None).cast("double").alias("notional"))
    return rows(qn.kept_rows(spark, f"{path}/table"), "kept").union(
        rows(qn.quarantined_rows(spark, f"{path}/table"), "quarantine")).union(values)


def q_declared_scan(spark, sf_dir):
    """The stored loan feed through its declaration, by date, and the columns
    that a differing declaration is refused for."""
    raw, path = _lineage(spark, sf_dir).raw["positions_loans"], _scratch(spark, "declared")
    typed = raw.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in RAW_POSITIONS_SCHEMA.fields])
    sinks.write_partitioned(typed, path)
    rows = sinks.read_declared(spark, path, RAW_POSITIONS_SCHEMA).groupBy(F.col(PARTITION_DATE).cast("string").alias("what")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("notional_value").cast("double").alias("notional"))
    other = T.StructType([T.StructField(f.name, T.StringType() if f.name == "maturity_date" else f.dataType)
                          for f in RAW_POSITIONS_SCHEMA.fields] + [T.StructField("desk", T.StringType())])
    try:
        sinks.read_declared(spark, path, other)
        refused = []
    except ValueError as e:
        refused = [p.strip() for p in str(e).split("declaration:", 1)[1].split(";")]
    return rows.union(spark.createDataFrame([(r, None, None) for r in refused], "what string, n_rows bigint, notional double"))


def q_ingest_raw(spark, sf_dir):
    return _ingest(spark, sf_dir, "positions_loans", RAW_POSITIONS_SCHEMA, "LMS")


def q_ingest_deposits(spark, sf_dir):
    return _ingest(spark, sf_dir, "positions_deposits", RAW_POSITIONS_SCHEMA, "CBS")


def q_ingest_market(spark, sf_dir):
    return _ingest(spark, sf_dir, "market_data", RAW_MARKET_SCHEMA, None)


# --- checks on inputs that fail them -----------------------------------------

LARGE_NOTIONAL = 500_000
SHORT_HORIZON = 31
MANY_ROWS = 10 ** 12
TIGHT_RULES = tuple(replace(r, name=r.name + "__tight", stddev_multiplier=0.5, min_history_days=5)
                    for r in th.POSITION_RULES)


def q_accepted_values_failing(spark, sf_dir):
    return ck.accepted_values(_lineage(spark, sf_dir).mart_positions, "position_type", ["LONG", "SHORT"])


def q_relationships_failing(spark, sf_dir):
    """Instruments of the book without market data (INS13)."""
    L = _lineage(spark, sf_dir)
    return ck.relationships(L.mart_positions, "instrument_id", L.stg_market_data, "instrument_id")


def q_between_failing(spark, sf_dir):
    return finish(ck.between(_lineage(spark, sf_dir).stg_market_data, "spread_bps", 5, 20))


def q_row_count_failing(spark, sf_dir):
    return ck.row_count_between(_lineage(spark, sf_dir).mart_positions, MANY_ROWS, None)


def q_expression_failing(spark, sf_dir):
    f = ck.expression_is_true(_lineage(spark, sf_dir).mart_positions, f"notional_value <= {LARGE_NOTIONAL}",
                              f"partition_date >= DATE'{UPSERT_FROM.isoformat()}'")
    return finish(f.select("position_id", "notional_value", PARTITION_DATE))


def q_forecast_days_failing(spark, sf_dir):
    return ck.forecast_has_days(_lineage(spark, sf_dir).mart_cashflow_forecast, SHORT_HORIZON)


def q_both_sources_failing(spark, sf_dir):
    """A book whose deposits don't arrive on weekends."""
    book = _lineage(spark, sf_dir).mart_positions
    return ck.both_sources(book.where((F.col("source_system") == "LOANS") | C.is_business_day(F.col(PARTITION_DATE))))


def q_no_outliers_failing(spark, sf_dir):
    """Rules half a sigma wide, for the run date."""
    m = th.agg_threshold_metrics(_lineage(spark, sf_dir).mart_positions, AS_OF, TIGHT_RULES)
    return report_metrics(ck.no_outliers(m, AS_OF))


# --- rules: null days, stored history ---------------------------------------------

# The value is null on two days of three; those days still count as history.
NULL_DAY_RULES = (th.AggRule("hedge_notional_every_third_day",
                             "sum(case when day(partition_date) % 3 = 0 then notional_value end)", ("source_system",),
                             "position_type = 'HEDGE'", 3, 60, 20),)


def q_threshold_null_days(spark, sf_dir):
    return report_metrics(th.agg_threshold_metrics(_lineage(spark, sf_dir).mart_positions, AS_OF, NULL_DAY_RULES))


def q_threshold_null_days_all_dates(spark, sf_dir):
    return report_metrics(th.agg_threshold_metrics_all_dates(_lineage(spark, sf_dir).mart_positions, NULL_DAY_RULES))


def q_threshold_from_daily(spark, sf_dir):
    """The form the daily job runs: values of half of the dates are stored, the
    missing ones are added from the book, the rules read the stored values."""
    book = _lineage(spark, sf_dir).mart_positions
    path = _scratch(spark, "daily-values")
    some = book.where(F.dayofmonth(PARTITION_DATE) % 2 == 0)
    sinks.write_partitioned(th.daily_rule_values(some), path)
    dates = book.select(PARTITION_DATE)
    missing = th.missing_daily_values(sinks.read_table(spark, path), book, dates, AS_OF)
    sinks.upsert(spark, missing, path, ["dq_daily_id"])
    return report_metrics(th.agg_threshold_metrics_from_daily(sinks.read_table(spark, path), dates, AS_OF))


# --- one day, the way the job runs it ------------------------------------------------

def q_stage_market_incremental(spark, sf_dir):
    return finish(stg.stage_market_data(_lineage(spark, sf_dir).raw["market_data"], AS_OF, "incremental"))


def q_stage_loans_incremental(spark, sf_dir):
    return finish(stg.stage_positions(_lineage(spark, sf_dir).raw["positions_loans"], AS_OF, "incremental"))


def q_stage_loans_stamped(spark, sf_dir):
    """All history under the run date, as a literal first run stamps it."""
    return finish(stg.stage_positions(_lineage(spark, sf_dir).raw["positions_loans"], AS_OF, "full", stamp=True))


def q_daily_run(spark, sf_dir):
    """A daily run into an empty warehouse: every report it stored, as one
    list of (report, portfolio, record key, amount)."""
    from .pipeline import Warehouse, run_daily

    root = _scratch(spark, "daily-run")
    run_daily(spark, _lineage(spark, sf_dir).raw, AS_OF, root, now=RECENCY_CLOCK)
    wh = Warehouse(spark, root)
    amounts = {"rpt_lcr": ("lcr_record_id", "total_hqla"), "rpt_nsfr": ("nsfr_record_id", "total_asf"),
               "rpt_fr2052a_outflows": ("outflow_record_id", "gross_amount"),
               "rpt_fr2052a_inflows": ("inflow_record_id", "gross_amount"),
               "rpt_fr2052a_supplemental": ("supplemental_record_id", "reported_amount")}
    return union_all([wh.read(t).select(F.lit(t).alias("report"), "portfolio_id", PARTITION_DATE, F.col(k).alias("record_id"),
                                        F.col(v).cast("double").alias("amount")) for t, (k, v) in amounts.items()])


# --- supplemental report with an instrument master --------------------------------------

def q_supplemental_levels(spark, sf_dir):
    """HQLA levels by instrument number, and a book in which every third
    instrument's amounts are zero: S.H.1 rows appear, zero items don't."""
    L = _lineage(spark, sf_dir)
    k = fixtures.instrument_number()
    book = L.mart_positions.withColumn("notional_value", F.when(k % 3 == 0, F.lit(0)).otherwise(
        F.col("notional_value")).cast("decimal(18,2)"))
    level = lambda _: F.when(k % 4 == 0, "1").when(k % 4 == 1, "2A").otherwise("NON_HQLA")
    return finish(reg.fr2052a_supplemental(book, L.mart_liquidity_risk, level))


def q_stream_ingest(spark, sf_dir):
    """The raw loan feed dropped as files (one folder per day), ingested by the
    exactly-once availableNow stream; a second run over the same drop folder
    must add nothing."""
    from ..streaming.ingest import ingest_available

    raw = _lineage(spark, sf_dir).raw["positions_loans"].drop("_ingestion_ts")
    path = _scratch(spark, "stream")
    raw.write.partitionBy(PARTITION_DATE).parquet(path + "/drop")
    src_schema = spark.read.parquet(path + "/drop").schema
    for _ in range(2):
        ingest_available(spark, path + "/drop", src_schema, RAW_POSITIONS_SCHEMA, path + "/raw",
                         path + "/ckpt", source_system="LMS")
    return finish(spark.read.parquet(path + "/raw").drop("_ingestion_ts"))


def q_stream_merge(spark, sf_dir):
    """The raw loan feed in three drops dealt by hash, so the latest row of a
    key is in any of them. The last drop is streamed first, then the others,
    then one of them again under a new checkpoint, as after a lost one."""
    from ..streaming.ingest import merge_available

    raw = _lineage(spark, sf_dir).raw["positions_loans"].withColumn(
        "_ingestion_ts", F.col("_ingestion_ts").cast("timestamp"))
    path = _scratch(spark, "stream-merge")
    drops = raw.withColumn("drop", F.pmod(F.xxhash64(*raw.columns), F.lit(3)))
    drops.write.partitionBy("drop").parquet(path + "/all")
    for i, checkpoint in ((2, "a"), (0, "b"), (1, "c"), (0, "d")):
        merge_available(spark, f"{path}/all/drop={i}", raw.schema, RAW_POSITIONS_SCHEMA, POSITION_KEYS, path + "/raw",
                        f"{path}/{checkpoint}")
    out = sinks.read_table(spark, path + "/raw")
    return finish(out.withColumn("_ingestion_ts", F.col("_ingestion_ts").cast("date")))


def q_sync_columns(spark, sf_dir):
    L = _lineage(spark, sf_dir)
    old = L.mart_positions.drop("interest_rate").withColumn("legacy_flag", F.lit(1))
    return finish(sinks.sync_columns(old, L.mart_positions))


def q_compact_partition(spark, sf_dir):
    """The whole table after one date was compacted, and how many files each
    of that date's sub-partitions has left."""
    book = _lineage(spark, sf_dir).mart_positions
    path, by = _scratch(spark, "compact"), PARTITIONING["mart_positions"]
    book.repartition(8).write.partitionBy(*by).parquet(path)
    sinks.compact_partition(spark, path, AS_OF, partition_by=by)
    day = F.col(PARTITION_DATE) == F.lit(AS_OF)
    table = spark.read.schema(book.schema).parquet(path)
    files = table.where(day).select(*by, F.input_file_name().alias("file")).distinct().groupBy(*by).agg(
        F.count("file").alias("files_of_day"))
    return finish(table.join(files, list(by), "left").select(*book.columns, "files_of_day"))


def q_compact_small_files(spark, sf_dir):
    """The whole book in one date. A system's rows are one large file and two
    small ones: compaction merges the small ones and leaves the large one,
    and a second run finds nothing to do."""
    book = _lineage(spark, sf_dir).mart_positions.withColumn(PARTITION_DATE, F.lit(AS_OF))
    path, by = _scratch(spark, "compact-small"), PARTITIONING["mart_positions"]
    part = F.pmod(F.xxhash64("position_id"), F.lit(10))
    day = f"{path}/{PARTITION_DATE}={AS_OF.isoformat()}"
    for rows, files in ((part > 1, 1), (part <= 1, 2)):
        for system in ck.EXPECTED_SOURCES:
            book.where(rows & (F.col("source_system") == system)).drop(*by).repartition(files).write.mode("append").parquet(
                f"{day}/source_system={system}")
    sizes = {s: sorted(n for _, n in sinks.data_files(spark, f"{day}/source_system={s}")) for s in ck.EXPECTED_SOURCES}
    limit = min(s[-1] for s in sizes.values())
    name = F.input_file_name()
    table = lambda: spark.read.schema(book.schema).parquet(path)
    before = table().select(F.col("source_system").alias("was_in"), name.alias("file")).distinct()
    before = before.checkpoint()
    first = sinks.compact_partition(spark, path, AS_OF, partition_by=by, file_bytes=limit)
    again = sinks.compact_partition(spark, path, AS_OF, partition_by=by, file_bytes=limit)
    after = table().groupBy("source_system", name.alias("file")).agg(F.count(F.lit(1)).alias("n"))
    kept = after.join(before, "file", "left").groupBy("source_system").agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("files"), F.count("was_in").alias("kept_files"))
    return kept.select("source_system", "n_rows", "files", "kept_files", F.lit(first).cast("bigint").alias("rewritten"),
                       F.lit(again).cast("bigint").alias("rewritten_again"))


def q_stored_failures(spark, sf_dir):
    L = _lineage(spark, sf_dir)
    path = _scratch(spark, "failures")
    checks = [ck.Check("not_null__mart_liquidity_risk__market_value", "mart_liquidity_risk",
                       ck.not_null(L.mart_liquidity_risk, "market_value"))]
    ck.store_failures(checks, path)
    return finish(spark.read.parquet(f"{path}/{checks[0].check_id}")
                  .withColumn("est_days_to_liquidate", F.col("est_days_to_liquidate").cast("bigint")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stage_market_data": _model("stg_market_data"),
    "stage_positions_loans": _model("stg_positions_loans"),
    "stage_positions_deposits": _model("stg_positions_deposits"),
    "unify_positions": _model("mart_positions"),
    "liquidity_risk": q_liquidity_risk,
    "liquidity_tier_summary": q_liquidity_tier_summary,
    "cashflow_forecast": _model("mart_cashflow_forecast"),
    "lcr": _model("rpt_lcr"),
    "lcr_instrument_master": q_lcr_instrument_master,
    "nsfr": _model("rpt_nsfr"),
    "fr2052a_outflows": _model("rpt_fr2052a_outflows"),
    "fr2052a_inflows": _model("rpt_fr2052a_inflows"),
    "fr2052a_supplemental": _model("rpt_fr2052a_supplemental"),
    "trailing_business_dates": q_trailing_business_dates,
    "agg_threshold_metrics": q_agg_threshold_metrics,
    "agg_threshold_metrics_all_dates": q_agg_threshold_metrics_all_dates,
    "dq_daily_values": _model("mart_positions_dq_daily"),
    "surrogate_key": q_surrogate_key,
    "cents_to_dollars": q_cents_to_dollars,
    "maturity_bucket": q_maturity_bucket,
    "seed_lookup": q_seed_lookup,
    "check_not_null": q_check_not_null,
    "check_unique": q_check_unique,
    "check_unique_digest": q_check_unique_digest,
    "check_accepted_values": q_check_accepted_values,
    "check_relationships": q_check_relationships,
    "check_between": q_check_between,
    "check_row_count": q_check_row_count,
    "check_recency": q_check_recency,
    "footer_checks": q_footer_checks,
    "check_expression": q_check_expression,
    "check_positive_when_not_null": q_check_positive_when_not_null,
    "check_freshness": q_check_freshness,
    "assert_forecast_30_days": q_assert_forecast_30_days,
    "assert_both_sources": q_assert_both_sources,
    "assert_market_data_present": q_assert_market_data_present,
    "assert_no_outliers": q_assert_no_outliers,
    "dq_check_results": q_dq_check_results,
    "dq_summary": q_dq_summary,
    "assertion_events": q_assertion_events,
    "upsert": q_upsert,
    "ingest_raw": q_ingest_raw,
    "stream_ingest": q_stream_ingest,
    "sync_columns": q_sync_columns,
    "compact_partition": q_compact_partition,
    "stored_failures": q_stored_failures,
    "stream_merge": q_stream_merge,
    "compact_small_files": q_compact_small_files,
    "upsert_update": q_upsert_update,
    "upsert_null_partition": q_upsert_null_partition,
    "schema_evolution": q_schema_evolution,
    "quarantine": q_quarantine,
    "declared_scan": q_declared_scan,
    "ingest_deposits": q_ingest_deposits,
    "ingest_market": q_ingest_market,
    "accepted_values_failing": q_accepted_values_failing,
    "relationships_failing": q_relationships_failing,
    "between_failing": q_between_failing,
    "row_count_failing": q_row_count_failing,
    "expression_failing": q_expression_failing,
    "forecast_days_failing": q_forecast_days_failing,
    "both_sources_failing": q_both_sources_failing,
    "no_outliers_failing": q_no_outliers_failing,
    "threshold_null_days": q_threshold_null_days,
    "threshold_null_days_all_dates": q_threshold_null_days_all_dates,
    "agg_threshold_metrics_from_daily": q_threshold_from_daily,
    "stage_market_incremental": q_stage_market_incremental,
    "stage_loans_incremental": q_stage_loans_incremental,
    "stage_loans_stamped": q_stage_loans_stamped,
    "daily_run": q_daily_run,
    "supplemental_levels": q_supplemental_levels,
    "bucketed_liquidity_risk": q_bucketed_liquidity_risk,
    "bucketed_cashflow_forecast": q_bucketed_cashflow_forecast,
}
