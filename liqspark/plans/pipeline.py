"""Daily run: stage the day's raw feeds, build every model for ``as_of`` and
merge it into its stored table, then run the declared checks on the stored
tables.

Each model reads the *stored* upstream tables (one pruned partition, or the
book's history for the DQ rules), so lineage is cut at every model and a
re-run of the same date replaces rows by key instead of appending. Running
the same date twice leaves every table unchanged.
"""

from __future__ import annotations

import datetime as dt
from typing import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import cashflow as cf
from ..operators import checks as ck
from ..operators import positions as pos
from ..operators import regulatory as reg
from ..operators import risk as rk
from ..operators import staging as stg
from ..operators import thresholds as th
from ..schemas import PARTITION_DATE
from ..session import ensure_runtime_conf
from ..sources import seeds, sinks
from ..functions.columns import with_audit
from .models import AUDIT_COLUMN, PARTITIONING
from .suite import DECLARED, build_checks, write_measures

# Merge key per model; the risk table has no unique key (its key omits the
# position type), so its day is replaced as a whole partition instead.
UNIQUE_KEYS = {
    "stg_market_data": ["market_data_id"],
    "stg_positions_loans": ["position_id"],
    "stg_positions_deposits": ["position_id"],
    "mart_positions": ["position_id"],
    "mart_liquidity_risk": None,
    "mart_cashflow_forecast": ["forecast_id"],
    "rpt_lcr": ["lcr_record_id"],
    "rpt_nsfr": ["nsfr_record_id"],
    "rpt_fr2052a_outflows": ["outflow_record_id"],
    "rpt_fr2052a_inflows": ["inflow_record_id"],
    "rpt_fr2052a_supplemental": ["supplemental_record_id"],
    "mart_positions_dq_metrics": ["dq_record_id"],
    "mart_positions_dq_daily": ["dq_daily_id"],
}


class Warehouse:
    """Path-based tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return sinks.read_table(self.spark, self.path(name)).drop(AUDIT_COLUMN.get(name, ""))

    def day(self, name: str, as_of: dt.date) -> DataFrame:
        return self.read(name).where(F.col(PARTITION_DATE) == F.lit(as_of))

    def dates(self, name: str) -> DataFrame:
        """The partition dates of a table, one row each, without reading its files."""
        return sinks.partition_dates(self.spark, self.path(name))

    def save(self, name: str, df: DataFrame, as_of: dt.date, measures: Sequence[ck.WriteMeasure] = ()) -> dict[str, int]:
        """Store one day of a model; returns the failures of the checks counted
        over the day's rows while they were written."""
        df = with_audit(df, AUDIT_COLUMN[name])
        key, path = UNIQUE_KEYS[name], self.path(name)
        seen = (Observation(), ck.measures_to_observe(measures)) if measures else None
        if key is None:
            sinks.replace_day(df, path, as_of, PARTITIONING[name], seen)
        else:
            sinks.upsert(self.spark, df, path, key, PARTITIONING[name], seen)
        return ck.observed_failures(seen[0], measures, sinks.stored_rows(self.spark, path, as_of)) if seen else {}


SCOPES = ("partition", "table")


def _level(builders: dict, wh: "Warehouse", as_of: dt.date, measures=lambda name: ()) -> dict[str, int]:
    """Build and store independent models concurrently (errors propagate);
    failures counted on the way."""
    from concurrent.futures import ThreadPoolExecutor

    known: dict[str, int] = {}
    with ThreadPoolExecutor(max_workers=len(builders)) as pool:
        for found in pool.map(lambda item: wh.save(item[0], item[1](), as_of, measures(item[0])), builders.items()):
            known.update(found)
    return known


def _threshold_metrics(wh: "Warehouse", as_of: dt.date, rules: Sequence[th.AggRule]) -> DataFrame:
    """Rule rows from the stored daily values. The book's dates are its folder
    names; what a new or changed rule lacks is first added from the book."""
    dates = wh.dates("mart_positions")
    missing = th.missing_daily_values(wh.read("mart_positions_dq_daily"), wh.read("mart_positions"), dates, as_of, rules)
    if missing is not None:
        wh.save("mart_positions_dq_daily", missing, as_of)
    return th.agg_threshold_metrics_from_daily(wh.read("mart_positions_dq_daily"), dates, as_of, rules)


def run_daily(spark: SparkSession, raw: dict[str, DataFrame], as_of: dt.date, root: str,
              now: dt.datetime | None = None, rules: Sequence[th.AggRule] = th.POSITION_RULES,
              failures_path: str | None = None, scope: str = "table") -> DataFrame:
    """Build and store all models for ``as_of``; return the check results.

    ``scope="table"`` (default) checks whole tables, as the original schedule
    does. ``scope="partition"`` is an option for large histories: it checks
    the partitions this run wrote. A daily run changes only ``as_of``, and
    every model key contains the partition date, so uniqueness and row checks
    are complete for the new day; damage to older days goes unseen. What checks
    look at in single rows is then counted while the day is written.
    """
    if scope not in SCOPES:
        raise ValueError(f"scope must be one of {SCOPES}")
    ensure_runtime_conf(spark)
    wh, known = Warehouse(spark, root), {}
    now = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    count = (lambda name: write_measures(name, as_of, now)) if scope == "partition" else (lambda name: ())
    seed = lambda n: seeds.load_seed(spark, n)

    mapping = lambda: seed("seed_fr2052a_product_mapping")
    # Each level's models are independent Spark jobs and run concurrently;
    # a level starts once the tables it reads are stored.
    known |= _level({
        "stg_market_data": lambda: stg.stage_market_data(raw["market_data"], as_of, "incremental"),
        "stg_positions_loans": lambda: stg.stage_positions(raw["positions_loans"], as_of, "incremental"),
        "stg_positions_deposits": lambda: stg.stage_positions(raw["positions_deposits"], as_of, "incremental"),
    }, wh, as_of, count)
    known |= _level({"mart_positions": lambda: pos.unify_positions(wh.day("stg_positions_loans", as_of),
                                                          wh.day("stg_positions_deposits", as_of))}, wh, as_of, count)
    # The day's book and market rows feed the nine models below: read them from
    # storage once and keep them (memory, spilling to disk) for those jobs.
    # A lost executor recomputes its blocks from the stored table (one scan).
    book = wh.day("mart_positions", as_of).persist(StorageLevel.MEMORY_AND_DISK)
    market = wh.day("stg_market_data", as_of).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        known |= _level({
            "mart_liquidity_risk": lambda: rk.liquidity_risk(book, market),
            "mart_cashflow_forecast": lambda: cf.cashflow_forecast(book, market),
            "rpt_nsfr": lambda: reg.nsfr(book, seed("seed_nsfr_factors")),
            "rpt_fr2052a_outflows": lambda: reg.fr2052a_outflows(book, mapping()),
            "rpt_fr2052a_inflows": lambda: reg.fr2052a_inflows(book, mapping()),
            # today's rule values come from today's partition only
            "mart_positions_dq_daily": lambda: th.daily_rule_values(book, rules),
        }, wh, as_of, count)
        known |= _level({
            "rpt_lcr": lambda: reg.lcr(book, wh.day("mart_cashflow_forecast", as_of),
                                       seed("seed_hqla_classification")),
            "rpt_fr2052a_supplemental": lambda: reg.fr2052a_supplemental(book, wh.day("mart_liquidity_risk", as_of)),
            "mart_positions_dq_metrics": lambda: _threshold_metrics(wh, as_of, rules),
        }, wh, as_of, count)
    finally:
        book.unpersist()
        market.unpersist()

    read = (lambda n: wh.day(n, as_of)) if scope == "partition" else wh.read
    raw_scope = (lambda df: stg.scan_partition(df, as_of, "incremental")) if scope == "partition" \
        else (lambda df: df)
    tables = {n: read(n) for n in UNIQUE_KEYS}
    tables.update({"raw_market_data": raw_scope(raw["market_data"]),
                   "raw_positions_loans": raw_scope(raw["positions_loans"]),
                   "raw_positions_deposits": raw_scope(raw["positions_deposits"])})
    tables.update({s: seed(s) for s in seeds.SEED_SCHEMAS})
    checks = build_checks(tables, as_of, now, DECLARED)
    results = ck.run_checks(spark, checks, known)
    if failures_path:
        # one row a check, computed once for the result and the choice of what to store
        results = spark.createDataFrame(results.collect(), ck.RESULT_SCHEMA)
        ck.store_failures(checks, failures_path, results)
    return results
