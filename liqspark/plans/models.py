"""The model lineage: raw feeds -> staging -> book -> risk / cashflow ->
reports -> DQ metrics.

Lazy by default: each model is a DataFrame whose plan Catalyst optimises as a
whole. With ``store`` set, every model is written once as a partitioned
Parquet table under that folder (in dependency order) and downstream models
read the stored table, as the daily job does: lineage is cut at each model,
checks scan stored files with column and partition pruning, and a lost
executor recomputes from the last stored model, not from the raw feeds.
"""

from __future__ import annotations

import datetime as dt
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from ..operators import cashflow as cf
from ..operators import positions as pos
from ..operators import regulatory as reg
from ..operators import risk as rk
from ..operators import staging as stg
from ..operators import thresholds as th
from ..operators.checks import WriteMeasure, measures_to_observe, observed_failures
from ..functions.columns import with_audit
from ..schemas import PARTITION_DATE
from ..session import co_partitioned, ensure_runtime_conf
from ..sources import fixtures, seeds, sinks

MODEL_NAMES = (
    "stg_market_data", "stg_positions_loans", "stg_positions_deposits", "mart_positions",
    "mart_liquidity_risk", "mart_cashflow_forecast", "rpt_lcr", "rpt_nsfr", "rpt_fr2052a_outflows",
    "rpt_fr2052a_inflows", "rpt_fr2052a_supplemental", "mart_positions_dq_metrics", "mart_positions_dq_daily",
)
# Upstream models of each model; models of one level are independent.
DEPENDENCIES = {
    "stg_market_data": (), "stg_positions_loans": (), "stg_positions_deposits": (),
    "mart_positions": ("stg_positions_loans", "stg_positions_deposits"),
    "mart_liquidity_risk": ("mart_positions", "stg_market_data"),
    "mart_cashflow_forecast": ("mart_positions", "stg_market_data"),
    "rpt_lcr": ("mart_positions", "mart_cashflow_forecast"),
    "rpt_nsfr": ("mart_positions",), "rpt_fr2052a_outflows": ("mart_positions",),
    "rpt_fr2052a_inflows": ("mart_positions",),
    "rpt_fr2052a_supplemental": ("mart_positions", "mart_liquidity_risk"),
    "mart_positions_dq_metrics": ("mart_positions",),
    "mart_positions_dq_daily": ("mart_positions",),
}


def with_upstream(names) -> list[str]:
    """The named models plus everything they read, in declaration order."""
    need: set[str] = set()
    stack = list(names)
    while stack:
        n = stack.pop()
        if n not in need:
            need.add(n)
            stack.extend(DEPENDENCIES[n])
    return [n for n in MODEL_NAMES if n in need]


def levels(names=MODEL_NAMES) -> list[list[str]]:
    """Models (with their upstream) grouped so every model's upstream is in an
    earlier group."""
    names = with_upstream(names)
    done: set[str] = set()
    out = []
    while len(done) < len(names):
        level = [n for n in names if n not in done and all(d in done for d in DEPENDENCIES[n])]
        out.append(level)
        done.update(level)
    return out


# Audit column stamped when a model is stored (never part of the pure operators).
AUDIT_COLUMN = {name: "_computed_at" for name in MODEL_NAMES}
AUDIT_COLUMN.update({"stg_market_data": "_loaded_at", "stg_positions_loans": "_loaded_at",
                     "stg_positions_deposits": "_loaded_at", "mart_positions": "_unified_at",
                     "mart_positions_dq_metrics": "computed_at"})

# Storage partitioning per model (the book is also split by source system).
PARTITIONING = {name: (PARTITION_DATE,) for name in MODEL_NAMES}
PARTITIONING["mart_positions"] = (PARTITION_DATE, "source_system")
# Models that are joined on (instrument, date): bucketed alike if buckets are asked for.
BUCKETED = {name: ("instrument_id",) for name in ("mart_positions", "stg_market_data")}


class Lineage:
    """All models of one run, built from the three raw feeds."""

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame], as_of: dt.date = fixtures.AS_OF,
                 mode: str = "full", rules=th.POSITION_RULES, store: str | None = None,
                 measures: Callable[[str], Sequence[WriteMeasure]] | None = None, buckets: int | None = None):
        """With a store, ``measures`` names what to count of a model while it
        is written; ``known`` then holds the failures by check id. ``buckets``
        stores the book and the market table in that many buckets of
        instruments, so that their joins need no exchange."""
        self.spark, self.raw, self.as_of, self.mode, self.rules, self.store = spark, raw, as_of, mode, rules, store
        if buckets:
            self.spark = co_partitioned(spark)  # stored models are read there
        self.measures, self.known, self.buckets = measures or (lambda name: ()), {}, buckets
        self._cache: dict[str, DataFrame] = {}
        ensure_runtime_conf(spark)

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, **kw) -> "Lineage":
        return cls(spark, fixtures.raw_feeds(spark, sf_dir), **kw)

    def seed(self, name: str) -> DataFrame:
        return seeds.load_seed(self.spark, name)

    def _builders(self) -> dict[str, Callable[[], DataFrame]]:
        t = self.table
        return {
            "stg_market_data": lambda: stg.stage_market_data(self.raw["market_data"], self.as_of, self.mode),
            "stg_positions_loans": lambda: stg.stage_positions(self.raw["positions_loans"], self.as_of, self.mode),
            "stg_positions_deposits": lambda: stg.stage_positions(self.raw["positions_deposits"], self.as_of,
                                                                  self.mode),
            "mart_positions": lambda: pos.unify_positions(t("stg_positions_loans"), t("stg_positions_deposits")),
            "mart_liquidity_risk": lambda: rk.liquidity_risk(t("mart_positions"), t("stg_market_data")),
            "mart_cashflow_forecast": lambda: cf.cashflow_forecast(t("mart_positions"), t("stg_market_data")),
            "rpt_lcr": lambda: self.lcr(),
            "rpt_nsfr": lambda: reg.nsfr(t("mart_positions"), self.seed("seed_nsfr_factors")),
            "rpt_fr2052a_outflows": lambda: reg.fr2052a_outflows(t("mart_positions"),
                                                                 self.seed("seed_fr2052a_product_mapping")),
            "rpt_fr2052a_inflows": lambda: reg.fr2052a_inflows(t("mart_positions"),
                                                               self.seed("seed_fr2052a_product_mapping")),
            "rpt_fr2052a_supplemental": lambda: reg.fr2052a_supplemental(t("mart_positions"),
                                                                         t("mart_liquidity_risk")),
            "mart_positions_dq_metrics": lambda: th.agg_threshold_metrics(
                t("mart_positions"), self.as_of, self.rules, self._stored_dates("mart_positions")),
            "mart_positions_dq_daily": lambda: th.daily_rule_values(t("mart_positions"), self.rules),
        }

    def lcr(self, classify: Callable[[DataFrame], Column] = reg.default_hqla_type) -> DataFrame:
        """The LCR of the stored book and forecast, or, where nothing is
        stored, in one pass over the book."""
        hqla = self.seed("seed_hqla_classification")
        if self.store is not None:
            return reg.lcr(self.table("mart_positions"), self.table("mart_cashflow_forecast"), hqla, classify)
        return reg.lcr_one_pass(self.table("mart_positions"), self.table("stg_market_data"), hqla, classify)

    def _stored_dates(self, name: str) -> DataFrame | None:
        """A stored model's dates, by its folders' names."""
        return sinks.partition_dates(self.spark, f"{self.store.rstrip('/')}/{name}") if self.store else None

    def table(self, name: str) -> DataFrame:
        if name not in self._cache:
            df = self._builders()[name]()
            if self.store is not None:
                path, measures = f"{self.store.rstrip('/')}/{name}", self.measures(name)
                seen = (Observation(), measures_to_observe(measures)) if measures else None
                out, bucketed = with_audit(df, AUDIT_COLUMN[name]), self.buckets and name in BUCKETED
                if bucketed:
                    sinks.write_bucketed(out, path, BUCKETED[name], self.buckets, PARTITIONING[name], seen)
                else:
                    sinks.write_partitioned(out, path, PARTITIONING[name], seen)
                if seen:
                    self.known.update(observed_failures(seen[0], measures, sinks.stored_rows(self.spark, path)))
                df = (sinks.read_bucketed(self.spark, path).select(*df.columns) if bucketed
                      else sinks.read_table(self.spark, path, df.schema))
            self._cache[name] = df
        return self._cache[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in MODEL_NAMES:
            return self.table(name)
        raise AttributeError(name)

    def materialize(self, parallel: int | None = None, names=MODEL_NAMES) -> dict[str, DataFrame]:
        """Build (and, with ``store``, write) the named models and their
        upstream; name -> DataFrame.

        With a store, the independent models of one dependency level are
        written as concurrent Spark jobs (they share the cluster's task slots);
        each level waits for the previous one.
        """
        plan = levels(names)
        parallel = parallel or max(len(level) for level in plan)  # widest level at once
        if self.store is not None and parallel > 1:
            from concurrent.futures import ThreadPoolExecutor

            with ThreadPoolExecutor(max_workers=parallel) as pool:
                for level in plan:
                    list(pool.map(self.table, level))
        return {n: self.table(n) for n in with_upstream(names)}
