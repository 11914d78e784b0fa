"""The declared check suite: every schema and singular check of the models,
as data (:class:`CheckSpec`), turned into Spark checks by :func:`build_checks`.

Keeping the suite declarative lets the same list drive the Spark run and an
independent SQL formulation in tests.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import checks as ck
from ..schemas import PARTITION_DATE


@dataclass(frozen=True)
class CheckSpec:
    kind: str
    table: str
    column: str | None = None
    params: dict = field(default_factory=dict)
    severity: str = "warn"
    tags: tuple[str, ...] = ("data_quality",)

    @property
    def check_id(self) -> str:
        parts = [self.kind, self.table] + ([self.column] if self.column else [])
        return "__".join(parts)


def _nn(table, *cols):
    return [CheckSpec("not_null", table, c) for c in cols]


def _key(table, col):
    return [CheckSpec("unique", table, col), CheckSpec("not_null", table, col)]


POSITION_TYPES = ("LONG", "SHORT", "HEDGE")

# The declared checks of each table (columns, bounds, lists).
DECLARED: tuple[CheckSpec, ...] = tuple(
    _nn("raw_market_data", "instrument_id", "as_of_date")
    + _nn("raw_positions_loans", "portfolio_id", "instrument_id")
    + _nn("raw_positions_deposits", "portfolio_id", "instrument_id")
    + _key("stg_market_data", "market_data_id")
    + _nn("stg_market_data", "instrument_id", "as_of_date", "close_price")
    + [CheckSpec("between", "stg_market_data", "close_price", {"min_value": 0, "max_value": 1000000}),
       CheckSpec("between", "stg_market_data", "volume", {"min_value": 0}),
       CheckSpec("between", "stg_market_data", "spread_bps", {"min_value": 0, "max_value": 10000})]
    + _nn("stg_market_data", PARTITION_DATE)
    + [spec for t in ("stg_positions_loans", "stg_positions_deposits") for spec in (
        _key(t, "position_id")
        + _nn(t, "portfolio_id", "instrument_id", "position_qty", "notional_value")
        + [CheckSpec("between", t, "notional_value", {"min_value": -10000000000, "max_value": 10000000000}),
           CheckSpec("accepted_values", t, "position_type", {"values": POSITION_TYPES}),
           CheckSpec("between", t, "interest_rate", {"min_value": -0.1, "max_value": 1.0})]
        + _nn(t, PARTITION_DATE))]
    + _key("mart_positions", "position_id")
    + _nn("mart_positions", "portfolio_id", "instrument_id", "position_qty", "notional_value")
    + [CheckSpec("accepted_values", "mart_positions", "position_type", {"values": POSITION_TYPES})]
    + _nn("mart_positions", "source_system")
    + [CheckSpec("accepted_values", "mart_positions", "source_system", {"values": ("LOANS", "DEPOSITS")})]
    + _nn("mart_positions", PARTITION_DATE)
    + [CheckSpec("row_count_between", "mart_positions", None, {"min_value": 1})]
    + [CheckSpec("expression_is_true", "mart_positions_dq_metrics", None,
                 {"expression": "not is_outlier", "row_condition": "as_of"})]
    + _key("mart_positions_dq_metrics", "dq_record_id")
    + _key("mart_liquidity_risk", "risk_record_id")
    + _nn("mart_liquidity_risk", "portfolio_id", "instrument_id")
    + [CheckSpec("accepted_values", "mart_liquidity_risk", "liquidity_tier", {"values": ("HIGH", "MEDIUM", "LOW")}),
       CheckSpec("between", "mart_liquidity_risk", "est_days_to_liquidate", {"min_value": 0})]
    + _nn("mart_liquidity_risk", "market_value", PARTITION_DATE)
    + [CheckSpec("row_count_between", "mart_liquidity_risk", None, {"min_value": 1}),
       CheckSpec("recency", "mart_liquidity_risk", PARTITION_DATE, {"interval_days": 2})]
    + _key("mart_cashflow_forecast", "forecast_id")
    + _nn("mart_cashflow_forecast", "portfolio_id")
    + [CheckSpec("relationships", "mart_cashflow_forecast", "portfolio_id",
                 {"to": "mart_positions", "field": "portfolio_id"})]
    + _nn("mart_cashflow_forecast", "forecast_date", "projected_inflow", "projected_outflow", "net_cashflow",
          PARTITION_DATE)
    + _key("rpt_lcr", "lcr_record_id") + _nn("rpt_lcr", "portfolio_id", PARTITION_DATE)
    + [CheckSpec("between", "rpt_lcr", "lcr_pct", {"min_value": 0})]
    + _key("rpt_nsfr", "nsfr_record_id") + _nn("rpt_nsfr", "portfolio_id", PARTITION_DATE)
    + [CheckSpec("between", "rpt_nsfr", "nsfr_pct", {"min_value": 0})]
    + _key("rpt_fr2052a_outflows", "outflow_record_id") + _nn("rpt_fr2052a_outflows", "portfolio_id", PARTITION_DATE)
    + _key("rpt_fr2052a_inflows", "inflow_record_id") + _nn("rpt_fr2052a_inflows", "portfolio_id", PARTITION_DATE)
    + _key("rpt_fr2052a_supplemental", "supplemental_record_id")
    + _nn("rpt_fr2052a_supplemental", "portfolio_id", PARTITION_DATE)
    + _key("instrument_reference", "instrument_id")
    + [CheckSpec("accepted_values", "instrument_reference", "asset_class",
                 {"values": ("EQUITY", "FIXED_INCOME", "FX", "INDEX", "COMMODITY")})]
    + _key("seed_hqla_classification", "instrument_type")
    + [CheckSpec("accepted_values", "seed_hqla_classification", "hqla_level", {"values": ("1", "2A", "2B", "NON_HQLA")})]
    + _nn("seed_nsfr_factors", "instrument_type")
    + _nn("seed_fr2052a_product_mapping", "product_category")
    + _key("seed_fr2052a_product_mapping", "product_code")
    + [CheckSpec("accepted_values", "seed_fr2052a_product_mapping", "schedule", {"values": ("I", "O", "S")})]
    + [CheckSpec("forecast_has_30_days", "mart_cashflow_forecast"),
       CheckSpec("both_sources", "mart_positions"),
       CheckSpec("market_data_present", "mart_liquidity_risk"),
       CheckSpec("no_outliers", "mart_positions_dq_metrics")]
)


def row_predicate(spec: CheckSpec, as_of: dt.date) -> Column | None:
    """What makes a row fail, for the checks that look at single rows."""
    p, c = spec.params, F.col(spec.column) if spec.column else None
    today = F.col(PARTITION_DATE) == F.lit(as_of)
    if spec.kind == "not_null":
        return c.isNull()
    if spec.kind == "between":
        bad = F.lit(False)
        if p.get("min_value") is not None:
            bad = bad | (c < F.lit(p["min_value"]))
        if p.get("max_value") is not None:
            bad = bad | (c > F.lit(p["max_value"]))
        return bad
    if spec.kind == "expression_is_true":
        return (today if p.get("row_condition") == "as_of" else F.lit(True)) & ~F.expr(p["expression"])
    if spec.kind == "no_outliers":
        return today & F.col("is_outlier")
    return None


def write_measures(table: str, as_of: dt.date, now: dt.datetime, specs=DECLARED) -> list[ck.WriteMeasure]:
    """What the declared checks of a table can count while it is written."""
    found = []
    for s in specs:
        if s.table != table:
            continue
        p, bad = s.params, row_predicate(s, as_of)
        if bad is not None:
            found.append(ck.WriteMeasure(s.check_id, F.count(F.when(bad, F.lit(1)))))
        elif s.kind == "accepted_values":  # failures are different values; rows tell whether there are any
            rows = F.count(F.when(~F.col(s.column).isin(list(p["values"])), F.lit(1)))
            found.append(ck.WriteMeasure(s.check_id, rows, exact=False))
        elif s.kind == "row_count_between":
            found.append(ck.WriteMeasure(s.check_id, ck.row_count_measure(p.get("min_value"), p.get("max_value"))))
        elif s.kind == "recency":
            found.append(ck.WriteMeasure(s.check_id, ck.recency_measure(s.column, p["interval_days"], now)))
    return found


def build_check(spec: CheckSpec, tables: dict[str, DataFrame], as_of: dt.date, now: dt.datetime) -> ck.Check:
    t = tables[spec.table]
    p = spec.params
    k = spec.kind
    if k in ("not_null", "between", "expression_is_true"):
        return ck.row_check(spec.check_id, spec.table, t, row_predicate(spec, as_of), spec.severity)
    measure = None
    if k == "unique":
        f = ck.unique(t, spec.column)
    elif k == "accepted_values":
        f = ck.accepted_values(t, spec.column, p["values"])
        measure = ck.accepted_values_measure(spec.column, p["values"])
    elif k == "row_count_between":
        f = ck.row_count_between(t, p.get("min_value"), p.get("max_value"))
        measure = ck.row_count_measure(p.get("min_value"), p.get("max_value"))
    elif k == "recency":
        f = ck.recency(t, spec.column, p["interval_days"], now)
        measure = ck.recency_measure(spec.column, p["interval_days"], now)
    elif k == "relationships":
        f = ck.relationships(t, spec.column, tables[p["to"]], p["field"])
    elif k == "forecast_has_30_days":
        f = ck.forecast_has_days(t, 30, as_of)
    elif k == "both_sources":
        f = ck.both_sources(t, as_of)
    elif k == "market_data_present":
        f = ck.market_data_present(t, tables["stg_market_data"], as_of)
    elif k == "no_outliers":
        f = ck.no_outliers(t, as_of)
    else:
        raise ValueError(f"unknown check kind {k!r}")
    return ck.Check(spec.check_id, spec.table, f, spec.severity, t if measure is not None else None, measure)


def select_specs(specs=DECLARED, tag: str | None = None, tables: set[str] | None = None) -> list[CheckSpec]:
    """Suite subset by tag and/or table (the selection a run after one model uses)."""
    return [s for s in specs if (tag is None or tag in s.tags) and (tables is None or s.table in tables)]


def build_checks(tables: dict[str, DataFrame], as_of: dt.date, now: dt.datetime,
                 specs=DECLARED) -> list[ck.Check]:
    return [build_check(s, tables, as_of, now) for s in specs]
