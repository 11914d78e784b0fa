"""liqspark: daily bank-liquidity reporting as PySpark DataFrame operators.

Raw feeds -> typed, deduplicated staging -> unified position book -> liquidity
risk and 30-day cashflow -> LCR, NSFR and FR 2052a reports -> statistical
data-quality rules and declared checks. Every operator is a plain
``DataFrame -> DataFrame`` function of built-in Spark expressions.

Entry points:
  liqspark.plans.models.Lineage        all models, lazy or stored
  liqspark.plans.pipeline.run_daily    one date: build, merge, check
  liqspark.plans.cli                   scheduled jobs (ingest / run / optimize)
  liqspark.operators.*                 the individual operators
"""

from .operators.cashflow import cashflow_forecast
from .operators.positions import unify_positions
from .operators.regulatory import fr2052a_inflows, fr2052a_outflows, fr2052a_supplemental, lcr, nsfr
from .operators.risk import liquidity_risk
from .operators.staging import stage_market_data, stage_positions
from .operators.thresholds import POSITION_RULES, AggRule, agg_threshold_metrics, agg_threshold_metrics_all_dates

__all__ = [
    "AggRule", "POSITION_RULES", "agg_threshold_metrics", "agg_threshold_metrics_all_dates", "cashflow_forecast",
    "fr2052a_inflows", "fr2052a_outflows", "fr2052a_supplemental", "lcr", "liquidity_risk", "nsfr",
    "stage_market_data", "stage_positions", "unify_positions",
]
