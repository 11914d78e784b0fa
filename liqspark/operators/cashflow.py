"""30-day cashflow forecast per portfolio."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import dec
from ..functions.keys import surrogate_key
from ..schemas import PARTITION_DATE
from .risk import enrich_with_market

HORIZON_DAYS = 30
# Fixed value: estimated daily margin cost on short notional.
MARGIN_RATE = "0.001"
DAYS_PER_YEAR = 365


def date_horizon(start: Column, days: int = HORIZON_DAYS) -> Column:
    """Array of ``days`` consecutive dates from ``start`` (explode it)."""
    return F.sequence(start, F.date_add(start, days - 1))


def daily_amounts() -> list[Column]:
    """Daily coupon income and margin cost of a group of positions with market fields."""
    return [
        F.sum(F.when(F.col("yield_rate") > 0,
                     F.col("notional_value") * F.col("yield_rate") / DAYS_PER_YEAR)
              .otherwise(F.lit(0))).alias("daily_coupon_income"),
        F.sum(F.when(F.col("position_qty") < 0, F.abs(F.col("notional_value")) * dec(MARGIN_RATE))
              .otherwise(F.lit(0))).alias("daily_margin_cost"),
    ]


def portfolio_cash_summary(positions: DataFrame, market: DataFrame) -> DataFrame:
    """Per (portfolio, date): daily coupon income and daily margin cost."""
    e = enrich_with_market(positions, market, ["yield_rate"])
    return e.groupBy("portfolio_id", PARTITION_DATE).agg(*daily_amounts())


def cashflow_forecast(positions: DataFrame, market: DataFrame, days: int = HORIZON_DAYS) -> DataFrame:
    """``days`` rows per (portfolio, partition date) with projected flows and
    their running sum.

    The horizon is generated per summary row (explode of a date sequence), not
    by a join against a date table, and the running-sum window partitions by
    the aggregation keys, so it reuses the aggregate's shuffle.
    """
    s = portfolio_cash_summary(positions, market)
    f = s.select(
        "portfolio_id",
        F.explode(date_horizon(F.col(PARTITION_DATE), days)).alias("forecast_date"),
        F.round("daily_coupon_income", 2).alias("projected_inflow"),
        F.round("daily_margin_cost", 2).alias("projected_outflow"),
        F.round(F.col("daily_coupon_income") - F.col("daily_margin_cost"), 2).alias("net_cashflow"),
        PARTITION_DATE,
    )
    w = (Window.partitionBy("portfolio_id", PARTITION_DATE).orderBy("forecast_date")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return f.select(
        surrogate_key("portfolio_id", "forecast_date", PARTITION_DATE).alias("forecast_id"),
        "portfolio_id", "forecast_date", "projected_inflow", "projected_outflow", "net_cashflow",
        F.sum("net_cashflow").over(w).alias("cumulative_cashflow"),
        PARTITION_DATE,
    )
