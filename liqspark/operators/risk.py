"""Liquidity risk per position: market join, tier, days to liquidate, value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import days_to_liquidate, liquidity_tier
from ..functions.keys import surrogate_key
from ..schemas import PARTITION_DATE

MARKET_FIELDS = ["close_price", "bid_price", "ask_price", "volume", "spread_bps", "yield_rate"]
RISK_KEY = ["portfolio_id", "instrument_id", PARTITION_DATE]


def enrich_with_market(positions: DataFrame, market: DataFrame, fields: list[str]) -> DataFrame:
    """Left join of positions to market data on (instrument_id, partition_date).

    No broadcast hint: market data grows with instruments x dates, so AQE
    broadcasts it only when the runtime size is under the threshold and keeps
    a sort-merge join (with skew splitting) otherwise.
    """
    m = market.select("instrument_id", PARTITION_DATE, *fields)
    return positions.join(m, on=["instrument_id", PARTITION_DATE], how="left")


def liquidity_risk(positions: DataFrame, market: DataFrame) -> DataFrame:
    """One row per position with market fields, tier, days to liquidate and
    market value; ``risk_record_id`` hashes (portfolio, instrument, date) and
    so repeats when an instrument is held under several position types."""
    e = enrich_with_market(positions, market, MARKET_FIELDS)
    return e.select(
        surrogate_key(*RISK_KEY).alias("risk_record_id"),
        "portfolio_id", "instrument_id", "position_qty", "notional_value",
        *MARKET_FIELDS,
        liquidity_tier("volume", "spread_bps").alias("liquidity_tier"),
        days_to_liquidate("position_qty", "volume").alias("est_days_to_liquidate"),
        (F.col("position_qty") * F.col("close_price")).alias("market_value"),
        PARTITION_DATE,
    )


def liquidity_tier_summary(risk: DataFrame) -> DataFrame:
    """Portfolio x tier x date roll-up of the risk table (partial aggregation
    before the shuffle, so hot portfolios do not skew the reduce side)."""
    return risk.groupBy("portfolio_id", PARTITION_DATE, "liquidity_tier").agg(
        F.count(F.lit(1)).alias("position_count"),
        F.sum("notional_value").alias("total_notional"),
        F.sum("market_value").alias("total_market_value"),
        F.max("est_days_to_liquidate").alias("max_days_to_liquidate"),
    )
