"""Adapter from the driver's ``lineitem`` table to the three raw feeds.

The reference ships no raw rows, so raw market data, loan positions and
deposit positions are derived from ``lineitem`` by fixed rules (one pass over
the table, all columns pruned to the eleven used). Every derived row keeps the
lineitem volume, so all downstream work grows with the input.

Rules (documented in FIXTURES.md §2): partition date = 2024-01-01 plus
``l_orderkey % 90`` days; loans are ``l_linestatus = 'O'``, deposits
``'F'``; market data covers every instrument except INS13.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import INGESTION_TS, PARTITION_DATE

# Fixed values of the adapter.
AS_OF = dt.date(2024, 3, 29)
BASE_DATE = dt.date(2024, 1, 1)
DAYS = 90
PORTFOLIOS = 10
INSTRUMENTS = 40
MISSING_MARKET_INSTRUMENT = 13
MATURITY_SPREAD_DAYS = 400
MATURITY_SHIFT_DAYS = 10
OPEN_MATURITY_LINE = 7

LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
    "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _partition_date() -> Column:
    return F.date_add(F.lit(BASE_DATE), (F.col("l_orderkey") % DAYS).cast("int"))


def _instrument_id() -> Column:
    return F.concat(F.lit("INS"), (F.col("l_partkey") % INSTRUMENTS).cast("string"))


def raw_positions(lineitem: DataFrame, linestatus: str) -> DataFrame:
    """Raw position feed rows (loans: 'O', deposits: 'F')."""
    pd_ = _partition_date()
    return lineitem.where(F.col("l_linestatus") == linestatus).select(
        F.concat(F.lit("PF"), (F.col("l_suppkey") % PORTFOLIOS).cast("string")).alias("portfolio_id"),
        _instrument_id().alias("instrument_id"),
        F.when(F.col("l_returnflag") == "N", -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("position_qty"),
        (F.col("l_extendedprice") * 12).alias("notional_value"),
        F.when(F.col("l_returnflag") == "A", "LONG").when(F.col("l_returnflag") == "N", "SHORT")
        .otherwise("HEDGE").alias("position_type"),
        F.when(F.col("l_suppkey") % 3 == 0, "USD").when(F.col("l_suppkey") % 3 == 1, "EUR")
        .otherwise("GBP").alias("currency"),
        F.when(F.col("l_linenumber") == OPEN_MATURITY_LINE, F.lit(None).cast("date"))
        .otherwise(F.date_add(pd_, (F.col("l_partkey") % MATURITY_SPREAD_DAYS).cast("int") - MATURITY_SHIFT_DAYS))
        .alias("maturity_date"),
        F.col("l_discount").alias("interest_rate"),
        pd_.alias(PARTITION_DATE),
        F.col("l_shipdate").alias(INGESTION_TS),
    )


def raw_market(lineitem: DataFrame) -> DataFrame:
    """Raw market data feed rows."""
    pd_ = _partition_date()
    price = F.col("l_extendedprice") / 100
    return lineitem.where(F.col("l_partkey") % INSTRUMENTS != MISSING_MARKET_INSTRUMENT).select(
        _instrument_id().alias("instrument_id"),
        pd_.alias("as_of_date"),
        price.alias("close_price"),
        (price - 0.05).alias("bid_price"),
        (price + 0.05).alias("ask_price"),
        (F.col("l_quantity") * 50000).cast("bigint").alias("volume"),
        F.col("l_tax").alias("yield_rate"),
        (F.col("l_discount") * 600).alias("spread_bps"),
        pd_.alias(PARTITION_DATE),
        F.col("l_shipdate").alias(INGESTION_TS),
    )


def raw_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three raw feeds derived from ``{sf_dir}/lineitem.parquet``."""
    lineitem = read_table(spark, sf_dir, "lineitem").select(*LINEITEM_COLUMNS)
    return {
        "market_data": raw_market(lineitem),
        "positions_loans": raw_positions(lineitem, "O"),
        "positions_deposits": raw_positions(lineitem, "F"),
    }


def instrument_number() -> Column:
    """Numeric part of the fixture's instrument id (INS<k> -> k)."""
    return F.regexp_extract(F.col("instrument_id"), r"(\d+)$", 1).cast("int")
