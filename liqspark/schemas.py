"""Typed schemas of the raw feeds and the staged tables."""

from __future__ import annotations

from pyspark.sql import types as T

DEC_PRICE = T.DecimalType(18, 6)
DEC_QTY = T.DecimalType(18, 4)
DEC_AMOUNT = T.DecimalType(18, 2)
DEC_RATE = T.DecimalType(10, 6)
DEC_BPS = T.DecimalType(10, 2)

# Staged market data: column -> target type (order is the output order).
MARKET_COLUMNS: dict[str, T.DataType] = {
    "instrument_id": T.StringType(),
    "as_of_date": T.DateType(),
    "close_price": DEC_PRICE,
    "bid_price": DEC_PRICE,
    "ask_price": DEC_PRICE,
    "volume": T.LongType(),
    "yield_rate": DEC_RATE,
    "spread_bps": DEC_BPS,
}
MARKET_KEYS = ["instrument_id", "as_of_date"]

# Staged positions (loans and deposits share one layout).
POSITION_COLUMNS: dict[str, T.DataType] = {
    "portfolio_id": T.StringType(),
    "instrument_id": T.StringType(),
    "position_qty": DEC_QTY,
    "notional_value": DEC_AMOUNT,
    "position_type": T.StringType(),
    "currency": T.StringType(),
    "maturity_date": T.DateType(),
    "interest_rate": DEC_RATE,
}
POSITION_KEYS = ["portfolio_id", "instrument_id", "position_type", "partition_date"]

INGESTION_TS = "_ingestion_ts"
PARTITION_DATE = "partition_date"

# Raw tables that set rows with malformed values apart (operators/quarantine.py).
BRANCH = "branch"
KEPT, QUARANTINED = "kept", "quarantine"
ISSUES = "_issues"


def _struct(columns: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in columns.items()])


RAW_MARKET_SCHEMA = T.StructType(
    _struct(MARKET_COLUMNS).fields
    + [T.StructField(PARTITION_DATE, T.DateType()), T.StructField(INGESTION_TS, T.TimestampType())]
)
RAW_POSITIONS_SCHEMA = T.StructType(
    _struct(POSITION_COLUMNS).fields
    + [T.StructField(PARTITION_DATE, T.DateType()), T.StructField(INGESTION_TS, T.TimestampType())]
)

# Source system tags of the two position feeds.
LOANS = "LOANS"
DEPOSITS = "DEPOSITS"
