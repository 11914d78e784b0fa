import datetime as dt
from decimal import Decimal

from liqspark.schemas import RAW_MARKET_SCHEMA, RAW_POSITIONS_SCHEMA

SF_SMALL = "/root/testdata/sf0.001"
D0 = dt.date(2024, 3, 29)


def ts(h):
    return dt.datetime(2024, 3, 29, h, 0, 0)


def positions(spark, rows):
    """rows: dicts with any raw position fields; defaults fill the rest."""
    base = dict(portfolio_id="PF1", instrument_id="INS1", position_qty=Decimal("10.0000"),
                notional_value=Decimal("1000.00"), position_type="LONG", currency="USD", maturity_date=None,
                interest_rate=Decimal("0.050000"), partition_date=D0, _ingestion_ts=ts(1))
    data = [tuple({**base, **r}[f.name] for f in RAW_POSITIONS_SCHEMA.fields) for r in rows]
    return spark.createDataFrame(data, RAW_POSITIONS_SCHEMA)


def market(spark, rows):
    base = dict(instrument_id="INS1", as_of_date=D0, close_price=Decimal("100.000000"),
                bid_price=Decimal("99.950000"), ask_price=Decimal("100.050000"), volume=2_000_000,
                yield_rate=Decimal("0.036500"), spread_bps=Decimal("5.00"), partition_date=D0, _ingestion_ts=ts(1))
    data = [tuple({**base, **r}[f.name] for f in RAW_MARKET_SCHEMA.fields) for r in rows]
    return spark.createDataFrame(data, RAW_MARKET_SCHEMA)


def book(spark, loans=(), deposits=()):
    from liqspark.operators.positions import unify_positions
    from liqspark.operators.staging import stage_positions

    return unify_positions(stage_positions(positions(spark, loans or [{}])).limit(len(loans)),
                           stage_positions(positions(spark, deposits or [{}])).limit(len(deposits)))
