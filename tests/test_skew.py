"""A third of all rows on one key: results stay whole and exact."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from helpers import market, positions
from liqspark.operators import risk as rk
from liqspark.operators.positions import unify_positions
from liqspark.operators.staging import stage_market_data, stage_positions


def test_hot_key_dedup_and_join(spark):
    n = 3000
    hot = [dict(_ingestion_ts=dt.datetime(2024, 3, 29, 0, 0) + dt.timedelta(seconds=i),
                position_qty=Decimal(i)) for i in range(n // 3)]  # one key, many versions
    cold = [dict(instrument_id=f"INS{i % 40}", portfolio_id=f"C{i}") for i in range(2 * n // 3)]
    raw = positions(spark, hot + cold).repartition(8)
    staged = stage_positions(raw)
    assert staged.count() == 1 + 2 * n // 3
    latest = staged.where(F.col("portfolio_id") == "PF1").where(F.col("instrument_id") == "INS1").collect()
    assert [r.position_qty for r in latest] == [Decimal(n // 3 - 1)]
    # hot instrument on the position side of the market join
    book = unify_positions(staged, staged.limit(0))
    m = stage_market_data(market(spark, [dict(instrument_id=f"INS{i}") for i in range(40)]))
    risk = rk.liquidity_risk(book, m)
    assert risk.count() == book.count()
    assert risk.where(F.col("close_price").isNull()).count() == 0


def test_runtime_conf_enables_skew_handling(spark):
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
