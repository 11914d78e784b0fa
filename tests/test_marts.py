import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import D0, book, market
from liqspark.operators import cashflow as cf
from liqspark.operators import checks as ck
from liqspark.operators import regulatory as reg
from liqspark.operators import risk as rk
from liqspark.operators.staging import stage_market_data
from liqspark.sources import seeds, sinks


def test_risk_without_market_data_is_low_and_999(spark):
    b = book(spark, loans=[dict(instrument_id="INS13")])
    m = stage_market_data(market(spark, [{}]))
    r = rk.liquidity_risk(b, m).collect()[0]
    assert r.liquidity_tier == "LOW" and r.est_days_to_liquidate == 999 and r.market_value is None


def test_risk_tier_days_and_value(spark):
    b = book(spark, loans=[dict(position_qty=Decimal("-250000"))])
    m = stage_market_data(market(spark, [{}]))
    r = rk.liquidity_risk(b, m).collect()[0]
    assert r.liquidity_tier == "HIGH"
    assert int(r.est_days_to_liquidate) == 2  # 250000 / (2e6 * 0.1) = 1.25 -> 2
    assert r.market_value == Decimal("-25000000")


def test_two_as_of_dates_in_one_partition_fan_out(spark):
    b = book(spark, loans=[{}])
    m = stage_market_data(market(spark, [{}, dict(as_of_date=dt.date(2024, 3, 28))]))
    assert rk.liquidity_risk(b, m).count() == 2


def test_long_and_hedge_share_risk_key_and_upsert_refuses(spark, tmp_dir):
    b = book(spark, loans=[dict(position_type="LONG"), dict(position_type="HEDGE")])
    r = rk.liquidity_risk(b, stage_market_data(market(spark, [{}])))
    assert ck.unique(r, "risk_record_id").count() == 1
    with pytest.raises(ValueError):
        sinks.upsert(spark, r, tmp_dir + "/risk", ["risk_record_id"])


def test_cashflow_thirty_days_and_running_sum(spark):
    b = book(spark, loans=[dict(position_qty=Decimal("-1"), notional_value=Decimal("1000000.00"))])
    m = stage_market_data(market(spark, [{}]))
    rows = cf.cashflow_forecast(b, m).orderBy("forecast_date").collect()
    assert len(rows) == 30
    assert rows[0].forecast_date == D0 and rows[-1].forecast_date == D0 + dt.timedelta(days=29)
    # coupon = 1e6 * 0.0365 / 365 = 100; margin = 1e6 * 0.001 = 1000
    assert rows[0].projected_inflow == Decimal("100.00") and rows[0].projected_outflow == Decimal("1000.00")
    assert rows[-1].cumulative_cashflow == 30 * rows[0].net_cashflow == Decimal("-27000.00")


def test_lcr_no_net_outflow_is_999_and_compliant(spark):
    b = book(spark, loans=[{}])
    cfs = cf.cashflow_forecast(b, stage_market_data(market(spark, [{}])))
    r = reg.lcr(b, cfs, seeds.load_seed(spark, "seed_hqla_classification")).collect()[0]
    assert float(r.lcr_pct) == 999.99 and r.is_lcr_compliant is True


def test_lcr_level2_cap(spark):
    # L1 = 60 (CASH, 0% haircut); 2A = 200 less the 15% AGENCY_BOND haircut = 170; the cap keeps 40
    b = book(spark, loans=[dict(instrument_id="INS1", notional_value=Decimal("60.00")),
                           dict(instrument_id="INS2", notional_value=Decimal("200.00"))])
    classify = lambda _df: F.when(F.col("instrument_id") == "INS1", "CASH").otherwise("AGENCY_BOND")  # noqa
    empty_cf = cf.cashflow_forecast(b, stage_market_data(market(spark, [{}]))).limit(0)
    r = reg.lcr(b, empty_cf, seeds.load_seed(spark, "seed_hqla_classification"), classify).collect()[0]
    assert r.hqla_level_1 == Decimal("60.00") and r.hqla_level_2a == Decimal("170.00")
    assert r.total_hqla == 100.0  # 60 + min(170, 60 * 0.4 / 0.6 = 40)


def test_nsfr_wildcard_and_default_factor(spark):
    b = book(spark, loans=[dict(maturity_date=D0 + dt.timedelta(days=400))],
             deposits=[dict(instrument_id="INS9", position_type="LONG")])
    r = reg.nsfr(b, seeds.load_seed(spark, "seed_nsfr_factors")).collect()[0]
    assert r.asf_retail_deposits == Decimal("950.00")  # stable retail deposit, ANY, 95%
    assert r.rsf_loans == Decimal("650.00")  # LOAN_RETAIL GTE_1Y 65%
    b2 = book(spark, loans=[dict(maturity_date=D0 + dt.timedelta(days=10))])
    r2 = reg.nsfr(b2, seeds.load_seed(spark, "seed_nsfr_factors")).collect()[0]
    assert r2.rsf_loans == Decimal("500.00")  # LT_6M has no factor row: default 50%
    assert float(r2.nsfr_pct) == 0.0 and r2.is_nsfr_compliant is False


def test_outflows_lookup_misses_default_to_full_run_off(spark):
    mapping = seeds.load_seed(spark, "seed_fr2052a_product_mapping")
    b = book(spark, deposits=[dict(position_type="SHORT", maturity_date=D0 + dt.timedelta(days=5)),
                              dict(instrument_id="INS2", position_type="LONG", notional_value=Decimal("100.00"))])
    rows = {r.maturity_bucket: r for r in reg.fr2052a_outflows(b, mapping).collect()}
    assert rows["LT_30D"].product_code == "O.U.1" and rows["LT_30D"].run_off_rate_pct == 40
    assert rows["OPEN"].product_code is None and rows["OPEN"].run_off_rate_pct == 100
    assert rows["OPEN"].maturity_bucket_order == 1


def test_outflows_null_position_type_drops_out(spark):
    mapping = seeds.load_seed(spark, "seed_fr2052a_product_mapping")
    b = book(spark, deposits=[dict(position_type=None)])
    assert reg.fr2052a_outflows(b, mapping).count() == 0


def test_inflows_interest_and_rate(spark):
    mapping = seeds.load_seed(spark, "seed_fr2052a_product_mapping")
    b = book(spark, loans=[dict(notional_value=Decimal("365000.00"), interest_rate=Decimal("0.100000"),
                                maturity_date=D0 + dt.timedelta(days=3))])
    r = reg.fr2052a_inflows(b, mapping).collect()[0]
    assert r.product_code == "I.R.1" and r.inflow_rate_pct == 50
    assert r.expected_inflow_amount == Decimal("184000.00")  # (365000 + 3000) * 50%


def test_supplemental_items_and_zero_drop(spark):
    b = book(spark, loans=[dict(position_type="HEDGE"), dict(instrument_id="INS2", position_type="SHORT",
                                                           notional_value=Decimal("-200.00"))])
    r = rk.liquidity_risk(b, stage_market_data(market(spark, [dict(instrument_id="INS9")])))
    items = {x.item_code: x for x in reg.fr2052a_supplemental(b, r).collect()}
    assert set(items) == {"S.E.1", "S.O.1"}  # S.L.1 is null (no market data), S.H.1 never
    assert items["S.O.1"].reported_amount == Decimal("200.00") and items["S.O.1"].net_amount == Decimal("10.00")
    assert items["S.E.1"].haircut_amount == Decimal("1000.00") and items["S.E.1"].net_amount == 0
