"""Reference tables (seeds): instrument master, HQLA classes, NSFR factors and
the FR 2052a product mapping.

They are a few dozen rows each, so joins broadcast them explicitly; the size
bound is the literal row lists below. A CSV with the same header can replace
any of them through ``load_seed(spark, name, path=...)``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_S = T.StringType()

SEED_SCHEMAS: dict[str, T.StructType] = {
    "instrument_reference": T.StructType([
        T.StructField("instrument_id", _S), T.StructField("instrument_name", _S),
        T.StructField("asset_class", _S), T.StructField("currency", _S),
        T.StructField("exchange", _S),
    ]),
    "seed_hqla_classification": T.StructType([
        T.StructField("instrument_type", _S), T.StructField("hqla_level", _S),
        T.StructField("haircut_pct", T.DecimalType(5, 2)), T.StructField("description", _S),
    ]),
    "seed_nsfr_factors": T.StructType([
        T.StructField("instrument_type", _S), T.StructField("maturity_bucket", _S),
        T.StructField("asf_factor_pct", T.LongType()), T.StructField("rsf_factor_pct", T.LongType()),
        T.StructField("description", _S),
    ]),
    "seed_fr2052a_product_mapping": T.StructType([
        T.StructField("product_category", _S), T.StructField("product_code", _S),
        T.StructField("schedule", _S), T.StructField("sub_schedule", _S),
        T.StructField("maturity_bucket", _S), T.StructField("run_off_rate_pct", T.LongType()),
        T.StructField("description", _S),
    ]),
}

# The four reference tables, row for row (public regulatory
# factors and instrument master data).
INSTRUMENT_REFERENCE = [
    ("AAPL", "Apple Inc.", "EQUITY", "USD", "NASDAQ"),
    ("MSFT", "Microsoft Corp.", "EQUITY", "USD", "NASDAQ"),
    ("GOOGL", "Alphabet Inc.", "EQUITY", "USD", "NASDAQ"),
    ("AMZN", "Amazon.com Inc.", "EQUITY", "USD", "NASDAQ"),
    ("US10Y", "US 10-Year Treasury", "FIXED_INCOME", "USD", "OTC"),
    ("US2Y", "US 2-Year Treasury", "FIXED_INCOME", "USD", "OTC"),
    ("EURUSD", "Euro/US Dollar", "FX", "USD", "OTC"),
    ("GBPUSD", "British Pound/US Dollar", "FX", "USD", "OTC"),
    ("SPX", "S&P 500 Index", "INDEX", "USD", "CBOE"),
    ("VIX", "VIX Volatility Index", "INDEX", "USD", "CBOE"),
]

HQLA_CLASSIFICATION = [
    ("CASH", "1", "0.00", "Cash and central bank reserves"),
    ("TREASURY_BOND", "1", "0.00", "Government bonds (0% risk weight)"),
    ("AGENCY_BOND", "2A", "15.00", "GSE and agency securities"),
    ("CORPORATE_BOND_AA", "2A", "15.00", "Investment grade corporate bonds (AA- or higher)"),
    ("CORPORATE_BOND_A", "2B", "50.00", "Investment grade corporate bonds (A+ to BBB-)"),
    ("COVERED_BOND", "2A", "15.00", "Covered bonds (AA- or higher)"),
    ("EQUITY_INDEX", "2B", "50.00", "Exchange-traded common equity (major index)"),
    ("RMBS", "2B", "25.00", "Residential mortgage-backed securities (AA or higher)"),
    ("OTHER", "NON_HQLA", "100.00", "Non-HQLA assets"),
    ("LOAN", "NON_HQLA", "100.00", "Loans and advances"),
    ("TERM_DEPOSIT", "NON_HQLA", "100.00", "Term deposits with other banks"),
    ("DEMAND_DEPOSIT", "NON_HQLA", "100.00", "Demand deposits (liability side)"),
]

NSFR_FACTORS = [
    ("RETAIL_DEPOSIT_STABLE", "ANY", 95, 0, "Stable retail deposits (insured)"),
    ("RETAIL_DEPOSIT_LESS_STABLE", "ANY", 90, 0, "Less stable retail deposits"),
    ("WHOLESALE_DEPOSIT_OPERATIONAL", "LT_6M", 50, 0, "Operational wholesale deposits (<6M)"),
    ("WHOLESALE_DEPOSIT_OPERATIONAL", "GTE_6M_LT_1Y", 50, 0, "Operational wholesale deposits (6M-1Y)"),
    ("WHOLESALE_DEPOSIT_OPERATIONAL", "GTE_1Y", 100, 0, "Operational wholesale deposits (>1Y)"),
    ("WHOLESALE_DEPOSIT_NON_OP", "LT_6M", 0, 0, "Non-operational wholesale deposits (<6M)"),
    ("WHOLESALE_DEPOSIT_NON_OP", "GTE_6M_LT_1Y", 50, 0, "Non-operational wholesale deposits (6M-1Y)"),
    ("WHOLESALE_DEPOSIT_NON_OP", "GTE_1Y", 100, 0, "Non-operational wholesale deposits (>1Y)"),
    ("REGULATORY_CAPITAL", "ANY", 100, 0, "Tier 1 and Tier 2 capital"),
    ("LONG_TERM_DEBT", "GTE_1Y", 100, 0, "Long-term debt (>1Y residual maturity)"),
    ("LOAN_RETAIL", "LT_1Y", 0, 50, "Retail loans (<1Y)"),
    ("LOAN_RETAIL", "GTE_1Y", 0, 65, "Retail loans (>1Y)"),
    ("LOAN_CORPORATE", "LT_1Y", 0, 50, "Corporate loans (<1Y)"),
    ("LOAN_CORPORATE", "GTE_1Y", 0, 65, "Corporate loans (>1Y)"),
    ("LOAN_RESIDENTIAL_MORTGAGE", "GTE_1Y", 0, 65, "Residential mortgages (>1Y)"),
    ("HQLA_LEVEL_1", "ANY", 0, 0, "HQLA Level 1 assets"),
    ("HQLA_LEVEL_2A", "ANY", 0, 15, "HQLA Level 2A assets"),
    ("HQLA_LEVEL_2B", "ANY", 0, 50, "HQLA Level 2B assets"),
    ("OTHER_ASSET", "LT_1Y", 0, 50, "Other assets (<1Y)"),
    ("OTHER_ASSET", "GTE_1Y", 0, 100, "Other assets (>1Y)"),
    ("UNENCUMBERED_EQUITY", "ANY", 0, 50, "Unencumbered listed equity"),
    ("OFF_BALANCE_SHEET", "ANY", 0, 5, "Irrevocable credit/liquidity facilities"),
]

FR2052A_PRODUCT_MAPPING = [
    ("RETAIL_STABLE", "I.A.1", "I", "A", "OPEN", 3, "Stable retail deposits - transactional"),
    ("RETAIL_STABLE", "I.A.2", "I", "A", "LT_30D", 3, "Stable retail deposits - non-transactional <30D"),
    ("RETAIL_LESS_STABLE", "I.A.3", "I", "A", "LT_30D", 10, "Less stable retail deposits <30D"),
    ("RETAIL_LESS_STABLE", "I.A.4", "I", "A", "GTE_30D", 10, "Less stable retail deposits >=30D"),
    ("WHOLESALE_OPERATIONAL", "O.O.1", "O", "O", "OPEN", 25, "Operational deposits - financial"),
    ("WHOLESALE_OPERATIONAL", "O.O.2", "O", "O", "LT_30D", 25, "Operational deposits - non-financial <30D"),
    ("WHOLESALE_NON_OP_UNSECURED", "O.U.1", "O", "U", "LT_30D", 40, "Unsecured wholesale non-operational <30D"),
    ("WHOLESALE_NON_OP_UNSECURED", "O.U.2", "O", "U", "GTE_30D", 20, "Unsecured wholesale non-operational >=30D"),
    ("SECURED_FUNDING_LEVEL_1", "O.S.1", "O", "S", "LT_30D", 0, "Secured by Level 1 HQLA <30D"),
    ("SECURED_FUNDING_LEVEL_2A", "O.S.2", "O", "S", "LT_30D", 15, "Secured by Level 2A HQLA <30D"),
    ("SECURED_FUNDING_LEVEL_2B", "O.S.3", "O", "S", "LT_30D", 25, "Secured by Level 2B HQLA <30D"),
    ("SECURED_FUNDING_OTHER", "O.S.4", "O", "S", "LT_30D", 100, "Secured by non-HQLA <30D"),
    ("CREDIT_FACILITY_RETAIL", "O.C.1", "O", "C", "UNDRAWN", 5, "Undrawn retail credit facilities"),
    ("CREDIT_FACILITY_CORP", "O.C.2", "O", "C", "UNDRAWN", 10, "Undrawn corporate credit facilities"),
    ("CREDIT_FACILITY_FIN", "O.C.3", "O", "C", "UNDRAWN", 100, "Undrawn financial institution credit"),
    ("LIQUIDITY_FACILITY", "O.L.1", "O", "L", "UNDRAWN", 100, "Undrawn liquidity facilities"),
    ("INFLOW_RETAIL_LOAN", "I.R.1", "I", "R", "LT_30D", 50, "Retail loan contractual inflows <30D"),
    ("INFLOW_WHOLESALE", "I.W.1", "I", "W", "LT_30D", 100, "Wholesale contractual inflows <30D"),
    ("INFLOW_SECURED", "I.S.1", "I", "S", "LT_30D", 0, "Secured lending maturing (Level 1) <30D"),
    ("INFLOW_SECURED", "I.S.2", "I", "S", "LT_30D", 15, "Secured lending maturing (Level 2A) <30D"),
    ("DERIVATIVES_COLLATERAL", "S.D.1", "S", "D", "ANY", 100, "Derivative collateral outflows"),
    ("DERIVATIVES_VALUATION", "S.D.2", "S", "D", "ANY", 0, "Derivative valuation changes"),
]

SEED_ROWS = {
    "instrument_reference": INSTRUMENT_REFERENCE,
    "seed_hqla_classification": [(a, b, Decimal(c), d) for a, b, c, d in HQLA_CLASSIFICATION],
    "seed_nsfr_factors": NSFR_FACTORS,
    "seed_fr2052a_product_mapping": FR2052A_PRODUCT_MAPPING,
}


def load_seed(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """Typed seed table; from a header CSV when ``path`` is given."""
    schema = SEED_SCHEMAS[name]
    if path is not None:
        return spark.read.schema(schema).option("header", True).csv(path)
    return spark.createDataFrame(SEED_ROWS[name], schema)
