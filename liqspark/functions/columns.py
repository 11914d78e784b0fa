"""Column functions shared by the operators (all JVM-side expressions).

Decimal literals are built with :func:`dec` so arithmetic keeps the exact
decimal types a SQL literal such as ``0.1`` would have; a Python float would
turn the whole expression into a double.
"""

from __future__ import annotations

from decimal import Decimal
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def dec(text: str) -> Column:
    """Exact decimal literal (SQL ``0.75`` rather than double ``0.75``)."""
    return F.lit(Decimal(text))


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- classification -------------------------------------------------------

# Liquidity tier limits (volume, spread in bps).
HIGH_VOLUME, HIGH_MAX_SPREAD = 1_000_000, 10
MEDIUM_VOLUME, MEDIUM_MAX_SPREAD = 100_000, 50


def liquidity_tier(volume: str | Column = "volume", spread_bps: str | Column = "spread_bps") -> Column:
    """HIGH / MEDIUM / LOW by traded volume and bid-ask spread (nulls -> LOW)."""
    v, s = col_of(volume), col_of(spread_bps)
    return (
        F.when((v > HIGH_VOLUME) & (s < HIGH_MAX_SPREAD), F.lit("HIGH"))
        .when((v > MEDIUM_VOLUME) & (s < MEDIUM_MAX_SPREAD), F.lit("MEDIUM"))
        .otherwise(F.lit("LOW"))
    )


def days_to_liquidate(qty: str | Column = "position_qty", volume: str | Column = "volume") -> Column:
    """ceil(|qty| / (10% of daily volume)); 999 when there is no volume."""
    q, v = col_of(qty), col_of(volume)
    return F.when(v > 0, F.ceil(F.abs(q) / (v * dec("0.1")))).otherwise(F.lit(999))


# Maturity buckets as (upper bound in days exclusive, label).
FR2052A_BUCKETS = ((30, "LT_30D"), (60, "GTE_30D_LT_60D"), (90, "GTE_60D_LT_90D"))
FR2052A_OPEN, FR2052A_LAST = "OPEN", "GTE_90D"
FR2052A_BUCKET_ORDER = ("OPEN", "LT_30D", "GTE_30D_LT_60D", "GTE_60D_LT_90D", "GTE_90D")
NSFR_BUCKETS = ((180, "LT_6M"), (365, "GTE_6M_LT_1Y"))
NSFR_OPEN, NSFR_LAST = "ANY", "GTE_1Y"


def maturity_bucket(maturity: str | Column, as_of: str | Column,
                    edges: Sequence[tuple[int, str]] = FR2052A_BUCKETS,
                    null_label: str = FR2052A_OPEN, last_label: str = FR2052A_LAST) -> Column:
    """Label the days from ``as_of`` to ``maturity``; null maturity -> ``null_label``."""
    m = col_of(maturity)
    days = F.datediff(m, col_of(as_of))
    out = F.when(m.isNull(), F.lit(null_label))
    for limit, label in edges:
        out = out.when(days < limit, F.lit(label))
    return out.otherwise(F.lit(last_label))


def bucket_order(bucket: str | Column, order: Sequence[str] = FR2052A_BUCKET_ORDER) -> Column:
    """1-based filing position of a bucket label; null for unknown labels."""
    b = col_of(bucket)
    out = None
    for i, label in enumerate(order, start=1):
        out = F.when(b == label, F.lit(i)) if out is None else out.when(b == label, F.lit(i))
    return out


# --- ratios and statistics ------------------------------------------------

# Fixed value: reported ratio when the denominator is not positive.
NO_DENOMINATOR_PCT = "999.99"


def coverage_pct(num: Column, den: Column) -> Column:
    """round(num/den*100, 2) when den > 0, else 999.99."""
    return F.when(den > 0, F.round(num / den * 100, 2)).otherwise(dec(NO_DENOMINATOR_PCT))


def is_covered(num: Column, den: Column) -> Column:
    """True when den <= 0 or num/den >= 1 (evaluated on the unrounded ratio)."""
    return F.when(den <= 0, F.lit(True)).when(num / den >= dec("1.0"), F.lit(True)).otherwise(F.lit(False))


def zscore(value: Column, mean: Column, stddev: Column) -> Column:
    """(value - mean) / stddev; null when stddev is null or zero."""
    return F.when(stddev.isNull() | (stddev == 0), F.lit(None)).otherwise((value - mean) / stddev)


def is_business_day(date: str | Column) -> Column:
    """Monday..Friday (Spark ``dayofweek``: 1 = Sunday)."""
    return F.dayofweek(col_of(date)).between(2, 6)


def dims_json(cols: Sequence[str]) -> Column:
    """JSON object of the dimension values; ``{}`` without dimensions."""
    if not cols:
        return F.lit("{}")
    return F.to_json(F.struct(*[F.col(c) for c in cols]))


def cents_to_dollars(c: str | Column, precision: int = 2) -> Column:
    """round(cast(c as decimal(18,p)) / 100, p)."""
    return F.round(col_of(c).cast(f"decimal(18,{precision})") / 100, precision)


def with_audit(df, column: str):
    """Stamp the load / compute time (``current_timestamp``) on every row."""
    return df.withColumn(column, F.current_timestamp())
