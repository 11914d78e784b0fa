"""Surrogate keys: md5 over the natural-key parts joined by '-'."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# These must equal the widely used surrogate-key convention so
# that keys computed here match keys computed by the SQL models.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def _as_column(part: str | Column) -> Column:
    return F.col(part) if isinstance(part, str) else part


def surrogate_key(*parts: str | Column) -> Column:
    """md5 hex of the parts cast to string, nulls replaced by a fixed token.

    Parts may be column names or Column expressions. Every operand is non-null
    after the coalesce, so ``concat_ws`` and ``||`` agree.
    """
    pieces = [F.coalesce(_as_column(p).cast("string"), F.lit(NULL_TOKEN)) for p in parts]
    return F.md5(F.concat_ws(SEPARATOR, *pieces))
