"""Unified position book: loans and deposits tagged by source system."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import surrogate_key
from ..schemas import DEPOSITS, LOANS, PARTITION_DATE, POSITION_COLUMNS

BOOK_KEY = ["portfolio_id", "instrument_id", "position_type", "source_system", PARTITION_DATE]
BOOK_COLUMNS = ["position_id", *POSITION_COLUMNS, "source_system", PARTITION_DATE]


def unify_positions(loans: DataFrame, deposits: DataFrame) -> DataFrame:
    """Union all of both feeds, re-keyed with ``source_system`` in the key.

    A plain union: no shuffle; the book is written partitioned by
    (partition_date, source_system) so readers prune by either.
    """
    cols = [*POSITION_COLUMNS, PARTITION_DATE]
    tagged = [
        df.select(*cols, F.lit(tag).alias("source_system"))
        for df, tag in ((loans, LOANS), (deposits, DEPOSITS))
    ]
    unioned = tagged[0].unionByName(tagged[1])
    return unioned.select(surrogate_key(*BOOK_KEY).alias("position_id"), *POSITION_COLUMNS,
                          "source_system", PARTITION_DATE)
