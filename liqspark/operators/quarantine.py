"""Raw rows with malformed values, kept apart with the value, its column, the
reason and the file.

The staging models cast with ``try_cast``, so a malformed value becomes null
and nothing says that there was one. :func:`typed_with_issues` finds such
values in the same projection as the cast, and :func:`ingest_checked` writes
rows with and without them in one pass, as two branches of one table. Every
input row is in exactly one branch.
"""

from __future__ import annotations

import datetime as dt
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BRANCH, INGESTION_TS, ISSUES, KEPT, PARTITION_DATE, QUARANTINED
from ..sources import sinks

BRANCHES = (PARTITION_DATE, BRANCH)
FILE = "_file"
UNREADABLE = "_unreadable"  # the text of a record that its format couldn't split into columns
TEXT_FORMATS = ("csv", "json")


def read_text_feed(spark: SparkSession, source: str, fmt: str = "csv", columns: Sequence[str] | None = None) -> DataFrame:
    """A feed with every column as text, ``_file`` and, for text formats,
    ``_unreadable``. JSON needs the names of its ``columns``; CSV takes them
    from its header, other formats from their schema."""
    if fmt not in TEXT_FORMATS:
        df = spark.read.format(fmt).load(source)
        return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns],
                         F.col("_metadata.file_path").alias(FILE))
    read = spark.read.format(fmt).option("header", True)
    names = list(columns or read.load(source).columns)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, UNREADABLE]])
    df = read.schema(schema).option("columnNameOfCorruptRecord", UNREADABLE).load(source)
    return df.select(*names, UNREADABLE, F.col("_metadata.file_path").alias(FILE))


def _reason(text: Column, dtype: T.DataType) -> Column:
    """Why a text that isn't null is no value of the type."""
    if isinstance(dtype, T.NumericType):
        number = text.try_cast("double")
        what = F.when(number.isNull() | F.isnan(number), "not_a_number").otherwise("does_not_fit")
    else:
        what = F.lit(f"not_a_{dtype.typeName()}")
    return F.when(F.trim(text) == "", "blank").otherwise(what)


def _issue(name: str, dtype: T.DataType, required: bool) -> Column:
    """(column, value, reason) of a malformed value, else null."""
    text = F.col(name).cast("string")
    bad = F.when(text.isNotNull() & F.col(name).try_cast(dtype).isNull(), _reason(text, dtype))
    if required:
        bad = F.when(text.isNull(), "missing").otherwise(bad)
    return F.when(bad.isNotNull(), F.struct(F.lit(name).alias("column_name"), text.alias("value"), bad.alias("reason")))


def typed_with_issues(raw: DataFrame, columns: Mapping[str, T.DataType], required: Sequence[str] = ()) -> DataFrame:
    """The declared columns by ``try_cast``, ``_issues`` (an array of column,
    value and reason, empty for a clean row) and ``_file`` (null if ``raw`` has
    none). A null is an issue only in a ``required`` column; a record that its
    format couldn't read is one issue, ``unreadable_row``. Rows are neither
    dropped nor merged; other columns of ``raw`` are left out."""
    found = [_issue(c, t, c in required) for c, t in columns.items()]
    if UNREADABLE in raw.columns:
        line = F.col(UNREADABLE)
        whole = F.when(line.isNotNull(), F.struct(F.lit(None).cast("string").alias("column_name"), line.alias("value"),
                                                  F.lit("unreadable_row").alias("reason")))
        found = [whole, *[F.when(line.isNull(), issue) for issue in found]]
    return raw.select(*[F.col(c).try_cast(t).alias(c) for c, t in columns.items()],
                      F.filter(F.array(*found), lambda x: x.isNotNull()).alias(ISSUES),
                      (F.col(FILE) if FILE in raw.columns else F.lit(None).cast("string")).alias(FILE))


def branched(typed: DataFrame) -> DataFrame:
    return typed.withColumn(BRANCH, F.when(F.size(ISSUES) == 0, KEPT).otherwise(QUARANTINED))


def store_branches(typed: DataFrame, path: str) -> None:
    """Rows of many dates, written once; both branches of a date that has rows
    in ``typed`` should be absent or come with it."""
    sinks.write_partitioned(branched(typed), path, BRANCHES)


def ingest_checked(spark: SparkSession, source: str | DataFrame, as_of: dt.date, schema: T.StructType, target: str,
                   fmt: str = "csv", required: Sequence[str] = (), source_system: str | None = None) -> DataFrame:
    """Load one day's text feed: clean rows into the day's ``kept`` branch, rows
    with a malformed value into its ``quarantine`` branch, in one pass over the
    feed and one write. A re-run replaces both. Returns the day's kept rows."""
    columns = {f.name: f.dataType for f in schema.fields if f.name not in (PARTITION_DATE, INGESTION_TS)}
    raw = source if isinstance(source, DataFrame) else read_text_feed(spark, source, fmt, list(columns) if fmt == "json" else None)
    typed = typed_with_issues(raw, columns, required)
    day = typed.select("*", F.current_timestamp().alias(INGESTION_TS), F.lit(as_of).alias(PARTITION_DATE))
    if source_system is not None:
        day = day.withColumn("source_system", F.lit(source_system))
    sinks.replace_day(branched(day), target, as_of, BRANCHES)
    return kept_rows(spark, target).where(F.col(PARTITION_DATE) == F.lit(as_of))


def kept_rows(spark: SparkSession, path: str) -> DataFrame:
    """The clean rows of a table of branches; only their folders are read."""
    return sinks.read_table(spark, path).where(F.col(BRANCH) == KEPT).drop(BRANCH, ISSUES, FILE)


def quarantined_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows with a malformed value, with all they had that could be cast."""
    return sinks.read_table(spark, path).where(F.col(BRANCH) == QUARANTINED).drop(BRANCH)


def quarantined_values(spark: SparkSession, path: str) -> DataFrame:
    """One row per malformed value: date, file, column, value and reason."""
    return quarantined_rows(spark, path).select(PARTITION_DATE, F.col(FILE).alias("file"), F.inline(ISSUES))
