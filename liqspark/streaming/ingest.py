"""Raw-feed ingestion as a Structured Streaming file source.

Daily feed drops land as files in a folder; an ``availableNow`` query picks
up exactly the files not yet seen (tracked in its checkpoint), types them,
stamps the load time and appends them to the raw table partitioned by date.
The file sink plus checkpoint make it exactly-once: a restarted or repeated
run never loads a file twice, and a lost executor only re-runs its batch.
The models then deduplicate by latest ``_ingestion_ts`` as usual.

:func:`start_feed_merge` keeps the raw table deduplicated instead: every batch
of files is merged by key, and the row with the latest ``_ingestion_ts`` stays,
whichever batch brought it. Files that come late, twice or in another order
leave the same table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..schemas import INGESTION_TS, PARTITION_DATE
from ..sources import sinks
from ..sources.sinks import STREAM_LOG, path_exists


def start_feed_ingest(spark: SparkSession, source_dir: str, source_schema: T.StructType,
                      target_schema: T.StructType, target: str, checkpoint: str, fmt: str = "parquet",
                      source_system: str | None = None, max_files_per_trigger: int | None = None
                      ) -> StreamingQuery:
    """Start an ``availableNow`` ingest of ``source_dir`` into ``target``.

    ``source_schema`` is the layout of the dropped files (streaming file
    sources need it up front); every target column is ``try_cast`` from it,
    so malformed values become null. The partition date comes from the data.
    A target that batch writes made is refused: the stream's log would hide
    its files from readers.
    """
    if path_exists(spark, target) and not path_exists(spark, f"{target}/{STREAM_LOG}") and not path_exists(spark, checkpoint):
        raise ValueError(f"{target} exists and isn't a stream's table")
    reader = spark.readStream.schema(source_schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir)
    cols = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in target_schema.fields
            if f.name != INGESTION_TS]
    out = stream.select(*cols, F.current_timestamp().alias(INGESTION_TS))
    if source_system is not None:
        out = out.withColumn("source_system", F.lit(source_system))
    return (out.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint)
            .partitionBy(PARTITION_DATE)
            .trigger(availableNow=True)
            .start(target))


def batch_merger(target: str, keys: Sequence[str], checkpoint: str) -> Callable[[DataFrame, int], None]:
    """The work of one micro-batch of :func:`start_feed_merge`. A batch whose
    number is noted in the checkpoint was merged before and is left out; one
    that died before its note is merged again, which changes nothing."""

    def merge(batch: DataFrame, number: int) -> None:
        spark, note = batch.sparkSession, f"{checkpoint}/merged/{number}"
        if path_exists(spark, note):
            return
        order = [INGESTION_TS] + [c for c in batch.columns if c not in keys and c != INGESTION_TS]
        sinks.merge_latest(spark, batch, target, keys, order)
        sinks.write_note(spark, note)

    return merge


def start_feed_merge(spark: SparkSession, source_dir: str, source_schema: T.StructType, target_schema: T.StructType,
                     keys: Sequence[str], target: str, checkpoint: str, fmt: str = "parquet",
                     source_system: str | None = None, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start an ``availableNow`` merge of ``source_dir`` into the table
    ``target``, by ``keys`` (with the partition date among them).

    The dropped files carry their own ``_ingestion_ts``: of all rows of a key
    the latest stays, and of several equally late ones the first by the other
    columns in descending order. ``target`` is a batch table: other
    writers of ``sinks`` may use it between runs.
    """
    if INGESTION_TS not in source_schema.names:
        raise ValueError(f"the files need {INGESTION_TS} to tell which row is the latest")
    reader = spark.readStream.schema(source_schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    out = reader.load(source_dir).select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in target_schema.fields])
    if source_system is not None:
        out = out.withColumn("source_system", F.lit(source_system))
    return (out.writeStream.foreachBatch(batch_merger(target, keys, checkpoint))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def merge_available(spark: SparkSession, *args, **kwargs) -> None:
    """Run :func:`start_feed_merge` to completion (all files now present)."""
    q = start_feed_merge(spark, *args, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def ingest_available(spark: SparkSession, *args, **kwargs) -> None:
    """Run :func:`start_feed_ingest` to completion (all files now present)."""
    q = start_feed_ingest(spark, *args, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
