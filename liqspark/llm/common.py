"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Letters that the contracts lower-case (ASCII only, whatever the locale).
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session's ``spark.checkpoint.dir``
    names it. Only a local session without that setting gets a scratch folder;
    a cluster session without it is an error, since executors could not see it.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, **options: str | int) -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, cut
    off from its lineage, and still there when executors are lost. ``options``
    are the Parquet writer's."""
    path = new_folder(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with ``value`` as column ``name``, computed in one place: no
    predicate or projection above copies the expression, as ``withColumn``
    would let the optimizer do."""
    return df.select("*", F.inline(F.array(F.struct(value.alias(name)))))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in views of a few rows, so what a task holds as Python
    objects at a time is small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def ascii_lower(text: Column | str) -> Column:
    return F.translate(text, UPPER, LOWER)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def vocabulary(name: str) -> str:
    """Path of an installed public vocabulary file (a parameter everywhere)."""
    import public_tokenizers

    return public_tokenizers.path(name)
