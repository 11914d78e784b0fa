"""Sinks: partitioned writes, keyed upsert, column sync, compaction and raw
ingestion, on path-based Parquet tables.

Re-runs are safe: a full write replaces only the partitions present in the new
data (dynamic partition overwrite). Jobs that change a table they read (merge,
day replacement, compaction) write once into a hidden folder of the table, note
what it replaces in a ``_swap`` file, and then rename; so a lost executor never
re-reads half-rewritten files, and a job that died between two renames is
finished by the next writer. Readers may meet a partition between the removal of
its old files and the rename of its new ones.

Each table keeps its schema in a ``_table_schema`` file beside the data. Every
write replaces it with the columns written (columns are synced to the latest
run), and every read uses it, so columns added later are read, a table whose
first write was empty is readable, and no file footer decides the columns.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BRANCH, INGESTION_TS, ISSUES, KEPT, PARTITION_DATE
from ..session import ensure_checkpoint_dir

SCHEMA_FILE = "_table_schema"
STREAM_LOG = "_spark_metadata"
BUCKETS_FILE = "_buckets"
MAX_BUCKET_SHARE = 4  # times the mean; with a larger bucket, joins are left to an exchange
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"  # fixed value: folder of rows without a partition value
SWAP_FILE, STAGING = "_swap", "_staging-"
# Values of the first partition column a merge may turn into a static filter.
MAX_STATIC_VALUES = 4_000
FILE_BYTES = 128 << 20


def _hadoop(spark: SparkSession, path: str):
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hpath, fs = _hadoop(spark, path)
    return fs.exists(hpath)


def table_exists(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path)


def refuse_stream_table(spark: SparkSession, path: str) -> None:
    """Readers of a table written by a stream see only the files of the
    stream's log: a batch write there would be invisible."""
    if path_exists(spark, f"{path}/{STREAM_LOG}"):
        raise ValueError(f"{path} is written by a stream; batch writes there would not be read")
    if path_exists(spark, f"{path}/{BUCKETS_FILE}"):
        raise ValueError(f"{path} is bucketed; only write_bucketed keeps its files in their buckets")


def _read_text(spark: SparkSession, path: str) -> str | None:
    hpath, fs = _hadoop(spark, path)
    if not fs.exists(hpath):
        return None
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    hpath, fs = _hadoop(spark, path)
    out = fs.create(hpath, True)
    out.write(bytearray(text.encode()))
    out.close()


def write_note(spark: SparkSession, path: str) -> None:
    """An empty file, whose presence says something."""
    _write_text(spark, path, "")


def table_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema kept with the table, or None if no writer of this module made it."""
    text = _read_text(spark, f"{path}/{SCHEMA_FILE}")
    return None if text is None else T.StructType.fromJson(json.loads(text))


def _keep_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    if table_schema(spark, path) != nullable:
        _write_text(spark, f"{path}/{SCHEMA_FILE}", nullable.json())


# Aggregates taken of the rows while they are written: (observation, aggregates).
Observed = tuple[Observation, Sequence[Column]]


def _arranged(df: DataFrame, partition_by: Sequence[str], observed: Observed | None) -> DataFrame:
    """``df`` clustered for its write. Aggregates are observed behind the
    shuffle, in the writing tasks, where a repeated task counts once."""
    out = df.hint("rebalance", *partition_by)
    return out.observe(observed[0], *observed[1]) if observed and observed[1] else out


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str] = (PARTITION_DATE,),
                      observed: Observed | None = None) -> None:
    """Write ``df`` replacing only the partitions it contains.

    The rebalance hint lets AQE cluster rows by the partition columns into
    advisory-size tasks (small dates coalesced, large dates split), so each
    partition gets a few right-sized files instead of one file per task, and
    no day is funnelled through a single task.
    """
    refuse_stream_table(df.sparkSession, path)
    finish_swap(df.sparkSession, path)
    (_arranged(df, partition_by, observed)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
    _keep_schema(df.sparkSession, path, df.schema)


def _bucket_spec(spark: SparkSession, path: str) -> dict:
    return json.loads(_read_text(spark, f"{path}/{BUCKETS_FILE}"))


def _create_bucketed(spark: SparkSession, name: str, folder: str, spec: dict, schema: T.StructType) -> None:
    quoted = lambda names: ", ".join(f"`{n}`" for n in names)
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = folder.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet PARTITIONED BY ({quoted(spec['partition_by'])}) "
              f"CLUSTERED BY ({quoted(spec['bucket_by'])}) INTO {int(spec['buckets'])} BUCKETS LOCATION '{place}'")


def _bucket_table(spark: SparkSession, path: str) -> str:
    """The catalog's name for a bucketed folder, entered if this session's
    catalog doesn't have it; only a catalog table can say how files are bucketed."""
    name = f"bucketed_{hashlib.sha1(path.encode()).hexdigest()[:16]}"
    if not spark.catalog.tableExists(name):
        _create_bucketed(spark, name, path, _bucket_spec(spark, path), table_schema(spark, path))
    spark.catalog.recoverPartitions(name)
    spark.catalog.refreshTable(name)
    return name


def write_bucketed(df: DataFrame, path: str, bucket_by: Sequence[str], buckets: int,
                   partition_by: Sequence[str] = (PARTITION_DATE,), observed: Observed | None = None) -> None:
    """Write ``df`` replacing only the partitions it contains, each in
    ``buckets`` files by a hash of ``bucket_by``: tables bucketed alike on a
    part of their join key are joined without an exchange.

    Rows are clustered by partition and bucket first, so a bucket is one file a
    partition, or a few where AQE splits a large one. Columns, bucketing and
    partitioning of a table stay as they were first written, and a folder of
    unbucketed files is refused. Null keys are a bucket like any other. The
    files are written once, beside the table, and then swapped in.
    """
    spark = df.sparkSession
    spec = {"bucket_by": list(bucket_by), "buckets": buckets, "partition_by": list(partition_by)}
    old = _read_text(spark, f"{path}/{BUCKETS_FILE}")
    ordered = df.select(*[c for c in df.columns if c not in partition_by], *partition_by)
    if old is None:
        if _partitions(spark, path, 1):
            raise ValueError(f"{path} holds files without buckets")
        _keep_schema(spark, path, ordered.schema)
        _write_text(spark, f"{path}/{BUCKETS_FILE}", json.dumps(spec))
    elif json.loads(old) != spec or [(f.name, f.dataType) for f in table_schema(spark, path)] != [
            (f.name, f.dataType) for f in ordered.schema]:
        raise ValueError(f"{path} was written with other buckets, partitions or columns")
    finish_swap(spark, path)
    staging = f"{STAGING}{uuid.uuid4().hex}"
    part = f"bucketed_{uuid.uuid4().hex}"
    _create_bucketed(spark, part, f"{path}/{staging}", spec, ordered.schema)
    bucket = F.pmod(F.hash(*bucket_by), F.lit(buckets))  # the hash that Spark's bucketed files use
    try:
        (_arranged(ordered.withColumn("_bucket", bucket), [*partition_by, "_bucket"], observed).drop("_bucket")
         .write.insertInto(part))
    finally:
        spark.sql(f"DROP TABLE {part}")  # its files stay
    swap(spark, path, staging, _partitions(spark, f"{path}/{staging}", len(partition_by)), [])


def bucket_bytes(spark: SparkSession, path: str) -> dict[int, int]:
    """Bytes of each bucket over all partitions, from the files' names and sizes."""
    depth, sizes = len(_bucket_spec(spark, path)["partition_by"]), {}
    for folder in _partitions(spark, path, depth):
        for name, size in data_files(spark, f"{path}/{folder}"):
            bucket = int(re.search(r"_(\d+)(?:\.[^_]*)?$", name).group(1))
            sizes[bucket] = sizes.get(bucket, 0) + size
    return sizes


def read_bucketed(spark: SparkSession, path: str, max_share: float = MAX_BUCKET_SHARE) -> DataFrame:
    """A bucketed table. A task of its join reads a whole bucket, which AQE
    can't split; so if one holds over ``max_share`` times the mean (a hot key)
    the files are read as they are, and joins exchange rows and split the hot
    key. The rows are the same."""
    sizes, buckets = bucket_bytes(spark, path), _bucket_spec(spark, path)["buckets"]
    if sizes and max(sizes.values()) > max_share * sum(sizes.values()) / buckets:
        return read_table(spark, path)
    return spark.table(_bucket_table(spark, path))


def _partitions(spark: SparkSession, root: str, depth: int, below: str = "") -> list[str]:
    """Partition folders ``depth`` levels below ``root``, as relative paths."""
    folder, fs = _hadoop(spark, f"{root}/{below}" if below else root)
    if not fs.exists(folder):
        return []
    if not depth:
        return [below]
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    return sorted(p for n in names if "=" in n and n[0] not in "_."
                  for p in _partitions(spark, root, depth - 1, f"{below}/{n}" if below else n))


def data_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """(name, bytes) of the data files in one folder."""
    hpath, fs = _hadoop(spark, folder)
    return sorted((s.getPath().getName(), s.getLen()) for s in fs.listStatus(hpath)
                  if s.isFile() and s.getPath().getName()[0] not in "_.")


def swap(spark: SparkSession, path: str, staging: str, add: Sequence[str], remove: Sequence[str]) -> None:
    """Make folders or files ``add`` of the staging folder part of the table,
    each in place of what has its name, and delete ``remove`` (relative paths).
    The plan is stored first, so it is finished even if this process dies."""
    tmp, fs = _hadoop(spark, f"{path}/{SWAP_FILE}.{uuid.uuid4().hex}")
    _write_text(spark, tmp.toString(), json.dumps({"staging": staging, "add": list(add), "remove": list(remove)}))
    fs.rename(tmp, _hadoop(spark, f"{path}/{SWAP_FILE}")[0])
    finish_swap(spark, path)


def finish_swap(spark: SparkSession, path: str) -> None:
    """Carry out a stored replacement, from wherever it stopped; each step can
    be repeated. Every writer of a table begins with this."""
    text = _read_text(spark, f"{path}/{SWAP_FILE}")
    if text is None:
        return
    plan = json.loads(text)
    at = lambda rel: _hadoop(spark, f"{path}/{rel}")
    for rel in plan["remove"]:
        old, fs = at(rel)
        fs.delete(old, True)
    for rel in plan["add"]:
        new, fs = at(f"{plan['staging']}/{rel}")
        if fs.exists(new):  # else it was renamed before
            old = at(rel)[0]
            fs.delete(old, True)
            fs.mkdirs(old.getParent())
            if not fs.rename(new, old):
                raise OSError(f"could not rename {new} to {old}")
    for rel in (plan["staging"], SWAP_FILE):
        done, fs = at(rel)
        fs.delete(done, True)


def _stage(df: DataFrame, path: str, partition_by: Sequence[str], observed: Observed | None = None) -> str:
    """``df`` written as partitions in a hidden folder of the table; its name."""
    staging = f"{STAGING}{uuid.uuid4().hex}"
    _arranged(df, partition_by, observed).write.partitionBy(*partition_by).parquet(f"{path}/{staging}")
    return staging


def replace_day(df: DataFrame, path: str, as_of: dt.date, partition_by: Sequence[str] = (PARTITION_DATE,),
                observed: Observed | None = None) -> None:
    """Make ``df``, whose rows are all of ``as_of``, the table's rows of that
    date. Sub-partitions of the date that ``df`` no longer has, and with an
    empty ``df`` the whole date, go. The rows are computed and written once."""
    spark = df.sparkSession
    refuse_stream_table(spark, path)
    finish_swap(spark, path)
    staging, depth = _stage(df, path, partition_by, observed), len(partition_by)
    new = _partitions(spark, f"{path}/{staging}", depth)
    old = _partitions(spark, path, depth - 1, f"{partition_by[0]}={as_of.isoformat()}")
    swap(spark, path, staging, new, [p for p in old if p not in new])
    _keep_schema(spark, path, df.schema)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a stored table with ``schema``, or the schema kept with it: columns
    missing from older files read as null and columns no longer in the schema
    are skipped. Only a table of another writer is read by merging the schemas
    of its files."""
    schema = schema or table_schema(spark, path)
    if schema is None:
        return spark.read.option("mergeSchema", True).parquet(path)
    return spark.read.schema(schema).parquet(path)


def footer_frame(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table in a session of its own, where a count, or the least or
    greatest value of an integer, floating-point or date column, is answered by
    the files' footers (``PushedAggregation`` in the plan): no column is read.
    Such a frame can't be joined with frames of the caller's session."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.schema(schema or table_schema(spark, path) or read_table(spark, path).schema).parquet(path)


def stored_rows(spark: SparkSession, path: str, as_of: dt.date | None = None) -> int:
    """How many rows a table has, or one date of it, by its files' footers."""
    rows = footer_frame(spark, path)
    rows = rows if as_of is None else rows.where(F.col(PARTITION_DATE) == F.lit(as_of))
    return rows.agg(F.count(F.lit(1))).first()[0] or 0  # the pushed count of no files is null


def footer_facts(spark: SparkSession, path: str, columns: Sequence[str] = ()) -> dict:
    """``n_rows`` of a table, ``min_<c>`` and ``max_<c>`` of integer,
    floating-point or date columns, and ``max_partition``: the newest partition
    value, by its folder's name. No data is read, unless a file has no range of
    a column (all its values are null): those columns are then scanned."""
    ends = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    facts = {"n_rows": stored_rows(spark, path)}
    if ends:
        try:
            facts |= footer_frame(spark, path).agg(*ends).first().asDict()
        except Py4JJavaError as e:  # Spark's own error for it isn't one that PySpark converts
            if "No min/max found" not in str(e):
                raise
            facts |= read_table(spark, path).agg(*ends).first().asDict()
    return {**facts, "max_partition": next((v for v in reversed(partition_values(spark, path)) if v != NULL_PARTITION), None)}


def read_declared(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The declared columns of a raw table; raises if one is missing or has
    another type, before any model reads it. Of a table that sets malformed
    rows apart, only the kept rows are read."""
    df = read_table(spark, path)
    if {BRANCH, ISSUES} <= set(df.columns):
        df = df.where(F.col(BRANCH) == KEPT)
    have = {f.name: f.dataType for f in df.schema.fields}
    wrong = [f"{f.name}: {have[f.name].simpleString() if f.name in have else 'missing'}, declared {f.dataType.simpleString()}"
             for f in schema.fields if have.get(f.name) != f.dataType]
    if wrong:
        raise ValueError(f"{path} differs from its declaration: {'; '.join(wrong)}")
    return df.select(*schema.names)


def partition_values(spark: SparkSession, path: str, column: str = PARTITION_DATE) -> list[str]:
    """Values of a table's first partition column, from its folder names."""
    hpath, fs = _hadoop(spark, path)
    if not fs.exists(hpath):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def partition_dates(spark: SparkSession, path: str) -> DataFrame:
    """The partition dates of a table, one row each, without reading its files."""
    days = [d for d in partition_values(spark, path) if d != NULL_PARTITION]
    return spark.createDataFrame([(dt.date.fromisoformat(d),) for d in days], f"{PARTITION_DATE} date")


def sync_columns(target: DataFrame, src: DataFrame) -> DataFrame:
    """Target rows projected onto the source schema: new columns as nulls,
    removed columns dropped, types cast to the source's."""
    cols = []
    existing = set(target.columns)
    for f in src.schema.fields:
        c = F.col(f.name) if f.name in existing else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return target.select(*cols)


def duplicate_keys(src: DataFrame, key: Sequence[str]) -> DataFrame:
    return src.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def _touched_rows(spark: SparkSession, src: DataFrame, path: str, partition_by: Sequence[str]) -> DataFrame:
    """The table's rows in those partitions that ``src`` has rows of, read with
    the source's schema (the column sync happens in the reader)."""
    first = partition_by[0]
    target = read_table(spark, path, src.schema)
    # A few values (one date for a daily run) become a static filter, so only
    # those partitions are read; with more, the semi-join alone selects rows.
    values = [r[0] for r in src.select(first).distinct().limit(MAX_STATIC_VALUES + 1).collect()]
    if len(values) <= MAX_STATIC_VALUES:
        known = sorted(v for v in values if v is not None)
        touches = F.col(first).isin(known) if known else F.lit(False)
        target = target.where(touches | F.col(first).isNull() if None in values else touches)
    touched = src.select(*partition_by).distinct()
    return target.join(touched, _same(target, touched, partition_by), "left_semi")


def upsert(spark: SparkSession, src: DataFrame, path: str, key: Sequence[str],
           partition_by: Sequence[str] = (PARTITION_DATE,), observed: Observed | None = None) -> None:
    """Merge ``src`` into the table at ``path``: rows with a matching key are
    replaced, others inserted; only partitions present in ``src`` are
    rewritten. Keys must contain the partition columns or be unique per
    partition; null keys and null partition values match themselves. Raises
    on duplicate source keys (a merge cannot pick one). The source is
    evaluated once.
    """
    ensure_checkpoint_dir(spark)
    refuse_stream_table(spark, path)
    finish_swap(spark, path)
    src = src.checkpoint(eager=True)
    if not duplicate_keys(src, key).isEmpty():
        raise ValueError(f"source has duplicate keys on {list(key)}; merge is ambiguous")
    if not table_exists(spark, path):
        write_partitioned(src, path, partition_by, observed)
        return
    rows, keys = _touched_rows(spark, src, path, partition_by), src.select(*key)
    kept = rows.join(keys, _same(rows, keys, key), "left_anti")
    _replace_partitions(sync_columns(kept, src).unionByName(src), path, partition_by, observed)


def _replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], observed: Observed | None = None) -> None:
    spark = df.sparkSession
    staging = _stage(df, path, partition_by, observed)
    swap(spark, path, staging, _partitions(spark, f"{path}/{staging}", len(partition_by)), [])
    _keep_schema(spark, path, df.schema)


def merge_latest(spark: SparkSession, src: DataFrame, path: str, key: Sequence[str], order: Sequence[str],
                 partition_by: Sequence[str] = (PARTITION_DATE,)) -> None:
    """Merge ``src`` into the table so that of all rows of a key, stored or
    new, the first by ``order`` (descending, nulls last) stays. The outcome
    depends only on which rows were ever merged: a batch merged twice, late or
    out of turn changes nothing. Keys must contain the partition columns. Only
    partitions that ``src`` has rows of are read and rewritten."""
    ensure_checkpoint_dir(spark)
    refuse_stream_table(spark, path)
    finish_swap(spark, path)
    missing = [c for c in partition_by if c not in key]
    if missing:
        raise ValueError(f"partition columns {missing} are not part of the key {list(key)}")
    src = src.checkpoint(eager=True)
    rows = src
    if table_exists(spark, path):
        rows = sync_columns(_touched_rows(spark, src, path, partition_by), src).unionByName(src)
    first = F.row_number().over(Window.partitionBy(*key).orderBy(*[F.col(c).desc_nulls_last() for c in order]))
    latest = rows.withColumn("_first", first).where("_first = 1").drop("_first")
    _replace_partitions(latest, path, partition_by)


def merge_sql(target: str, source_view: str, key: Sequence[str], columns: Sequence[str]) -> str:
    """``MERGE INTO`` statement for a catalog table of a merge-capable format
    (Iceberg, Delta): update matched keys, insert the rest."""
    on = " AND ".join(f"t.`{k}` = s.`{k}`" for k in key)
    sets = ", ".join(f"t.`{c}` = s.`{c}`" for c in columns)
    cols = ", ".join(f"`{c}`" for c in columns)
    vals = ", ".join(f"s.`{c}`" for c in columns)
    return (f"MERGE INTO {target} t USING {source_view} s ON {on} "
            f"WHEN MATCHED THEN UPDATE SET {sets} WHEN NOT MATCHED THEN INSERT ({cols}) VALUES ({vals})")


def merge_into(spark: SparkSession, src: DataFrame, table: str, key: Sequence[str]) -> None:
    """Keyed merge into a catalog table whose format supports row-level
    MERGE (Iceberg / Delta on the classpath). Same contract as :func:`upsert`:
    duplicate source keys are refused."""
    if duplicate_keys(src, key).limit(1).count() > 0:
        raise ValueError(f"source has duplicate keys on {list(key)}; merge is ambiguous")
    view = f"_liqspark_merge_src_{abs(hash((table, tuple(key)))) % 10**8}"
    src.createOrReplaceTempView(view)
    try:
        spark.sql(merge_sql(table, view, key, src.columns))
    finally:
        spark.catalog.dropTempView(view)


def pack_files(files: Sequence[tuple[str, int]], file_bytes: int) -> list[list[str]]:
    """Bins of files to merge, each of at most ``file_bytes``: largest first,
    into the first bin with room. Files of that size or more, and those no
    other fits with, are in none."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted((f for f in files if f[1] < file_bytes), key=lambda f: (-f[1], f[0])):
        i = next((i for i, (full, _) in enumerate(bins) if full + size <= file_bytes), None)
        if i is None:
            bins.append((size, [name]))
        else:
            bins[i] = (bins[i][0] + size, [*bins[i][1], name])
    return [names for _, names in bins if len(names) > 1]


def compact_partition(spark: SparkSession, path: str, as_of: dt.date, target_files: int | None = None,
                      partition_by: Sequence[str] = (PARTITION_DATE,), file_bytes: int = FILE_BYTES) -> int:
    """Merge the small files of one date of a table; returns how many files
    were rewritten.

    In each sub-partition of the date (``partition_by`` is the table's full
    partitioning, date first) files are packed into bins of ``file_bytes``; the
    files of bins with more than one are rewritten into as many files as there
    are such bins, and all others stay as they are, so a second run rewrites
    none. With ``target_files`` a sub-partition with more files than that is
    rewritten into so many. All columns of the table's schema are kept.
    """
    refuse_stream_table(spark, path)
    finish_swap(spark, path)
    day = f"{partition_by[0]}={as_of.isoformat()}"
    staging, jobs = f"{STAGING}{uuid.uuid4().hex}", []
    for part in _partitions(spark, path, len(partition_by) - 1, day):
        files = data_files(spark, f"{path}/{part}")
        bins = pack_files(files, file_bytes)
        names, n = sorted(f for b in bins for f in b), len(bins)
        if target_files is not None:
            names, n = ([f for f, _ in files], target_files) if len(files) > target_files else ([], 0)
        if names:
            jobs.append((part, names, n))
    if not jobs:
        return 0
    schema = table_schema(spark, path) or read_table(spark, path).schema
    stored = T.StructType([f for f in schema.fields if f.name not in partition_by])

    def rewrite(part: str, names: list[str], n: int) -> None:
        # round-robin: a large sub-partition is spread over n tasks
        rows = spark.read.schema(stored).parquet(*[f"{path}/{part}/{f}" for f in names])
        rows.repartition(n).write.parquet(f"{path}/{staging}/{part}")

    with ThreadPoolExecutor(max_workers=8) as pool:  # sub-partitions of one date
        list(pool.map(lambda j: rewrite(*j), jobs))
    add = [f"{part}/{f}" for part, _, _ in jobs for f, _ in data_files(spark, f"{path}/{staging}/{part}")]
    swap(spark, path, staging, add, [f"{part}/{f}" for part, names, _ in jobs for f in names])
    return sum(len(names) for _, names, _ in jobs)


def ingest_raw(spark: SparkSession, source: str | DataFrame, as_of: dt.date, schema: T.StructType,
               target: str, fmt: str = "parquet", source_system: str | None = None) -> DataFrame:
    """Load one day's raw feed into the raw table: typed read, load stamp,
    run-date partition, optional source-system tag. Re-running replaces the
    day's partition, also by nothing. Returns the written day, read back lazily."""
    if isinstance(source, DataFrame):
        df = source
    else:
        # Self-describing formats keep their own types; text formats arrive as
        # strings. Either way the cast to the target type is a try_cast, so a
        # malformed value becomes null instead of failing the load.
        df = spark.read.format(fmt).option("header", True).load(source)
    cols = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields
            if f.name not in (PARTITION_DATE, INGESTION_TS)]
    out = df.select(*cols, F.current_timestamp().alias(INGESTION_TS), F.lit(as_of).alias(PARTITION_DATE))
    if source_system is not None:
        out = out.withColumn("source_system", F.lit(source_system))
    replace_day(out, target, as_of)
    return read_table(spark, target).where(F.col(PARTITION_DATE) == F.lit(as_of))
