"""Spark session defaults and the shared checkpoint folder.

Cluster runs pass their own session; these helpers only fill in settings that
are unset, so a cluster's configuration always wins.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: AQE re-plans joins from runtime sizes (the only
# place a non-seed side is ever broadcast), splits skewed join partitions and
# coalesces small shuffle partitions; UTC keeps dates stable across machines.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Runtime settings the operators rely on for skew and join sizing (Spark's
# defaults in 4.x); applied to a given session only where the cluster's
# configuration does not set them, so an explicit cluster value always wins.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # the size check behind every non-seed broadcast: a join side is
    # broadcast only when its measured (runtime) size is below this
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
}


def ensure_runtime_conf(spark: SparkSession) -> None:
    apply_conf(spark, RUNTIME_CONF)


def scale_conf(input_bytes: int, target_partition_bytes: int = 128 << 20,
               max_partitions: int | None = None) -> dict[str, str]:
    """Partition sizing for a job reading ``input_bytes``: scan splits and
    shuffle partitions of about ``target_partition_bytes`` (so a task's sort
    and aggregation buffers fit in executor memory and spill rarely), AQE
    starting from that count and coalescing small ones, and skew splitting
    for join partitions four times the target. At 100 TB this gives about
    800,000 initial shuffle partitions; a caller whose scheduler can't hold so
    many passes ``max_partitions`` and gets larger ones."""
    n = max(200, -(-input_bytes // target_partition_bytes))
    if max_partitions is not None:
        n = min(n, max_partitions)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> None:
    """Set runtime SQL settings that neither the cluster configuration nor the
    session has set."""
    explicit = {k for k, _ in spark.sparkContext.getConf().getAll()} | set(spark.conf.getAll)
    for key, value in conf.items():
        if key not in explicit:
            spark.conf.set(key, value)


def build_session(master: str = "local[*]", app: str = "liqspark",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests, bench and examples."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def co_partitioned(spark: SparkSession) -> SparkSession:
    """A session like ``spark`` in which a join whose inputs are stored in
    equal buckets of a part of its key needs no exchange. Spark asks for the
    whole key by default, since a part can be skewed; so only tables whose
    buckets were measured (``sinks.read_bucketed``) are read here."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return own


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process."""
    return re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master) is not None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is only read;
    without it this raises, since executors don't share the driver's folders.
    A local session (tests) gets a fresh scratch folder.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="liqspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return current
