"""Session construction and shared scratch locations.

Scratch data (CSV round trips, checkpoints, saved models) always lives under the
directory named by ``spark.checkpoint.dir`` so that it is on shared storage on a
cluster. Where that setting is missing, a folder under the session's warehouse takes
its place. An application's scratch folder is deleted when its driver ends.
"""

from __future__ import annotations

import atexit
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # generated methods above HotSpot's 8000-byte JIT limit would run interpreted; fall back
    # to per-expression codegen instead (matters for wide CASE projections over survey codes)
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # small lookup checkpoints are deleted once their DataFrames are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "surveyspark", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE, skew-join handling and ANSI semantics on."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: int, executor_memory_gb: float = 16.0, executor_cores: int = 4,
               target_partition_mb: int = 256) -> dict:
    """Shuffle and scan sizing for a given input size (e.g. 100 TB on a large cluster).

    * scan splits of ``target_partition_mb`` (``maxPartitionBytes``);
    * an initial shuffle partition count that keeps each shuffle partition near the target
      size, which AQE then coalesces (``advisoryPartitionSizeInBytes``) or splits (skew join);
    * per-task memory = executor memory / cores must comfortably hold one partition's
      aggregation buffers, so the target shrinks when tasks get little memory.
    """
    per_task_mb = executor_memory_gb * 1024 * 0.6 / max(1, executor_cores)  # unified memory share
    part_mb = int(max(32, min(target_partition_mb, per_task_mb / 2)))
    parts = max(200, int(input_bytes // (part_mb << 20)) + 1)
    return {
        "spark.sql.files.maxPartitionBytes": f"{part_mb}m",
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{part_mb}m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{4 * part_mb}m",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, registering it with the context.

    Reads ``spark.checkpoint.dir`` from the session. Only where that is unset (as in tests) it is a folder
    under the session's warehouse, which is shared storage too, whatever the master.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0] if _is_generated(current) else current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def _is_generated(path: str) -> bool:
    # SparkContext appends a random UUID directory to the configured checkpoint root.
    tail = path.rstrip("/").rsplit("/", 1)[-1]
    try:
        uuid.UUID(tail)
        return True
    except ValueError:
        return False


_SCRATCH: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint root for intermediate tables/files."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/surveyspark-scratch/{spark.sparkContext.applicationId}"
    if root not in _SCRATCH:
        _SCRATCH.add(root)
        atexit.register(_drop_scratch, spark.sparkContext, root)
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def _drop_scratch(sc, root: str) -> None:
    """Delete an application's scratch folder through the Hadoop file system that holds it."""
    try:
        path = sc._gateway.jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(sc._gateway.jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
    except (Py4JError, OSError):  # the JVM has ended before
        pass


def reliable_checkpoint(df):
    """Materialise ``df`` under the shared checkpoint directory and cut its lineage.

    Unlike a local checkpoint, the files survive the loss of the executors that wrote them.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


BROADCAST_MAX_BYTES = 64 << 20


def row_bytes(df):
    """Bytes of a row as a Column: the fixed widths of its columns and its texts' lengths."""
    from pyspark.sql import functions as F

    texts = [f.name for f in df.schema.fields if f.dataType.typeName() in ("string", "binary")]
    nested = [f.name for f in df.schema.fields if f.dataType.typeName() in ("array", "map", "struct")]
    sizes = [F.coalesce(F.octet_length(c), F.lit(0)) for c in texts] + [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in nested]
    return sum(sizes, F.lit(16 * len(df.columns)))


def table_bytes(df) -> int:
    """Bytes of a small materialised table: the fixed widths of its columns times its rows, and its texts' lengths."""
    from pyspark.sql import functions as F

    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0))).first()[0]


def broadcast_if_small(df, max_bytes: int = BROADCAST_MAX_BYTES):
    """Broadcast hint behind a size check in bytes: ``df`` must be a small materialised table (e.g. a
    checkpoint). Larger tables keep a shuffled join, where AQE's skew handling applies."""
    from pyspark.sql import functions as F

    return F.broadcast(df) if table_bytes(df) <= max_bytes else df
