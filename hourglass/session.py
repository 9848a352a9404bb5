"""Session helpers: one place for the configuration the operators rely on.

The operators never read a machine-local folder on their own. Everything that
must survive the loss of an executor (dictionaries, the run log, CSV round trips)
is written below the shared folder named by ``spark.checkpoint.dir``. That
setting is read from the session; a private folder is created only for local
sessions (tests, benches) where it is unset.
"""

from __future__ import annotations

import gc
import math
import os
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings applied when this package builds the session itself. A cluster
# deployment passes its own values through spark-submit; these are defaults.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A single user or game may hold a third of all rows: let AQE split the
    # hot partition of a sort-merge join instead of running one huge task.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # remove checkpoint files once the DataFrames that use them are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def scale_conf(shuffle_bytes: int, cores: int, partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition sizing for a cluster run, from the expected bytes of the
    largest shuffle (after filters and column pruning, not the raw input).

    Shuffle partitions start at one per ``partition_bytes`` of shuffle data
    (at least two per core, at most 50k map-side blocks per map task) and AQE
    coalesces small ones back to ``partition_bytes / 2``; scan splits are
    ``partition_bytes``. Each task then holds a few hundred MB, which fits
    executor memory without spilling on typical 4-8 GB per-core executors.
    """
    parts = max(2 * cores, min(50_000, math.ceil(shuffle_bytes / partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }


def get_session(
    master: str | None = None,
    app_name: str = "hourglass",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    expected_shuffle_bytes: int | None = None,
    cores: int | None = None,
) -> SparkSession:
    """Build (or get) the session with the package defaults. With
    ``expected_shuffle_bytes`` and ``cores`` the partition sizes come from
    ``scale_conf``; explicit ``shuffle_partitions`` / ``extra_conf`` win."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if expected_shuffle_bytes and cores:
        conf.update(scale_conf(expected_shuffle_bytes, cores))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def _context(spark: SparkSession):
    """The SparkContext, or None for a Spark Connect session (which has none;
    its server owns the checkpoint folder)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    Order: the context's own folder, then ``spark.checkpoint.dir`` from the
    session conf. Only a local session without either gets a fresh folder
    under the system temp dir; a cluster session without one is an error,
    because a machine-local folder is not visible to the other executors.
    """
    sc = _context(spark)
    if sc is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set on the Spark Connect server")
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not configured:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) before running hourglass operators on a cluster"
            )
        configured = tempfile.mkdtemp(prefix="hourglass-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for tables this package writes."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "hourglass", *parts])


def stable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    Used where a later step must see exactly the same rows and partition
    layout as an earlier one (e.g. ids derived from partition positions), and
    where a lost executor must not force a non-deterministic recomputation.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stable_table(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` as a Parquet table below the shared checkpoint folder and
    read it back: lineage cut like ``stable``, but columnar and compressed,
    with column pruning, pushed filters and (via ``partition_by``) folder
    pruning for every later reader. Used for the large intermediate tables.
    """
    path = scratch_path(df.sparkSession, "tables", f"{name}-{uuid.uuid4().hex}")
    writer = df.write.mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path).select(*df.columns)


def sweep(spark: SparkSession) -> None:
    """Have Spark delete what no DataFrame or model refers to any more: shuffle
    files, cached blocks, broadcasts, RDD checkpoints. Its cleaner learns of
    them from the driver's garbage collector only, which by itself may not run
    for as long as the driver has memory left, while the executors' disks fill.
    """
    gc.collect()  # Python's references to JVM objects, where they lie in cycles
    # py4j passes on what Python has dropped from a queue, about once a second
    dropped = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", ())
    until = time.monotonic() + 3
    while dropped and time.monotonic() < until:
        time.sleep(0.05)
    spark.sparkContext._jvm.System.gc()


def default_parallelism(spark: SparkSession) -> int:
    try:
        return max(1, int(spark.sparkContext.defaultParallelism))
    except Exception:  # pragma: no cover - connect sessions
        return max(1, os.cpu_count() or 1)
