"""Session and shared-scratch helpers.

Scratch output (round trips, intermediate tables that cut lineage) goes under the shared folder the
cluster names in ``spark.checkpoint.dir`` -- never a machine-local temp dir on a cluster.  Only a
local-mode session without that setting (tests, a laptop) gets a folder of our own; on any other
master the missing setting is an error.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_OWN_SCRATCH: dict[int, str] = {}
#: Spark removes the shuffle files of a finished execution instead of waiting for the driver's collector.
_SHUFFLE_CLEANUP = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def is_local_master(master: str) -> bool:
    """Whether driver and executors are one JVM (``local``, ``local[8]``; not ``local-cluster[...]``)."""
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """Shared scratch root: the session's checkpoint dir, or (if unset, local mode) a fresh local one.

    Works for classic sessions (``SparkContext.getCheckpointDir``) and Spark Connect sessions
    (the ``spark.checkpoint.dir`` setting only).  Raises ``RuntimeError`` when the master is not
    local and no folder is named: executors could not see a folder that the driver made.
    """
    root = None
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir", None)
        except Exception:
            root = None
    if not root:
        if sc is None or not is_local_master(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        key = id(sc)
        if key not in _OWN_SCRATCH:
            _OWN_SCRATCH[key] = tempfile.mkdtemp(prefix="hydrix-ckpt-")
            sc.setCheckpointDir(_OWN_SCRATCH[key])
        root = sc.getCheckpointDir() or _OWN_SCRATCH[key]
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique directory path under the shared scratch root."""
    return f"{scratch_root(spark)}/hydrix/{name}-{uuid.uuid4().hex}"


def scale_conf(
    input_bytes: int,
    *,
    shuffle_bytes: int | None = None,
    target_partition_bytes: int = 256 << 20,
    min_partitions: int = 200,
    max_blocks: int = 10**10,
) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of input.

    Reducers get about ``target_partition_bytes`` of the expected shuffle (``shuffle_bytes``; the whole
    input by default, an upper bound, as every shuffle here follows a map-side reduction) and scan
    splits half of that.  Map tasks times reducers is the number of shuffle blocks that the driver
    tracks: beyond ``max_blocks`` splits and reducers both grow by the same factor, so neither number
    has a fixed cap.  AQE coalesces small partitions and splits skewed join partitions at run time.
    """
    shuffled = int(input_bytes if shuffle_bytes is None else shuffle_bytes)
    split = target_partition_bytes // 2
    blocks = (int(input_bytes) / split) * (shuffled / target_partition_bytes)
    if blocks > max_blocks:
        grow = math.sqrt(blocks / max_blocks)
        split, target_partition_bytes = math.ceil(split * grow), math.ceil(target_partition_bytes * grow)
    n = max(min_partitions, -(-shuffled // int(target_partition_bytes)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.parquet.filterPushdown": "true",
    }


def apply_conf(spark: SparkSession, conf: dict[str, str]) -> dict[str, str | None]:
    """Set runtime SQL options (e.g. ``scale_conf(...)``) on a session; returns the previous values
    (None for options that were not set) for ``restore_conf``."""
    previous = {}
    for key, value in conf.items():
        previous[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)
    return previous


def restore_conf(spark: SparkSession, previous: dict[str, str | None]) -> None:
    """Undo ``apply_conf``: reset changed options and unset the ones that were not set before."""
    for key, value in previous.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def local_session(
    cores: int | None = None,
    shuffle_partitions: int | None = None,
    app: str = "hydrix",
    driver_memory: str | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """A local-mode session for tests and benchmarks (UI off, AQE on, UTC)."""
    cores = cores or int(os.environ.get("HYDRIX_CORES", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory or os.environ.get("HYDRIX_DRIVER_MEMORY", "8g"))
        # the status store keeps finished executions with their plan text even with the UI off
        .config("spark.sql.ui.retainedExecutions", "50")
        .config("spark.ui.retainedJobs", "100")
        .config("spark.ui.retainedStages", "100")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)  # make sure a checkpoint dir exists
    return spark


def stage(df, name: str = "stage"):
    """Write ``df`` once as Parquet under the shared scratch root and return the re-read table.

    Use it where several branches of a plan reuse one expensive input (e.g. every gold table and
    gate reads the deduplicated silver table): the branches then scan column-pruned Parquet
    instead of each recomputing the input, and the written table cuts lineage, so a lost executor
    recomputes from it rather than from the raw source.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _hadoop_path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def qualified_path(spark: SparkSession, path: str) -> str:
    """The path with scheme and absolute folder, decoded, as its file system names it."""
    jvm_path, fs = _hadoop_path(spark, path)
    return fs.makeQualified(jvm_path).toString().rstrip("/")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path, fs = _hadoop_path(spark, path)
    return fs.exists(jvm_path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a table folder on whatever file system it is in."""
    jvm_path, fs = _hadoop_path(spark, path)
    fs.delete(jvm_path, True)


class Scratch:
    """Owner of a job's staged tables: ``with Scratch(spark) as s: t = s.stage(df)``.

    On leaving the block the staged tables are deleted, except those marked with ``keep=True``:
    such a table backs the DataFrame that the job returns, and stays until the cluster's retention
    rules expire ``<spark.checkpoint.dir>/hydrix``.
    """

    def __init__(self, spark: SparkSession, name: str = "scratch"):
        self.spark, self.name, self._owned = spark, name, []

    def __enter__(self) -> Scratch:
        return self

    def stage(self, df, name: str = "t", keep: bool = False):
        """Write ``df`` as Parquet, cut its lineage, return the re-read table.

        The committed table replaces the write's shuffle files, so Spark deletes them at once.
        """
        path = scratch_path(self.spark, f"{self.name}-{name}")
        if not keep:
            self._owned.append(path)
        previous = apply_conf(self.spark, _SHUFFLE_CLEANUP)
        try:
            df.write.mode("overwrite").parquet(path)
        finally:
            restore_conf(self.spark, previous)
        table = self.spark.read.schema(df.schema).parquet(path)
        table._scratch_path = path
        return table

    def drop(self, *tables) -> None:
        """Delete staged tables early, once nothing reads them any more."""
        for table in tables:
            path = table._scratch_path
            if path in self._owned:
                self._owned.remove(path)
                delete_path(self.spark, path)

    def __exit__(self, *exc) -> None:
        for path in self._owned:
            delete_path(self.spark, path)
        self._owned = []
