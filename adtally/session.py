"""SparkSession construction and shared-storage helpers.

Cluster runs get their settings from the submitter; ``get_spark`` only fills in what is
unset, so the same code works under ``spark-submit`` on a large cluster and in local tests.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings every job relies on for correct results (UTC day boundaries, ANSI arithmetic)
# and for scale (AQE re-plans joins/partition counts from real shuffle sizes, splits skew).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


LOCAL_DRIVER_MEMORY = "8g"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the models rely on to an existing session."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def submitted_conf() -> dict[str, str]:
    """Settings that the submitter or the cluster's defaults file gave (launches the JVM)."""
    SparkContext._ensure_initialized()
    return dict(SparkConf().getAll())


def is_local(master: str | None) -> bool:
    """One JVM on one machine; a local cluster has several processes that share no folders by right."""
    return master is None or master == "local" or master.startswith("local[")


def get_spark(master: str | None = None, app_name: str = "adtally", **conf: str) -> SparkSession:
    """Return the active session, or build one.

    An active session is reused as is, apart from the runtime settings in ``REQUIRED_CONF`` and ``conf``.
    In a new one the submitter's settings stand; ``LOCAL_DEFAULTS`` only fill what is unset.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        for k, v in {**REQUIRED_CONF, **conf}.items():
            active.conf.set(k, v)
        return active
    if is_local(master) and "PYSPARK_SUBMIT_ARGS" not in os.environ:
        memory = conf.get("spark.driver.memory", LOCAL_DRIVER_MEMORY)  # must be known before the JVM starts
        os.environ["PYSPARK_SUBMIT_ARGS"] = f"--driver-memory {memory} pyspark-shell"
    given = submitted_conf()
    builder = SparkSession.builder.appName(app_name)
    if master and "spark.master" not in given:
        builder = builder.master(master)
    defaults = {k: v for k, v in LOCAL_DEFAULTS.items() if k not in given}
    for k, v in {**defaults, **REQUIRED_CONF, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and materialised tables.

    Uses the cluster's ``spark.checkpoint.dir`` (or a checkpoint folder already set on the
    SparkContext). Only when neither is set and the master is local, a fresh scratch folder is created
    once per application, registered with ``setCheckpointDir`` and removed at exit. On any other
    master a machine-local folder would lose rows, so this raises.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(root)
        return root
    app = spark.sparkContext.applicationId
    if app in _LOCAL_ROOTS:
        return _LOCAL_ROOTS[app]
    ctx_dir = spark.sparkContext.getCheckpointDir()
    if ctx_dir:
        return ctx_dir
    if not is_local(spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="adtally-ckpt-")
    atexit.register(shutil.rmtree, _LOCAL_ROOTS[app], ignore_errors=True)
    spark.sparkContext.setCheckpointDir(_LOCAL_ROOTS[app])
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint root for one materialised table."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


_TEMPORARY: list[tuple[SparkSession, str]] = []


def temporary_path(spark: SparkSession, name: str) -> str:
    """A scratch path for a table that only this application reads; what is left of it at exit is deleted."""
    if not _TEMPORARY:
        atexit.register(_drop_temporary)
    path = scratch_path(spark, name)
    _TEMPORARY.append((spark, path))
    return path


def _drop_temporary() -> None:
    for spark, path in _TEMPORARY:
        try:
            delete_path(spark, path)
        except Exception:  # noqa: BLE001  the session is stopped: nothing can be deleted any more
            return


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of raw events.

    * scan splits of ``target_partition_bytes`` (Parquet row groups permitting);
    * initial shuffle partitions so each holds about one target partition of the largest
      shuffle (the dedup on event_id moves roughly the whole projected input), at least two
      waves of tasks; AQE coalesces them down for the small later stages;
    * AQE advisory size equal to the target, skew splitting for partitions 5x the median;
    * broadcast only under 64 MB (dimensions); larger sides fall back to sort-merge joins.
    """
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }


def file_listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, modification time) of every file at or under ``path``; empty if there is none."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found, files = [], fs.listFiles(root, True)
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(found)


def is_directory(spark: SparkSession, path: str) -> bool:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(root) and fs.getFileStatus(root).isDirectory()


def delete_path(spark: SparkSession, path: str) -> None:
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)


def size_for_input(spark: SparkSession, paths: list[str]) -> None:
    """Apply ``cluster_conf`` for the files at ``paths``, except where the submitter chose a value."""
    given = submitted_conf()
    total = sum(size for path in paths for _, size, _ in file_listing(spark, path))
    for k, v in cluster_conf(total, spark.sparkContext.defaultParallelism).items():
        if k not in given:
            spark.conf.set(k, v)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole or not at all; False if ``path`` is there already."""
    fs_package, conf = spark._jvm.org.apache.hadoop.fs, spark.sparkContext._jsc.hadoopConfiguration()
    target, draft = fs_package.Path(path), fs_package.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    fs = target.getFileSystem(conf)
    stream = fs.create(draft, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    no_options = spark.sparkContext._gateway.new_array(getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        fs_package.FileContext.getFileContext(fs.getUri(), conf).rename(draft, target, no_options)
        return True
    except Exception as error:  # noqa: BLE001  the gateway's error type carries the Java one
        fs.delete(draft, False)
        if fs.exists(target):
            return False
        raise error


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under a folder; none if there is no folder."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(root)) if fs.exists(root) else []
