"""Session construction and the shared scratch location.

On a cluster the shared folder comes from ``spark.checkpoint.dir`` as set by
the cluster; only when it is unset (local tests) do we pick a temporary one.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; all can be overridden by the caller's conf.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Extra settings for a large cluster (hundreds of executors, ~100 TB inputs).
# Shuffles start with many partitions and AQE merges them towards the advisory
# size, so small stages do not pay for thousands of empty tasks while big ones
# never build multi-GB partitions that spill.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.shuffle.partitions": "4000",
}


def get_session(app: str = "tablekit", master: str | None = None,
                conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    Pass ``conf=CLUSTER_CONF`` (plus your own overrides) on a large cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    merged = dict(DEFAULT_CONF)
    merged.update(conf or {})
    for key, value in merged.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """True when driver and executors are one process (``local`` or ``local[n]``)."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A temporary folder is created only when the setting is unset and the session
    is a single local process.  On a cluster an unset folder is an error: each
    executor would write to its own disk and later reads would miss those files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the driver and "
                               f"all executors (master is {sc.master})")
        configured = tempfile.mkdtemp(prefix="tablekit-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_scratch: list[str] = []
_databases: list[str] = []


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder (Spark's writers create it).

    It stays until :func:`remove_dir` or :func:`remove_scratch` deletes it.
    """
    _scratch.append(f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _scratch[-1]


def scratch_database(name: str) -> str:
    """Note a database that :func:`remove_scratch` drops."""
    _databases.append(name)
    return name


def remove_scratch(spark: SparkSession) -> int:
    """Delete every folder handed out by :func:`shared_dir` so far and drop the noted
    databases; how many folders existed.

    Frames that read them must have been consumed.
    """
    databases, _databases[:] = _databases[:], []
    for name in databases:
        spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
    paths, _scratch[:] = _scratch[:], []
    return sum(remove_dir(spark, p) for p in paths)


def remove_dir(spark: SparkSession, path: str) -> bool:
    """Delete a folder of the shared file system; True when something was deleted."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def publish_dir(spark: SparkSession, hidden: str, path: str) -> None:
    """Make a finished folder visible under its name by one rename; an existing name is an error.

    A rename onto an existing folder would move the new one into it, so that is looked for
    first: one writer at a time.
    """
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    target = jvm_path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(target):
        raise FileExistsError(f"{path} exists already")
    fs.mkdirs(target.getParent())
    if not fs.rename(jvm_path(hidden), target):
        raise OSError(f"{path} could not be published")
