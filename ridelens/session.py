"""Session helpers: a local session for tests and benches, and the shared
checkpoint folder used to cut lineage."""

from __future__ import annotations

import atexit
import os
import posixpath
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter for the operators of this library.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime conversion of a shuffle join to a broadcast join happens only
    # after the small side has been materialised and measured.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "ridelens") -> SparkSession:
    """A local session configured like a cluster job, for tests and benches."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("RIDELENS_DRIVER_MEMORY", "8g"))
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Partition settings sized from the input: shuffle partitions so that
    each holds about ``target_partition_bytes`` of input (at least two waves
    of tasks), scan splits of 256 MB, and adaptive coalescing toward 128 MB.
    At 100 TB and 8,000 cores this gives about 400,000 shuffle partitions,
    which adaptive execution then merges where the data shrank."""
    partitions = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    }


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder named by ``spark.checkpoint.dir``, if any."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return configured or spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a private one only for
    a local-mode session where none is configured. On a cluster the folder must
    be named by the job (a shared file system), never a machine-local path."""
    current = checkpoint_dir(spark)
    if current:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not re.match(r"local(\[(?!.*cluster)|$)", spark.sparkContext.master):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder (HDFS/S3/ABFS) for checkpoints"
        )
    local = tempfile.mkdtemp(prefix="ridelens-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


# Folders of intermediate tables that this process wrote: path -> session.
_SCRATCH: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, kind: str, name: str) -> str:
    """A new folder's path below the checkpoint folder, for an intermediate
    table. It goes with ``clear_scratch``, at the latest when the process ends;
    until then lazily built frames may read it."""
    path = posixpath.join(ensure_checkpoint_dir(spark), kind, f"{name}-{uuid.uuid4().hex}")
    _SCRATCH[path] = spark
    return path


def is_scratch(path: str) -> bool:
    """Whether an intermediate table is still there."""
    return path in _SCRATCH


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder of any file system that Spark can write to."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop
    target = hadoop.fs.Path(path)
    return target.getFileSystem(hadoop.conf.Configuration()).delete(target, True)


def clear_scratch() -> int:
    """Delete the intermediate tables written so far; call it when no frame
    built from them is needed any more. Returns the number of folders."""
    n = 0
    while _SCRATCH:
        path, spark = _SCRATCH.popitem()
        n += bool(delete_path(spark, path))
    return n


def _clear_at_exit() -> None:
    try:
        clear_scratch()
    except Exception:  # the JVM may be gone
        pass


atexit.register(_clear_at_exit)
