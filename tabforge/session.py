"""Session construction and cluster-wide settings.

Every operator in the package is a ``DataFrame -> DataFrame`` function and
never builds its own session; this module is only for entry points (tests,
bench, scripts).  On a cluster the session comes from the platform and only
the *missing* settings are filled in.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every entry point wants.  Time zone is pinned to UTC so that
# window boundaries and epoch arithmetic do not depend on the host.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Percentile sketches are object buffers; sort-based fallback after 128
    # groups per task is needlessly early for window-sized groups.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "512",
    # Reliable checkpoints (plans.joins.materialise) are deleted once the
    # DataFrame that owns them is garbage-collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def cluster_conf(total_cores: int, input_tb: float = 100.0) -> dict[str, str]:
    """Settings for a large cluster run (pass as ``extra_conf``).

    * scans: 512 MiB file splits → ~200k scan tasks for 100 TB, each far
      below executor memory;
    * shuffles: start wide (about 3 partitions per core, at least one per
      512 MiB of input) and let AQE coalesce small partitions to ~256 MiB
      and split skewed ones (skew join on by default here);
    * broadcast: Spark's own size-based broadcast stays at its 10 MiB
      default; operators give no hint for sides without a bound.
    """
    initial = max(3 * total_cores, int(input_tb * 1024 * 1024 / 512))
    return {
        "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
        "spark.sql.adaptive.localShuffleReader.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def build_session(
    master: str | None = None,
    app_name: str = "tabforge",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant
    folder (HDFS/S3/ABFS); we read it and never override it.  Only when it is
    unset (local tests) do we create a scratch folder of our own.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is unset: on a cluster it must name a shared, "
            "fault-tolerant folder (a machine-local folder would not survive executor loss)"
        )
    local = tempfile.mkdtemp(prefix="tabforge-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    atexit.register(shutil.rmtree, local, ignore_errors=True)  # our own scratch folder, gone with the process
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for materialised tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder of this package that no later read needs, on whatever file system it is."""
    if not path.startswith(ensure_checkpoint_dir(spark).rstrip("/") + "/"):
        raise ValueError(f"{path} is not under the checkpoint folder")
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def prepare_session(spark: SparkSession) -> None:
    """Settings the operators rely on, applied to an existing session: UTC
    session time zone (window bounds, epoch arithmetic) and a checkpoint
    folder (read from the session; created only when unset)."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
