"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import pathlib
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .operators.sizing import _bytes, scanned_bytes

MAX_SHUFFLE_PARTITIONS = 200_000

_shipped: set[str] = set()

# Left alone where the cluster or the caller already decided.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where that costs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoints of intermediate results go away with the frames that need them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(app_name: str = "threadloom", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session; ``conf`` keys use ``__`` for the dots of Spark settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**_DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    if master and master.startswith("local"):
        cores = master[6:-1]
        settings.setdefault(
            "spark.sql.shuffle.partitions", cores if cores.isdigit() else str(os.cpu_count() or 8)
        )
        settings.setdefault("spark.ui.enabled", "false")
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors, whose Python workers import it for stemming.

    Needed once per application, and not at all where the package is installed
    on every machine.  Call it before the first stemming or look-up.
    """
    package = pathlib.Path(__file__).resolve().parent
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        folder = tempfile.mkdtemp(prefix="threadloom-package-")
        archive = shutil.make_archive(
            f"{folder}/{package.name}", "zip", root_dir=package.parent, base_dir=package.name
        )
        spark.sparkContext.addPyFile(archive)
        _shipped.add(application)
    return spark


def bound_batches(spark: SparkSession, most_bytes: int = 8 << 20) -> SparkSession:
    """Bound the bytes of an Arrow batch for this session.

    Spark's own bounds are 10,000 rows and 64 MB; whole texts are large, and the
    JVM and the worker each hold a batch per task, the worker some copies of it.
    A lower bound that is set already holds.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < _bytes(spark.conf.get(name)) <= most_bytes:
        spark.conf.set(name, str(most_bytes))
    return spark


def size_shuffles(*scans: DataFrame, per_task: int = 200 << 20, stored_bytes: int = 0) -> int:
    """Raise ``spark.sql.shuffle.partitions`` to fit tables of this size.

    Each shuffle task should hold about ``per_task`` bytes so that it sorts in
    memory; adaptive execution merges partitions that turn out small.  What
    counts is the size of the tables that are read, at any depth of the plan, or
    ``stored_bytes`` of files if that is more.
    The setting is never lowered.
    """
    spark = scans[0].sparkSession
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    largest = max([stored_bytes, *map(scanned_bytes, scans)])
    # Columnar files unpack to a few times their size in a shuffle.
    wanted = max(current, min(-(-3 * largest // per_task), MAX_SHUFFLE_PARTITIONS))
    spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return wanted


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    ``spark.checkpoint.dir`` is read from the session.  Only a local session
    that leaves it unset gets a temporary folder; on a cluster that would be a
    different disk on every machine, so there the setting is demanded.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="threadloom-"))
    return spark.sparkContext.getCheckpointDir()


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors, keeps partitioning."""
    spark = df.sparkSession
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system that is no longer read."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
