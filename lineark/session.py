"""Session construction and the shared folder used for checkpoints and written tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, partitions: int | None = None,
              app: str = "lineark") -> SparkSession:
    """Build (or reuse) a session with the settings this library is tuned for.

    On a cluster the master and the checkpoint folder come from the launcher;
    the defaults here only serve local runs and tests.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.sql.shuffle.partitions", str(partitions or os.environ.get("BENCH_CPUS", "8")))
            # in local mode the driver JVM is the whole cluster: size its heap
            builder = builder.config("spark.driver.memory", os.environ.get("LINEARK_DRIVER_MEMORY", "16g"))
    if partitions and not (master or "").startswith("local"):
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # checkpointed rounds (closure, levels, series index) write rows with
        # this serializer; Kryo is markedly cheaper than Java serialization
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
        # remove a loop's checkpoint files once its DataFrames are garbage
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Read from the session.  Only a local session without the setting gets a
    folder of its own, so that ``DataFrame.checkpoint`` works; on a cluster
    the setting must be there, since a folder of one machine is no use.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if not path:
        current = sc.getCheckpointDir()
        if current:
            return current
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="lineark-ckpt-")     # the context remembers it, see above
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh location under the shared folder for a table a job writes."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/lineark-{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def clean_shuffles(spark: SparkSession):
    """What is written in the block leaves no shuffle files behind: each write's go when it ends."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table under the shared folder whose last reader has run."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


# what one task takes at most: bytes of a scan's split and of a shuffle's partition, and the partitions that
# a shuffle starts with, which AQE merges up to that size
SPLIT_BYTES, PARTITION_BYTES, PARTITIONS = 16 << 20, 8 << 20, 512


def _bytes(text: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)i?b?", text.strip().lower()).groups()
    return int(number) << 10 * " kmgt".index(unit or " ")


def bound_tasks(spark: SparkSession) -> None:
    """Let the number of tasks grow with the input, not their size: a hash aggregate or sort holds its
    task's rows, so its memory is bounded by them.  Smaller settings of the session stay."""
    for key, most in (("spark.sql.files.maxPartitionBytes", SPLIT_BYTES),
                      ("spark.sql.adaptive.advisoryPartitionSizeInBytes", PARTITION_BYTES)):
        if _bytes(spark.conf.get(key)) > most:
            spark.conf.set(key, str(most))
    if not spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum",
                       str(max(PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``lineark`` importable in Python workers (pandas UDFs, stream state
    functions): zip the package once per SparkContext and add it with
    ``addPyFile``, which Spark distributes to every executor."""
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _shipped:
        return
    import lineark
    pkg = os.path.dirname(os.path.abspath(lineark.__file__))
    root = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="lineark-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _shipped.add(key)
