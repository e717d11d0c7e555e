"""Session settings and the place for shared intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a temporary one only where none is named."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="haulgrain-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession) -> str:
    """A fresh folder for one run's tables, removed when the driver's process ends."""
    folder = f"{shared_folder(spark).rstrip('/')}/haulgrain-{uuid.uuid4().hex}"
    atexit.register(_remove, spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), folder)
    return folder


def _remove(jvm, configuration, folder: str) -> None:
    try:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(configuration).delete(path, True)
    except Exception:  # the JVM may be gone already; nothing depends on the removal
        pass


# The JVM never compiles a method of more than 8000 bytes of bytecode. Cleaning fifty text
# columns in one fused stage makes such a method; below this limit Spark generates one
# smaller class per operator instead, which runs several times faster.
#
# Sorting both sides took most of the time of the lookups. Adaptive execution hashes the lookup instead
# where the shuffle found every partition of it below this size, and sorts otherwise.
_DEFAULTS_TO_CHANGE = {
    "spark.sql.codegen.hugeMethodLimit": ("65535", "8000"),
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": ("0b", "64m"),
}


# Arrow batches of long texts: 10,000 rows of 2 KB take 25 MB in the JVM and again in Python, for each task.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "2m")}


def tune(spark: SparkSession, options: dict[str, tuple[str, str]] = _DEFAULTS_TO_CHANGE) -> None:
    """Set the few runtime options wide tables or long texts need, unless the user already has."""
    for key, (default, better) in options.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, better)


# A write runs its plan once, so nobody reads its shuffles afterwards; else they stay until the driver happens to collect garbage.
_REMOVE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Writes in this block remove the shuffle files they made when they end."""
    before = spark.conf.get(_REMOVE_SHUFFLES, None)
    spark.conf.set(_REMOVE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(_REMOVE_SHUFFLES) if before is None else spark.conf.set(_REMOVE_SHUFFLES, before)
