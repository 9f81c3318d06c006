"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the plans in this package are written for. Joins carry no
# broadcast hints: Spark broadcasts a side only after seeing that it is below
# autoBroadcastJoinThreshold, and AQE splits hot shuffle partitions otherwise.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Rows with long texts: what Python workers get at once is bounded by bytes.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}
_tuned: weakref.WeakSet[SparkSession] = weakref.WeakSet()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session once; everything else stays as the cluster set it."""
    if spark not in _tuned:
        for key, value in RUNTIME_CONF.items():
            spark.conf.set(key, value)
        _tuned.add(spark)
    return spark


@contextmanager
def settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Settings for a while; afterwards the session has its own again."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _configured_dir(spark: SparkSession) -> str | None:
    return spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor sees.

    Only in local mode, where none is set, a private one is made; it goes when the process ends.
    """
    folder = _configured_dir(spark) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="stargrain-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpointing(spark: SparkSession) -> None:
    """Make DataFrame.checkpoint() usable."""
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is ever overwritten there.

    All paths of an application lie in one folder, ``<shared>/stargrain-<application id>``,
    which can be removed as a whole when the application has ended.
    """
    return f"{shared_dir(spark)}/stargrain-{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table that several later steps read, and read it back.

    It cuts the lineage, survives lost executors, and the size of its files
    tells Spark whether a join may broadcast it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)
