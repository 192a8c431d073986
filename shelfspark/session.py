"""Session construction and shared-folder lookup."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Session settings every job relies on. They only tune planning; none of
# them changes a result.
SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "shelfspark") -> SparkSession:
    """Build (or reuse) a session. On a cluster pass ``master=None`` and let
    spark-submit decide; tests use ``local[*]`` with few shuffle partitions."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.ui.enabled", "false") \
        .config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session. Only when it is unset
    and the master is local (tests) do we pick a folder of our own and register it, so
    ``DataFrame.checkpoint()`` and staged tables land in one place.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = os.path.join(tempfile.gettempdir(), "shelfspark-checkpoints")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/shelfspark/{name}-{uuid.uuid4().hex[:12]}"


#: What every table is written with: shuffle files go when the query that made them ends, and not when the driver
#: happens to collect its garbage.
WRITE_SETTINGS = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def save(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists", partition_by: str | None = None) -> None:
    """Write ``df`` as a table, in little space: compressed well, and without the shuffle files left behind."""
    out = df.write.format(fmt).mode(mode)
    if fmt in ("parquet", "orc"):
        out = out.option("compression", "zstd")
    if partition_by:
        out = out.partitionBy(partition_by).option("partitionOverwriteMode", "static")
    with settings(df.sparkSession, WRITE_SETTINGS):
        out.save(path)


def staged(df: DataFrame, name: str, paths: list[str] | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: what reads it twice computes it once, and a lost
    executor costs no more than the tasks of one read. The folder is added to ``paths``, for callers that drop it."""
    path = scratch_path(df.sparkSession, name)
    if paths is not None:
        paths.append(path)
    save(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session that hold within; those before are restored."""
    had = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in had.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system that Spark reads."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of this library, if it is there."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
