"""Session and lineage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a job of this library wants on any cluster: adaptive execution
# (runtime coalescing, skew-join splitting, broadcast conversion from
# runtime sizes) and no web UI.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "tessera", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if master and master.startswith("local"):
        # local mode runs everything in the driver JVM
        conf["spark.driver.memory"] = os.environ.get("TESSERA_DRIVER_MEMORY", "8g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` (or a directory already set on the context) is
    used as is.  Only a local-mode session without one (tests, bench) gets a
    fresh folder under /tmp; a cluster session without one is an error,
    because a machine-local folder does not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative operators")
    path = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TESSERA_TMP", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Cut the lineage by writing the frame as a parquet table in the shared
    checkpoint folder and reading it back (never a local checkpoint).

    A written table survives executor loss like a reliable checkpoint, costs
    one job (an eager RDD checkpoint needs two, or a persist), is stored
    columnar and compressed, and later reads prune columns and push filters."""
    spark = df.sparkSession
    path = ensure_checkpoint_dir(spark).rstrip("/") + f"/tables/{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path)


def drop_table(spark: SparkSession, path: str) -> None:
    """Remove a table this library wrote to the checkpoint folder, once nothing reads it any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """These session settings hold inside, the ones before hold again after."""
    old = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


# The shuffle files of a query go when it ends, instead of when the driver
# happens to collect garbage.  For queries that are run once.
SWEPT = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def working_set(df: DataFrame) -> DataFrame:
    """Persisted working set of an iterative operator.

    The projection is persisted and materialised once.  When the cached data
    has fewer partitions than the cluster has cores (a few large files or
    row groups), it is round-robin spread over ``defaultParallelism``
    partitions so that every later pass uses all cores; otherwise the
    partitioning is left alone.  (The partition count is read from the
    cached data: asking a plan with shuffles for it would run the shuffles.)
    Callers unpersist the returned frame."""
    from pyspark import StorageLevel
    level = StorageLevel.MEMORY_AND_DISK
    data = df.persist(level)
    data.count()
    target = df.sparkSession.sparkContext.defaultParallelism
    if data.rdd.getNumPartitions() >= target:
        return data
    spread = data.repartition(target).persist(level)
    spread.count()
    data.unpersist()
    return spread


# Upper bound for an explicit broadcast: the table's size is proven from its
# row count times its row width, never guessed.
BROADCAST_LIMIT_BYTES = 256 * 1024 * 1024


def fits_broadcast(n_rows: int, n_cols: int, bytes_per_value: int = 8,
                   limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    return n_rows * max(1, n_cols) * bytes_per_value <= limit
