"""Session settings and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

#: Settings every job here relies on. Partition counts stay with the cluster:
#: AQE coalesces small shuffles and splits skewed join partitions.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """Session with ``JOB_CONF``; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    A local session without that setting gets its own temporary folder; on a
    cluster the setting is required, because a machine-local folder would be
    lost with its executor.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in this application's part of the shared folder.

    Everything an application wrote there lies under one folder named after the
    application id, which can be deleted once its results are no longer read.
    """
    root = shared_dir(spark).rstrip("/")
    return f"{root}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def pin(df: DataFrame, name: str = "pinned") -> DataFrame:
    """Cut lineage: write the rows once to the shared folder and read them back.

    Unlike a checkpoint the plan runs only once, later reads prune columns, and
    the file size lets Spark choose broadcast joins by the real size.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def drop_paths(spark: SparkSession, name: str = "", keep: str | None = None) -> None:
    """Delete this application's folders in the shared folder whose names begin with ``name`` (and not with ``keep``), once nothing reads them."""
    home = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark).rstrip('/')}/{spark.sparkContext.applicationId}")
    fs = home.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(home) if fs.exists(home) else []:
        found = status.getPath().getName()
        if found.startswith(name) and not (keep and found.startswith(keep)):
            fs.delete(status.getPath(), True)
