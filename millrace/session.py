"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app: str = "millrace",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the jobs expect; the cluster's own settings stay as they are."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine (tests) a temporary folder is made and set as
    the checkpoint folder; on a cluster the folder must be named.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one run's table below the shared folder."""
    return f"{shared_folder(spark)}/millrace/{name}-{uuid.uuid4().hex}"


# bytes of a group of rows in files of whole pages; readers hold the batches of a group, writers the group
PAGES_BYTES = 16 << 20


def land(df: DataFrame, name: str, group_bytes: int | None = None) -> DataFrame:
    """Write a frame that is used several times to the shared folder and read it back.

    This cuts the lineage and survives lost executors. ``group_bytes`` is for rows so large that a batch of thousands is
    too much: no batch goes beyond a file's group of rows.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write if group_bytes is None else df.write.option("parquet.block.size", group_bytes)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
