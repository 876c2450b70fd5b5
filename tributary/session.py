"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tributary", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Session with UTC time and adaptive execution.

    ``shuffle_partitions`` is only the starting number: adaptive execution merges small
    partitions and splits skewed ones, so on a cluster it should be generous
    (about total shuffle bytes / 128 MB).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        # Of members with the same name the last one counts, as in other JSON readers.
        "spark.sql.variant.allowDuplicateKeys": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    Only a local session may leave it unset; it then gets a folder beside the warehouse. Either
    way the context's checkpoint folder is set.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh, never reused path under the shared folder; it goes when the application ends."""
    top = f"{shared_dir(spark)}/tributary/{spark.sparkContext.applicationId}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(top)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        files.mkdirs(folder)
        files.deleteOnExit(folder)
    return f"{top}/{uuid.uuid4().hex}/{label}"


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder; later uses survive the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def store(df: DataFrame, path: str) -> DataFrame:
    """``df`` written once as a parquet table, for results that several queries read.

    Unlike a checkpoint, each reader scans only the columns it needs.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stored(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``store`` in the shared folder for the length of a block; dropped at its end."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    try:
        yield store(df, path)
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
