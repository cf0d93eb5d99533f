"""Tables written to the shared folder: they cut lineage, survive lost executors and are read column by column."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Otherwise the files stay until the driver happens to collect what refers to them.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, or the checkpoint folder the context was given.

    Only a local master (tests) gets a temporary folder of its own; on a cluster a missing setting is an error, because a
    machine-local folder would not be seen by the other executors.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidemark-shared-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df``, computed once, written to the shared folder and read again.  Spark deletes the shuffle files of the job
    as soon as it is done."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def dropped(df: DataFrame) -> None:
    """Delete the table of a frame made by ``written`` that nothing reads any more."""
    path = getattr(df, "_written", None)
    if path:
        jvm = df.sparkSession._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(place, True)
