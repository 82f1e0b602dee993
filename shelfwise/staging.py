"""Stage outputs: tables written to the shared folder to cut lineage.

A lost executor then only costs re-reading a file, and later passes (medians,
bounds, ranks, model fits) scan the compact stage instead of the raw tables.
The folder is a required setting: the session's ``spark.checkpoint.dir``, or
``SparkContext.setCheckpointDir`` where tests and local runs name one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def stage_root(spark: SparkSession) -> str:
    """The folder that driver and executors share."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write the frame as parquet under a fresh folder and read it back."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_path(spark: SparkSession, name: str = "run") -> str:
    """Unused path in the application's own folder, which can go when the application has ended."""
    return f"{stage_root(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def drop_stage(df: DataFrame) -> None:
    """Delete the files of a staged frame that nothing will read any more.

    Only folders that :func:`stage` made for this application are touched.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    own = f"/{spark.sparkContext.applicationId}/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if own in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
