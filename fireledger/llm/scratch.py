"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, or the warehouse where that is unset.

    It is deleted when the application ends. On a cluster a warehouse that is a folder of
    one machine is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if base.startswith(("file:", "/")) and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    folder = f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


#: Whether Spark deletes the shuffle files of a query as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as parquet and read back: lineage ends here, and its size is known.

    What was shuffled to make it is not needed again, and its files go with the write.
    """
    spark = df.sparkSession
    folder, before = shared_folder(spark), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(folder)


def forget(spark: SparkSession, *frames: DataFrame) -> None:
    """Delete tables that ``stored`` wrote, whose readers have all ended."""
    for df in frames:
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Whole texts that a Python worker gets at once.
BATCH = 1000


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``; its session hands Python at most ``BATCH`` rows at a time from now on."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH:
        conf.set(key, str(BATCH))
    return df


def unused(name: str, columns: list[str]) -> str:
    """``name``, with underscores behind it while a column has that name."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
