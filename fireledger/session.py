"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Settings the plans rely on. All but the time zone are Spark defaults, repeated
# so that a session built with other defaults still gets them.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cpus: int | str = "*", memory: str = "8g", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fireledger")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or a folder in the warehouse where that is unset.

    On a cluster a warehouse that is a folder of one machine is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir") + "/_work"
        if base.startswith(("file:", "/")) and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return base.rstrip("/")


def work_folder(spark: SparkSession) -> str:
    """A fresh shared folder, deleted when the application ends."""
    folder = f"{shared_folder(spark)}/fireledger-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return folder


def stage(df: DataFrame, folder: str, name: str, parts: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as parquet, in folders by ``parts``, and read it back.

    Cuts lineage, and gives Catalyst the true file size, so it broadcasts the
    table in later joins only when it is below autoBroadcastJoinThreshold.
    """
    path = f"{folder}/{name}"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*parts).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
