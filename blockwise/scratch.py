"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a folder of its own only where that is unset and Spark runs locally."""
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="blockwise-shared-")
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table to the shared folder and read back.

    What follows starts from the table: it is not computed again for each use, and a lost
    executor rereads it.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/blockwise/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
