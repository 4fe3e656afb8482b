"""Session construction with the settings every job relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings applied to sessions we create.  AQE re-plans joins from measured
# shuffle sizes, coalesces small partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Shuffle partitions are sized at runtime by AQE towards this target; scan
    # splits stay at the same order so a task's input fits executor memory.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                app_name: str = "blockwise", extra: dict | None = None) -> SparkSession:
    """Return a session with AQE on and the UI off.

    ``shuffle_partitions`` is for local runs; on a cluster leave it to the
    cluster's own setting.
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
