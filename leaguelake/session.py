"""Session settings the jobs are written for. A cluster's own values win; these fill the gaps."""

from __future__ import annotations

from pyspark.sql import SparkSession

RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName("leaguelake")
    settings = {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": str(shuffle_partitions or cores),
        "spark.driver.memory": "8g",
        # Inputs are small here: do not merge partitions to the point of idle cores.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
