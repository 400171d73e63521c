"""Session settings the plans were written for, and fault-tolerant lineage cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# AQE sizes shuffles at run time. On a cluster set spark.sql.shuffle.partitions to a few times
# the cores: grouped results are merged down from that, exact percentiles and month layouts
# use all of it. Scans decode few of many columns and aggregate at once, so wide splits are
# safe and mean fewer partial results to shuffle; the advisory size gives month folders
# files worth opening.
SETTINGS = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app_name: str = "tripcohorts", **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def cut_lineage(frame: DataFrame) -> DataFrame:
    """Compute once and keep in the cluster's shared checkpoint folder.

    Used for small grouped tables that several results are read from: a lost executor then
    costs a re-read of that table and not another scan of the trips.
    """
    context = frame.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = frame.sparkSession.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        context.setCheckpointDir(folder)
    return frame.checkpoint(eager=True)


def remove_checkpoints(spark: SparkSession) -> None:
    """Deletes what this application has kept in the checkpoint folder."""
    folder = spark.sparkContext.getCheckpointDir()
    if folder is not None:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
