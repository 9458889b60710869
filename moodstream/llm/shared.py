"""Intermediate tables in the folder that all executors share."""

import uuid

from pyspark.sql import DataFrame

from moodstream.streaming.folders import new_folder, shared_folder


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a Parquet table below spark.checkpoint.dir: cuts lineage, survives lost executors."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def removed(spark, path: str) -> None:
    """Remove a table written for one job only."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
