"""Where jobs keep checkpoints and tables."""

import gc
import tempfile
import time
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder from spark.checkpoint.dir.

    Only where that is unset, as in local tests, a temporary folder takes its place.
    """
    name = "spark.checkpoint.dir"
    folder = spark.conf.get(name, None) or spark.sparkContext.getConf().get(name)
    if folder is None:
        folder = _local_folder()
    return folder.rstrip("/")


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="moodstream-")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"


#: Seconds between two clean-ups at least.
PAUSE = 10.0
_cleaned = {"at": float("-inf")}


def release(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files that ended jobs have left.

    They go when the driver's JVM finds that nothing refers to them, and a driver with little to do may not look for half an hour.
    """
    if time.monotonic() - _cleaned["at"] >= PAUSE:
        gc.collect()  # what Python holds, the JVM holds
        spark.sparkContext._jvm.System.gc()
        _cleaned["at"] = time.monotonic()


def written(frame: DataFrame, purpose: str) -> DataFrame:
    """The frame as a table in the shared folder, for a small result of much work that is read twice."""
    path = new_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
