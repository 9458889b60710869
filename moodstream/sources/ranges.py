"""Text files read by byte ranges, with the order of what is read."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def pieces(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(file, size, block, at, piece): files cut at a separator; `block` is the start of a byte range, and `at` grows within it."""
    return spark.read.option("lineSep", sep).text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("piece"),
    )


def running(rows: DataFrame, value: str, name: str) -> DataFrame:
    """Adds `name`: the sum of `value` over all earlier pieces of the file.

    Sums run inside byte ranges; one row per byte range passes the sum over a file.
    """
    inside = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("file", "block").agg(F.sum(value).alias("_sum"))
    totals = totals.select("file", "block", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    own = F.coalesce(F.sum(value).over(inside), F.lit(0))
    return rows.withColumn("_own", own).join(totals, ["file", "block"]).withColumn(name, F.col("_before") + F.col("_own")).drop("_own", "_before")
