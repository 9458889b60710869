"""Top-k per group, dense numbering and trailing frames without a one-task sort."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodstream.streaming.folders import written


def top_per_group(
    frame: DataFrame, by: str | Sequence[str], order: Sequence[Column], k: int
) -> DataFrame:
    """k first rows of each group.

    The rank filter becomes a group limit below the shuffle: each task sends at most k rows per
    group, so a group that holds most of the rows costs its reducer no more than k per task. (The
    optimizer does this for k up to spark.sql.optimizer.windowGroupLimitThreshold, 1000 by default.)
    """
    by = [by] if isinstance(by, str) else list(by)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return frame.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def numbered(frame: DataFrame, order: Column, chunk: Column, name: str = "idx") -> DataFrame:
    """Number rows 0, 1, 2, ... by `order`, in parallel.

    `chunk` must grow with `order` (a day for a time, id div 65536 for a dense id). Rows are ranked
    inside their chunk and shifted by the rows of all earlier chunks. Only the chunk totals, one
    short row per chunk, pass through a single running sum.
    """
    frame = frame.withColumn("_chunk", chunk)
    earlier = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        frame.groupBy("_chunk")
        .agg(F.count("*").alias("_rows"))
        .select("_chunk", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    within = F.row_number().over(Window.partitionBy("_chunk").orderBy(order)) - 1
    return (
        frame.withColumn("_within", within)
        .join(offsets, "_chunk")
        .withColumn(name, (F.col("_offset") + F.col("_within")).cast("bigint"))
        .drop("_chunk", "_offset", "_within")
    )


def numbered_by_ranges(frame: DataFrame, *order: str | Column, name: str = "idx") -> DataFrame:
    """Number rows 0, 1, 2, ... by an order of any kind, however sparse or skewed, in parallel.

    Spark samples the order and deals the rows into ranges of about equal size; the ranges are written, so that they stay what they are, and numbered like chunks.
    Equal rows get different numbers.
    """
    dealt = frame.repartitionByRange(*order).withColumn("_range", F.spark_partition_id())
    by = F.struct(*((F.col(x) if isinstance(x, str) else x).alias(f"o{k}") for k, x in enumerate(order)))
    return numbered(written(dealt, "ranges"), by, F.col("_range"), name).drop("_range")


def trailing_sum(
    frame: DataFrame, idx: str, values: Sequence[str], n: int, block_rows: int = 4096
) -> DataFrame:
    """Add `trailing_<value>`: sum over a row and the n - 1 rows before it in dense `idx` order.

    Rows are cut into blocks of block_rows, and the last n - 1 rows of a block are copied to the
    following one as context. Every block is then a window partition of bounded size.
    """
    size = max(block_rows, n)
    block = F.floor(F.col(idx) / size)
    into_next = F.pmod(F.col(idx), F.lit(size)) >= size - (n - 1)
    copies = F.when(into_next, F.array(block, block + 1)).otherwise(F.array(block))
    frames = (
        Window.partitionBy("_block").orderBy(idx).rowsBetween(-(n - 1), Window.currentRow)
    )
    return (
        frame.withColumn("_own", block)
        .withColumn("_block", F.explode(copies))
        .withColumns({f"trailing_{v}": F.sum(v).over(frames) for v in values})
        .filter(F.col("_block") == F.col("_own"))
        .drop("_block", "_own")
    )
