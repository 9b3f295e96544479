"""Arrival order, dense positions, row limits. The one window without a partition has a row per task, not per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadloom.operators.checkpoints import written


def arrival(provider_rank: int, position: Column) -> Column:
    """One BIGINT that orders rows by source first and by position within the source second.

    Positions stay below 2**59, so scan positions from ``monotonically_increasing_id`` fit.
    """
    return F.shiftleft(F.lit(provider_rank).cast("bigint"), 59) + position.cast("bigint")


def with_position(df: DataFrame, order: Sequence[Column], name: str = "pos") -> DataFrame:
    """Add dense positions 0, 1, 2, ... in ``order``.

    Rows are range-partitioned and sorted once; positions are the offset of the partition plus the
    row number inside it, so no task sees more than one range.
    """
    ranged = written(df.orderBy(*order).withColumn("_part", F.spark_partition_id())
                     .withColumn("_row", F.monotonically_increasing_id()))
    start = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    # one row per partition of the sort: bounded by the partition number, not by the data
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    joined = ranged.join(offsets, "_part")
    return joined.withColumn(name, F.col("offset") + start).drop("_part", "_row", "offset")


def file_position(read: DataFrame, name: str) -> DataFrame:
    """Add dense positions by file name, then place in the file, whatever way Spark packs files into tasks.

    ``read`` comes straight from a file source; its column ``_metadata`` is used.
    """
    placed = read.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                         F.monotonically_increasing_id().alias("_line"))
    order = [F.col("_file"), F.col("_block"), F.col("_line")]
    return with_position(placed, order, name).drop("_file", "_block", "_line")


def first_rows(df: DataFrame, limit: int | None, *order: str) -> DataFrame:
    """The first ``limit`` rows in order (each task keeps its own top), or all rows."""
    return df if limit is None else df.orderBy(*order).limit(limit)


def last_rows(df: DataFrame, limit: int | None, *order: str) -> DataFrame:
    """The last ``limit`` rows in order, or all rows."""
    return df if limit is None else df.orderBy(*[F.desc(c) for c in order]).limit(limit)


def first_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows per group; the rank filter also runs before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def circular_batch(positioned: DataFrame, offset: int, limit: int) -> tuple[DataFrame, int]:
    """``limit`` rows from position ``offset`` on, wrapping around, and the next offset.

    ``positioned`` holds dense positions in ``pos``; the result is numbered from 0 in ``turn``.
    """
    total = positioned.count()
    if not total or limit <= 0:
        return positioned.limit(0).withColumn("turn", F.lit(0).cast("bigint")), offset
    size = min(limit, total)
    turn = F.pmod(F.col("pos") - F.lit(offset % total), F.lit(total).cast("bigint"))
    return positioned.withColumn("turn", turn).filter(F.col("turn") < size), (offset % total + size) % total
