"""Distributed 1-based positions over a total order (no global window over the rows).

The frame is range-partitioned on the order, sorted inside partitions and
written to the shared checkpoint folder, so partition boundaries are fixed
once and survive executor loss. Per-partition counts (one row per
partition, a size bounded by the partition count) give offsets, which are
broadcast back; each row's position is its partition offset plus its index
inside the partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_dir


def with_ordinal(df: DataFrame, order_by: list[str | Column], name: str = "ordinal",
                 num_partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    shared_dir(spark)  # make sure a (shared) checkpoint folder is set
    # Ties on the order go by a hash of the row, so positions repeat between
    # runs. A row-unique last sort column lets range partitioning split runs of
    # identical rows, whose positions are interchangeable.
    hashed = [F.col(f.name) for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    df = df.withColumn("_rh", F.xxhash64(*hashed) if hashed else F.lit(0)).withColumn("_tb", F.monotonically_increasing_id())
    cols = [F.col(c) if isinstance(c, str) else c for c in order_by] + [F.col("_rh"), F.col("_tb")]
    # Without an explicit count AQE may coalesce the range partitions; it only
    # merges neighbouring ranges, so partition order still follows the order.
    ranged = df.repartitionByRange(num_partitions, *cols) if num_partitions else df.repartitionByRange(*cols)
    ranged = ranged.sortWithinPartitions(*cols).withColumn("_pid", F.spark_partition_id())
    ranged = ranged.checkpoint(eager=True)
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    # Index inside the (materialised, sorted) partition, taken before the join.
    local = ranged.withColumn(
        "_idx", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33))
    return (local.join(F.broadcast(offsets), "_pid")
                 .withColumn(name, (F.col("_off") + F.col("_idx") + 1).cast("bigint"))
                 .drop("_pid", "_off", "_idx", "_rh", "_tb"))
