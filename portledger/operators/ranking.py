"""A running number over the whole result without sorting it in one task."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from portledger.session import pinned


def with_global_rank(df, order, name="rank"):
    """Number rows from 1 in ``order``, which must be a total order.

    Rows are range-partitioned and sorted within their partition; a row's number is its place in the
    partition plus the sizes of the partitions before it. The sorted rows are checkpointed because
    range bounds are sampled: both uses below must see the same partitions.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = pinned(
        df.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    # The id is (partition << 33) + place in the partition.
    part = F.shiftright("_id", 33)
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, so this window is as small as the partition count.
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + place + 1)
        .drop("_id", "_part", "_offset")
    )
