"""Global row index in a sort order without a single-partition window.

The rows are range-partitioned on the order, each partition counts its rows,
the partition counts (one small row per partition) give offsets, and inside a
partition ``row_number`` adds the local position. Every step is distributed;
the only gathered table has one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def global_index(df: DataFrame, order: Sequence[str], name: str = "index",
                 partitions: int | None = None) -> DataFrame:
    """``df`` plus ``name`` = 1-based position of the row in ``order`` (order must be unique)."""
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(parts, *order).withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))  # read twice; partition ids fixed
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: the window over it is tiny
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # exactly one row per range partition: bounded by construction
    side = F.broadcast(offsets)
    local = Window.partitionBy("_pid").orderBy(*order)
    return (ranged.join(side, "_pid", "inner")
            .withColumn(name, (F.col("_off") + F.row_number().over(local)).cast("long"))
            .drop("_pid", "_off"))
