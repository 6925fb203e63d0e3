"""Numbers along a total order, without passing all rows through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored


def number_rows(df: DataFrame, name: str, *order: Column | str) -> DataFrame:
    """df with `name`: each row's place, from 0, in the order given, which should have no ties.

    Rows are dealt by range, sorted within partitions and written with their partition and place there, so that the sizes
    of partitions and the rows come from one dealing. A row's place is its place there plus the sizes of the partitions
    before, of which there are as many as shuffle partitions.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = stored(dealt.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)}))
    sizes = placed.groupBy("__part").agg((F.max("__at") + 1).alias("__n"))
    before = sizes.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    return placed.join(F.broadcast(before), "__part").withColumn(name, F.col("__before") + F.col("__at")).drop("__part", "__at", "__before")  # one row a partition
