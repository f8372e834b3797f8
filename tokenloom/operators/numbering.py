"""Numbers of rows within their group, without a task that holds a group."""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def numbered(rows: DataFrame, group: str, order: Sequence[str], out: str = "idx") -> DataFrame:
    """rows with `out`, their place from 0 in their group by `order` (nulls first).

    Rows are dealt by ranges of (group, order), so a large group lies in many
    tasks, and written sorted with their place in the task to the shared folder;
    the tasks' counts of each group, a row for each, are summed up before them.
    """
    spark = rows.sparkSession
    folder = f"{checkpoint_dir(spark).rstrip('/')}/numbered-{uuid.uuid4().hex}"
    part = F.spark_partition_id()
    place = F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    dealt.withColumn("_part", part).withColumn("_place", place).write.parquet(folder)
    kept = spark.read.parquet(folder)
    counts = kept.groupBy(group, "_part").agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col(group).alias("_g"), F.col("_part").alias("_p"),
                           (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    same = kept[group].eqNullSafe(counts["_g"]) & (kept["_part"] == counts["_p"])
    return kept.join(counts, same).withColumn(out, F.col("_place") + F.col("_shift")).drop("_g", "_p", "_shift", "_part", "_place")
