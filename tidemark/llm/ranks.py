"""Places of rows within their groups, without a task that holds a whole group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import shuffle_count, stored


def ranked(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``df`` with ``place`` (from 0, in its group, by ``order``, nulls first) and
    ``group_rows``; null is a group of its own.

    Rows are dealt by ranges of (group, order); a task numbers its own rows, and a
    row for each task and group tells what earlier ranges hold of the group. Rows
    equal in all these columns are told apart by a running number, so one group,
    or copies of one row, may hold any share of the rows. ``df`` is read twice
    (once for the bounds of the ranges).
    """
    keys = [*(F.col(c).asc_nulls_first() for c in (group, *order)), F.col("__tie")]
    dealt = stored(df.withColumn("__tie", F.monotonically_increasing_id())
                   .repartitionByRange(shuffle_count(df.sparkSession), *keys).sortWithinPartitions(*keys).drop("__tie")
                   .withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), name)
    own = dealt.groupBy("__part", group).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(group).orderBy("__part")            # a row for each task
    parts = stored(own.select(F.col("__part").alias("__own"), F.col(group).alias("__group"), "__first",
                              (F.sum("__n").over(before) - F.col("__n")).alias("__before"),
                              F.sum("__n").over(Window.partitionBy(group)).alias("group_rows")), f"{name}-parts", "snappy")
    return (dealt.join(parts, (F.col("__part") == F.col("__own")) & F.col(group).eqNullSafe(F.col("__group")))
            .select(*df.columns, (F.col("__at") - F.col("__first") + F.col("__before")).alias("place"), "group_rows"))
