"""Ranks of rows inside groups of any size: range partitions, ids in file order, one offset for each partition and group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparktab.llm.common import cut

ROW_BITS = 33  # monotonically_increasing_id: rows of a partition below, partitions above


def numbered(df: DataFrame, groups: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """``df`` with ``idx`` (0, 1, 2, ... in the group) and ``n`` (rows of the group).

    ``groups`` hold no nulls, ``groups`` and ``order`` together tell all rows apart. A group may hold any share of the rows: ranges cut it at any row, and
    only its counts by partition meet in one place. The sorted rows are written once, because ranks must belong to the rows that are returned.
    """
    keys = [*groups, *order]
    rows = cut(df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()))
    rows = rows.withColumn("part", F.shiftright("at", ROW_BITS))
    found = rows.groupBy(*groups, "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("own"))
    whole = W.partitionBy(*groups)
    before = F.coalesce(F.sum("own").over(whole.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = found.select(*groups, "part", (before - F.col("first")).alias("shift"), F.sum("own").over(whole).alias("n"))
    return rows.join(offsets, [*groups, "part"]).withColumn("idx", F.col("at") + F.col("shift")).drop("at", "part", "shift")
