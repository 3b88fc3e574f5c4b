"""Distributed radix sort from the least significant digit: stable counting passes with global prefix offsets."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from sparktab.llm.common import cut

# A destination partition holds this many rows at most.
ROWS_PER_PART = 1 << 20


def labelled(rows: DataFrame, digit: Column, size: int) -> DataFrame:
    """``rows`` with ``digit``, ``part`` (their partition) and ``nth`` (rank among the rows of this digit in the partition)."""
    rows = rows.withColumn("digit", digit.cast("int"))
    out = StructType([*rows.schema.fields, StructField("part", IntegerType()), StructField("nth", LongType())])
    schema, spot = to_arrow_schema(out), rows.columns.index("digit")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, part = np.zeros(size, dtype=np.int64), TaskContext.get().partitionId()
        for b in batches:
            d = b.column(spot).to_numpy()
            counts = np.bincount(d, minlength=size)
            order = np.argsort(d.astype(np.uint16), kind="stable")  # a counting sort for 16-bit digits
            first = np.cumsum(counts) - counts
            nth = np.empty(len(d), dtype=np.int64)
            nth[order] = np.arange(len(d)) - first[d[order]] + seen[d[order]]
            seen += counts
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(d), part, dtype=np.int32)), pa.array(nth)], schema=schema)

    return rows.mapInArrow(counted, out)


def counting_pass(rows: DataFrame, digit: Column, size: int, total: int) -> DataFrame:
    """Move every row to its place by one digit, rows of one digit in their old order; adds ``position`` (0, 1, 2, ...).

    ``rows`` lie in checkpoint files, so that each reading finds the same rows in the same partitions and order.
    """
    spark = rows.sparkSession
    old = rows.drop("position")
    counts = old.groupBy(digit.cast("int").alias("digit"), F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("own"))
    totals = {r["digit"]: r["n"] for r in counts.groupBy("digit").agg(F.sum("own").alias("n")).collect()}  # ``size`` numbers at most
    base, starts = 0, []
    for d in sorted(totals):
        starts.append((d, base))
        base += totals[d]
    earlier = W.partitionBy("digit").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = counts.select("digit", "part", F.coalesce(F.sum("own").over(earlier), F.lit(0)).alias("before"))
    offsets = before.join(F.broadcast(spark.createDataFrame(starts, "digit int, base long")), "digit").select("digit", "part", (F.col("base") + F.col("before")).alias("offset"))
    placed = labelled(old, digit, size).join(offsets, ["digit", "part"]).select(*old.columns, (F.col("offset") + F.col("nth")).alias("position"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // ROWS_PER_PART))
    each = max(1, -(-total // parts))
    return cut(placed.repartitionById(parts, F.expr(f"int(position div {each})")).sortWithinPartitions("position"))


def radix_sort(rows: DataFrame, keys: Sequence[tuple[str, int]], total: int, width: int = 12) -> DataFrame:
    """``rows`` with ``position``, their rank from 0 by the keys.

    keys: columns of type long, most significant first, each with the number of its low bits that tell rows apart (as an unsigned number). Rows with equal keys keep
    their order. Each pass writes the rows once. Hot digits don't matter: destinations are places, dealt in equal shares.
    """
    if not 0 < width <= 16:
        raise ValueError("digits have 1 to 16 bits")
    rows = rows.withColumn("position", F.lit(0).cast("long"))
    digits = [(c, at, min(width, bits - at)) for c, bits in reversed(keys) for at in range(0, bits, width)]
    for c, at, bits in digits or [(keys[-1][0], 0, 1)]:
        digit = F.shiftrightunsigned(c, at).bitwiseAND(F.lit((1 << bits) - 1)) if digits else F.lit(0)
        rows = counting_pass(rows, digit, 1 << bits, total)
    return rows
