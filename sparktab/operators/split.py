"""Deterministic splits, folds and bootstrap draws.

Rows are ordered by a hash of seed and key, so the result does not depend on
partitioning and any engine with md5 can repeat it. A split or fold is a cut in
that order: the cut values are found exactly (see ``ranking``) and every row is
then compared with the cuts of its class. That is a narrow projection; no class
is ever sorted in one task, however large its share of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktab.functions.expressions import hash60, poisson_weight, unit_hash, unit_hash52
from sparktab.operators.ranking import DIRECT_ROWS, order_values
from sparktab.session import small_side


def _cut_index(
    df: DataFrame, order: Column, by: Sequence[str], starts: Callable[[int], Sequence[int]], out: str, limit: int
) -> DataFrame:
    """Number of blocks that start at or before each row, minus one.

    ``starts(n)`` are the 0-based ranks where blocks begin (rank 0 left out).
    """
    ordered = df.withColumn("__pos", order)
    found = order_values(ordered, ["__pos"], lambda n: [s for s in starts(n) if s < n], by, limit)

    def cuts(count: int, values: dict[int, int]) -> list[int]:
        return sorted(values[s] for s in starts(count) if s < count)

    if not by:
        ranked = found.get(("__pos",))
        marks = cuts(ranked.count, ranked.values) if ranked else []
        index = sum((F.when(F.col("__pos") >= F.lit(m), 1).otherwise(0) for m in marks), F.lit(0))
        return ordered.withColumn(out, index.cast("int")).drop("__pos")
    fields = [T.StructField(f"__b{i}", df.schema[b].dataType) for i, b in enumerate(by)]
    fields.append(T.StructField("__cuts", T.ArrayType(T.LongType())))
    rows = [(*key[:-1], cuts(r.count, r.values)) for key, r in found.items()]
    side = df.sparkSession.createDataFrame(rows, T.StructType(fields))
    match = F.lit(True)
    for i, b in enumerate(by):
        match &= F.col(f"`{b}`").eqNullSafe(F.col(f"__b{i}"))
    index = F.size(F.filter("__cuts", lambda c: c <= F.col("__pos")))
    joined = ordered.join(small_side(side, len(rows)), match)
    return joined.withColumn(out, index.cast("int")).drop("__pos", "__cuts", *[f"__b{i}" for i in range(len(by))])


def fold_starts(k: int) -> Callable[[int], list[int]]:
    """Where ``k`` contiguous blocks begin whose sizes differ by at most one."""

    def starts(n: int) -> list[int]:
        small, extra = divmod(n, k)
        return [i * small + min(i, extra) for i in range(1, k)]

    return starts


def stratified_split(
    df: DataFrame, key: str, label: str, frac: float = 0.2, seed: int = 42, out: str = "is_test", limit: int = DIRECT_ROWS
) -> DataFrame:
    """Mark ``round(frac * n)`` rows of each class as test rows."""
    def starts(n: int) -> list[int]:
        return [math.floor(frac * n + 0.5)]

    cut = _cut_index(df, hash60(seed, F.col(key)), [label], starts, "__after", limit)
    return cut.withColumn(out, F.col("__after") == 0).drop("__after")


def train_test(df: DataFrame, key: str, label: str, frac: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    marked = stratified_split(df, key, label, frac, seed)
    return marked.where(~F.col("is_test")).drop("is_test"), marked.where("is_test").drop("is_test")


def stratified_folds(
    df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42, shuffle: bool = True,
    out: str = "fold", limit: int = DIRECT_ROWS,
) -> DataFrame:
    """Folds 0..k-1 with every class spread evenly; unshuffled folds follow the key.

    Unshuffled folds need an integer key.
    """
    order = hash60(seed, F.col(key)) if shuffle else F.col(key).cast("bigint")
    return _cut_index(df, order, [label], fold_starts(k), out, limit)


def kfold(df: DataFrame, key: str, k: int = 5, seed: int = 42, out: str = "fold", limit: int = DIRECT_ROWS) -> DataFrame:
    """Shuffled folds that ignore the classes; sizes differ by at most one."""
    return _cut_index(df, hash60(seed, F.col(key)), [], fold_starts(k), out, limit)


def per_class(label: Column, values: dict) -> Column:
    """A number looked up by class, written out as a CASE over the classes."""
    out = F.lit(None).cast("double")
    for c, v in values.items():
        out = F.when(label.eqNullSafe(F.lit(c)), F.lit(float(v))).otherwise(out)
    return out


def class_quotas(counts: dict, n: int) -> dict:
    """Split ``n`` over the classes in proportion, largest remainder first."""
    total = sum(counts.values())
    exact = {c: n * v / total for c, v in counts.items()}
    quota = {c: math.floor(x) for c, x in exact.items()}
    rest = sorted(exact, key=lambda c: (quota[c] - exact[c], str(c)))
    for c in rest[: n - sum(quota.values())]:
        quota[c] += 1
    return quota


def stratified_bootstrap(
    df: DataFrame, key: str, label: str, n: int, seed: int = 42, bucket_rows: int = 10_000
) -> DataFrame:
    """``n`` rows drawn with replacement, classes in proportion; all rows if ``n`` is not smaller.

    A draw is a random rank inside its class. Rows get ranks in two levels:
    hash bucket, then position inside the bucket. Only buckets that were drawn
    are ranked.
    """
    spark = df.sparkSession
    found = df.groupBy(label).count().collect()
    counts = {r[0]: r[1] for r in sorted(found, key=lambda r: str(r[0]))}
    if n >= sum(counts.values()):
        return df.withColumn("draw", F.lit(None).cast("bigint"))
    bits = max(0, min(36, math.ceil(math.log2(max(counts.values()) / bucket_rows))))
    bucket = F.shiftright("__h", 60 - bits) if bits else F.lit(0).cast("bigint")
    rows = df.withColumn("__h", hash60(seed, F.col(key))).withColumn("__bucket", bucket)
    upto = W.partitionBy(label).orderBy("__bucket").rowsBetween(W.unboundedPreceding, 0)
    spans = (
        rows.groupBy(label, "__bucket").agg(F.count("*").alias("n"))
        .withColumn("stop", F.sum("n").over(upto))
        .select(F.col(label).alias("c"), F.col("__bucket").alias("b"), (F.col("stop") - F.col("n")).alias("start"), "stop")
    )
    quota, first = class_quotas(counts, n), 0
    names, size_of, owner, size = list(counts), {c: counts[c] for c in counts}, F.lit(0), F.lit(1)
    for i, c in enumerate(names):
        inside = (F.col("draw") >= first) & (F.col("draw") < first + quota[c])
        owner, size = F.when(inside, i).otherwise(owner), F.when(inside, counts[c]).otherwise(size)
        first += quota[c]
    classes = F.array(*[F.lit(c).cast(df.schema[label].dataType) for c in names])
    draws = spark.range(n).withColumnRenamed("id", "draw").select("draw", F.get(classes, owner).alias("c"), size.cast("bigint").alias("size"))
    draws = draws.withColumn("rank", F.floor(unit_hash52(f"{seed}-draw", F.col("draw")) * F.col("size")).cast("bigint"))
    # ranks meet buckets through a coarse cell, so this is an equi join, not a range scan
    width = F.greatest(F.lit(1), F.ceil(F.col("size") / F.lit(2**bits))).cast("bigint")
    cut = spans.withColumn("size", per_class(F.col("c"), size_of).cast("bigint"))
    cut = cut.withColumn("cell", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor((F.col("stop") - 1) / width))))
    cut = cut.select(F.col("c").alias("sc"), "b", "start", "stop", "cell")
    hit = draws.withColumn("dcell", F.floor(F.col("rank") / width)).join(
        cut, F.col("c").eqNullSafe(F.col("sc")) & (F.col("dcell") == F.col("cell")) & (F.col("rank") >= F.col("start")) & (F.col("rank") < F.col("stop"))
    )
    wanted = hit.select("draw", F.col("sc").alias("wc"), F.col("b").alias("wb"), (F.col("rank") - F.col("start") + 1).alias("wr"))
    hot = wanted.select(F.col("wc").alias("hc"), F.col("wb").alias("hb")).distinct()
    order = W.partitionBy(label, "__bucket").orderBy("__h", key)
    ranked = rows.join(
        small_side(hot), F.col(label).eqNullSafe(F.col("hc")) & (F.col("__bucket") == F.col("hb")), "left_semi"
    ).withColumn("__r", F.row_number().over(order))
    match = F.col(label).eqNullSafe(F.col("wc")) & (F.col("__bucket") == F.col("wb")) & (F.col("__r") == F.col("wr"))
    return ranked.join(wanted, match).drop("__h", "__bucket", "__r", "wc", "wb", "wr")


def bootstrap_replicas(df: DataFrame, key: str, frac: float = 0.8, n: int = 20, seed: int = 42) -> DataFrame:
    """``n`` bagging replicas: each row with its number of copies in a replica (0 left out).

    Copies follow Poisson(frac), the limit of drawing ``frac * rows`` rows with
    replacement; every row decides by itself, so nothing is shuffled.
    """
    drawn = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda r: F.struct(r.alias("replica"), replica_copies(key, r, frac, seed).alias("copies")))
    each = df.withColumn("__r", F.explode(F.filter(drawn, lambda d: d["copies"] > 0)))
    return each.select(*[F.col(f"`{c}`") for c in df.columns], "__r.replica", "__r.copies")


def replica_copies(key: str, replica: Column | int, frac: float, seed: int = 42) -> Column:
    """Copies of a row in one replica: a column, so that a single replica needs neither the others nor a join."""
    r = replica if isinstance(replica, Column) else F.lit(replica)
    return poisson_weight(unit_hash(seed, r, F.col(key)), frac)


def class_weights(df: DataFrame, label: str, mode: str = "balanced", out: str = "weight") -> DataFrame:
    """Add ``n / (K * n_class)``, or with ``mode='ratio'`` ``n0 / n1`` on class 1 and 1 on class 0."""
    return df.withColumn(out, per_class(F.col(label), weight_table(df, label, mode)))


def weight_table(df: DataFrame, label: str, mode: str = "balanced") -> dict:
    """Class weights as numbers; one aggregation, as many entries as classes."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect() if r[0] is not None}
    if mode == "ratio":
        ones, zeros = counts.get(1, 0), counts.get(0, 0)
        return {0: 1.0, 1: zeros / ones if ones else 1.0}
    total = sum(counts.values())
    return {c: total / (len(counts) * n) for c, n in counts.items()}
