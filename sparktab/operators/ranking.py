"""Exact order statistics without sorting a table in one task.

``percentile`` keeps one map of all values per group, and a window without a
fine partition key sorts a whole class in one task. Both stop working when a
class holds a third of a very large table. Here a rank is found by narrowing:
count equal-width bins inside a bracket, keep the bin that holds the rank,
repeat until the bracket is small, and only then look at single values. Each
pass is a scan with a partial aggregation; only bin counts are shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktab.functions.expressions import finite, is_fractional
from sparktab.session import small_side

DIRECT_ROWS = 4_000_000  # values (rows times columns; those of all brackets) that fit a task with room to spare
BINS = 512
BIN_ROWS = 100_000  # bin counts fetched per pass, over all brackets


@dataclass
class Bracket:
    """A closed value range of one (group, feature) that holds wanted ranks."""

    group: tuple
    feature: str
    low: float
    high: float
    size: int
    ranks: dict[int, int] = field(default_factory=dict)  # wanted rank -> rank inside


@dataclass(frozen=True)
class Ranked:
    """Row count of one (group, feature) and the values at the wanted ranks (0-based)."""

    count: int
    values: dict[int, float]


def _long(df: DataFrame, cols: Sequence[str], by: Sequence[str], kind: str) -> DataFrame:
    cells = []
    for c in cols:
        value = finite(F.col(f"`{c}`")) if kind == "double" else F.col(f"`{c}`").cast("bigint")
        cells.append(F.struct(F.lit(c).alias("feature"), value.alias("value")))
    groups = [F.col(f"`{b}`").alias(f"g{i}") for i, b in enumerate(by)]
    return df.select(*groups, F.inline(F.array(*cells))).where(F.col("value").isNotNull())


def _bracket_frame(df: DataFrame, by: Sequence[str], kind: str, brackets: list[Bracket]) -> DataFrame:
    number = T.DoubleType() if kind == "double" else T.LongType()
    fields = [T.StructField("id", T.IntegerType())]
    fields += [T.StructField(f"b{i}", df.schema[b].dataType) for i, b in enumerate(by)]
    fields += [
        T.StructField("name", T.StringType()),
        T.StructField("low", number),
        T.StructField("high", number),
        T.StructField("ranks", T.ArrayType(T.LongType())),
    ]
    rows = [
        (i, *b.group, b.feature, b.low, b.high, sorted(b.ranks.values()))
        for i, b in enumerate(brackets)
    ]
    return df.sparkSession.createDataFrame(rows, T.StructType(fields))


def _inside(long: DataFrame, frame: DataFrame, by: Sequence[str], rows: int) -> DataFrame:
    match = F.col("feature") == F.col("name")
    for i in range(len(by)):
        match &= F.col(f"g{i}").eqNullSafe(F.col(f"b{i}"))
    match &= F.col("value").between(F.col("low"), F.col("high"))
    return long.join(small_side(frame, rows), match)


def _narrow(long, df, by, kind, wide: list[Bracket], bins: int) -> list[Bracket]:
    bins = max(16, min(bins, BIN_ROWS // len(wide)))
    frame = _bracket_frame(df, by, kind, wide)
    offset = (F.col("value") - F.col("low")).cast("double")
    width = (F.col("high") - F.col("low")).cast("double")
    cell = F.least(F.lit(bins - 1), F.floor(offset / width * bins)).cast("int")
    counts = (
        _inside(long, frame, by, len(wide))
        .groupBy("id", cell.alias("bin"))
        .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        .collect()
    )
    per_bracket: dict[int, list] = {}
    for r in counts:  # at most brackets x bins rows
        per_bracket.setdefault(r["id"], []).append(r)
    out = []
    for i, b in enumerate(wide):
        before, wanted = 0, sorted(b.ranks.items(), key=lambda kv: kv[1])
        for r in sorted(per_bracket[i], key=lambda r: r["bin"]):
            here = {w: rank - before for w, rank in wanted if before <= rank < before + r["n"]}
            if here:
                out.append(Bracket(b.group, b.feature, r["low"], r["high"], r["n"], here))
            before += r["n"]
    return out


def order_values(
    df: DataFrame,
    cols: Sequence[str],
    ranks: Callable[[int], Sequence[int]],
    by: Sequence[str] = (),
    limit: int = DIRECT_ROWS,
    bins: int = BINS,
) -> dict[tuple, Ranked]:
    """Exact values at ``ranks(n)`` of each column, per group.

    Returns ``{(*group, column): Ranked}``: as many entries as classes times
    columns, never rows. Integer columns stay integers.
    """
    kind = "double" if any(is_fractional(df, c) for c in cols) else "bigint"
    long = _long(df, cols, by, kind)
    keys = [f"g{i}" for i in range(len(by))]
    spans = (
        long.groupBy(*keys, "feature")
        .agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
        .collect()
    )
    found: dict[tuple, Ranked] = {}
    work: list[Bracket] = []
    for s in spans:
        group = tuple(s[k] for k in keys)
        found[(*group, s["feature"])] = Ranked(s["n"], {})
        wanted = {r: r for r in ranks(s["n"]) if 0 <= r < s["n"]}
        if wanted:
            work.append(Bracket(group, s["feature"], s["low"], s["high"], s["n"], wanted))

    ready: list[Bracket] = []
    while work:
        wide, room = [], limit // len(work)  # one task may get all brackets
        for b in work:
            if b.low == b.high:
                found[(*b.group, b.feature)].values.update({w: b.low for w in b.ranks})
            elif b.size <= max(room, 1) or not math.isfinite(float(b.high) - float(b.low)):
                ready.append(b)
            else:
                wide.append(b)
        work = _narrow(long, df, by, kind, wide, bins) if wide else []

    if ready:
        frame = _bracket_frame(df, by, kind, ready)
        upto = W.partitionBy("id").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
        hit = F.exists("ranks", lambda r: (r >= F.col("seen") - F.col("n")) & (r < F.col("seen")))
        picked = (
            _inside(long, frame, by, len(ready))
            .groupBy("id", "ranks", "value")
            .agg(F.count("*").alias("n"))
            .withColumn("seen", F.sum("n").over(upto))
            .where(hit)
            .select("id", "value", "n", "seen")
            .collect()
        )
        for r in picked:
            b = ready[r["id"]]
            hits = {w: r["value"] for w, k in b.ranks.items() if r["seen"] - r["n"] <= k < r["seen"]}
            found[(*b.group, b.feature)].values.update(hits)
    return found


def interpolated(ranked: Ranked, prob: float) -> float | None:
    """Linear interpolation between the two nearest order statistics."""
    if not ranked.count:
        return None
    at = (ranked.count - 1) * prob
    low, high = ranked.values[math.floor(at)], ranked.values[math.ceil(at)]
    return low + (high - low) * (at - math.floor(at))


def quantile_ranks(probs: Sequence[float]) -> Callable[[int], list[int]]:
    def ranks(n: int) -> list[int]:
        spots = [(n - 1) * p for p in probs]
        return sorted({f(s) for s in spots for f in (math.floor, math.ceil)})

    return ranks


def largest_group(df: DataFrame, by: Sequence[str] = ()) -> int:
    if not by:
        return df.count()
    row = df.groupBy(*[f"`{b}`" for b in by]).count().agg(F.max("count").alias("n")).collect()[0]
    return row["n"] or 0


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    limit: int = DIRECT_ROWS,
) -> DataFrame:
    """Exact interpolated quantiles: one row ``(*by, feature, q)`` per class and column.

    Groups that fit a task use Spark's exact ``percentile``; larger ones are
    narrowed first, with the same result.
    """
    keys = [F.col(f"`{b}`") for b in by]
    sizes = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    crowded = sizes.where(F.col("__n") * len(cols) > limit)
    large = crowded.collect()  # so few because each holds many rows; all other groups stay in the cluster
    if by and large and len(large) < sizes.count():
        marks = crowded.select(*[k.alias(f"__{b}") for k, b in zip(keys, by)])
        match = reduce(lambda x, y: x & y, [k.eqNullSafe(F.col(f"`__{b}`")) for k, b in zip(keys, by)])
        small = exact_quantiles(df.join(marks, match, "left_anti"), cols, probs, by, limit)
        return small.unionByName(exact_quantiles(df.join(marks, match, "left_semi"), cols, probs, by, limit))
    if not large:
        spots = F.array(*[F.lit(float(p)) for p in probs])
        cells = [F.struct(F.lit(c).alias("feature"), F.percentile(finite(F.col(f"`{c}`")), spots).alias("q")) for c in cols]
        grouped = df.groupBy(*[f"`{b}`" for b in by]).agg(F.array(*cells).alias("cells"))
        return grouped.select(*[f"`{b}`" for b in by], F.inline("cells"))
    found = order_values(df, cols, quantile_ranks(probs), by, limit)
    fields = [T.StructField(b, df.schema[b].dataType) for b in by]
    fields += [T.StructField("feature", T.StringType()), T.StructField("q", T.ArrayType(T.DoubleType()))]
    groups = [tuple(r[b] for b in by) for r in large] if by else [()]
    # a group's column without a finite value has its row too, as in smaller groups
    rows = [(*g, c, [float(interpolated(found[(*g, c)], p)) for p in probs] if (*g, c) in found else None) for g in groups for c in cols]
    return df.sparkSession.createDataFrame(rows, T.StructType(fields))
