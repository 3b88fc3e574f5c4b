"""Categorical and label encoding with levels fixed at fit time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from sparktab.functions.expressions import name, num, text
from sparktab.operators.clean import map_values
from sparktab.session import checkpointed

MISSING = "nan"  # fixed value: the name of the level made of missing values
MAX_LEVELS = 10_000  # levels become columns or literals, so their number must be bounded


def level_text(col: str) -> str:
    """The string form a value is encoded by."""
    return f"coalesce(cast({name(col)} AS string), {text(MISSING)})"


def fit_levels(df: DataFrame, cols: Sequence[str], max_levels: int = MAX_LEVELS) -> dict[str, list[str]]:
    """Sorted distinct string forms of each column, in one pass over the table."""
    if not cols:
        return {}
    cells = [F.struct(F.lit(c).alias("feature"), F.expr(level_text(c)).alias("level")) for c in cols]
    pairs = df.select(F.inline(F.array(*cells))).distinct()
    rows = pairs.limit(max_levels * len(cols) + 1).collect()
    found: dict[str, list[str]] = {c: [] for c in cols}
    for r in rows:
        found[r["feature"]].append(r["level"])
    for c, levels in found.items():
        if len(levels) > max_levels:
            raise ValueError(f"{c!r} has more than {max_levels} levels; use code_table and encode_by_table")
    return {c: sorted(v) for c, v in found.items()}


def onehot_columns(col: str, levels: Sequence[str]) -> list[tuple[str, str]]:
    """One 0/1 column per fitted level; an unseen value gives zeros throughout."""
    return [(f"{col}_{v}", f"if({level_text(col)} = {text(v)}, 1D, 0D)") for v in levels]


def label_code(col: str, levels: Sequence[str], unseen: float = -1.0) -> str:
    """Position of the value among the sorted levels; ``unseen`` otherwise."""
    if not levels:
        return num(unseen)
    codes = ", ".join(f"{text(v)}, {num(i)}" for i, v in enumerate(levels))
    return f"coalesce(try_element_at(map({codes}), {level_text(col)}), {num(unseen)})"


def code_table(df: DataFrame, col: str) -> DataFrame:
    """``level, code`` for any number of levels: their positions in sorted order.

    Levels are sorted by ranges; a range's first code is the number of levels in the ranges before it, so neither the
    driver nor one task holds them all. The ranges are written once, because codes must come from the same ones.
    """
    levels = df.select(F.expr(level_text(col)).alias("level")).distinct().repartitionByRange("level")
    ranges = checkpointed(levels).withColumn("part", F.spark_partition_id())
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # a row for each range
    starts = ranges.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    own = F.row_number().over(W.partitionBy("part").orderBy("level")) - 1
    return ranges.withColumn("own", own).join(starts, "part").select("level", (F.col("start") + F.col("own")).cast("double").alias("code"))


def encode_by_table(df: DataFrame, col: str, codes: DataFrame, out: str, unseen: float = -1.0) -> DataFrame:
    """Add the code of ``col`` from a ``code_table``; ``unseen`` where it has none. The join form of ``label_code``."""
    table = codes.select(F.col("level").alias("__level"), F.col("code").alias("__code"))
    joined = df.join(table, F.expr(level_text(col)) == F.col("__level"), "left")
    return joined.withColumn(out, F.coalesce("__code", F.lit(float(unseen)))).drop("__level", "__code")


@dataclass(frozen=True)
class LabelCoder:
    """Codes for the target classes in alphabetical order."""

    label: str
    classes: tuple[str, ...]

    def encode(self, df: DataFrame, out: str) -> DataFrame:
        return df.withColumn(out, F.expr(label_code(self.label, self.classes)))

    def decode(self, df: DataFrame, code: str, out: str) -> DataFrame:
        names = F.array(*[F.lit(c) for c in self.classes])
        return df.withColumn(out, F.try_element_at(names, F.col(code).cast("int") + 1))


def fit_label(df: DataFrame, label: str) -> LabelCoder:
    return LabelCoder(label, tuple(fit_levels(df, [label])[label]))


def preprocess_simple(
    train: DataFrame, test: DataFrame, key: str, mappings: Mapping[str, Mapping]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Coded train and test tables and the test ids. The key stays in the tables."""
    return map_values(train, mappings), map_values(test, mappings), test.select(key)
