"""Column selection, role inference, clean-up and row predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktab.functions.expressions import finite_or, is_fractional, is_numeric
from sparktab.session import small_side


def select_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[f"`{c}`" for c in cols])


def drop_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns; names that do not exist are ignored."""
    return df.drop(*cols)


def split_xy(df: DataFrame, key: str, target: str) -> tuple[DataFrame, DataFrame]:
    """The feature table and the target table, both keeping the key."""
    return df.drop(target), df.select(key, target)


def rows_of_class(df: DataFrame, label: str, value) -> DataFrame:
    return df.where(F.col(label) == F.lit(value))


def infer_roles(df: DataFrame, exclude: Sequence[str] = (), max_card: int = 10) -> tuple[list[str], list[str]]:
    """Numeric and categorical column names.

    The type decides; columns that are neither number nor string count as
    categorical if they hold at most ``max_card`` distinct values.
    """
    names = [c for c in df.columns if c not in exclude]
    numeric = [c for c in names if is_numeric(df, c)]
    text = [c for c in names if isinstance(df.schema[c].dataType, T.StringType)]
    rest = [c for c in names if c not in numeric and c not in text]
    if rest:
        counts = df.agg(*[F.count_distinct(F.col(f"`{c}`")).alias(c) for c in rest]).first()
        for c in rest:
            (text if counts[c] <= max_card else numeric).append(c)
    return numeric, text


def sanitize(df: DataFrame, cols: Sequence[str], value: float = 0.0) -> DataFrame:
    """NULL, NaN and both infinities become ``value``."""
    fixed = {}
    for c in cols:
        col = F.col(f"`{c}`")
        fixed[c] = finite_or(col, value) if is_fractional(df, c) else F.coalesce(col, F.lit(value).cast(df.schema[c].dataType))
    return df.withColumns(fixed)


def align_columns(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly ``names`` in that order: missing ones as 0, extra ones dropped."""
    have = set(df.columns)
    cols = [F.col(f"`{c}`") if c in have else F.lit(0.0).alias(c) for c in names]
    return df.select(*keep, *cols)


def holdout_by_ids(df: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is not listed and rows whose key is listed."""
    listed = small_side(ids.select(key).distinct())
    held = df.join(listed, key, "left_semi")
    if held.isEmpty():
        raise ValueError("no id of the hold-out list occurs in the table")
    return df.join(listed, key, "left_anti"), held


def apply_threshold(df: DataFrame, score: str, t: float = 0.5, out: str = "prediction") -> DataFrame:
    """1 where the score is strictly above the threshold, else 0."""
    return df.withColumn(out, (F.col(score) > F.lit(float(t))).cast("int"))


def preview(df: DataFrame, n: int, order_by: str | Sequence[str]) -> DataFrame:
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*keys).limit(n)


def map_values(df: DataFrame, mapping: Mapping[str, Mapping], suffix: str = "_encoded") -> DataFrame:
    """Replace coded columns by numbers; unlisted values become NULL.

    Meant for short dictionaries written by hand. ``lookup`` serves long ones.
    """
    present = {c: m for c, m in mapping.items() if c in df.columns}
    codes = {}
    for c, m in present.items():
        pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(m.items())])
        codes[c + suffix] = F.try_element_at(pairs, F.col(c)).cast("double")
    return df.withColumns(codes).drop(*present) if codes else df


def lookup(df: DataFrame, col: str, table: DataFrame, value: str, code: str, out: str) -> DataFrame:
    """Dictionary lookup against a table of any size, as a left join."""
    side = table.select(F.col(value).alias("__value"), F.col(code).alias(out))
    return df.join(small_side(side), F.col(col) == F.col("__value"), "left").drop("__value")
