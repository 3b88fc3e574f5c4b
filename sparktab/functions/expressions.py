"""Column expressions shared by the operators. All of them stay in the JVM."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPS = 1e-8  # fixed value: the guard added to every denominator
INF = float("inf")


# Wide projections are written as SQL text: building hundreds of columns call
# by call costs seconds on the driver.


def num(v: float) -> str:
    """A double literal."""
    return f"({float(v)!r}D)"


def name(c: str) -> str:
    """A quoted column name."""
    return "`" + c.replace("`", "``") + "`"


def text(v: str) -> str:
    """A string literal."""
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def finite_sql(x: str, otherwise: str = "NULL") -> str:
    return f"if(abs({x}) < double('Infinity'), {x}, {otherwise})"


def is_numeric(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.NumericType)


def is_fractional(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.FractionalType)


def finite(c: Column) -> Column:
    """The value, or NULL where it is NULL, NaN or infinite.

    Spark orders NaN above infinity, so one comparison covers both.
    """
    x = c.cast("double")
    return F.when(F.abs(x) < F.lit(INF), x)


def finite_or(c: Column, value: float = 0.0) -> Column:
    x = c.cast("double")
    return F.when(F.abs(x) < F.lit(INF), x).otherwise(F.lit(float(value)))


def missing(df: DataFrame, col: str) -> Column:
    """True for NULL and, in fractional columns, for NaN."""
    c = F.col(name(col))
    return (c.isNull() | F.isnan(c)) if is_fractional(df, col) else c.isNull()


def known(df: DataFrame, col: str) -> Column:
    """The column with NaN turned into NULL, so that aggregates skip it."""
    c = F.col(name(col))
    return F.when(~F.isnan(c), c) if is_fractional(df, col) else c


def safe_share(part: Column, whole: Column) -> Column:
    """``part / whole`` with 0 where it is undefined."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def hash60(seed: int | str, *keys: Column) -> Column:
    """A 60-bit position in a random order that any engine with md5 can repeat."""
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def unit_hash(seed: int | str, *keys: Column) -> Column:
    """A repeatable uniform number in [0, 1) with 32 bits."""
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def unit_hash52(seed: int | str, *keys: Column) -> Column:
    """The same with 52 bits: every rank of a group of up to 2^52 rows can be drawn."""
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def poisson_bounds(rate: float) -> list[float]:
    """Cumulative Poisson chances up to where no 32-bit uniform number lies beyond."""
    bounds, i, term, total = [], 0, math.exp(-rate), 0.0
    while total < 1 - 2.0**-34 and (i <= rate or term > 0):
        total += term
        bounds.append(total)
        i += 1
        term *= rate / i
    return bounds


def poisson_weight(u: Column, rate: float) -> Column:
    """Number of copies of a row in a Poisson(rate) bootstrap, by inverting the CDF.

    ``u`` is bound once as an array element, so that a hash is evaluated once per row.
    """
    steps = lambda x: sum((F.when(x >= F.lit(b), 1).otherwise(0) for b in poisson_bounds(rate)), F.lit(0))
    return F.transform(F.array(u), steps)[0].cast("int")


def best_index(scores: Column) -> Column:
    """Position (0-based) of the largest entry of an array; the first one on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def vector_of(features: Sequence[str]) -> Column:
    """The features as one array column."""
    return F.expr("array(" + ", ".join(f"double({name(c)})" for c in features) + ")")
