"""Reading and writing keyed tables (CSV and parquet)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    fmt: str | None = None,
    infer: bool = False,
) -> DataFrame:
    """Scan a CSV file with a header (either line ending) or a parquet table.

    CSV needs a schema; ``infer=True`` reads the file once more to guess one.
    """
    fmt = fmt or ("csv" if path.rstrip("/").endswith(".csv") else "parquet")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        if schema is None and not infer:
            raise ValueError("a CSV scan needs a schema, or infer=True")
        return reader.csv(path, header=True, nullValue="", inferSchema=schema is None)
    return reader.format(fmt).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write features, targets or ids; CSV gets a header and no index column."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_predictions(
    df: DataFrame,
    key: str,
    label: str,
    path: str,
    fmt: str = "csv",
    as_int: bool = True,
    prediction: str = "prediction",
) -> None:
    """Write ``(key, label)`` rows; the binary task stores the label as an integer."""
    value = F.col(prediction).cast("int") if as_int else F.col(prediction)
    write_table(df.select(key, value.alias(label)), path, fmt)


def check_same_keys(left: DataFrame, right: DataFrame, key: str) -> None:
    """Raise unless both tables hold the same keys, once each."""
    a = left.groupBy(key).agg(F.count("*").alias("left_rows"))
    b = right.groupBy(key).agg(F.count("*").alias("right_rows"))
    odd = (F.col("left_rows").isNull()) | (F.col("right_rows").isNull()) | (F.col("left_rows") > 1) | (F.col("right_rows") > 1)
    bad = a.join(b, key, "full_outer").where(odd).count()
    if bad:
        raise ValueError(f"{bad} keys do not match one to one between features and target")


def load_dataset(
    features: DataFrame,
    key: str,
    target_col: str,
    target_table: DataFrame | None = None,
    validate: bool = True,
) -> DataFrame:
    """Features with their target, joined by key.

    A target column already among the features wins; else it comes from
    ``target_table``. ``validate`` replaces the length check of a positional
    load with a key check.
    """
    if target_col in features.columns:
        return features
    if target_table is None:
        raise ValueError(f"{target_col!r} is not in the features and no target table was given")
    if validate:
        check_same_keys(features, target_table, key)
    return features.join(target_table.select(key, target_col), key, "inner")


def ensure_features(
    spark: SparkSession, path: str, build: Callable[[], DataFrame], fmt: str = "parquet"
) -> DataFrame:
    """Read the stored features, building and storing them first if absent."""
    try:
        return spark.read.format(fmt).load(path)
    except AnalysisException:
        write_table(build(), path, fmt, mode="ignore")
        return spark.read.format(fmt).load(path)
