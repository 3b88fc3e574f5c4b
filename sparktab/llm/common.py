"""What the operators share: projections safe against clashing names, bounded Arrow batches, cut lineage."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.session import ensure_checkpoint_dir

# Texts are handed on in groups of about this many bytes, however many rows that is.
GROUP_BYTES = 1 << 20
# Arrow batches that Spark sends to a task hold about this many bytes at most (a longer row goes alone).
BATCH_BYTES = 4 << 20
ARROW = {
    "tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64(), "float": pa.float32(), "double": pa.float64(), "string": pa.string(),
    "binary": pa.binary(), "boolean": pa.bool_(), "date": pa.date32(), "timestamp": pa.timestamp("us", tz="UTC"), "timestamp_ntz": pa.timestamp("us"),
}


def pa_type(kind: str) -> pa.DataType:
    """Arrow type of a key column, from Spark's short name of its type (workers can't ask Spark)."""
    if m := re.fullmatch(r"decimal\((\d+),(\d+)\)", kind):
        return pa.decimal128(int(m[1]), int(m[2]))
    if kind not in ARROW:
        raise TypeError(f"keys of type {kind} are not supported")
    return ARROW[kind]


def bytes_of(setting: str) -> int:
    """Bytes of a Spark size such as ``4194304``, ``64m`` or ``-1``."""
    m = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", setting.strip().lower())
    if not m:
        raise ValueError(f"not a size: {setting}")
    return int(m[1]) << 10 * " kmgtp".index(m[2] or " ")


def small_batches(df: DataFrame) -> DataFrame:
    """Bound the Arrow batches of the session in bytes, unless it has a lower bound already.

    A batch is held in the JVM, in transfer and in Python at once; ten thousand long texts would be a gigabyte each time.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < bytes_of(conf.get(name)) <= BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return df


def texts(df: DataFrame, key: str = "doc_id", text: str = "text", *others: str) -> DataFrame:
    """Key and text (as UTF-8 bytes, null as empty) and the named columns; all other columns stay behind.

    Operators start from this projection, so extra columns of the input can have any names.
    """
    small_batches(df)
    body = F.coalesce(df[text], F.lit("")).cast("binary").alias("body")
    return df.select(df[key].alias("key"), body, *[df[c] for c in others])


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from the files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def by_bytes(keys: list, bodies: list[bytes], limit: int = GROUP_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """Split the rows of a batch into groups of about ``limit`` bytes, each with one row at least."""
    k, b, size = [], [], 0
    for key, body in zip(keys, bodies, strict=True):
        if b and size + len(body) > limit:
            yield k, b
            k, b, size = [], [], 0
        k.append(key)
        b.append(body)
        size += len(body)
    if b:
        yield k, b


def give_back() -> None:
    """Return freed memory to the system: workers live on from stage to stage beside a JVM that has grown."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def rows_of(batches: Iterator[pa.RecordBatch], limit: int = GROUP_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """Keys and bodies of Arrow batches of ``texts``, regrouped by bytes."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            yield from by_bytes(part.column(0).to_pylist(), part.column(1).to_pylist(), limit)
        give_back()


def hash_of(*columns: Column) -> Column:
    """A non-negative 63-bit hash of the columns."""
    return F.xxhash64(*columns).bitwiseAND(F.lit((1 << 63) - 1))
