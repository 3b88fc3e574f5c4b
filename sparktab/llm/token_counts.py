"""Token counts: batch encoding in Arrow functions that return lengths only."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from sparktab.llm.common import pa_type, rows_of, texts
from sparktab.llm.tokens import default_path, encoder

SCHEMA = "key {}, n_bytes long, n_tokens long"


def token_counts(df: DataFrame, path: str | None = None, limit: int = 2048, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_bytes, n_tokens, over_limit`` for every row, over whole texts.

    Rows are regrouped by bytes inside each Arrow batch, longer texts are cut at safe boundaries, and only the numbers
    leave the function. No shuffle. Null or empty text: zero bytes, zero tokens. Repeated rows and null keys are
    kept as they are; other columns are ignored; an empty table gives an empty result.
    """
    path = path or default_path()
    kind = df.schema[key].dataType.simpleString()

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, counts=True)
        for keys, bodies in rows_of(batches):
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa_type(kind)), pa.array(list(map(len, bodies)), pa.int64()), pa.array(coder.encode(bodies), pa.int64())], ["key", "n_bytes", "n_tokens"])

    counted = texts(df, key, text).mapInArrow(lengths, SCHEMA.format(kind))
    return counted.select(counted["key"].alias(key), "n_bytes", "n_tokens", (counted["n_tokens"] > limit).alias("over_limit"))
