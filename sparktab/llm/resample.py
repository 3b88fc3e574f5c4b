"""Importance resampling towards a target: hashed word n-grams, array-scored weights, Gumbel noise, a distributed radix sort.

Two bucket counts (corpus and target) give one gain for each bucket; a document's weight is the mean of its features' gains. Drawing the highest sums of weight and Gumbel noise is
drawing without replacement with chances that follow the weights.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegralType, LongType, StructField, StructType

from sparktab.llm.common import cut, rows_of, texts
from sparktab.llm.radix import radix_sort

ONES = np.uint32(0xFFFFFFFF)
SEGMENT = 1 << 20
SIGN = 1 << 63


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, np.uint32(0xEDB88320) ^ (c >> np.uint32(1)), c >> np.uint32(1))
    return c.astype(np.uint32)


CRC = _crc_table()
# A-Z to a-z; letters, digits and all bytes above 127 belong to words.
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
IN_WORD = np.zeros(256, dtype=bool)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = True


def advance(state: np.ndarray, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of many byte runs side by side: ``state`` (final form) after the bytes ``data[start : start + length]``."""
    order = np.argsort(-length, kind="stable")
    at, s = start[order], ~state[order]
    reach = np.searchsorted(-length[order], -np.arange(1, (int(length.max()) if len(length) else 0) + 1), side="right")  # runs that have a j-th byte
    for j, m in enumerate(reach.tolist()):
        if m < 8:  # few very long words are left
            for k in range(m):
                a, n = int(at[k]), int(length[order[k]])
                s[k] = ~np.uint32(zlib.crc32(data[a + j : a + n].tobytes(), int(~s[k])))
            break
        s[:m] = CRC[(s[:m] ^ data[at[:m] + j]) & np.uint32(255)] ^ (s[:m] >> np.uint32(8))
    out = np.empty_like(s)
    out[order] = ~s
    return out


def segments(body: bytes, limit: int = SEGMENT) -> Iterator[bytes]:
    """Cut a long text before ASCII white space; a run without any stays whole."""
    at = 0
    while len(body) - at > limit:
        found = [p for p in (body.find(c, at + limit) for c in (b" ", b"\n", b"\t")) if p >= 0]
        if not found:
            break
        yield body[at : min(found)]
        at = min(found)
    yield body[at:]


def buckets_of(bodies: list[bytes], buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first text, bucket, text)`` for groups of texts: the buckets of all their features, and which text each is of.

    Features are words and pairs of neighbouring words, joined by a space; repeats count. A text longer than ``SEGMENT`` comes in several groups.
    """
    todo, size, first = [], 0, 0
    for i, body in enumerate(bodies):
        if len(body) <= SEGMENT and size + len(body) <= SEGMENT:
            todo.append(body)
            size += len(body)
            continue
        if todo:
            yield (first, *_features(todo, None, buckets)[:2])
        todo, size, first = [body], len(body), i
        if len(body) > SEGMENT:
            last = None
            for part in segments(body):
                bucket, owner, last = _features([part], last, buckets)
                yield i, bucket, owner
            todo, size, first = [], 0, i + 1
    if todo:
        yield (first, *_features(todo, None, buckets)[:2])


def _features(bodies: list[bytes], previous: int | None, buckets: int) -> tuple[np.ndarray, np.ndarray, int | None]:
    """Buckets and owners of one group. previous: CRC of the last word before it, if the first text goes on from there."""
    data = LOWERED[np.frombuffer(b"\0" + b"\0".join(bodies) + b"\0", dtype=np.uint8)]
    inside = IN_WORD[data].view(np.int8)
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    length = end - start
    limits = np.cumsum([len(b) + 1 for b in bodies])
    owner = np.searchsorted(limits, start, side="left") if len(start) else start
    words = advance(np.zeros(len(start), dtype=np.uint32), data, start, length)
    spaced = ~(CRC[(~words ^ np.uint32(32)) & np.uint32(255)] ^ (~words >> np.uint32(8)))
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    pairs = advance(spaced[pair], data, start[pair + 1], length[pair + 1])
    values, owners = [words, pairs], [owner, owner[pair]]
    if previous is not None and len(start):
        joined = zlib.crc32(data[start[0] : end[0]].tobytes(), zlib.crc32(b" ", previous))
        values.append(np.array([joined], dtype=np.uint32))
        owners.append(owner[:1])
    last = int(words[-1]) if len(words) else previous
    return (np.concatenate(values) % np.uint32(buckets)).astype(np.int64), np.concatenate(owners), last


def bucket_counts(df: DataFrame, buckets: int, text: str = "text") -> np.ndarray:
    """Features of all texts by bucket: a row for each bucket and task is shuffled, one for each bucket reaches the driver."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for _, bodies in rows_of(batches):
            for _, bucket, _ in buckets_of(bodies, buckets):
                total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    found = texts(df, text, text).select(F.lit(0).alias("key"), "body").mapInArrow(counted, "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the smoothed shares of each bucket, rounded down."""
    buckets, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    ratio = [((t + 1.0) * (s_all + float(buckets))) / ((s + 1.0) * (t_all + float(buckets))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)]
    return np.array([math.floor(1000.0 * math.log(r)) for r in ratio], dtype=np.int64)


def noise(key: int | None, seed: int = 7) -> int:
    """Gumbel noise in thousandths, from the key alone."""
    h = int(hashlib.sha256(f"{seed}:{'-' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000.0 * math.log(-math.log((h + 0.5) / 4294967296.0)))


def scored(df: DataFrame, gain: np.ndarray, seed: int = 7, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_features, weight, score`` for every row."""
    if not isinstance(df.schema[key].dataType, IntegralType):
        raise TypeError(f"{key} must be a column of integers, its digits are sorted")
    schema = StructType([StructField("key", df.schema[key].dataType), *[StructField(c, LongType()) for c in ("n_features", "weight", "score")]])
    arrow, buckets = to_arrow_schema(schema), len(gain)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, bodies in rows_of(batches):
            n, total = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
            for first, bucket, owner in buckets_of(bodies, buckets):
                np.add.at(total, first + owner, gain[bucket])
                n += np.bincount(first + owner, minlength=len(keys))
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            score = weight + np.array([noise(k, seed) for k in keys], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys, arrow.field(0).type), pa.array(n), pa.array(weight), pa.array(score)], schema=arrow)

    return texts(df, key, text).mapInArrow(weighed, schema)


def resample(df: DataFrame, target: DataFrame, percent: int = 25, buckets: int = 10_000, least_words: int = 20, seed: int = 7, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_features, weight, score, rank`` for every row; rank is null for rows that are not drawn.

    Of the rows with ``least_words`` words or more, ``percent`` per cent (rounded down) with the highest scores are drawn, ties to the smaller key, a null key
    last. A null or empty text has no features and weight 0. Repeated rows are drawn one by one, rows of equal key and score in any order; an empty target has only smoothed
    shares; other columns are ignored; an empty table gives no rows. What the driver holds is one count for each bucket and one for each digit.
    """
    gain = gains(bucket_counts(df, buckets, text), bucket_counts(target, buckets, text))
    rows = cut(scored(df, gain, seed, key, text))
    enough = F.col("n_features") >= max(1, 2 * least_words - 1) if least_words > 0 else F.lit(True)
    id_ = F.col("key").cast("long").bitwiseXOR(F.lit(-SIGN))  # unsigned order
    found = rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(enough).alias("open"), F.max("score").alias("top"), F.min("score").alias("low"),
        F.min("key").cast("long").alias("a"), F.max("key").cast("long").alias("b"), F.count_if(F.col("key").isNull()).alias("nulls"),
    ).first()
    total = found["rows"]
    top, low = found["top"] or 0, found["low"] or 0
    keys = [("high", (top - low + 1).bit_length()), ("bare", min(1, found["nulls"])), ("low", ((found["a"] or 0) ^ (found["b"] or 0)) % (1 << 64))]
    keys = [(c, n if c != "low" else n.bit_length()) for c, n in keys]
    ready = rows.select(
        "*", F.when(enough, F.lit(top) - F.col("score")).otherwise(F.lit(top - low + 1)).cast("long").alias("high"),
        F.col("key").isNull().cast("long").alias("bare"), F.coalesce(id_, F.lit(0)).cast("long").alias("low"),
    )
    drawn = percent * found["open"] // 100
    ranked = radix_sort(ready, keys, total)
    rank = F.when(F.col("position") < drawn, F.col("position") + 1)
    return ranked.select(F.col("key").alias(key), "n_features", "weight", "score", rank.cast("long").alias("rank"))
