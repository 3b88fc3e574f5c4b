"""SimHash near duplicates by the generalised pigeonhole principle.

Correlated bits are grouped into partitions. Fingerprints at most ``radius`` bits apart lie, in some partition ``i``, at most
``t_i`` bits apart whenever the sum of ``t_i + 1`` is ``radius + 1`` (``t_i = -1``: not probed). The thresholds are allocated by dynamic
programming on candidate counts that are estimated from all fingerprints. Probes meet equal keys by a join, and each
candidate is verified on all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import cut, pa_type, rows_of, texts
from sparktab.llm.components import components

BITS, SEED = 64, 42
# A bucket with more fingerprints is not compared pair by pair but joined through common neighbours.
HOT_BUCKET = 256
# Shingles that are counted at once.
BLOCK = 1 << 15


def shingle_hashes(body: bytes, words: int) -> np.ndarray:
    """XXH64 of each shingle of the lower-cased text; the whole sequence if it is shorter, none if it is empty."""
    found = body.lower().split()  # bytes: A-Z only, and the six ASCII white-space characters
    if not found:
        return np.zeros(0, dtype=np.uint64)
    line = b" ".join(found)
    n = len(found) - words + 1
    digest = xxhash.xxh64_intdigest
    if n <= 1:
        return np.array([digest(line, SEED)], dtype=np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1)
    starts = np.concatenate(([0], ends[: n - 1])).tolist()
    stops = (ends[words - 1 :] - 1).tolist()
    return np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, n)


def majority(hashes: np.ndarray) -> int:
    """The fingerprint: bits set in over half of the hashes; zero without any. As a signed number."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        block = np.ascontiguousarray(hashes[at : at + BLOCK]).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(np.int64)[0])


def fingerprints(df: DataFrame, words: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, mark, fp`` for every row; fp is a signed long, mark a hash of the text. Empty and null texts have fp zero."""
    kind = df.schema[key].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = iter(batch.column(2).to_pylist())
            for keys, bodies in rows_of([batch]):
                fps = [majority(shingle_hashes(b, words)) for b in bodies]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa_type(kind)), pa.array(list(islice(marks, len(fps))), pa.int64()), pa.array(fps, pa.int64())], ["key", "mark", "fp"])

    rows = texts(df, key, text)
    return rows.withColumn("mark", F.xxhash64("body")).mapInArrow(hashed, f"key {kind}, mark long, fp long")


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have both bit i and bit j, over all of them."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS))
        for b in batches:
            values = b.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(values), BLOCK):
                bits = (values[at : at + BLOCK, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
                bits = bits.astype(np.float64)
                both += bits.T @ bits
        cells = np.flatnonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(both.ravel()[cells].astype(np.int64))], ["cell", "n"])

    rows = fps.select("fp").mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # 4,096 at most
    both = np.zeros(BITS * BITS)
    for r in rows:
        both[r["cell"]] = r["n"]
    return fps.count(), both.reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of near equal width; each grows by the bit most correlated with those it has."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    with np.errstate(divide="ignore", invalid="ignore"):
        tie = np.where(spread > 0, np.abs(both / max(n, 1) - np.outer(p, p)) / spread, 0.0)
    np.fill_diagonal(tie, 0.0)
    free, groups = list(range(BITS)), []
    for k in range(parts):
        width = len(free) // (parts - k)
        group = [max(free, key=lambda b: (tie[b, free].sum(), -b))]
        free.remove(group[0])
        while len(group) < width:
            group.append(max(free, key=lambda b: (tie[b, group].sum(), -b)))
            free.remove(group[-1])
        groups.append(sorted(group))
    return groups


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def mask_of(bits: list[int] | tuple[int, ...]) -> int:
    return signed(sum(1 << b for b in bits))


def estimated_costs(pairs: list[int], groups: list[list[int]], n: int, both: np.ndarray, radius: int) -> list[list[float]]:
    """Cost of threshold t (row: partition; column: t + 1): candidates, and probes that have to be sent.

    ``pairs``: pairs that are equal in a partition, counted. Pairs that differ in some bits are estimated from those
    by each bit's odds to differ.
    """
    p = np.diag(both) / max(n, 1)
    same = np.maximum(p * p + (1 - p) ** 2, 1e-9)
    odds = 2 * p * (1 - p) / same
    table = []
    for equal, group in zip(pairs, groups, strict=True):
        row, near = [0.0], np.zeros(radius + 1)
        near[0] = 1.0
        for o in odds[group]:  # elementary symmetric sums
            near[1:] += o * near[:-1].copy()
        probes, seen = 0, 0.0
        for t in range(radius + 1):
            probes += len(list(combinations(group, t)))
            seen += near[t]
            row.append(max(equal, 1) * seen + probes * n)
        table.append(row)
    return table


def allocate(costs: list[list[float]], radius: int) -> list[int]:
    """Thresholds of least total cost whose sum of ``t + 1`` is ``radius + 1``."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for add in range(min(len(row) - 1, radius + 1 - used) + 1):
                new = (cost + row[add], [*chosen, add - 1])
                if used + add not in step or new[0] < step[used + add][0]:
                    step[used + add] = new
        best = step
    return best[radius + 1][1]


def flips(group: list[int], most: int) -> list[int]:
    return [mask_of(c) for k in range(most + 1) for c in combinations(group, k)]


def xored(value: Column, masks: list[int]) -> Column:
    return F.explode(F.transform(F.array(*[F.lit(m) for m in masks]), lambda m: value.bitwiseXOR(m)))


def links(fps: DataFrame, radius: int = 2, parts: int = 3, hot: int = HOT_BUCKET) -> DataFrame:
    """Edges ``a, b`` that connect the same fingerprints as all pairs at most ``radius`` bits apart.

    ``fps`` holds each fingerprint once, in a column ``fp``. Every edge is a verified pair, except in buckets of more than ``hot``
    fingerprints: theirs are hung on the smallest fingerprint that shares a neighbour at one bit. Two fingerprints share one exactly if they are
    at most two bits apart, so nothing is lost, and the work grows with the bucket instead of its square. Radius: 0 to 2.
    """
    if not 0 <= radius <= 2:
        raise ValueError("radius must be 0, 1 or 2")
    n, both = bit_counts(fps)
    groups = group_bits(n, both, parts)
    keyed = reduce(DataFrame.union, [fps.select(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(mask_of(g))).alias("at")) for i, g in enumerate(groups)])
    loads = keyed.groupBy("part", "at").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    equal = {r["part"]: int(r["pairs"]) for r in loads.groupBy("part").agg(F.sum(F.expr("cast(n as double) * (n - 1) / 2")).alias("pairs")).collect()}
    chosen = allocate(estimated_costs([equal.get(i, 0) for i in range(parts)], groups, n, both, radius), radius)
    busy = {r["part"] for r in loads.where(F.col("n") > hot).select("part").distinct().collect()}  # a few numbers
    edges, crowded = [], []
    for i, (group, t) in enumerate(zip(groups, chosen, strict=True)):
        if t < 0:
            continue
        at = F.col("fp").bitwiseAND(F.lit(mask_of(group)))
        index = fps.select(at.alias("at"), F.col("fp").alias("b"))
        probe = fps.select(xored(at, flips(group, t)) if t else at, F.col("fp")).toDF("at", "a")
        if i in busy:
            many = loads.where((F.col("part") == i) & (F.col("n") > hot)).select("at")
            crowded.append(probe.join(many, "at", "left_semi").select(F.col("a").alias("fp")))
            index = index.join(many, "at", "left_anti")
        edges.append(index.join(probe, "at").where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b"))
    if crowded:
        some = reduce(DataFrame.union, crowded).distinct()
        reach = [0, *flips(list(range(BITS)), 1)[1:]] if radius == 2 else [0]
        if radius == 1:
            # one bit apart: equal after clearing that bit
            spots = some.select("fp", F.explode(F.array(*[F.struct(F.lit(b).alias("bit"), F.col("fp").bitwiseAND(F.lit(signed(((1 << 64) - 1) ^ (1 << b)))).alias("x")) for b in range(BITS)])).alias("s")).select("fp", "s.bit", "s.x")
        else:
            spots = some.select("fp", F.lit(0).alias("bit"), xored(F.col("fp"), reach).alias("x"))
        least = spots.groupBy("bit", "x").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
        edges.append(spots.join(least, ["bit", "x"]).where("fp <> a").select("a", F.col("fp").alias("b")).distinct())
    return reduce(DataFrame.union, edges)


def grouped(df: DataFrame, words: int, radius: int, parts: int, key: str, text: str) -> DataFrame:
    """``key, mark, fp, root, component_id`` for every row; root is the group's own fingerprint."""
    own = cut(fingerprints(df, words, key, text))
    fps = cut(own.groupBy("fp").agg(F.min("key").alias("first")))
    roots = components(links(fps.select("fp"), radius, parts))
    members = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("root"))
    least = members.groupBy("root").agg(F.min("first").alias("component_id"))
    return own.join(members.join(least, "root").select("fp", "root", "component_id"), "fp")


def simhash_groups(df: DataFrame, words: int = 3, radius: int = 2, parts: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fingerprint, component_id`` for every row; the fingerprint is 16 hex digits.

    component_id is the smallest key reachable over fingerprints at most ``radius`` bits apart. Equal fingerprints are one node, so
    any number of copies costs one comparison. Null and empty texts have fingerprint zero and link like others. A row with a
    null key gets its group's smallest key (null if it has none); repeated rows stay; other columns are ignored; an empty table gives no rows.
    """
    out = grouped(df, words, radius, parts, key, text)
    return out.select(F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each(df: DataFrame, words: int = 3, radius: int = 2, parts: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, with one row for each group: that of the smallest key (a null key only if there is no other).

    Of rows with that key the one with the least hash of its text stays, of repeated ones any. An empty table gives no rows; other columns and their names are
    of no effect. Rows meet the keys that stay by key and text hash, so texts are shuffled at most once.
    """
    found = grouped(df, words, radius, parts, key, text)
    own = found.where(F.col("key").eqNullSafe(F.col("component_id"))).groupBy("root", "key", "mark").agg(F.count(F.lit(1)).alias("same"))
    stays = own.groupBy("root").agg(F.min(F.struct("mark", "key", "same")).alias("s")).select(F.col("s.key").alias("kept_key"), F.col("s.mark").alias("kept_mark"), F.col("s.same").alias("same"))
    stays = cut(stays)
    body = F.coalesce(df[text], F.lit("")).cast("binary")
    rows = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"), df[key].alias("own_key"), F.xxhash64(body).alias("own_mark"))
    left = rows.join(stays, F.col("own_key").eqNullSafe(F.col("kept_key")) & (F.col("own_mark") == F.col("kept_mark")))
    once = left.where("same = 1").select("row")
    if stays.where("same > 1").isEmpty():
        return once.select("row.*")
    again = left.where("same > 1").groupBy("own_key", "own_mark").agg(F.first("row").alias("row")).select("row")
    return once.union(again).select("row.*")
