"""Best-fit packing of token sequences by large-item matching.

The plan is made from the number of pieces of each length (at most ``capacity`` numbers, whatever the size of the corpus):
lengths above a third of the capacity are matched greedily, at most two to a sequence; shorter ones fill the
smallest gap that takes them. Equal steps are made for whole ranges of sequences at once. Each piece then finds its place
from its length and its rank among the pieces of that length.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sparktab.llm.common import cut, pa_type, rows_of, texts
from sparktab.llm.tokens import default_path, encoder


@dataclass(frozen=True)
class Step:
    """Pieces ``rank .. rank + count - 1`` of a length go, ``each`` to a sequence, to ``sequence ...`` from ``offset`` on."""

    length: int
    rank: int
    count: int
    sequence: int
    offset: int
    each: int


class Plan:
    """Steps for given numbers of pieces by length."""

    def __init__(self, counts: dict[int, int], capacity: int):
        if any(not 0 < s <= capacity for s in counts):
            raise ValueError("lengths must lie between 1 and the capacity")
        self.capacity, self.left = capacity, {s: n for s, n in counts.items() if n > 0}
        self.placed = dict.fromkeys(self.left, 0)
        self.sequences, self.steps = 0, []
        self.gaps: list[int] = []  # sorted
        self.ranges: dict[int, list[tuple[int, int]]] = {}  # gap: (first sequence, how many)
        self._match_large()
        self._fill_small()

    def _place(self, length: int, count: int, sequence: int, offset: int, each: int = 1) -> None:
        self.steps.append(Step(length, self.placed[length], count, sequence, offset, each))
        self.placed[length] += count
        self.left[length] -= count

    def _open(self, count: int) -> int:
        self.sequences += count
        return self.sequences - count

    def _gap(self, gap: int, first: int, count: int) -> None:
        if gap and count:
            if not self.ranges.get(gap):
                insort(self.gaps, gap)
            self.ranges.setdefault(gap, []).append((first, count))

    def _match_large(self) -> None:
        large = sorted(s for s in self.left if 3 * s > self.capacity)
        for s in reversed(large):
            while self.left[s]:
                at = bisect_left(large, min(s, self.capacity - s) + 1) - 1
                while at >= 0 and self.left[large[at]] < (2 if large[at] == s else 1):
                    at -= 1
                if at < 0:
                    n = self.left[s]
                    first = self._open(n)
                    self._place(s, n, first, 0)
                    self._gap(self.capacity - s, first, n)
                    break
                t = large[at]
                n = self.left[s] // 2 if t == s else min(self.left[s], self.left[t])
                first = self._open(n)
                self._place(s, n, first, 0)
                self._place(t, n, first, s)
                self._gap(self.capacity - s - t, first, n)

    def _fill_small(self) -> None:
        for s in sorted((s for s in self.left if 3 * s <= self.capacity), reverse=True):
            while n := self.left[s]:
                at = bisect_left(self.gaps, s)
                if at == len(self.gaps):
                    gap, each = self.capacity, self.capacity // s
                    bins = -(-n // each)
                    first = self._open(bins)
                else:
                    gap = self.gaps[at]
                    each = gap // s
                    first, bins = self.ranges[gap].pop()
                    if not self.ranges[gap]:
                        self.gaps.pop(at)
                full = min(bins, n // each)
                if full:
                    self._place(s, full * each, first, self.capacity - gap, each)
                    self._gap(gap - each * s, first, full)
                rest = self.left[s] if full < bins else 0
                if rest:  # fewer than fill one more sequence
                    self._place(s, rest, first + full, self.capacity - gap, rest)
                    self._gap(gap - rest * s, first + full, 1)
                    full += 1
                self._gap(gap, first + full, bins - full)

    def arrays(self) -> np.ndarray:
        """Steps by length and rank, one column each."""
        rows = sorted((x.length, x.rank, x.count, x.sequence, x.offset, x.each) for x in self.steps)
        return np.array(rows, dtype=np.int64).reshape(-1, 6)


def pieces(df: DataFrame, capacity: int = 2048, end: int = 0, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, piece, start, length, ids_crc32``: each document's ids and ``end``, cut every ``capacity`` ids.

    Also ``part`` and ``nth``: the task, and the rank among the pieces of equal length in it.
    """
    path = path or default_path()
    kind = df.schema[key].dataType.simpleString()
    last = np.array([end], dtype="<u4").tobytes()
    width = 4 * capacity
    names = ["key", "piece", "start", "length", "ids_crc32", "part", "nth"]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = encoder(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for keys, bodies in rows_of(batches):
            out = [[], [], [], [], []]
            for k, ids in zip(keys, coder.encode(bodies), strict=True):
                ids += last
                for i, at in enumerate(range(0, len(ids), width)):
                    own = ids[at : at + width]
                    for column, v in zip(out, (k, i, at // 4, len(own) // 4, zlib.crc32(own)), strict=True):
                        column.append(v)
            lengths = np.array(out[3], dtype=np.int64)
            order = np.argsort(lengths, kind="stable")
            run = lengths[order]
            first = np.searchsorted(run, run, side="left")
            nth = np.empty(len(run), dtype=np.int64)
            nth[order] = np.arange(len(run)) - first + seen[run]
            seen += np.bincount(lengths, minlength=capacity + 1)
            columns = [pa.array(out[0], pa_type(kind)), pa.array(out[1], pa.int32()), *[pa.array(c, pa.int64()) for c in out[2:]]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(run), part)), pa.array(nth)], names)

    return texts(df, key, text).mapInArrow(encoded, f"key {kind}, piece int, start long, length long, ids_crc32 long, part long, nth long")


def pack(df: DataFrame, capacity: int = 2048, end: int = 0, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack all documents: ``key, piece, start, length, ids_crc32, sequence_id, offset``, one row per piece.

    A null or empty text has the end id alone. Repeated rows and null keys are packed row by row; equal lengths
    may take each other's place; other columns are ignored; an empty table gives no rows. The pieces (no texts,
    no ids) are written once to the checkpoint folder, because ranks and places must come from the same rows.
    """
    found = cut(pieces(df, capacity, end, path, key, text))
    per_task = found.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    steps = Plan(counts, capacity).arrays()
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    starts = per_task.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = found.join(starts, ["part", "length"]).select("key", "piece", "start", "length", "ids_crc32", (F.col("earlier") + F.col("nth")).alias("rank"))
    kind = ranked.schema["key"].dataType.simpleString()

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = int(steps[:, 1:3].sum(axis=1).max(initial=0)) + 1
        starts_at = steps[:, 0] * span + steps[:, 1]
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            own = steps[np.searchsorted(starts_at, length * span + rank, side="right") - 1]
            nth = rank - own[:, 1]
            places = [pa.array(own[:, 3] + nth // own[:, 5]), pa.array(own[:, 4] + nth % own[:, 5] * length)]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], *places], ["key", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    out = ranked.mapInArrow(placed, f"key {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("key", key)
