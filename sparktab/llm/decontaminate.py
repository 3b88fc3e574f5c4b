"""Benchmark decontamination by the q-gram lemma.

Each item is cut into overlapping windows of ``width`` bytes. A region of a document within ``k`` edits of a window of ``w`` bytes shares at least
``w + 1 - q (k + 1)`` q-grams with it, all on ``k + 1`` neighbouring diagonals. So: count shared q-grams in overlapping bands of diagonals, keep
the bands that meet the bound, and align window and region inside the band. The index holds the items; documents stream past it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import GROUP_BYTES, by_bytes, hash_of, pa_type, rows_of, small_batches, texts

Q = 8
BAND = 16
# Items of one pass over the documents, in bytes of text. More items take more passes.
BLOCK_BYTES = 16 << 20
TABLE_BITS = 22
MIX = np.uint64(0x9E3779B97F4A7C15)


def normalised(body: bytes) -> bytes:
    """Lower case, single blanks."""
    return b" ".join(body.decode("utf-8", "replace").lower().encode().split())


def grams(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one number each."""
    n = len(data) - Q + 1
    return np.lib.stride_tricks.as_strided(data, (n, Q), (1, 1)).copy().view("<u8").ravel() if n > 0 else np.zeros(0, "<u8")


def slots(codes: np.ndarray) -> np.ndarray:
    return (codes * MIX) >> np.uint64(64 - TABLE_BITS)


@dataclass(frozen=True)
class Settings:
    """Window width in bytes, share of edits, fewest bytes of an item that can be recognised, least number of shared q-grams."""

    width: int = 96
    edits: float = 0.1
    shortest: int = 24
    fewest: int = 12


class Index:
    """Windows of items and where their q-grams are."""

    def __init__(self, items: list[tuple[int, bytes]], s: Settings):
        windows, self.item = [], []
        for item, body in items:
            t = normalised(body)
            if len(t) < s.shortest:
                continue
            last = max(len(t) - s.width, 0)
            for at in sorted({*range(0, last + 1, s.width // 2), last}):
                windows.append(t[at : at + s.width])
                self.item.append(item)
        self.windows = windows
        self.length = np.array([len(w) for w in windows], dtype=np.int64)
        self.budget = np.minimum((s.edits * self.length).astype(np.int64), (self.length + 1 - s.fewest) // Q - 1)
        self.least = self.length + 1 - Q * (self.budget + 1)
        codes = [grams(np.frombuffer(w, np.uint8)) for w in windows]
        every = np.concatenate([np.zeros(0, "<u8"), *codes])
        owner = np.repeat(np.arange(len(windows)), [len(c) for c in codes])
        place = np.concatenate([np.zeros(0, np.int64), *[np.arange(len(c)) for c in codes]])
        order = np.argsort(every, kind="stable")
        self.owner, self.place = owner[order], place[order]
        self.codes, self.first, self.times = np.unique(every[order], return_index=True, return_counts=True)
        self.known = np.zeros(1 << TABLE_BITS, dtype=bool)
        self.known[slots(self.codes)] = True
        self.reach = int((self.length + self.budget).max(initial=0))
        self.slack = int(self.budget.max(initial=0))
        self.bound = int(self.least.min(initial=1 << 30))

    def dense(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions, and their q-grams, where as many known q-grams as any window needs lie within its reach."""
        codes = grams(data)
        hit = self.known[slots(codes)]
        at = np.flatnonzero(hit)
        if len(at) < self.bound:
            return at[:0], codes[:0]
        close = np.flatnonzero(at[self.bound - 1 :] - at[: len(at) - self.bound + 1] <= self.reach)
        cover = np.zeros(len(at) + 1, dtype=np.int64)
        np.add.at(cover, close, 1)
        np.add.at(cover, close + self.bound, -1)
        at = at[np.cumsum(cover)[:-1] > 0]
        return at, codes[at]

    def candidates(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows and the first diagonals of bands with enough shared q-grams."""
        at, codes = self.dense(data)
        spot = np.minimum(np.searchsorted(self.codes, codes), max(len(self.codes) - 1, 0))
        real = self.codes[spot] == codes if len(codes) else np.zeros(0, bool)
        at, spot = at[real], spot[real]
        times = self.times[spot]
        total = int(times.sum())
        if not total:
            return at[:0], at[:0]
        step = np.arange(total) - np.repeat(np.cumsum(times) - times, times)
        entry = np.repeat(self.first[spot], times) + step
        window = self.owner[entry]
        diagonal = np.repeat(at, times) - self.place[entry] + self.reach  # never negative
        band = diagonal // BAND
        lower = (diagonal % BAND <= self.budget[window]) & (band > 0)  # also in the band before, which reaches over
        keys = np.concatenate([window * (1 << 40) + band, window[lower] * (1 << 40) + band[lower] - 1])
        found, n = np.unique(keys, return_counts=True)
        window = found >> 40
        found, window = found[n >= self.least[window]], window[n >= self.least[window]]
        return window, (found & ((1 << 40) - 1)) * BAND - self.reach

    def aligned(self, data: np.ndarray, window: np.ndarray, diagonal: np.ndarray) -> np.ndarray:
        """Which candidates lie within their budget: banded alignment of the whole window, free ends in the document."""
        spread = BAND + self.slack + 1
        good = np.zeros(len(window), dtype=bool)
        for n in np.unique(self.length[window]):
            for some in np.array_split(np.flatnonzero(self.length[window] == n), max(1, len(window) // 1024)):
                if not len(some):
                    continue
                pattern = np.stack([np.frombuffer(self.windows[w], np.uint8) for w in window[some]])
                spots = diagonal[some, None] + np.arange(n + spread)
                inside = (spots >= 0) & (spots < len(data))
                region = np.where(inside, data[np.clip(spots, 0, len(data) - 1)], 0)
                ramp = np.arange(spread, dtype=np.int32)
                cost = np.zeros((len(some), spread), dtype=np.int32)
                for i in range(n):
                    step = cost + (region[:, i : i + spread] != pattern[:, i, None])
                    step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
                    cost = np.minimum.accumulate(step - ramp, axis=1) + ramp
                good[some] = cost.min(axis=1) <= self.budget[window[some]]
        return good

    def matches(self, bodies: list[bytes]) -> list[list[int]]:
        """Per document the items of which it holds a window, ascending."""
        found: list[set[int]] = [set() for _ in bodies]
        if self.windows:
            clean = [normalised(b) for b in bodies]
            gap = b"\n" * Q  # in no q-gram of an item
            data = np.frombuffer(gap.join(clean) + gap, dtype=np.uint8)
            starts = np.cumsum([0, *[len(c) + Q for c in clean]])
            window, diagonal = self.candidates(data)
            good = self.aligned(data, window, diagonal)
            # the middle of the region tells the document
            middle = diagonal[good] + BAND // 2 + self.length[window[good]] // 2
            for w, d in zip(window[good], np.searchsorted(starts, middle, side="right") - 1, strict=True):
                if 0 <= d < len(bodies):
                    found[d].add(self.item[w])
        return [sorted(f) for f in found]


def indexes(items: DataFrame, settings: Settings, key: str, text: str) -> list:
    """Broadcast indexes of the items, in blocks of bounded size: counted first, each collected alone."""
    named = items.where(F.col(text).isNotNull() & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("key"), F.col(text).cast("binary").alias("body"))
    size = named.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    blocks = -(-size // BLOCK_BYTES) or 1
    out = []
    for b in range(blocks):
        rows = named.where(hash_of(F.col("key"), F.col("body")) % blocks == b).collect()
        out.append(items.sparkSession.sparkContext.broadcast(Index([(r["key"], bytes(r["body"])) for r in rows], settings)))
    return out


def find_items(df: DataFrame, items: DataFrame, settings: Settings | None = None, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """``key, contaminated, item_ids`` for every row of ``df``: the items of which it holds a passage, ascending.

    A passage is a whole window of an item (96 bytes after normalisation, or all of a shorter item) with at most a tenth of it edited.
    Items of under 24 bytes, without text or without key are not looked for. Null and empty texts, and every text if there are no items, hold none. Documents
    are not shuffled; repeated rows and null keys stay as they are; other columns are ignored; an empty table gives no rows.
    """
    kind = df.schema[key].dataType.simpleString()
    held = indexes(items, settings or Settings(), item_key, item_text)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, bodies in rows_of(batches):
            own = [sorted({i for m in every for i in m}) for every in zip(*[h.value.matches(bodies) for h in held], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa_type(kind)), pa.array([bool(m) for m in own]), pa.array(own, pa.list_(pa.int64()))], ["key", "contaminated", "item_ids"])

    return texts(df, key, text).mapInArrow(scan, f"key {kind}, contaminated boolean, item_ids array<long>").withColumnRenamed("key", key)


def drop_contaminated(df: DataFrame, items: DataFrame, settings: Settings | None = None, text: str = "text", item_key: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, that hold no passage of an item. Rows as in ``find_items``."""
    def clean(held: Broadcast) -> Callable[[Column], Column]:
        @F.pandas_udf("boolean")
        def holds_none(s: pd.Series) -> pd.Series:
            bodies = [t.encode() if t else b"" for t in s]
            return pd.Series([not m for _, some in by_bytes(bodies, bodies, GROUP_BYTES) for m in held.value.matches(some)], dtype=bool)

        return holds_none

    small_batches(df)
    for held in indexes(items, settings or Settings(), item_key, item_text):
        df = df.where(clean(held)(df[text]))
    return df
