"""Near copies among vectors by collision counting on sorted one-dimensional projections.

Vectors are projected on random directions. A pair collides on a direction if one lies in the window centred on the other. Each of several routes
sorts the vectors of a label by one projection, after cells of a few others that keep windows short as the table grows; pairs that meet
in a window are counted over all counting projections, and those that reach the calibrated count are verified by the cosine.
Windows, routes and counts follow from the wanted recall at the threshold itself; closer pairs are found more surely.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import cut
from sparktab.llm.components import components

# Rows of a window that are compared in one go; larger ones are split into pairs of parts.
PART = 2048
# Small groups are compared together up to this many rows.
TOGETHER = 256


@dataclass(frozen=True)
class Routes:
    """How vectors meet: number of routes, cells of each, counting projections, least count; lengths in units of the pairs' spread."""

    distance: float
    cells: int
    routes: int
    counting: int
    least: int
    cell: float = 5.0
    window: float = 2.0
    slab: float = 8.0

    @classmethod
    def calibrated(cls, threshold: float, largest: int, miss: float = 5e-4, counting: int = 24) -> Routes:
        """For a cosine threshold and the largest label's vectors. ``miss``: chance to lose a pair just at the threshold, by either cause."""
        distance = math.sqrt(2 * (1 - threshold))
        near = math.erf(cls.window / math.sqrt(2))  # a pair at the threshold meets in the window
        same = 1 - math.sqrt(2 / math.pi) / cls.cell  # ... and stands in one cell
        spread = 1 / max(distance, 1e-6)
        apart = min(1.0, 0.29 * cls.cell / spread)  # unrelated vectors stand in one cell
        cells = max(0, min(14, math.ceil(math.log(max(largest, 1) / 64) / -math.log(apart)))) if apart < 1 else 0
        hit = near * same**cells
        routes = max(1, math.ceil(math.log(miss) / math.log(1 - hit)))
        chance, least = 1.0, counting + 1
        for c in range(counting + 1):  # least count that loses no more than miss
            chance -= math.comb(counting, c) * near**c * (1 - near) ** (counting - c)
            if 1 - chance > miss:
                least = c
                break
        return cls(distance, cells, routes, counting, least)

    def directions(self, width: int) -> np.ndarray:
        """Projections of the routes (cells and one sorted each), then the counting ones; scaled so that a pair at the threshold spreads by 1."""
        n = self.routes * (self.cells + 1) + self.counting
        return np.random.default_rng(width).standard_normal((width, n)) / max(self.distance, 1e-6)

    def split(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell numbers hashed to one (row, route), sorted projection (row, route), counting projections."""
        own = p[:, : self.routes * (self.cells + 1)].reshape(len(p), self.routes, self.cells + 1)
        shift = np.random.default_rng(5).random((self.routes, self.cells)) * self.cell
        cells = np.floor((own[:, :, :-1] + shift) / self.cell).astype(np.int64).astype(np.uint64)
        factors = np.random.default_rng(6).integers(1, 1 << 62, size=self.cells, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        mixed = (cells * factors).sum(axis=2, dtype=np.uint64)
        return mixed ^ (mixed >> np.uint64(31)), own[:, :, -1], p[:, self.routes * (self.cells + 1) :]


def unit(data: list[bytes]) -> np.ndarray:
    x = np.stack([np.frombuffer(d, np.float32) for d in data]).astype(np.float64)
    with np.errstate(over="ignore"):
        x = x / np.abs(x).max(axis=1, keepdims=True)
        return x / np.linalg.norm(x, axis=1, keepdims=True)


def spots(nodes: DataFrame, r: Routes) -> DataFrame:
    """Each vector at its place on each route: ``at`` (label, route, cells and slab as one number), ``route``, ``home``; guests reach in from the slab below."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                b = batch.slice(start, 1024)
                widths = b.column(2).to_numpy()
                data = b.column(3).to_pylist()
                for width in np.unique(widths):
                    rows = np.flatnonzero(widths == width)
                    if width not in made:
                        made[width] = r.directions(int(width))
                    cells, last, _ = r.split(unit([data[i] for i in rows]) @ made[width])
                    slab = np.floor(last / r.slab).astype(np.int64)
                    route = np.broadcast_to(np.arange(r.routes), cells.shape)
                    place = b.column(1).to_numpy()[rows].view(np.uint64)[:, None] + (route * 7_919 + int(width) * 104_729).astype(np.uint64)
                    place = (place * np.uint64(0x9E3779B97F4A7C15)) ^ cells
                    reach = (last + r.window) // r.slab > slab
                    for who, home in (((slice(None), slice(None)), True), (np.nonzero(reach), False)):
                        row = np.broadcast_to(np.arange(len(rows))[:, None], cells.shape)[who].ravel()
                        at = (place[who] + (slab[who] + (not home)).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)).ravel()
                        pick = pa.array(rows[row])
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(at.view(np.int64)), pa.array(route[who].ravel().astype(np.int32)), pa.array(np.full(len(row), home)), b.column(0).take(pick), b.column(1).take(pick), b.column(4).take(pick), b.column(3).take(pick)],
                            ["at", "route", "home", "node", "label", "copies", "vector"],
                        )

    return nodes.select("node", "label", "width", "vector", "copies").mapInArrow(scan, "at long, route int, home boolean, node long, label long, copies long, vector binary")


def compared(rows: pa.Table, r: Routes, threshold: float, made: dict[int, np.ndarray]) -> list[np.ndarray]:
    """Links among the rows of some groups: node, number of vectors linked, and a node of the same component."""
    n = rows.num_rows
    get = lambda c: rows.column(c).to_numpy()
    data = rows.column("vector").to_pylist()
    width = len(data[0]) // 4
    if any(len(d) != 4 * width for d in data):  # of two groups; equal inside a group
        sizes = np.array([len(d) for d in data])
        return [np.concatenate(c) for c in zip(*[compared(rows.take(pa.array(np.flatnonzero(sizes == s))), r, threshold, made) for s in np.unique(sizes)], strict=True)]
    if width not in made:
        made[width] = r.directions(width)
    x = unit(data)
    cells, last, counting = r.split(x @ made[width])
    at, i, j, side, home, route, node, copies, label = (get(c) for c in ("at", "i", "j", "side", "home", "route", "node", "copies", "label"))
    may = (at[:, None] == at) & (i[:, None] == i) & (j[:, None] == j) & (label[:, None] == label) & (home[:, None] | home) & (node[:, None] < node)
    may &= ((side[:, None] != side) | (i == j)) & (route[:, None] == route)
    a, b = np.nonzero(may)
    good = np.zeros(len(a), dtype=bool)
    for s in range(0, len(a), 50_000):
        p, q = a[s : s + 50_000], b[s : s + 50_000]
        meets = (cells[p] == cells[q]) & (np.abs(last[p] - last[q]) <= r.window)
        ok = np.where(meets.any(axis=1), meets.argmax(axis=1), -1) == route[p]  # only on the first route on which they meet
        p, q, spot = p[ok], q[ok], np.flatnonzero(ok)
        enough = (np.abs(counting[p] - counting[q]) <= r.window).sum(axis=1) >= r.least
        p, q, spot = p[enough], q[enough], spot[enough]
        good[s + spot[np.einsum("ij,ij->i", x[p], x[q]) >= threshold]] = True
    a, b = a[good], b[good]
    linked = np.bincount(a, weights=copies[b], minlength=n) + np.bincount(b, weights=copies[a], minlength=n)
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    some = np.flatnonzero(linked)
    return [node[some], linked[some].astype(np.int64), node[root[some]]]


def local_links(placed: DataFrame, r: Routes, threshold: float) -> DataFrame:
    """Links of all groups of ``at, i, j``, whose rows follow each other in a task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        rest: pa.Table | None = None

        def results(table: pa.Table, whole: bool) -> Iterator[pa.RecordBatch]:
            nonlocal rest
            keys = [table.column(c).to_numpy() for c in ("at", "i", "j")]
            change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
            edges = np.concatenate([[0], change, [table.num_rows]])
            stop = len(edges) - 1 if whole else len(edges) - 2
            sizes = np.diff(edges)
            k = 0
            while k < stop:
                if sizes[k] < 2:
                    k += 1
                    continue
                end = k + 1
                while end < stop and edges[end + 1] - edges[k] <= TOGETHER:
                    end += 1
                out = compared(table.slice(edges[k], edges[end] - edges[k]), r, threshold, made)
                if len(out[0]):
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], ["node", "linked", "other"])
                k = end
            rest = table.slice(edges[stop])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None or not rest.num_rows else pa.concat_tables([rest, table])
            yield from results(table, False)
        if rest is not None and rest.num_rows:
            yield from results(rest, True)

    return placed.mapInArrow(scan, "node long, linked long, other long")


def vector_links(df: DataFrame, threshold: float = 0.98, miss: float = 5e-4, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``key, n_links, component_id, kept`` for every row. Vectors are taken as 32-bit numbers, labels by their 64-bit hash.

    Two vectors of one width and one label (not null) are linked if their cosine in double precision reaches ``threshold``. Vectors that are null or zero, or hold
    nulls, NaN or infinities, link with nothing. Equal vectors are one node, with their number; a window of any size is compared whole, in parts. component_id: the smallest key reachable
    (null if no row of the component has one). kept: the key is the component's. Repeated rows count as other vectors; an empty
    table gives no rows; other columns are ignored.
    """
    values = F.transform(df[vector], lambda v: v.cast("float"))
    finite = F.forall(values, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    sound = df[label].isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(values, lambda v: v != 0), F.lit(False))
    rows = df.select(df[key].alias("key"), F.xxhash64(df[label]).alias("label"), values.alias("values"), sound.alias("sound"))
    rows = rows.withColumn("node", F.when(F.col("sound"), F.xxhash64("label", "values"))).withColumn("mark", F.when(F.col("sound"), F.xxhash64(F.lit("second"), "values", "label")))
    alone = rows.where("NOT sound").select(F.col("key").alias(key), F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"), F.lit(True).alias("kept"))
    good = rows.where("sound")
    nodes = cut(good.groupBy("node", "mark").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("values").alias("values")).select("node", "mark", "first", "copies", "label", F.size("values").alias("width"), F.col("values")))
    largest = nodes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    r = Routes.calibrated(threshold, largest, miss)
    placed = spots(_as_bytes(nodes), r)
    crowds = cut(placed.groupBy("at").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > PART).select("at", F.ceil(F.col("n") / PART).cast("int").alias("parts")))
    placed = placed.join(crowds, "at", "left").withColumn("side", F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64("node"), F.col("parts"))).otherwise(F.lit(0)).cast("int"))
    placed = placed.withColumn("with", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1)))
    placed = placed.withColumn("i", F.least("side", "with")).withColumn("j", F.greatest("side", "with")).select("at", "i", "j", "side", "route", "home", "node", "label", "copies", "vector")
    found = cut(local_links(placed.repartition("at", "i", "j").sortWithinPartitions("at", "i", "j"), r, threshold))
    linked = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    groups = components(found.select(F.col("node").alias("a"), F.col("other").alias("b")))
    known = nodes.join(groups, "node", "left").join(linked, "node", "left").select("node", "mark", "first", F.coalesce("component", "node").alias("root"), (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    whole = good.select("key", "node", "mark").join(known.join(least, "root").select("node", "mark", "n_links", "component_id"), ["node", "mark"])
    return whole.select(F.col("key").alias(key), "n_links", "component_id", F.coalesce(F.col("key") == F.col("component_id"), F.lit(False)).alias("kept")).union(alone)


def _as_bytes(nodes: DataFrame) -> DataFrame:
    """The vectors packed as 32-bit floats."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(3)
            flat, ends = lists.flatten().to_numpy().astype("<f4"), np.concatenate([[0], np.cumsum(b.column(2).to_numpy())])
            own = [flat[s:e].tobytes() for s, e in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(own, pa.binary()), b.column(4)], ["node", "label", "width", "vector", "copies"])

    return nodes.select("node", "label", "width", "values", "copies").mapInArrow(pack, "node long, label long, width int, vector binary, copies long")
