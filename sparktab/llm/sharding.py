"""Consistent hashing with bounded loads, in DataFrame functions only.

Every shard has virtual nodes on a ring of hash values; a row belongs to the next one clockwise. Rows that a full shard can't take go on
clockwise to the next shard with room. Loads are bounded by the exact share of each shard, so that counts differ by one
at most. What is planned on the driver is one number for each virtual node, however many rows there are.
"""

from __future__ import annotations

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import cut, hash_of
from sparktab.llm.order import numbered

RING_BITS, SLICE_BITS = 63, 12


def ring(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """(position, shard) of all virtual nodes, clockwise."""
    return sorted((xxhash.xxh64_intdigest(f"{s}/{v}", 7) >> (64 - RING_BITS), s) for s in range(shards) for v in range(virtual_nodes))


def placements(nodes: list[tuple[int, int]], counts: dict[int, int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(node, first rank, rows, shard, first slot) for the rows that arrive at each virtual node.

    Each shard takes its own rows first; then the rest goes on clockwise, in the order of the ring.
    """
    room, slot, out, over = list(room), [0] * len(room), [], []

    def give(node: int, first: int, n: int, shard: int) -> int:
        n = min(n, room[shard])
        if n:
            out.append((node, first, n, shard, slot[shard]))
            room[shard] -= n
            slot[shard] += n
        return n

    for node, (_, shard) in enumerate(nodes):
        n = counts.get(node, 0)
        taken = give(node, 0, n, shard)
        if taken < n:
            over.append((node, taken, n - taken))
    for node, first, n in over:
        at = node
        while n:
            at = (at + 1) % len(nodes)
            taken = give(node, first, n, nodes[at][1])
            first, n = first + taken, n - taken
    return out


def shard_rows(df: DataFrame, shards: int = 40, virtual_nodes: int = 64, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, size, text_crc32, law, shard, slot, grown_shard, home_shard`` for every row; law is ``rows``.

    size: UTF-8 bytes of the text (null: none) plus 16. The key's hash alone decides on the home shard; which rows of a full shard go on is decided by hash, key
    and text, not by files or partitions. Rows with one key (or none) may be any share: their ranks are taken over range partitions. Repeated rows are
    placed one by one; other columns are ignored; an empty table gives no rows. ``grown_shard`` is null under this law.
    """
    spark = df.sparkSession
    nodes = ring(shards, virtual_nodes)
    inside: list[list[tuple[int, int]]] = [[] for _ in range(1 << SLICE_BITS)]
    for node, (position, _) in enumerate(nodes):
        inside[position >> (RING_BITS - SLICE_BITS)].append((position, node))
    after, following = 0, [0] * len(inside)
    for s in reversed(range(len(inside))):
        following[s] = after
        after = inside[s][0][1] if inside[s] else after
    slices = spark.createDataFrame([(s, inside[s], following[s]) for s in range(len(inside))], "slice int, marks array<struct<position: long, node: int>>, following int")

    body = F.coalesce(df[text], F.lit("")).cast("binary")
    rows = df.select(df[key].alias("key"), (F.octet_length(body) + 16).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), hash_of(df[key].cast("string")).alias("position"))
    rows = rows.withColumn("slice", F.shiftright("position", RING_BITS - SLICE_BITS).cast("int"))
    met = F.get(F.filter("marks", lambda m: m["position"] >= F.col("position")), F.lit(0))["node"]
    homes = rows.join(F.broadcast(slices), "slice").select("key", "size", "text_crc32", "position", F.coalesce(met, F.col("following")).alias("node"))
    # 4,096 slices and their marks: bounded by the parameters. Rows of one node, however many, get their ranks over range partitions.
    ranked = numbered(cut(homes.withColumn("seq", F.monotonically_increasing_id())), ["node"], ["position", "key", "text_crc32", "size", "seq"]).withColumnRenamed("idx", "rank")
    arrived = {r["node"]: r["n"] for r in ranked.groupBy("node").agg(F.max("n").alias("n")).collect()}  # a number for each virtual node
    total = sum(arrived.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    plan = spark.createDataFrame(placements(nodes, arrived, room) or [(-1, 0, 0, 0, 0)], "node int, first long, n long, shard int, slot0 long")

    own = F.broadcast(plan.withColumnRenamed("node", "at"))
    placed = ranked.drop("n").join(own, (F.col("node") == F.col("at")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("n")))
    owners = F.broadcast(spark.createDataFrame([(i, s) for i, (_, s) in enumerate(nodes)], "node int, home_shard int"))
    return placed.join(owners, "node").select(
        F.col("key").alias(key), "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("slot0") + F.col("rank") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "home_shard"
    )
