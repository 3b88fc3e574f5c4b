"""Merkle manifest of a table: a tree over the rows of each group, and a tree over the groups.

Every ``arity`` consecutive nodes become one. Only every ``every``-th level is persisted (checkpoint-and-recompute): a stored node stands
for an aligned subtree of ``arity ** every`` stored nodes below it. Proofs are taken from the top: in each aligned
subtree the levels between are folded again from the stored nodes, the siblings of every node are emitted, and the levels
are dropped again. Subtrees are bounded, so a group may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.llm.common import cut
from sparktab.llm.order import numbered

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*inputs: Column) -> Column:
    """Lowercase hex SHA-256 of the inputs, one after the other."""
    return F.sha2(F.concat(*inputs), 256)


def field(c: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, ``:`` and the value as text."""
    s = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s))


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with ``value`` evaluated once."""
    return F.transform(F.array(value), fn)[0]


def folded(nodes: Column, arity: int) -> Column:
    """The next level: digests of every ``arity`` consecutive nodes, the last run as long as it is."""
    runs = F.sequence(F.lit(0), ((F.size(nodes) - 1) / arity).cast("int"))
    return F.transform(runs, lambda j: F.sha2(F.array_join(F.slice(nodes, j * arity + 1, F.lit(arity)), ""), 256))


def siblings(nodes: Column, at: Column, arity: int) -> Column:
    """The run's other nodes, before and after position ``at``, each side in one string."""
    place = at % arity
    before, after = F.slice(nodes, at - place + 1, place), F.slice(nodes, at + 2, F.lit(arity - 1) - place)
    return F.struct(F.array_join(before, "").alias("before"), F.array_join(after, "").alias("after"))


def fold_up(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda acc, s: digest(s["before"], acc, s["after"]))


def proof_text(path: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), "")


@dataclass
class Tree:
    """Stored levels of the trees of all groups: ``grp, idx, n, digest`` and, at the leaves, ``payload``.

    n: nodes of the group at that level. A group is in the levels down from the first at which it is one node.
    """

    levels: list[DataFrame]
    payload: tuple[str, ...]
    arity: int
    every: int

    @classmethod
    def build(cls, leaves: DataFrame, payload: Sequence[str] = (), arity: int = 16, every: int = 2) -> Tree:
        """``leaves``: ``grp, idx, n, digest`` and payload, ``idx`` from 0 in the group."""
        tree = cls([leaves], tuple(payload), arity, every)
        most = leaves.agg(F.max("n")).first()[0] or 0
        span = arity**every
        while most > 1:
            nodes = tree._subtrees(tree.levels[-1].where("n > 1"), ())
            top = F.col("l0")[0]
            for j in range(1, every + 1):
                top = F.when(F.col("n") > arity ** (j - 1), F.col(f"l{j}")[0]).otherwise(top)
            tree.levels.append(cut(nodes.select("grp", F.col("block").alias("idx"), F.ceil(F.col("n") / span).alias("n"), top.alias("digest"))))
            most = -(-most // span)
        return tree

    def _subtrees(self, level: DataFrame, payload: Sequence[str]) -> DataFrame:
        """Aligned subtrees: ``grp, n, block``, their stored nodes, and ``l0, l1, ...``: the levels folded again."""
        block = F.expr(f"idx div {self.arity**self.every}").alias("block")
        out = level.groupBy("grp", "n", block).agg(F.array_sort(F.collect_list(F.struct("idx", "digest", *payload))).alias("nodes"))
        out = out.withColumn("l0", F.col("nodes.digest"))
        for j in range(1, self.every + 1):
            lower = F.col(f"l{j - 1}")
            out = out.withColumn(f"l{j}", F.when(F.col("n") > self.arity ** (j - 1), let(lower, lambda d: folded(d, self.arity))))
        return out

    def roots(self) -> DataFrame:
        """``grp, digest``: the root of each group's tree."""
        single = [level.where("n = 1").select("grp", "digest") for level in self.levels]
        out = single[0]
        for more in single[1:]:
            out = out.unionByName(more)
        return out

    def proofs(self, above: DataFrame) -> DataFrame:
        """``grp, idx, digest, path``, payload and the other columns of ``above`` for every leaf.

        above: ``grp, path`` and any other columns, one row for each group; its path goes on where the group's root ends.
        """
        others = [c for c in above.columns if c not in ("grp", "path")]
        upper = None
        for depth in reversed(range(len(self.levels))):
            level, payload = self.levels[depth], self.payload if depth == 0 else ()
            out = level.where("n = 1").join(above, "grp").select("grp", "idx", "digest", "path", *payload, *others)
            if upper is not None:
                trees = self._subtrees(level.where("n > 1"), payload)
                met = trees.join(upper.select("grp", F.col("idx").alias("block"), "path", *others), ["grp", "block"])
                rows = met.select("*", F.posexplode("nodes").alias("at", "node"))
                own = [F.when(F.col("n") > self.arity**j, F.array(siblings(F.col(f"l{j}"), F.expr(f"int(at div {self.arity**j})"), self.arity))) for j in range(self.every)]
                none = F.slice(F.col("path"), 1, 0)
                path = F.concat(*[F.coalesce(p, none) for p in own], "path").alias("path")
                out = out.unionByName(rows.select("grp", *[F.col("node")[c].alias(c) for c in ("idx", "digest")], path, *[F.col("node")[c].alias(c) for c in payload], *others))
            upper = out
        return upper


@dataclass
class Manifest:
    """Trees of the groups, the tree over the groups, and its root (None for an empty table)."""

    groups: Tree
    top: Tree
    root: str | None

    def proofs(self) -> DataFrame:
        """Leaves with payload, ``path``, ``subroot`` and ``root``."""
        empty = F.array().cast("array<struct<before: string, after: string>>")
        start = self.top.levels[0].select("grp").distinct().select("grp", empty.alias("path"))
        subroots = self.top.proofs(start).select(F.col("member").alias("grp"), "path", F.col("digest").alias("subroot"))
        return self.groups.proofs(subroots).withColumn("root", F.lit(self.root).cast("string"))


def build_manifest(leaves: DataFrame, payload: Sequence[str] = (), arity: int = 16, every: int = 2) -> Manifest:
    """Trees over ``grp, id, digest`` and payload. Leaves ascend by id (null first, ties by digest), groups bytewise."""
    rows = numbered(leaves.withColumn("seq", F.monotonically_increasing_id()), ["grp"], ["id", "digest", "seq"])
    groups = Tree.build(cut(rows.select("grp", "idx", "n", "digest", *payload)), payload, arity, every)
    members = groups.roots().select(F.lit("").alias("grp"), F.col("grp").alias("member"), "digest")
    top = Tree.build(cut(numbered(members, ["grp"], ["member"])), ("member",), arity, every)
    last = top.roots().collect()  # one row
    return Manifest(groups, top, last[0]["digest"] if last else None)


def verify_manifest(df: DataFrame, arity: int = 16, every: int = 2, key: str = "doc_id", text: str = "text", group: str = "source", fields: Sequence[str] = FIELDS) -> DataFrame:
    """``key, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row.

    Every row is a leaf of its ``group``; a null group comes first. Rows whose key's CRC-32 (of its decimal text) is divisible by 5 are tampered
    with: A-Z of the text become lower case (a null text stays). Their folded root comes from the changed leaf and the original
    siblings. A null key has the text ``-`` in its leaf, stands first and is not tampered with; repeated rows are leaves of their own, those of
    one key in the order of their digests; other columns are ignored; an empty table gives no rows.
    """
    def leaf(body: Column) -> Column:
        return digest(*[field(body if c == text else df[c]) for c in fields])

    chosen = F.crc32(df[key].cast("string").cast("binary")) % 5 == 0
    grp = F.when(df[group].isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), df[group].cast("string")))
    leaves = df.select(grp.alias("grp"), df[key].alias("id"), leaf(df[text]).alias("digest"), F.when(chosen, leaf(F.translate(df[text], UPPER, LOWER))).alias("changed"))
    proofs = build_manifest(cut(leaves), ("id", "changed"), arity, every).proofs()
    out = proofs.select(
        F.col("id").alias(key), F.col("digest").alias("leaf"), "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
        fold_up(F.coalesce("changed", "digest"), F.col("path")).alias("folded_root"),
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
