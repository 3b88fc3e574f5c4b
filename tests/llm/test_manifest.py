import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from sparktab.llm.common import cut
from sparktab.llm.manifest import build_manifest, fold_up, verify_manifest
from sparktab.llm.order import numbered

from .cases import DOCUMENTS, crowded, frame, rows, same_rows


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def levels_of(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def siblings_of(levels, i, arity):
    out = []
    for nodes in levels[:-1]:
        a = i // arity * arity
        out.append(("".join(nodes[a:i]), "".join(nodes[i + 1 : a + arity])))
        i //= arity
    return out


def plain(data, arity=16):
    groups = {}
    for doc_id, text, lang, source, n in data:
        groups.setdefault(source, []).append((doc_id, leaf_of(doc_id, source, lang, n, text), (source, lang, n, text)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[s] = levels_of([r[1] for r in groups[s]], arity)
    top = levels_of([trees[s][-1][0] for s in order], arity)
    out = []
    for g, s in enumerate(order):
        for i, (doc_id, leaf, (source, lang, n, text)) in enumerate(groups[s]):
            path = siblings_of(trees[s], i, arity) + siblings_of(top, g, arity)
            shown = leaf
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0:
                shown = leaf_of(doc_id, source, lang, n, text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
            for before, after in path:
                shown = h(before, shown, after)
            root = top[-1][0]
            out.append((doc_id, leaf, trees[s][-1][0], root, h(*[a + b for a, b in path]), shown, shown == root))
    return out


def test_given_rows_with_nulls_ties_and_clashing_names(spark):
    assert same_rows(verify_manifest(crowded(frame(spark))).collect(), plain(rows()))


@pytest.mark.parametrize("arity, every", [(2, 1), (2, 3), (3, 2), (16, 2)])
def test_stored_levels_do_not_matter(spark, arity, every):
    data = [(i, f"Text {i} A", "en", "hot" if i % 3 else f"s{i % 7}", i) for i in range(400)] + [(1000, "alone", "en", "one", 1)]
    found = verify_manifest(spark.createDataFrame(data, DOCUMENTS).repartition(7), arity, every).collect()
    assert same_rows(found, plain(data, arity))
    assert {r["verified"] for r in found} == {True, False}


@pytest.mark.parametrize("n", [0, 1, 16, 17, 256, 257])
def test_one_group_of_every_shape(spark, n):
    data = [(i, f"t{i}", None, None, None) for i in range(n)]
    found = verify_manifest(spark.createDataFrame(data, DOCUMENTS)).collect()
    assert same_rows(found, plain(data))


def test_proofs_fold_to_the_root_and_a_changed_leaf_does_not(spark):
    leaves = spark.range(700).select(F.lit("g").alias("grp"), F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    made = build_manifest(cut(leaves), ("id",))
    proofs = made.proofs().select(fold_up(F.col("digest"), F.col("path")).alias("right"), fold_up(F.sha2("digest", 256), F.col("path")).alias("wrong")).collect()
    assert len(proofs) == 700 and {r["right"] for r in proofs} == {made.root} and made.root not in {r["wrong"] for r in proofs}
    assert [level.count() for level in made.groups.levels] == [700, 3, 1]  # every second level is stored


def test_ranks_of_a_hot_group(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("g"), F.col("id"))
    found = numbered(df.repartition(9), ["g"], ["id"]).collect()
    for g in {r["g"] for r in found}:
        own = sorted((r["id"], r["idx"], r["n"]) for r in found if r["g"] == g)
        assert [r[1] for r in own] == list(range(len(own))) and {r[2] for r in own} == {len(own)}
