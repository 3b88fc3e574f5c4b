import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from sparktab.llm import simhash
from sparktab.llm.components import components
from sparktab.llm.simhash import allocate, keep_one_of_each, links, shingle_hashes, signed, simhash_groups
from sparktab.llm.vector_dedup import Routes, vector_links

from .cases import crowded, frame, rows, same_rows, sentence


def grouped(n, linked):
    """Smallest member by union-find."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(range(n), 2):
        if linked(a, b):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    words = [w for w in "".join(c if c not in "\t\n\x0b\x0c\r" else " " for c in (text or "")).split(" ") if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def keys_of(roots, keys):
    """Smallest key of each group, none without any."""
    return [min((k for k, r in zip(keys, roots, strict=True) if r == own and k is not None), default=None) for own in roots]


def test_fingerprints_and_groups(spark):
    own = rows()
    fps = [plain_fingerprint(r[1]) for r in own]
    roots = grouped(len(own), lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    want = [(r[0], f"{f:016x}", c) for r, f, c in zip(own, fps, keys_of(roots, [r[0] for r in own]), strict=True)]
    assert same_rows(simhash_groups(crowded(frame(spark))).collect(), want)
    assert simhash_groups(frame(spark, [])).collect() == []


@pytest.mark.parametrize("radius", [0, 1, 2])
@pytest.mark.parametrize("hot", [4, 256])
def test_links_lose_no_pair(spark, radius, hot):
    g = random.Random(radius)
    values = set()
    for _ in range(12):
        base = g.getrandbits(64)
        for _ in range(20):
            values.add(base ^ sum({1 << g.randrange(64) for _ in range(g.randrange(4))}))
    values = sorted(values)
    found = links(spark.createDataFrame([(signed(v),) for v in values], "fp long"), radius, hot=hot).collect()
    at = {signed(v): i for i, v in enumerate(values)}
    pairs = {frozenset((at[r.a], at[r.b])) for r in found}
    want = grouped(len(values), lambda a, b: (values[a] ^ values[b]).bit_count() <= radius)
    assert grouped(len(values), lambda a, b: frozenset((a, b)) in pairs) == want


def test_thresholds():
    assert allocate([[0, 5, 50, 500]] * 3, 2) == [0, 0, 0]
    assert allocate([[0, 1, 2, 500], [0, 1, 50, 500], [0, 900, 999, 999]], 2) == [1, 0, -1]
    with pytest.raises(ValueError, match="radius"):
        links(None, 3)


def test_long_texts_are_counted_in_blocks(monkeypatch):
    body = sentence(5, 3000).encode()
    want = simhash.majority(shingle_hashes(body, 3))
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert simhash.majority(shingle_hashes(body, 3)) == want


def test_components(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, 1001), (1001, 1000), (7, 7), (2000, 2000)] + [(5000, 5000 + i) for i in range(1, 200)]
    found = dict(components(spark.createDataFrame(chain, "a long, b long")).collect())
    assert found == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000} | {5000 + i: 5000 for i in range(200)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def near(a, b):
    return (plain_fingerprint(a) ^ plain_fingerprint(b)).bit_count() <= 2


def edited(text, n, seed):
    g, words = random.Random(seed), text.split()
    for _ in range(n):
        words[g.randrange(len(words))] = f"new{g.randrange(999)}"
    return " ".join(words)


def test_one_of_each(spark):
    own = rows() + [(100 + 10 * f + i, edited(sentence(50 + f, 150), i % 4, i), "en", "a", 1) for f in range(5) for i in range(8)]
    roots = grouped(len(own), lambda a, b: near(own[a][1], own[b][1]))
    want = keys_of(roots, [r[0] for r in own])
    assert len(set(roots)) < len(own) - 12
    df = crowded(frame(spark, own))
    kept = keep_one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect()) == sorted(-1 if k is None else k for k in {r: k for r, k in zip(roots, want, strict=True)}.values())
    assert keep_one_of_each(frame(spark, [])).collect() == []


def vectors(seed=0):
    g = np.random.default_rng(seed)
    data, k = [], 0
    for label in (1, 2):
        for _ in range(6):
            base = g.standard_normal(16)
            for _ in range(g.integers(1, 30)):
                v = base + g.standard_normal(16) * g.choice([0.0, 0.05, 0.12, 0.2])
                data.append((k, [float(np.float32(x)) for x in v], label))
                k += 1
    data += [(k, None, 1), (k + 1, [0.0] * 16, 1), (k + 2, [None] + [1.0] * 15, 1), (k + 3, [float("nan")] + [1.0] * 15, 1), (k + 4, [float("inf")] + [1.0] * 15, 1), (k + 5, [1.0] * 16, None), (k + 6, [1.0] * 16, None), (k + 7, [], 1)]
    data += [(k + 8, [1.0, 2.0], 1), (k + 9, [1.0, 2.0], 1), (k + 9, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (None, [9.0] + [0.0] * 15, 2), (k + 10, [1e30] * 16, 3), (k + 11, [1e-30] * 16, 3)]
    return data


@pytest.mark.parametrize("part", [2048, 7])
def test_vectors(spark, monkeypatch, part):
    monkeypatch.setattr("sparktab.llm.vector_dedup.PART", part)
    data = vectors()
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")

    def sound(r):
        return r[1] and r[2] is not None and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])

    unit = [np.array(r[1]) / np.abs(r[1]).max() if sound(r) else None for r in data]
    unit = [u / np.linalg.norm(u) if u is not None else None for u in unit]
    linked = lambda a, b: unit[a] is not None and unit[b] is not None and data[a][2] == data[b][2] and len(unit[a]) == len(unit[b]) and float(unit[a] @ unit[b]) >= 0.98
    n = len(data)
    roots = grouped(n, linked)
    least = keys_of(roots, [r[0] for r in data])
    want = [(data[i][0], sum(linked(i, j) for j in range(n) if j != i), least[i], data[i][0] is not None and data[i][0] == least[i]) for i in range(n)]
    found = [tuple(r) for r in vector_links(df.withColumn("node", df.label)).collect()]
    want = [(*w[:3], True) if unit[i] is None else w for i, w in enumerate(want)]
    assert same_rows(found, want)
    assert vector_links(df.limit(0)).collect() == []


def test_recall_is_calibrated():
    for n in (10, 10_000, 10**9):
        r = Routes.calibrated(0.98, n)
        near_one = 0.9545 * (1 - np.sqrt(2 / np.pi) / r.cell) ** r.cells
        assert (1 - near_one) ** r.routes < 1e-3 and r.least > 12
    assert Routes.calibrated(0.98, 10**9).cells > Routes.calibrated(0.98, 10_000).cells
