import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.llm import resample as rs
from sparktab.llm.common import cut
from sparktab.llm.radix import radix_sort

from .cases import DOCUMENTS, crowded, frame, rows, same_rows, sentence

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def bucket(feature, buckets):
    return zlib.crc32(feature.encode()) % buckets


def plain(docs, target, buckets=10_000, percent=25, least=20):
    s, t = (Counter(bucket(f, buckets) for x in xs for f in features(x)[1]) for xs in ([x for _, x in docs], target))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets)))) for b in range(buckets)]
    out, able = [], []
    for key, text in docs:
        words, fs = features(text)
        weight = sum(gain[bucket(f, buckets)] for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{'-' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
        if len(words) >= least:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = i + 1
    return [tuple(r) for r in out]


def bench(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")


@pytest.mark.parametrize("percent", [25, 100])
def test_given_rows_with_nulls_ties_and_clashing_names(spark, percent):
    target = [sentence(2, 30), None, "", "quiet river"]
    found = rs.resample(crowded(frame(spark)), bench(spark, target), percent).collect()
    assert same_rows(found, plain([(r[0], r[1]) for r in rows()], target, percent=percent))


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCUMENTS)
    assert rs.resample(none, bench(spark, ["a b"])).collect() == []
    docs = [(i, sentence(i, 25)) for i in range(9)]
    found = rs.resample(spark.createDataFrame(docs, "doc_id long, text string"), bench(spark, ["x"]).limit(0), 50).collect()
    assert same_rows(found, plain(docs, [], percent=50))


def test_extreme_keys_and_key_types(spark):
    docs = [(k, sentence(1, 25)) for k in (-(2**63), -1, 0, 5, 2**63 - 1)]
    found = rs.resample(spark.createDataFrame(docs, "doc_id long, text string"), bench(spark, ["x"]), 100).collect()
    assert same_rows(found, plain(docs, ["x"], percent=100))
    small = spark.createDataFrame([(3, sentence(1, 25))], "doc_id long, text string").withColumn("doc_id", F.col("doc_id").cast("smallint"))
    assert rs.resample(small, bench(spark, ["x"]), 100).first()["rank"] == 1
    with pytest.raises(TypeError):
        rs.resample(small.withColumn("doc_id", F.lit("a")), bench(spark, ["x"]))


def test_buckets_of_long_and_odd_texts(monkeypatch):
    monkeypatch.setattr(rs, "SEGMENT", 500)
    g = random.Random(3)
    parts = ["a", "Zé", "9", " ", "  ", "\n", "-", "x" * 60, "東京", ".", "word", "İ"]
    texts = ["".join(g.choices(parts, k=g.randint(0, 400))) for _ in range(120)] + ["y" * 3000, "", "one", " " * 2000]
    got = [Counter() for _ in texts]
    for first, buckets, owner in rs.buckets_of([t.encode() for t in texts], 997):
        for b, o in zip(buckets.tolist(), owner.tolist(), strict=True):
            got[first + o][b] += 1
    assert got == [Counter(bucket(f, 997) for f in features(t)[1]) for t in texts]


def test_crc_of_runs_side_by_side():
    data = np.frombuffer(bytes(range(256)) * 8, dtype=np.uint8)
    g = np.random.default_rng(0)
    start, length = g.integers(0, 1000, 300), g.integers(0, 900, 300)
    state = g.integers(0, 2**32, 300).astype(np.uint32)
    want = [zlib.crc32(data[a : a + n].tobytes(), int(s)) for a, n, s in zip(start, length, state, strict=True)]
    assert rs.advance(state, data, start, length).tolist() == want


@pytest.mark.parametrize("width, parts", [(3, 2), (12, 5), (16, 9)])
def test_radix_sort_is_stable_and_takes_hot_digits(spark, width, parts):
    g = random.Random(width)
    data = [(g.choice([0, 0, 0, 7, 2**40]), g.randint(0, 5), i) for i in range(3000)]
    df = cut(spark.createDataFrame(data, "a long, b long, i long").coalesce(1).repartition(parts))
    before = [tuple(r) for part in df.rdd.glom().collect() for r in part]
    found = radix_sort(df, [("a", 41), ("b", 3)], len(data), width).collect()
    want = sorted(before, key=lambda r: r[:2])
    assert [tuple(r)[:3] for r in sorted(found, key=lambda r: r["position"])] == want
    assert sorted(r["position"] for r in found) == list(range(len(data)))
