import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sparktab.llm import pii, quality, toxicity
from sparktab.llm.decontaminate import normalised
from sparktab.llm.quality import co_train, keep_quality, score_quality
from sparktab.llm.toxicity import Network, Settings, indexed, score_toxicity, starts_of, words_of

from .cases import DOCUMENTS, WORDS, crowded, frame, rows, sentence
from .test_duplicates import grouped, near
from .test_tokens import packed

SMALL = Settings(window=8, stride=6, hidden=4, word_width=4, char_width=6, attention=3, hash_bits=10, epochs=20, batch=16, toxic_rows=150, other_rows=200)
RUDE = ["moron", "scumbag", "trashy"]


def prose(seed, n):
    g = random.Random(seed)
    return [g.choice(WORDS) for _ in range(n)]


def toxic_documents(n):
    data = []
    for i in range(n):
        words = prose(i, 10 + i % 60)
        bad = i % 3 == 0
        if bad:
            words[random.Random(i).randrange(len(words))] = RUDE[i % 9 // 3] + ".,!"[i % 3]
        data.append((i, " ".join(words), "en", "a", 10, int(bad)))
    return data


def junk_documents(n):
    data = []
    for i in range(n):
        words = prose(i, 20 + i % 50)
        bad = i % 4 == 0
        text = "!! ".join(words).upper() if bad and i % 8 else " ".join(words[:3] * 12) if bad else " ".join(words).capitalize() + "."
        data.append((i, text, "en", f"s{i % 5}", len(text), int(not bad)))
    return data


def test_gradients_of_the_network():
    s = Settings(window=5, hidden=3, word_width=3, char_width=3, attention=2, hash_bits=6)
    net = Network.fresh(s)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    words, ids = indexed([[b"ab", b"cde", b"x"], [b"cde", b"ab", b"fghi", b"q", b"zz"], []], 5)
    factor = np.array([0.3, -0.7, 0.2])
    loss = lambda: (net.gradients(words, ids, lambda _: factor)[0] * factor).sum()
    _, grads = net.gradients(words, ids, lambda _: factor)
    for name, value in net.p.items():
        for i in np.random.default_rng(0).integers(0, value.size, 5):
            old = value.flat[i]
            value.flat[i] = old + 1e-3
            up = loss()
            value.flat[i] = old - 1e-3
            down = loss()
            value.flat[i] = old
            assert abs((up - down) / 2e-3 - np.ravel(grads[name])[i]) < 1e-5, name


def test_windows_cover_all_words():
    for n in (0, 1, 7, 8, 9, 14, 15, 100):
        seen = {w for a in starts_of(n, 8, 6) for w in range(a, min(a + 8, n))}
        assert seen == set(range(n))
    assert b"".join(words_of(b"ab " + b"x" * 1000)) == b"ab" + b"x" * 1000


@pytest.fixture(scope="module")
def toxic(spark):
    data = toxic_documents(600)
    docs = frame(spark, [d[:5] for d in data] + [(1000 + i if r[0] is not None else None, *r[1:]) for i, r in enumerate(rows())])
    labels = spark.createDataFrame([(d[0], d[5]) for d in data if d[0] % 7] + [(3, None), (None, 1), (6, 1), (6, 1)], "doc_id long, toxic int")
    return data, crowded(docs), labels


def test_toxicity(spark, toxic):
    data, docs, labels = toxic
    found = {r.doc_id: r for r in score_toxicity(docs, labels, SMALL).collect()}
    assert len(found) == len({d[0] for d in data}) + len(rows())
    for k, r in found.items():
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (k is not None and zlib.crc32(str(k).encode()) % 5 == 0)
    fresh = [d for d in data if found[d[0]].held_out]
    assert len(fresh) > 80 and sum(found[d[0]].predicted == d[5] for d in fresh) > 0.95 * len(fresh)
    assert score_toxicity(docs.limit(0), labels, SMALL).collect() == []


def test_scores_do_not_depend_on_batches(spark, toxic):
    data, docs, labels = toxic
    net = toxicity.fit_toxicity(docs, labels, SMALL)
    bodies = [d[1].encode() for d in data[:60]] + [b"", sentence(1, 3000).encode()]
    together = toxicity.Scorer(net).documents(bodies)
    alone = [float(toxicity.Scorer(net).documents([b])[0]) for b in bodies]
    assert np.allclose(together, alone, atol=1e-5)


def test_toxicity_without_both_classes(spark):
    docs = frame(spark)
    labels = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    assert {round(r.score, 6) for r in score_toxicity(docs, labels, SMALL).collect()} == {0.01}
    assert {r.predicted for r in score_toxicity(docs, labels.limit(0), SMALL).collect()} == {0}


def test_co_training_teaches_the_other_view():
    g = np.random.default_rng(0)
    y = g.integers(0, 2, 3000)
    text, meta = (np.stack([y * s + g.standard_normal(3000) for _ in range(6)], axis=1) for s in (1.5, 1.0))
    few = 60
    model = co_train(text[:few], meta[:few], y[:few], np.arange(few) % 3 == 0, (text[few:2000], meta[few:2000]), quality.Settings())
    assert min(model.added) > 50
    p, q, both = model.scores(text[2000:], meta[2000:])
    right = [((s >= 0.5) == y[2000:]).mean() for s in (p, q, both)]
    assert right[2] > 0.96 and right[1] > 0.9
    alone = quality.Regression(1.0).fit(meta[:few][np.arange(few) % 3 > 0], y[:few][np.arange(few) % 3 > 0].astype(float))
    assert right[1] >= ((alone.raw(meta[2000:]) >= 0) == y[2000:]).mean() - 0.01


def test_quality(spark):
    data = junk_documents(500)
    docs = crowded(frame(spark, [d[:5] for d in data] + [(1000 + i if r[0] is not None else None, *r[1:]) for i, r in enumerate(rows())]))
    labels = spark.createDataFrame([(d[0], d[5]) for d in data if d[0] % 3] + [(1, None), (None, 0), (4, 0)], "doc_id long, quality int")
    found = {r.doc_id: r for r in score_quality(docs, labels).collect()}
    unseen = [d for d in data if d[0] % 3 == 0]
    assert sum(found[d[0]].keep == bool(d[5]) for d in unseen) > 0.97 * len(unseen)
    kept = keep_quality(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(k or -1 for k, r in found.items() if r.keep)
    assert keep_quality(docs, labels.limit(0)).count() == docs.count()
    assert score_quality(docs.limit(0), labels).collect() == []


def test_stages(spark, tmp_path):
    """All stages on a small folder; each is compared with a plain version on the rows that it got."""
    junk = junk_documents(160)
    item = sentence(777, 30)
    more = [(500, sentence(40, 120), "en", "a", 1), (501, sentence(40, 120) + " more", "en", "a", 1), (502, f"{sentence(41, 40)} {item}", "de", "b", 1), (503, f"{sentence(42, 60)} x.y@mail.example.com {sentence(43, 9)}", "de", "b", 1)]
    docs = [d[:5] for d in junk] + more + [(900 + i if r[0] is not None else None, *r[1:]) for i, r in enumerate(rows())]
    spark.createDataFrame(docs, DOCUMENTS).withColumn("extra", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d[0], d[5]) for d in junk], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = quality.fit_quality(got, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    order = lambda d: sorted(map(tuple, d), key=str)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = order(got.collect())
        out = stage(spark, got, str(tmp_path))
        if k == 4:
            pieces = out.collect()
            assert {r.doc_id for r in pieces} == {r[0] for r in before} and packed(pieces, 2048) == -(-sum(r.length for r in pieces) // 2048)
            break
        assert out.columns == got.columns, name
        out.write.parquet(f"{tmp_path}/{k}")
        got = spark.read.parquet(f"{tmp_path}/{k}")
        after = order(got.collect())
        if k == 0:
            x = [np.stack([f(r) for r in before]) for f in (lambda r: quality.text_features((r[1] or "").encode()), lambda r: quality.meta_features(*r[2:5]))]
            assert after == [r for r, s in zip(before, model.scores(*x)[2], strict=True) if s >= 0.5]
        elif k == 1:
            roots = grouped(len(before), lambda a, b: near(before[a][1], before[b][1]))  # noqa: B023
            best = {}
            for r, root in zip(before, roots, strict=True):
                best.setdefault(root, []).append((r[0] is None, r[0] or 0))
            assert sorted((r[0] is None, r[0] or 0) for r in after) == sorted(min(v) for v in best.values())
            assert set(after) <= set(before)
        elif k == 2:
            assert after == [r for r in before if normalised(item.encode()) not in normalised((r[1] or "").encode())] and len(after) < len(before)
        else:
            clean = [r if r[1] is None else (r[0], t := pii.mask_all(r[1]), r[2], r[3], r[4] if r[4] is None else len(t), r[5]) for r in before]
            clean = [r if r[1] is not None or r[4] is None else (*r[:4], 0, r[5]) for r in clean]
            assert after == order(clean) and any("[EMAIL]" in (r[1] or "") for r in after)


def test_regression_reaches_the_optimum_from_separable_rows():
    g = np.random.default_rng(3)
    x = g.standard_normal((80, 40))
    y = (x[:, 0] > 0).astype(float)
    r = quality.Regression(1.0).fit(x, y)
    a = r._x(x)
    slope = a.T @ (quality.sigmoid(a @ r.w) - y) + np.append(np.full(40, 1.0), 1e-6) * r.w
    assert np.abs(slope).max() < 1e-3


def test_a_view_without_signal_teaches_nothing():
    """Few labels, a metadata view of noise: the text view must stay as good as it was alone."""
    for seed in range(5):
        g = np.random.default_rng(seed)
        y = (g.random(2000) < 0.85).astype(int)
        text = np.stack([y * 3 + g.standard_normal(2000) for _ in range(8)], axis=1)
        meta = (g.random((2000, 30)) < 0.1).astype(float)
        few = 350
        args = text[:few], meta[:few], y[:few], np.arange(few) % 5 == 0, (text[few:1200], meta[few:1200])
        alone, model = (co_train(*args, quality.Settings(rounds=r)) for r in (0, 3))
        wrong = [((m.scores(text[1200:], meta[1200:])[2] >= 0.5) != y[1200:]).mean() for m in (alone, model)]
        assert wrong[1] <= wrong[0] + 0.005 and wrong[1] < 0.01
        assert model.lines[0][0] > 0


def test_added_rows_keep_the_mix_of_classes():
    zeros, ones = quality.in_mix([np.arange(40), np.arange(100, 500)], 0.8)
    assert len(zeros) == 40 and len(ones) == 160 and ones[0] == 100
    assert [len(r) for r in quality.in_mix([np.arange(0), np.arange(9)], 0.5)] == [0, 0]
    assert quality.platt(np.array([3.0, 2.0, -2.0, -3.0]), np.array([0, 0, 1, 1]))[0] == 0


def test_scores_by_a_plain_loop(spark):
    """Every score again, from the fitted numbers alone, feature by feature."""
    data = junk_documents(300)
    docs = frame(spark, [d[:5] for d in data])
    labels = spark.createDataFrame([(d[0], d[5]) for d in data if d[0] % 3], "doc_id long, quality int")
    model = quality.fit_quality(docs, labels)
    found = {r.doc_id: r for r in score_quality(docs, labels).collect()}

    def chance(view, line, x):
        z = view.w[-1]
        for v, m, s, w in zip(x, view.mean, view.scale, view.w, strict=False):
            z += w * min(8.0, max(-8.0, (float(v) - m) / s))
        return 1 / (1 + np.exp(-(line[0] * z + line[1])))

    for d in data[::17]:
        p = chance(model.views[0], model.lines[0], quality.text_features(d[1].encode()))
        q = chance(model.views[1], model.lines[1], quality.meta_features(*d[2:5]))
        both = model.blend @ [quality.logit(p), quality.logit(q), 1.0]
        r = found[d[0]]
        assert abs(r.text_score - p) < 1e-6 and abs(r.meta_score - q) < 1e-6 and abs(r.score - 1 / (1 + np.exp(-both))) < 1e-6
