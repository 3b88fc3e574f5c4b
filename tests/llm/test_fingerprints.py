import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.llm.fingerprints import BINS, densified, edited_fingerprints, fingerprint, likeness

from .cases import DOCUMENTS, crowded, frame, rows, sentence


def shingles(text, k=5):
    words = [w for w in re.split("[ \t-\r]+", text.lower()) if w]
    return {" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def test_edited_texts_nulls_repeats_and_clashing_names(spark):
    found = edited_fingerprints(crowded(frame(spark))).collect()
    docs = {(r[0], r[1] or "") for r in rows()}
    ids = sorted({d[0] for d in docs if d[0] is not None}, reverse=True)
    texts = {k: [t for i, t in docs if i == k] for k in [*ids, None]}
    after = dict(zip([*ids, None], [*ids[1:], None, ids[0]], strict=True))
    assert sorted(str((r["doc_id"], r["n_chars"])) for r in found) == sorted(str((r[0], len(r[1] or ""))) for r in rows())
    for r in found:
        if len(texts[r["doc_id"]]) == 1 and len(texts[after[r["doc_id"]]]) == 1:
            text, other = texts[r["doc_id"]][0], texts[after[r["doc_id"]]][0]
            half = len(text) // 2
            edited = text[: len(text) - half] + other[:half]
            assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
            assert abs(r["near_edited"] - jaccard(text, edited)) < 0.16 and abs(r["near_next"] - jaccard(text, other)) < 0.16
    same = {r["fingerprint"] for r in found if r["doc_id"] in (25, 26)}
    assert len(same) == 1 and len(same.pop()) == 2 * BINS
    assert {r["fingerprint"] for r in found if r["doc_id"] in (20, 21, 22)} == {""}


def test_one_document_and_none(spark):
    assert edited_fingerprints(spark.createDataFrame([], DOCUMENTS)).collect() == []
    only = edited_fingerprints(spark.createDataFrame([(4, "abcdef", None, None, None)], DOCUMENTS)).first()
    assert only["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and only["near_next"] == 1.0 and only["next_id"] == 4


def test_likeness_is_unbiased_also_for_short_texts(spark):
    pairs = []
    for n in (30, 120, 600):
        for s in range(60):
            words = sentence(s, n).split()
            other = sentence(s + 500, n).split()
            cut = n * (s % 5) // 5
            pairs.append((n, " ".join(words), " ".join(words[: n - cut] + other[:cut])))
    df = spark.createDataFrame(pairs, "n int, a string, b string").select("*", likeness(fingerprint(F.col("a")), fingerprint(F.col("b"))).alias("x"))
    for n in (30, 120, 600):
        off = np.array([r["x"] - jaccard(r["a"], r["b"]) for r in df.where(F.col("n") == n).collect()])
        assert abs(off.mean()) < 0.02 and np.sqrt((off**2).mean()) < (0.09 if n == 30 else 0.05), n


def test_empty_bins_take_values_of_filled_ones(spark):
    one = spark.range(1).select(densified(F.array(F.lit(5).cast("long"), F.lit(1 << 60).cast("long"))).alias("v")).first()["v"]
    assert len(one) == BINS and one[0] == 5 and one[16] == 1 << 60 and set(one) == {5, 1 << 60}
    assert 0.35 < sum(v == 5 for v in one) / BINS < 0.65


@pytest.mark.parametrize("query", ["fingerprints"])
def test_no_python_on_the_main_path(spark, query):
    df = edited_fingerprints(frame(spark))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
