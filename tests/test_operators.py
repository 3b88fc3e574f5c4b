"""Edge cases and properties on small frames."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.models.ensemble import blend_search, f1_weights, vote
from sparktab.operators import clean, encode, features, knn, metrics, moments, profile, ranking, split
from sparktab.sources import tables

INF, NAN = float("inf"), float("nan")


def rows(df):
    return [tuple(r) for r in df.collect()]


# --- clean-up and roles ----------------------------------------------------------

def test_sanitize_replaces_all_three_states(spark):
    df = spark.createDataFrame([(1, None), (2, NAN), (3, INF), (4, -INF), (5, 2.5)], "k int, x double")
    assert [r[1] for r in sorted(rows(clean.sanitize(df, ["x"])))] == [0.0, 0.0, 0.0, 0.0, 2.5]


def test_roles_count_only_unclear_types(spark):
    df = spark.range(30).select("id", (F.col("id") % 2 == 0).alias("flag"), F.col("id").cast("double").alias("x"), F.col("id").cast("string").alias("s"), F.timestamp_seconds("id").alias("t"))
    assert clean.infer_roles(df, ["id"]) == (["x", "t"], ["s", "flag"])


def test_holdout_needs_a_match(spark):
    df, ids = spark.range(5), spark.range(90, 95)
    with pytest.raises(ValueError):
        clean.holdout_by_ids(df, ids, "id")


def test_threshold_is_strict(spark):
    df = spark.createDataFrame([(0.5,), (0.51,)], "p double")
    assert [r[1] for r in rows(clean.apply_threshold(df, "p"))] == [0, 1]


def test_unlisted_value_maps_to_null(spark):
    df = spark.createDataFrame([(1, "M"), (2, "X"), (3, None)], "k int, s string")
    assert [r[1] for r in sorted(rows(clean.map_values(df, {"s": {"M": 1, "F": 0}, "absent": {}})))] == [1.0, None, None]


# --- ranking ------------------------------------------------------------------------

def test_narrowed_quantiles_equal_exact_ones(spark):
    rng = random.Random(7)
    values = [rng.choice([1.5, rng.gauss(0, 100), rng.expovariate(0.001)]) for _ in range(3000)] + [1.5] * 1500 + [None, NAN]
    df = spark.createDataFrame([(i % 3 if i % 7 else None, v) for i, v in enumerate(values)], "g int, x double")
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)
    exact = {r["g"]: r["q"] for r in ranking.exact_quantiles(df, ["x"], probs, ["g"]).collect()}
    narrowed = {r["g"]: r["q"] for r in ranking.exact_quantiles(df, ["x"], probs, ["g"], limit=40).collect()}
    assert exact.keys() == narrowed.keys() == {0, 1, 2, None}
    for g in exact:
        assert narrowed[g] == pytest.approx(exact[g], rel=1e-12)


def test_many_columns_narrow_to_the_same_quantiles(spark):
    cols = [f"c{i}" for i in range(30)]
    df = spark.range(800).select(*[(F.hash("id", F.lit(i)) % 1000 / 7.0).alias(c) for i, c in enumerate(cols)])
    a = {r["feature"]: r["q"] for r in ranking.exact_quantiles(df, cols, (0.25, 0.5, 0.75)).collect()}
    b = {r["feature"]: r["q"] for r in ranking.exact_quantiles(df, cols, (0.25, 0.5, 0.75), limit=100).collect()}
    assert a.keys() == b.keys()
    for c in cols:
        assert b[c] == pytest.approx(a[c], rel=1e-12)


def test_ranks_of_integers_stay_exact(spark):
    big = 2**60
    df = spark.range(1000).select((F.lit(big) + F.col("id")).alias("x"))
    found = ranking.order_values(df, ["x"], lambda n: [0, 500, 999], limit=10)
    assert found[("x",)].values == {0: big, 500: big + 500, 999: big + 999}


@pytest.mark.parametrize("limit", [25, 1_000_000])
def test_folds_partition_every_class(spark, limit):
    df = spark.range(1003).select("id", F.when(F.col("id") % 10 < 7, "hot").when(F.col("id") < 3, None).otherwise("cold").alias("c"))
    for out in (split.stratified_folds(df, "id", "c", 5, limit=limit), split.stratified_folds(df, "id", "c", 5, shuffle=False, limit=limit)):
        sizes = rows(out.groupBy("c", "fold").count())
        assert sum(n for _, _, n in sizes) == 1003
        for c in ("hot", "cold"):
            mine = [n for label, _, n in sizes if label == c]
            assert len(mine) == 5 and max(mine) - min(mine) <= 1


def test_small_class_gets_one_row_per_fold(spark):
    df = spark.createDataFrame([(i, "a" if i < 3 else "b") for i in range(20)], "id long, c string")
    small = rows(split.stratified_folds(df, "id", "c", 5).where("c = 'a'").groupBy("fold").count())
    assert sorted(n for _, n in small) == [1, 1, 1]


def test_split_does_not_depend_on_limit_or_partitions(spark):
    df = spark.range(500).select("id", (F.col("id") % 3).alias("c"))
    a = rows(split.stratified_split(df, "id", "c").orderBy("id"))
    b = rows(split.stratified_split(df.repartition(13), "id", "c", limit=20).orderBy("id"))
    assert a == b
    assert sum(r[2] for r in a) == 3 * 33  # 0.2 of 167, 167 and 166 rows


def test_bootstrap_sizes(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") < 4000, 0).otherwise(1).alias("c"))
    drawn = split.stratified_bootstrap(df, "id", "c", 500, bucket_rows=50)
    assert sorted(rows(drawn.groupBy("c").count())) == [(0, 400), (1, 100)]
    again = split.stratified_bootstrap(df, "id", "c", 500, bucket_rows=100_000)
    assert sorted(rows(drawn.select("draw", "id"))) == sorted(rows(again.select("draw", "id")))
    copies = split.bootstrap_replicas(df, "id", 0.8, 4)
    for _, n in rows(copies.groupBy("replica").agg(F.sum("copies"))):
        assert abs(n - 4000) < 250


# --- profiling --------------------------------------------------------------------

def test_describe_of_an_empty_table(spark):
    df = spark.createDataFrame([], "x double, g string")
    assert profile.describe(df, ["x"]).first()["n"] == 0
    assert profile.describe(df, ["x"], "g").count() == 0
    assert profile.value_counts(df, "g").count() == 0


def test_missing_and_info_count_nan(spark):
    df = spark.createDataFrame([(None, "a"), (NAN, None), (1.0, "b")], "x double, s string")
    assert dict(rows(profile.missing_counts(df))) == {"x": 2, "s": 1, "__total__": 3}
    assert {r["feature"]: r["non_null"] for r in profile.table_info(df).collect()} == {"x": 1, "s": 2}


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(2.0,)] * 5, "x double")
    assert rows(profile.histogram(df, "x", 10)) == [(5, 2.0, 2.1, 5)]


def test_duplicates_treat_nulls_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, None)], "k int, x double")
    assert dict(rows(profile.duplicate_counts(df, "k"))) == {"rows": 1, "keys": 1}


def test_wide_and_narrow_correlations_agree(spark):
    df = spark.range(2000).select(*[(F.hash("id", F.lit(i)) % 100 / 10.0 + (F.col("id") % 7) * i).alias(f"c{i}") for i in range(10)])
    df = df.withColumn("c3", F.when(F.col("c3") > 5, F.col("c3")))
    few = {(r[0], r[1]): r[2] for r in profile.corr_matrix(df, ["c1", "c3", "c7"]).collect()}
    many = {(r[0], r[1]): r[2] for r in profile.corr_matrix(df, [f"c{i}" for i in range(10)]).collect()}
    for pair, value in few.items():
        assert many[pair] == pytest.approx(value, abs=1e-9)


def test_moments_agree_across_paths(spark):
    df = spark.range(5000).select(*[(F.hash("id", F.lit(i)) % 1000 * 1.0 + 1e6).alias(f"c{i}") for i in range(12)])
    df = df.withColumn("c0", F.when(F.col("c0") > 1e6, F.col("c0")).when(F.col("c0") < 1e6 - 900, F.lit(INF)))
    many = moments.column_moments(df, [f"c{i}" for i in range(12)])
    for c in ("c0", "c5"):
        one = moments.column_moments(df, [c])[c]
        assert (many[c].n, many[c].rows, many[c].low, many[c].high) == (one.n, one.rows, one.low, one.high)
        assert many[c].mean == pytest.approx(one.mean) and many[c].std(1) == pytest.approx(one.std(1))


# --- features -----------------------------------------------------------------------

def test_wide_table_feature_names(spark):
    health = ["height_cm", "weight_kg", "bp_systolic", "bp_diastolic", "hdl_cholesterol", "ldl_cholesterol", "total_cholesterol", "vision_left",
              "vision_right", "hearing_left", "hearing_right", "ast_enzyme_level", "alt_enzyme_level"]
    numeric = health + [f"m{i}" for i in range(9)]
    df = spark.range(60).select("id", *[(F.hash("id", F.lit(i)) % 50 + 60.0).alias(c) for i, c in enumerate(numeric)],
                                F.when(F.col("id") % 2 == 0, "M").otherwise("F").alias("sex"), (F.col("id") % 2).cast("int").alias("y"))
    model = features.FeatureSpec("id", "y").fit(df)
    sizes = {}
    for r in model.summary(df).collect():
        sizes[r["block"]] = sizes.get(r["block"], 0) + 1
    assert sizes == {"linear": 22, "quadratic": 76, "logarithmic": 30, "other": 40, "statistical": 66, "categorical": 2}
    out = model.transform(df)
    assert out.columns == ["id", "y", *model.names]
    stats = moments.column_moments(out, list(model.names))
    assert all(abs(s.mean) < 1e-9 and (abs(s.std(0) - 1) < 1e-6 or s.std(0) == 0) for s in stats.values())


def test_constant_column_drops_conditional_features(spark):
    df = spark.createDataFrame([(i, 5.0, float(i)) for i in range(6)], "id int, flat double, x double")
    model = features.FeatureSpec("id", blocks=("other", "statistical"), categorical=()).fit(df)
    assert "flat_zscore" not in model.names and "flat_normalized" not in model.names and "exp_flat_normalized" not in model.names
    assert "flat_distance_from_mean" in model.names and "x_zscore" in model.names
    assert {r["flat_distance_from_mean"] for r in model.transform(df).collect()} == {0.0}


def test_missing_values_and_query_below_the_minimum(spark):
    train = spark.createDataFrame([(1, 1.0), (2, 5.0), (3, None), (4, INF)], "id int, x double")
    model = features.FeatureSpec("id", blocks=("linear", "logarithmic"), categorical=(), scaler=None).fit(train)
    assert model.names == ("x", "log_x")  # log10 needs a complete column
    low = spark.createDataFrame([(9, -50.0), (10, NAN)], "id int, x double")
    assert rows(model.transform(low).orderBy("id")) == [(9, -50.0, 0.0), (10, 0.0, 0.0)]


def test_unseen_and_null_levels(spark):
    train = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id int, s string")
    test = spark.createDataFrame([(1, "a"), (2, "zz"), (3, None), (4, "it's")], "id int, s string")
    model = features.FeatureSpec("id", blocks=("categorical",), encoding="both", scaler=None).fit(train)
    assert model.names == ("s_a", "s_b", "s_nan", "s_encoded")
    assert rows(model.transform(test).orderBy("id")) == [(1, 1.0, 0.0, 0.0, 0.0), (2, 0.0, 0.0, 0.0, -1.0), (3, 0.0, 0.0, 1.0, 2.0), (4, 0.0, 0.0, 0.0, -1.0)]


def test_missing_column_becomes_zero(spark):
    df = spark.createDataFrame([(1, 2.0)], "id int, x double")
    assert rows(clean.align_columns(df, ["y", "x"], ["id"])) == [(1, 0.0, 2.0)]


@pytest.mark.parametrize("mode,want", [("standard", [-1.0, 1.0]), ("minmax", [0.0, 1.0]), ("robust", [-1.0, 1.0]), ("other", None)])
def test_scalers(spark, mode, want):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "x double, flat double")
    scaler = features.fit_scaler(df, ["x", "flat"], mode)
    if want is None:
        assert scaler is None
        return
    out = sorted(rows(scaler.transform(df)))
    assert [r[0] for r in out] == pytest.approx(want) and [r[1] for r in out] == [0.0, 0.0]


def test_fitted_features_run_on_a_stream(spark, tmp_path):
    df = spark.range(40).select("id", (F.col("id") * 1.5).alias("x"))
    df.write.parquet(str(tmp_path / "in"))
    model = features.FeatureSpec("id", categorical=()).fit(df)
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = model.transform(stream).writeStream.format("memory").queryName("scored").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(rows(spark.table("scored"))) == sorted(rows(model.transform(df)))


def test_label_codes_round_trip(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c")], "id int, s string")
    coder = encode.fit_label(df, "s")
    out = coder.decode(coder.encode(df, "code"), "code", "back")
    assert rows(out.orderBy("id")) == [(1, "b", 1.0, "b"), (2, "a", 0.0, "a"), (3, "c", 2.0, "c")]


# --- sources --------------------------------------------------------------------------

def test_csv_reads_both_line_endings(spark, tmp_path):
    for name, end in (("unix", "\n"), ("dos", "\r\n")):
        path = tmp_path / f"{name}.csv"
        path.write_bytes(end.join(["k,x,s", "1,2.5,a", "2,,b"]).encode())
        assert rows(tables.read_table(spark, str(path), "k long, x double, s string")) == [(1, 2.5, "a"), (2, None, "b")]
    with pytest.raises(ValueError):
        tables.read_table(spark, str(path))


def test_load_checks_keys(spark):
    left, right = spark.range(3).withColumn("x", F.lit(1.0)), spark.createDataFrame([(0, 1), (1, 0)], "id long, y int")
    with pytest.raises(ValueError):
        tables.load_dataset(left, "id", "y", right)
    assert tables.load_dataset(left.where("id < 2"), "id", "y", right).count() == 2
    with pytest.raises(ValueError):
        tables.load_dataset(left, "id", "y")


# --- neighbours -----------------------------------------------------------------------

def brute_force(train, query, k, p):
    out = []
    for qid, q in query:
        gaps = sorted((float((np.abs(np.array(q) - np.array(t)) ** p).sum() ** (1 / p)), tid) for tid, t in train)
        out += [(qid, tid, rank + 1) for rank, (_, tid) in enumerate(gaps[:k])]
    return sorted(out)


@pytest.mark.parametrize("p", [1, 2, 3])
@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "pivots": 6, "chunk": 15}, {"broadcast_bytes": 0, "pivots": 1, "chunk": 1000}])
def test_neighbours_equal_brute_force(spark, p, options):
    rng = np.random.default_rng(3)
    train = [(i, [float(v) for v in rng.normal(size=3)]) for i in range(120)]
    train += [(200 + i, [0.25, 0.25, 0.25]) for i in range(60)]  # a third are copies of one point
    query = [(i, [float(v) for v in rng.normal(size=3)]) for i in range(40)] + [(100 + i, [0.25, 0.25, 0.25]) for i in range(20)]
    t, q = spark.createDataFrame(train, "id long, v array<double>"), spark.createDataFrame(query, "id long, v array<double>")
    got = knn.knn_join(t, q, "id", "v", 7, p, **options)
    assert sorted(tuple(r) for r in got.select("qid", "tid", "rank").collect()) == brute_force(train, query, 7, p)


def test_exact_match_takes_the_whole_vote(spark):
    train = spark.createDataFrame([(1, 0.0, "b"), (2, 0.1, "a"), (3, 0.1, "a")], "id long, x double, y string")
    query = spark.createDataFrame([(9, 0.0), (10, 0.05)], "id long, x double")
    out = {r["id"]: (r["prediction"], list(r["probability"])) for r in knn.knn_classify(train, query, "id", ["x"], "y", k=3).collect()}
    assert out[9] == ("b", [0.0, 1.0]) and out[10][0] == "a"


def test_tied_votes_go_to_the_first_class(spark):
    train = spark.createDataFrame([(1, 1.0, "b"), (2, -1.0, "a")], "id long, x double, y string")
    query = spark.createDataFrame([(9, 0.0)], "id long, x double")
    assert knn.knn_classify(train, query, "id", ["x"], "y", k=2, weights="uniform").first()["prediction"] == "a"


# --- metrics ----------------------------------------------------------------------------

def test_report_with_a_class_that_is_never_predicted(spark):
    df = spark.createDataFrame([("a", "a"), ("b", "a"), ("c", "c"), ("a", "d")], "y string, prediction string")
    out = {r["class"]: r for r in metrics.classification_report(df, "y").collect()}
    assert (out["b"]["precision"], out["b"]["recall"], out["b"]["f1"], out["b"]["support"]) == (0.0, 0.0, 0.0, 1)
    assert out["d"]["support"] == 0 and out["accuracy"]["f1"] == 0.5
    assert metrics.f1_macro(df, "y").first()[0] == pytest.approx((0.5 + 0 + 1 + 0) / 4)
    grid = metrics.confusion_matrix(df, "y")
    assert grid.count() == 16 and grid.agg(F.sum("n")).first()[0] == 4


def test_binary_scores_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, prediction int")
    assert metrics.f1_binary(df, "y").first()[0] == 0.0
    assert dict(rows(metrics.metric_summary(df, "y"))) == {"accuracy": 1.0, "precision": 0.0, "recall": 0.0, "f1": 0.0}
    assert split.weight_table(df, "y", "ratio")[1] == 1.0


@pytest.mark.parametrize("bucket_rows", [7, 1_000_000])
def test_curves_do_not_depend_on_buckets(spark, bucket_rows):
    rng = random.Random(5)
    data = [(round(rng.random(), 2), int(rng.random() < 0.4)) for _ in range(400)] + [(0.5, i % 2) for i in range(200)]
    df = spark.createDataFrame(data, "s double, y int")
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert metrics.roc_auc(df, "s", "y", bucket_rows=bucket_rows).first()[0] == pytest.approx(want)
    flipped = metrics.roc_auc(df.withColumn("s", -F.col("s")), "s", "y", bucket_rows=bucket_rows).first()[0]
    assert flipped == pytest.approx(1 - want)
    full = metrics.roc_curve(df, "s", "y", drop_intermediate=False, bucket_rows=bucket_rows)
    assert full.count() == len({s for s, _ in data}) + 1
    short = rows(metrics.roc_curve(df, "s", "y", bucket_rows=bucket_rows).orderBy(F.desc("threshold")))
    area = sum((b[1] - a[1]) * (a[2] + b[2]) / 2 for a, b in zip(short, short[1:]))
    assert area == pytest.approx(want) and short[0] == (INF, 0.0, 0.0) and short[-1][1:] == (1.0, 1.0)
    curve = sorted((r["recall"], -r["precision"]) for r in metrics.pr_curve(df, "s", "y", bucket_rows=bucket_rows).collect())
    assert curve[0] == (0.0, -1.0)
    assert 0 < metrics.pr_auc(df, "s", "y", bucket_rows=bucket_rows).first()[0] < 1


def test_log_loss_clips(spark):
    df = spark.createDataFrame([(0.0, 1), (1.0, 1)], "p double, y int")
    assert metrics.log_loss(df, "p", "y").first()[0] == pytest.approx(-math.log(1e-15) / 2)


# --- combining ----------------------------------------------------------------------------

def test_weights_and_votes(spark):
    assert f1_weights([0.0, 0.0]) == [0.5, 0.5]
    assert f1_weights([0.2, 0.4]) == pytest.approx([0.2, 0.8])
    df = spark.createDataFrame([([0.5, 0.5], [0.5, 0.5], 1, 0)], "p array<double>, q array<double>, a int, b int")
    assert vote(df, ["p", "q"], 2).first()["prediction"] == 0
    assert vote(df, ["a", "b"], 2, "hard").first()["prediction"] == 0
    assert vote(df, ["a", "b"], 2, "hard", [3.0, 1.0]).first()["prediction"] == 1


def test_blend_with_one_weight_is_the_model(spark):
    df = spark.createDataFrame([(0.9, 0.1, 1), (0.2, 0.8, 0), (0.6, 0.4, 0)], "a double, b double, y int")
    out = blend_search(df, ["a", "b"], "y", [((1.0, 0.0), 0.5), ((0.0, 1.0), 0.5)]).orderBy("ordinal").collect()
    assert [r["f1"] for r in out] == pytest.approx([2 / 3, 0.0])


def test_both_sides_of_the_size_limit_agree(spark):
    """NULL groups, columns without a finite value, NaN and infinities: the same rows from either path."""
    from sparktab.operators import profile

    inf, nan = float("inf"), float("nan")
    data = [(g, float(i % 17) if i % 5 else None, None, [inf, -inf, nan, float(i)][i % 4]) for g in ("a", "b", None) for i in range(60)]
    data += [("lonely", 1.0, None, inf)]
    df = spark.createDataFrame(data, "g string, x double, empty double, odd double")
    cols, order = ["x", "empty", "odd"], lambda d: sorted(map(str, d.collect()))
    for limit in (1, 100, 200):  # narrowed for all groups, for the large ones, for none
        for f in (lambda n: profile.describe(df, cols, "g", n), lambda n: profile.describe(df, cols, None, n), lambda n: profile.outlier_summary(df, cols, 1.5, n), lambda n: profile.box_stats(df, cols, "g", 1.5, n)):
            assert order(f(limit)) == order(f(10**9))
    assert profile.describe(df, cols, "g", 1).count() == 12
    assert profile.histogram(df, "odd", 4).agg(F.sum("n")).first()[0] == 45
    assert profile.corr_matrix(df, ["x", "odd"]).where("feature_a = 'x' AND feature_b = 'odd'").first()["corr"] == pytest.approx(
        profile.corr_matrix(df.select("*", *[F.col("x").alias(f"x{i}") for i in range(9)]), ["x", "odd", *[f"x{i}" for i in range(9)]]).where("feature_a = 'x' AND feature_b = 'odd'").first()["corr"]
    )


def test_incomplete_vectors_have_no_neighbours(spark):
    from sparktab.operators.knn import knn_join

    rows = [(i, float(i), float(i % 3)) for i in range(30)]
    odd = [(100, None, 1.0), (101, float("nan"), 1.0), (102, 1.0, float("inf"))]
    clean, mixed = (spark.createDataFrame(d, "id long, a double, b double") for d in (rows, rows + odd))
    want = sorted(map(tuple, knn_join(clean, clean, "id", ["a", "b"], 3).collect()))
    assert len(want) == 90
    for size in (64 << 20, 0):  # broadcast, pivots
        assert sorted(map(tuple, knn_join(mixed, mixed, "id", ["a", "b"], 3, broadcast_bytes=size).collect())) == want


def test_curves_with_infinite_scores_and_many_buckets(spark):
    from sparktab.operators.metrics import roc_auc

    inf = float("inf")
    df = spark.createDataFrame([(s, int((i * 7) % 3 == 0)) for i, s in enumerate([inf, -inf, 0.5, 0.25, inf, 0.75, -inf, 0.1] * 20)], "score double, y int")
    one, many = (roc_auc(df, "score", "y", 1, n).first()[0] for n in (10_000, 10))
    assert one == pytest.approx(many)


def test_copies_follow_the_rate(spark):
    from sparktab.functions.expressions import poisson_weight, unit_hash

    mean = spark.range(20_000).select(F.avg(poisson_weight(unit_hash(1, F.col("id")), 15.0))).first()[0]
    assert abs(mean - 15) < 0.15


def test_codes_of_levels(spark):
    from sparktab.operators.encode import label_code

    df = spark.createDataFrame([("b",), ("a",), ("zz",), (None,)], "c string")
    assert [r[0] for r in df.select(F.expr(label_code("c", ["a", "b"]))).collect()] == [1.0, 0.0, -1.0, -1.0]
    assert [r[0] for r in df.select(F.expr(label_code("c", []))).collect()] == [-1.0] * 4


def test_brackets_of_many_columns_fit_a_task_together(spark, monkeypatch):
    """What is looked at value by value is bounded over all columns, as one task may get it all; the ranks stay exact."""
    from sparktab.operators import ranking

    cols, seen = [f"c{i}" for i in range(12)], []
    df = spark.range(300).select(*[(((F.col("id") * 37 + i) % 300) / 7.0).alias(c) for i, c in enumerate(cols)])
    frame = ranking._bracket_frame
    monkeypatch.setattr(ranking, "_bracket_frame", lambda df, by, kind, brackets: seen.append(sum(b.size for b in brackets)) or frame(df, by, kind, brackets))
    found = ranking.order_values(df, cols, lambda n: [n // 2], limit=480, bins=16)
    assert all(found[c,].values == {150: 150 / 7.0} for c in cols)
    assert len(seen) > 1 and seen[-1] <= 480


def test_neighbours_in_tiles_and_boxes_against_brute_force():
    """Ties, equal rows and single precision: every path of a block finds what plain sorting finds, on a fraction of the work."""
    rng = np.random.default_rng(3)
    for d, scale in ((40, None), (40, 0.5), (3, None), (3, 2.0), (1, 30.0), (2, 0.0)):
        t, q = rng.normal(size=(9000, d)), rng.normal(size=(300, d))
        t, q = (t, q) if scale is None else (np.round(t * scale), np.round(q * scale))
        ids = rng.permutation(len(t))
        for p in (1, 2, 3):
            rows, cols, dist = knn.nearest(q, t, ids, 7, p)
            assert np.array_equal(rows, np.repeat(np.arange(len(q)), 7))
            for i in range(0, len(q), 23):
                plain = knn._exact(np.tile(q[i], (len(t), 1)), t, p)
                want = np.lexsort((ids, plain))[:7]
                assert np.array_equal(ids[cols[7 * i : 7 * i + 7]], ids[want]) and np.allclose(dist[7 * i : 7 * i + 7], plain[want], rtol=1e-12, atol=0)


def test_boxes_measure_few_pairs(monkeypatch):
    """Thirty times as many train rows do not bring many more exact distances."""
    rng, seen = np.random.default_rng(4), []
    plain = knn._exact
    monkeypatch.setattr(knn, "_exact", lambda a, b, p: seen.append(len(a)) or plain(a, b, p))
    for n in (3000, 90_000):
        knn.nearest(rng.uniform(size=(500, 3)), rng.uniform(size=(n, 3)), np.arange(n), 5, 2.0)
    assert seen and sum(seen) < 500 * 2 * 200


def test_neighbours_without_cells_copy_rows_by_blocks(spark, monkeypatch):
    """Rows of many components meet by blocks, same result; queries of a single file are dealt over the cores."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(rng.normal(size=(600, 24)))]
    df = spark.createDataFrame(rows, "id int, v array<double>").coalesce(1)
    met, old = [], knn._met
    monkeypatch.setattr(knn, "_met", lambda left, right, *a: met.append((left.count(), right.count())) or old(left, right, *a))
    for p in (1.0, 2.0):
        want = sorted(map(tuple, knn.knn_join(df, df, "id", "v", 4, p).collect()))
        assert sorted(map(tuple, knn.knn_join(df, df, "id", "v", 4, p, broadcast_bytes=0).collect())) == want
    assert len(met) == 2 and max(a + b for a, b in met) < 600 * 40  # 64 cells would take 64 copies of a query
    monkeypatch.setattr(knn, "SPREAD_ROWS", 100)
    assert knn.knn_join(df, df, "id", "v", 4).rdd.getNumPartitions() > 1
