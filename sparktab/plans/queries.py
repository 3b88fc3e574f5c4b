"""One query per operator over the standard tables. Names match ``oracles``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.functions.expressions import is_fractional
from sparktab.models import ensemble as ens
from sparktab.models import tune
from sparktab.models.bayes import gaussian_nb, GaussianNB
from sparktab.models.boosting import adaboost
from sparktab.models.kernel import KernelSVM, rbf_svm
from sparktab.models.learner import predict, refit
from sparktab.models.linear import linear_svm, logreg
from sparktab.models.mlp import mlp, mlp_ensemble
from sparktab.models.nca import bagged_knn, nca_fit
from sparktab.models.trees import gbt, large_forest, large_gbt, out_of_bag, random_forest
from sparktab.operators import clean, encode, knn, metrics, profile, split
from sparktab.operators.features import FeatureSpec, fit_scaler
from sparktab.plans import workflows
from sparktab.session import cached, ensure_checkpoint_dir
from sparktab.sources import tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
SHAPE = ("letter_share", "word_share", "log_chars")
VOWELS = ("share_a", "share_e", "share_n", "share_o")


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded and without negative zero, for comparing engines."""
    return df.select(*[(F.round(F.col(f"`{c}`"), digits) + F.lit(0.0)).alias(c) if is_fractional(df, c) else F.col(f"`{c}`") for c in df.columns])


def read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return tables.read_table(spark, f"{sf}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/tables-{uuid.uuid4().hex}"


def share(col: str, rest: Column) -> Column:
    """Share of the characters of a text that are missing from ``rest``."""
    n = F.length(col)
    return F.coalesce(F.try_divide((n - F.length(rest)).cast("double"), n), F.lit(0.0))


def without(col: str, letter: str) -> Column:
    return F.replace(F.replace(col, F.lit(letter)), F.lit(letter.upper()))


def shape_features(spark: SparkSession, sf: str) -> DataFrame:
    """Measures of the whole text of every document."""
    docs = read(spark, sf, "documents")
    words = F.split("text", " ")
    return docs.select(
        "doc_id", "lang",
        share("text", F.translate("text", LETTERS, "")).alias("letter_share"),
        (F.size(F.array_distinct(words)) / F.size(words)).alias("word_share"),
        F.log1p(F.col("n_chars")).alias("log_chars"),
        *[share("text", without("text", c)).alias(f"share_{c}") for c in "aeno"],
    )


def quality(spark: SparkSession, sf: str) -> DataFrame:
    """The binary task: text shape against the quality label."""
    return tables.load_dataset(shape_features(spark, sf), "doc_id", "quality", read(spark, sf, "labels"), validate=False)


def languages(spark: SparkSession, sf: str) -> DataFrame:
    """The four-class task: letter shares against the coded language."""
    docs = shape_features(spark, sf)
    coded = encode.fit_label(docs, "lang").encode(docs, "y")
    return coded.withColumn("y", F.col("y").cast("int"))


def scored_items(spark: SparkSession, sf: str) -> DataFrame:
    """Three fixed scores in [0, 1] over the line items, with a binary label."""
    li = read(spark, sf, "lineitem")
    s1 = F.col("l_quantity") / 50.0
    s2 = F.col("l_extendedprice") / 105000.0
    s3 = F.col("l_discount") * 4.0 + F.col("l_tax") * 5.0
    out = li.select((F.col("l_linestatus") == "O").cast("int").alias("y"), "l_returnflag", s1.alias("s1"), s2.alias("s2"), s3.alias("s3"))
    for s in ("s1", "s2", "s3"):
        out = clean.apply_threshold(out, s, 0.5, f"p{s[1]}")
    return out


def classed_items(spark: SparkSession, sf: str) -> DataFrame:
    """Three classes against a fixed three-class guess."""
    guess = F.when(F.col("s1") > 0.6, "A").when(F.col("s2") > 0.5, "N").otherwise("R")
    return scored_items(spark, sf).select(F.col("l_returnflag").alias("label"), guess.alias("prediction"))


# --- sources and sinks -------------------------------------------------------

@query
def csv_round_trip(spark, sf):
    df = read(spark, sf, "customer")
    path = scratch(spark) + "/customer.csv"
    tables.write_table(df, path, "csv")
    return tables.read_table(spark, path, df.schema)


@query
def keyed_load(spark, sf):
    return rounded(quality(spark, sf).select("doc_id", "quality", *SHAPE))


@query
def load_with_fallback(spark, sf):
    orders = read(spark, sf, "orders")
    kept = tables.load_dataset(orders, "o_orderkey", "o_orderstatus")
    features, target = clean.split_xy(orders, "o_orderkey", "o_orderstatus")
    joined = tables.load_dataset(features, "o_orderkey", "o_orderstatus", target)
    cols = ("o_orderkey", "o_orderstatus", "o_totalprice")
    return kept.select(*cols, F.lit("embedded").alias("origin")).unionByName(joined.select(*cols, F.lit("table").alias("origin")))


@query
def build_if_missing(spark, sf):
    path = scratch(spark) + "/features"

    def build():
        return read(spark, sf, "part").select("p_partkey", (F.col("p_retailprice") * F.col("p_size")).alias("value"))

    tables.ensure_features(spark, path, build)
    return rounded(tables.ensure_features(spark, path, build), 4)


@query
def prediction_sink(spark, sf):
    df = read(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") / 500000.0).alias("score"))
    path = scratch(spark) + "/predictions.csv"
    tables.write_predictions(clean.apply_threshold(df, "score"), "o_orderkey", "label", path)
    return tables.read_table(spark, path, "o_orderkey bigint, label int")


# --- projections and predicates ----------------------------------------------

@query
def select_and_drop(spark, sf):
    df = clean.drop_cols(read(spark, sf, "customer"), ["c_name", "no_such_column"])
    return clean.select_features(df, ["c_custkey", "c_acctbal", "c_mktsegment"])


@query
def column_roles(spark, sf):
    numeric, text = clean.infer_roles(read(spark, sf, "orders"), ["o_orderkey"])
    return spark.createDataFrame([(c, "numeric") for c in numeric] + [(c, "categorical") for c in text], "feature string, role string")


@query
def sanitized(spark, sf):
    c = F.col("c_acctbal")
    df = read(spark, sf, "customer").select("c_custkey", F.exp(c).alias("grown"), F.ln(c).alias("logged"), F.sqrt(c).alias("root"))
    # ln gives NULL below zero, sqrt gives NaN, exp overflows to infinity
    fixed = clean.sanitize(df, ["grown", "logged", "root"])
    return rounded(fixed.select("c_custkey", F.log1p("grown").alias("grown"), "logged", "root"))


@query
def rows_of_one_class(spark, sf):
    return clean.rows_of_class(read(spark, sf, "customer"), "c_mktsegment", "BUILDING").select("c_custkey", "c_acctbal")


@query
def outlier_rows(spark, sf):
    return profile.outlier_rows(read(spark, sf, "events"), ["value"]).select("event_id", "value")


@query
def holdout_by_ids(spark, sf):
    rest, held = clean.holdout_by_ids(read(spark, sf, "documents"), read(spark, sf, "labels"), "doc_id")
    return rest.select("doc_id", F.lit("train").alias("part")).unionByName(held.select("doc_id", F.lit("held").alias("part")))


@query
def thresholded(spark, sf):
    df = read(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") / 500000.0).alias("score"))
    return clean.apply_threshold(df, "score", 0.4).select("o_orderkey", "prediction")


@query
def aligned_columns(spark, sf):
    df = read(spark, sf, "part")
    return clean.align_columns(df, ["p_size", "not_there", "p_retailprice"], keep=["p_partkey"])


@query
def preview(spark, sf):
    return clean.preview(read(spark, sf, "orders"), 10, "o_orderkey").select("o_orderkey", "o_custkey", "o_totalprice")


@query
def mapped_values(spark, sf):
    codes = {"o_orderstatus": {"F": 1, "O": 0}, "o_orderpriority": {"1-URGENT": 1, "5-LOW": 0}}
    return clean.map_values(read(spark, sf, "orders"), codes).select("o_orderkey", "o_orderstatus_encoded", "o_orderpriority_encoded")


@query
def table_lookup(spark, sf):
    out = clean.lookup(read(spark, sf, "customer"), "c_nationkey", read(spark, sf, "nation"), "n_nationkey", "n_name", "nation")
    return out.select("c_custkey", "nation")


# --- profiling -----------------------------------------------------------------

@query
def table_info(spark, sf):
    return profile.table_info(read(spark, sf, "orders"))


@query
def missing_counts(spark, sf):
    li = read(spark, sf, "lineitem")
    return profile.missing_counts(li.withColumn("ratio", F.try_divide(F.col("l_tax"), F.col("l_discount"))))


@query
def missing_counts_positive(spark, sf):
    li = read(spark, sf, "lineitem")
    return profile.missing_counts(li.withColumn("ratio", F.try_divide(F.col("l_tax"), F.col("l_discount"))), only_positive=True)


@query
def value_counts(spark, sf):
    return rounded(profile.value_counts(read(spark, sf, "events"), "event_type"))


@query
def value_counts_by_value(spark, sf):
    return rounded(profile.value_counts(read(spark, sf, "customer"), "c_mktsegment", "value"))


@query
def describe(spark, sf):
    return rounded(profile.describe(read(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]), 4)


@query
def describe_by_class(spark, sf):
    return rounded(profile.describe(read(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"], "l_returnflag"), 4)


@query
def stats_by_group(spark, sf):
    return rounded(profile.stats_by_group(read(spark, sf, "customer"), "c_mktsegment", ["c_acctbal"]), 4)


@query
def distinct_counts(spark, sf):
    return profile.nunique(read(spark, sf, "part"), ["p_brand", "p_type", "p_size", "p_name"])


@query
def distinct_values(spark, sf):
    return profile.distinct_values(read(spark, sf, "orders"), "o_orderpriority")


@query
def duplicate_rows(spark, sf):
    return profile.duplicate_counts(read(spark, sf, "lineitem"), "l_orderkey")


@query
def crosstab(spark, sf):
    return profile.crosstab(read(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", ["F", "O"])


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query
def corr_matrix(spark, sf):
    return rounded(profile.corr_matrix(read(spark, sf, "lineitem"), MEASURES))


@query
def target_corr(spark, sf):
    li = read(spark, sf, "lineitem").withColumn("y", (F.col("l_linestatus") == "O").cast("int"))
    return rounded(profile.target_corr(li, MEASURES, "y"))


@query
def top_corr(spark, sf):
    return rounded(profile.top_corr(quality(spark, sf), [*SHAPE, *VOWELS], "quality", 4))


@query
def outlier_summary(spark, sf):
    return rounded(profile.outlier_summary(read(spark, sf, "events"), ["value", "user_id"]), 4)


@query
def compare_tables(spark, sf):
    orders = read(spark, sf, "orders")
    early, late = orders.where(F.col("o_orderdate") < "1998-01-01"), orders.where(F.col("o_orderdate") >= "1998-01-01")
    return rounded(profile.compare_tables(early, late.drop("o_orderkey"), ["o_orderkey", "o_totalprice", "o_custkey"]), 4)


@query
def value_ranges(spark, sf):
    return profile.ranges(read(spark, sf, "customer"), ["c_acctbal", "c_nationkey"])


@query
def summary_report(spark, sf):
    return rounded(profile.summary_report(read(spark, sf, "orders"), read(spark, sf, "customer"), "o_orderkey", "o_orderstatus", ["o_totalprice", "o_custkey"], ["o_orderpriority"]), 4)


@query
def histogram(spark, sf):
    return rounded(profile.histogram(read(spark, sf, "lineitem"), "l_extendedprice", 50), 4)


@query
def histogram_by_class(spark, sf):
    return rounded(profile.histogram(read(spark, sf, "customer"), "c_acctbal", 30, "c_mktsegment"), 4)


@query
def box_stats(spark, sf):
    return rounded(profile.box_stats(read(spark, sf, "events"), ["value"], "event_type"), 4)


@query
def scatter_sample(spark, sf):
    return profile.scatter_sample(read(spark, sf, "orders"), "o_totalprice", "o_custkey", "o_orderstatus", 20, ["o_orderkey"])


@query
def class_weights(spark, sf):
    df = split.class_weights(read(spark, sf, "labels"), "quality")
    return rounded(df.select("doc_id", "quality", "weight"))


@query
def class_ratio(spark, sf):
    df = split.class_weights(read(spark, sf, "labels"), "quality", "ratio")
    return rounded(df.groupBy("quality").agg(F.max("weight").alias("weight"), F.count("*").alias("n")))


# --- features ------------------------------------------------------------------

def accounts(spark: SparkSession, sf: str) -> DataFrame:
    """Two measures of every customer, in units that keep all digits comparable."""
    c = read(spark, sf, "customer")
    return c.select("c_custkey", "c_mktsegment", (F.col("c_acctbal") / 100).alias("c_acctbal"), (F.col("c_nationkey") + 1).alias("c_nationkey"))


def account_pair(scaler: str | None, **options) -> FeatureSpec:
    return FeatureSpec("c_custkey", layout="pair", numeric=("c_acctbal", "c_nationkey"), categorical=(), short=("balance", "nation"), scaler=scaler, **options)


@query
def pair_features(spark, sf):
    df = accounts(spark, sf)
    return rounded(account_pair(None).fit(df).transform(df))


@query
def pair_features_standard(spark, sf):
    df = accounts(spark, sf)
    return rounded(account_pair("standard").fit(df).transform(df), 4)


@query
def pair_features_minmax(spark, sf):
    df = accounts(spark, sf)
    return rounded(account_pair("minmax", blocks=("linear", "logarithmic", "statistical")).fit(df).transform(df))


@query
def pair_features_robust(spark, sf):
    df = accounts(spark, sf)
    return rounded(account_pair("robust", blocks=("linear", "quadratic", "other")).fit(df).transform(df), 4)


@query
def batch_statistics(spark, sf):
    df = accounts(spark, sf)
    train, test = split.train_test(df, "c_custkey", "c_mktsegment")
    model = account_pair(None, blocks=("statistical",), stats_scope="batch").fit(train)
    return rounded(model.transform(test))


def part_spec(**options) -> FeatureSpec:
    return FeatureSpec("p_partkey", numeric=("p_retailprice", "p_size"), categorical=("p_brand", "p_type"), **options)


@query
def wide_features(spark, sf):
    df = read(spark, sf, "part")
    return rounded(part_spec(scaler=None, blocks=("linear", "quadratic", "logarithmic", "other", "statistical")).fit(df).transform(df), 4)


@query
def onehot_standard(spark, sf):
    df = read(spark, sf, "part")
    return rounded(FeatureSpec("p_partkey", numeric=("p_size",), categorical=("p_type",), blocks=("linear", "categorical")).fit(df).transform(df))


@query
def label_codes(spark, sf):
    df = read(spark, sf, "part")
    return part_spec(scaler=None, encoding="label", blocks=("categorical",)).fit(df).transform(df)


@query
def label_codes_many(spark, sf):
    """Any number of levels, by join; one part in ten is left out of the fit, so some names are unseen."""
    df = read(spark, sf, "part")
    codes = encode.code_table(df.where(F.col("p_partkey") % 10 != 0), "p_name")
    return encode.encode_by_table(df, "p_name", codes, "p_name_code").select("p_partkey", "p_name", "p_name_code")


@query
def both_encodings(spark, sf):
    df = read(spark, sf, "customer")
    return FeatureSpec("c_custkey", numeric=(), categorical=("c_mktsegment",), encoding="both", scaler=None, blocks=("categorical",)).fit(df).transform(df)


@query
def unseen_levels(spark, sf):
    parts = read(spark, sf, "part")
    fitted = FeatureSpec("p_partkey", numeric=(), categorical=("p_brand",), encoding="label", scaler=None, blocks=("categorical",)).fit(parts.where("p_size <= 1"))
    return fitted.transform(parts)


@query
def health_ratios(spark, sf):
    c = read(spark, sf, "customer")
    a, n = F.col("c_acctbal"), F.col("c_nationkey")
    df = c.select(
        "c_custkey", (n + 150).alias("height_cm"), (F.abs(a) / 100 + 40).alias("weight_kg"), (n * 3 + 90).alias("bp_systolic"),
        (n + 60).alias("bp_diastolic"), (F.abs(a) / 90 + 30).alias("hdl_cholesterol"), (n * 4 + 1).alias("ldl_cholesterol"),
        (F.abs(a) / 50).alias("total_cholesterol"), (n / 10).alias("vision_left"), (F.abs(a) / 9000).alias("vision_right"),
        (n % 2 + 1).alias("hearing_left"), (n % 3).alias("hearing_right"), (n + 10).alias("ast_enzyme_level"), (F.abs(a) / 200 + 5).alias("alt_enzyme_level"),
    )
    spec = FeatureSpec("c_custkey", scaler=None, max_interact=0, blocks=("quadratic",), categorical=())
    out = spec.fit(df).transform(df)
    return rounded(out.select("c_custkey", *[label for label, _, _ in spec.domain]))


@query
def feature_list(spark, sf):
    df = accounts(spark, sf)
    return account_pair(None).fit(df).summary(df)


@query
def preprocess_train_test(spark, sf):
    df = read(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    train, test = split.train_test(df, "o_orderkey", "o_orderstatus")
    spec = FeatureSpec("o_orderkey", "o_orderstatus", numeric=("o_totalprice",), categorical=(), blocks=("linear", "logarithmic", "statistical"))
    a, b, _ = workflows.preprocess(train, test, spec)
    return rounded(a.withColumn("part", F.lit("train")).unionByName(b.withColumn("part", F.lit("test"))))


@query
def target_codes(spark, sf):
    df = read(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    coder = encode.fit_label(df, "c_mktsegment")
    return coder.decode(coder.encode(df, "code"), "code", "decoded")


@query
def simple_preprocess(spark, sf):
    li = read(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    train, test, ids = encode.preprocess_simple(li, li, "o_orderkey", {"o_orderstatus": {"F": 1, "O": 0}})
    return test.join(ids, "o_orderkey").unionByName(train)


# --- splits --------------------------------------------------------------------

@query
def stratified_split(spark, sf):
    return split.stratified_split(read(spark, sf, "orders"), "o_orderkey", "o_orderstatus").select("o_orderkey", "o_orderstatus", "is_test")


@query
def stratified_folds(spark, sf):
    return split.stratified_folds(read(spark, sf, "orders"), "o_orderkey", "o_orderstatus").select("o_orderkey", "fold")


@query
def ordered_folds(spark, sf):
    return split.stratified_folds(read(spark, sf, "orders"), "o_orderkey", "o_orderstatus", shuffle=False).select("o_orderkey", "fold")


@query
def plain_folds(spark, sf):
    return split.kfold(read(spark, sf, "orders"), "o_orderkey").select("o_orderkey", "fold")


@query
def stratified_bootstrap(spark, sf):
    return split.stratified_bootstrap(read(spark, sf, "orders"), "o_orderkey", "o_orderstatus", 800).select("draw", "o_orderkey", "o_orderstatus")


@query
def bootstrap_replicas(spark, sf):
    return split.bootstrap_replicas(read(spark, sf, "customer"), "c_custkey", 0.8, 20).select("c_custkey", "replica", "copies")


# --- metrics -------------------------------------------------------------------

@query
def accuracy(spark, sf):
    return rounded(metrics.accuracy(classed_items(spark, sf), "label"))


@query
def f1_binary(spark, sf):
    return rounded(metrics.f1_binary(scored_items(spark, sf), "y", "p1"))


@query
def f1_macro(spark, sf):
    return rounded(metrics.f1_macro(classed_items(spark, sf), "label"))


@query
def f1_auto(spark, sf):
    two = metrics.f1_auto(scored_items(spark, sf), "y", "p2").withColumn("task", F.lit("binary"))
    return rounded(two.unionByName(metrics.f1_auto(classed_items(spark, sf), "label").withColumn("task", F.lit("multi"))))


@query
def classification_report(spark, sf):
    return rounded(metrics.classification_report(classed_items(spark, sf), "label"))


@query
def confusion_matrix(spark, sf):
    return metrics.confusion_matrix(scored_items(spark, sf).select(F.col("l_returnflag").alias("a"), F.lit("A").alias("b")), "a", "b")


@query
def precision_recall(spark, sf):
    df = scored_items(spark, sf)
    p = metrics.precision(df, "y", "p3").toDF("value").withColumn("metric", F.lit("precision"))
    return rounded(p.unionByName(metrics.recall(df, "y", "p3").toDF("value").withColumn("metric", F.lit("recall"))))


@query
def roc_curve(spark, sf):
    return rounded(metrics.roc_curve(scored_items(spark, sf), "s3", "y"), 8)


@query
def roc_auc(spark, sf):
    return rounded(metrics.roc_auc(scored_items(spark, sf), "s2", "y"))


@query
def pr_curve(spark, sf):
    return rounded(metrics.pr_curve(scored_items(spark, sf), "s1", "y"), 8)


@query
def pr_auc(spark, sf):
    return rounded(metrics.pr_auc(scored_items(spark, sf), "s2", "y"))


@query
def log_loss(spark, sf):
    df = split.class_weights(scored_items(spark, sf), "y")
    plain = metrics.log_loss(df, "s1", "y").withColumn("kind", F.lit("plain"))
    return rounded(plain.unionByName(metrics.log_loss(df, "s1", "y", "weight").withColumn("kind", F.lit("weighted"))))


@query
def metric_summary(spark, sf):
    return rounded(metrics.metric_summary(scored_items(spark, sf), "y", "p1"))


@query
def model_scores(spark, sf):
    return rounded(metrics.model_scores(scored_items(spark, sf), "y", {"quantity": "p1", "price": "p2", "discount": "p3"}))


# --- models with an exact counterpart --------------------------------------------

@query
def naive_bayes(spark, sf):
    df = cached(quality(spark, sf))
    train, test = split.train_test(df, "doc_id", "quality")
    out = gaussian_nb(train, SHAPE, "quality").transform(test)
    return rounded(out.select("doc_id", "prediction", F.col("probability")[1].alias("p1")))


@query
def naive_bayes_multiclass(spark, sf):
    df = cached(languages(spark, sf))
    model = gaussian_nb(df, VOWELS, "y")
    return rounded(predict(model, df, "doc_id").select("doc_id", "prediction", F.col("probability")[0].alias("p0")), 5)


@query
def training_metrics(spark, sf):
    df = cached(quality(spark, sf))
    return rounded(metrics.metric_summary(refit(GaussianNB(SHAPE, "quality"), df).transform(df), "quality"))


@query
def decision_surface(spark, sf):
    li = read(spark, sf, "lineitem").select((F.col("l_extendedprice") / 1000).alias("price"), F.col("l_quantity").alias("quantity"), "l_linestatus")
    model = gaussian_nb(li, ("price", "quantity"), "l_linestatus")
    return rounded(workflows.score_grid(model, li, "price", "quantity", 2.0).select("price", "quantity", "prediction"))


@query
def nearest_neighbours(spark, sf):
    e = read(spark, sf, "embeddings")
    return rounded(knn.knn_join(e, e, "vec_id", "embedding", 5))


@query
def nearest_neighbours_pivots(spark, sf):
    """The path for training sides that are not broadcast."""
    e = read(spark, sf, "embeddings")
    return rounded(knn.knn_join(e, e, "vec_id", "embedding", 5, broadcast_bytes=0))


@query
def nearest_neighbours_manhattan(spark, sf):
    e = read(spark, sf, "embeddings")
    return rounded(knn.knn_join(e, e, "vec_id", "embedding", 3, p=1))


@query
def knn_classify(spark, sf):
    e = read(spark, sf, "embeddings")
    train, test = split.train_test(e, "vec_id", "label")
    out = knn.knn_classify(train, test, "vec_id", "embedding", "label", k=15)
    return rounded(out.select("vec_id", "prediction", F.array_max("probability").alias("top_share")))


@query
def knn_settings(spark, sf):
    df = cached(split.stratified_folds(quality(spark, sf).select("doc_id", "quality", *SHAPE), "doc_id", "quality"))
    return rounded(tune.knn_grid(df, "doc_id", SHAPE, "quality"))


@query
def holdout_report(spark, sf):
    """Hold out the documents whose labels are toxic; train on the rest."""
    df = cached(quality(spark, sf))
    ids = read(spark, sf, "labels").where("toxic = 1")
    _, report, _ = workflows.evaluate_holdout(df, ids, "doc_id", "quality", GaussianNB(SHAPE, "quality"))
    return rounded(report)


@query
def naive_bayes_report(spark, sf):
    """The flagship: text features, scaling, split, naive Bayes, report."""
    df = cached(quality(spark, sf))
    spec = FeatureSpec("doc_id", "quality", numeric=SHAPE, categorical=(), blocks=("linear",))
    train, test = split.train_test(df, "doc_id", "quality")
    a, b, _ = workflows.preprocess(train, test, spec)
    return rounded(metrics.classification_report(gaussian_nb(a, SHAPE, "quality").transform(b), "quality"))


# --- combining -----------------------------------------------------------------

def share_columns(df: DataFrame) -> DataFrame:
    return df.withColumns({f"probability_{i}": F.array(F.lit(1.0) - F.col(f"s{i}"), F.col(f"s{i}")) for i in (1, 2, 3)})


def vote_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("y", "prediction").agg(F.count("*").alias("n"))


@query
def soft_vote(spark, sf):
    return vote_counts(ens.vote(share_columns(scored_items(spark, sf)), [f"probability_{i}" for i in (1, 2, 3)], 2))


@query
def hard_vote(spark, sf):
    return vote_counts(ens.vote(scored_items(spark, sf), ["p1", "p2", "p3"], 2, "hard"))


@query
def weighted_vote(spark, sf):
    df = share_columns(scored_items(spark, sf))
    scores = metrics.model_scores(df, "y", {"1": "p1", "2": "p2", "3": "p3"}).orderBy("ordinal").collect()
    return vote_counts(ens.vote(df, [f"probability_{i}" for i in (1, 2, 3)], 2, "soft", ens.f1_weights([r["f1"] for r in scores])))


@query
def vote_weights(spark, sf):
    return rounded(ens.f1_weight_table(metrics.model_scores(scored_items(spark, sf), "y", {"1": "p1", "2": "p2", "3": "p3"})))


@query
def blend_search_pair(spark, sf):
    return rounded(ens.blend_search(scored_items(spark, sf), ["s1", "s2"], "y", ens.pair_grid(**ens.PAIR_FIVE_THRESHOLDS)))


@query
def blend_search_fine(spark, sf):
    return rounded(ens.blend_search(scored_items(spark, sf), ["s2", "s3"], "y", ens.pair_grid()))


@query
def blend_search_triple(spark, sf):
    return rounded(ens.blend_search(scored_items(spark, sf), ["s1", "s2", "s3"], "y", ens.triple_grid()))


@query
def blend_search_classes(spark, sf):
    """Four sets of shares for three classes: every weight vector in steps of a tenth."""
    s1, s2, s3 = F.col("s1"), F.col("s2"), F.col("s3")
    shares = {"a": (s1, 1 - s1, F.lit(0.4)), "b": (F.lit(0.4), s2, 1 - s2), "c": (1 - s3, F.lit(0.5), s3), "d": (F.lit(0.3), 1 - s1, s2)}
    df = scored_items(spark, sf).withColumns({"y": F.array_position(F.array(*map(F.lit, "ANR")), F.col("l_returnflag")).cast("int") - 1, **{n: F.array(*v) for n, v in shares.items()}})
    found = ens.blend_search_classes(df, list(shares), "y", 3, ens.simplex_grid(4))
    return rounded(found.select("ordinal", *[F.col("weights")[i].alias(f"w{i + 1}") for i in range(4)], "f1"))


@query
def best_blend(spark, sf):
    return rounded(ens.best_blend(ens.blend_search(scored_items(spark, sf), ["s1", "s2"], "y", ens.pair_grid(**ens.PAIR_FIVE_THRESHOLDS))))


@query
def blended(spark, sf):
    return vote_counts(ens.blend_predict(scored_items(spark, sf), ["s1", "s2"], (0.35, 0.65), 0.45))


@query
def best_method(spark, sf):
    scores = metrics.model_scores(scored_items(spark, sf), "y", {"quantity": "p1", "price": "p2", "discount": "p3"})
    return rounded(ens.select_best(scores).select("model", "f1"))


# --- models without one ----------------------------------------------------------

def binary_report(spark, sf, learner) -> DataFrame:
    df = cached(quality(spark, sf))
    train, test = split.train_test(df, "doc_id", "quality")
    return rounded(metrics.classification_report(learner.fit(cached(train)).transform(test), "quality"), 4)


def language_report(spark, sf, learner) -> DataFrame:
    df = cached(languages(spark, sf))
    train, test = split.train_test(df, "doc_id", "y")
    return rounded(metrics.classification_report(learner.fit(cached(train)).transform(test), "y"), 4)


@query
def logistic_l2(spark, sf):
    return binary_report(spark, sf, logreg(SHAPE, "quality"))


@query
def logistic_line(spark, sf):
    """Slope and intercept on one scaled measure, for several penalties."""
    df = cached(quality(spark, sf))
    rows = []
    for c in (0.01, 0.25, 4.0):
        model = logreg(("log_chars",), "quality", C=c, tol=1e-12).fit(df).model
        rows.append((c, float(model.coefficients[0]), float(model.intercept)))
    return rounded(spark.createDataFrame(rows, "c double, slope double, intercept double"), 4)


@query
def logistic_l1(spark, sf):
    return binary_report(spark, sf, logreg(SHAPE, "quality", C=0.1, penalty="l1"))


@query
def logistic_multiclass(spark, sf):
    return language_report(spark, sf, logreg(VOWELS, "y"))


@query
def linear_svm_binary(spark, sf):
    return binary_report(spark, sf, linear_svm(SHAPE, "quality"))


@query
def squared_hinge_line(spark, sf):
    """Slope and intercept on one scaled measure, for several penalties."""
    df = cached(quality(spark, sf))
    rows = [(c, *map(float, linear_svm(("log_chars",), "quality", C=c).fit(df).coefficients[0])) for c in (0.001, 0.25, 4.0)]
    return rounded(spark.createDataFrame(rows, "c double, slope double, intercept double"), 5)


@query
def linear_svm_multiclass(spark, sf):
    return language_report(spark, sf, linear_svm(VOWELS, "y"))


@query
def rbf_svm_multiclass(spark, sf):
    return language_report(spark, sf, rbf_svm(VOWELS, "y", C=10.0, n_components=100))


@query
def poly_svm_binary(spark, sf):
    return binary_report(spark, sf, KernelSVM(SHAPE, "quality", kernel="poly", scale="standard"))


@query
def forest(spark, sf):
    return language_report(spark, sf, random_forest(VOWELS, "y", key="doc_id"))


@query
def forest_large(spark, sf):
    return binary_report(spark, sf, large_forest(SHAPE, "quality", key="doc_id"))


@query
def forest_out_of_bag(spark, sf):
    df = cached(quality(spark, sf))
    scores = out_of_bag(large_forest(SHAPE, "quality", key="doc_id"), df)
    return rounded(spark.createDataFrame([(k, v) for k, v in sorted(scores.items())], "metric string, value double"), 4)


@query
def boosted_trees(spark, sf):
    return binary_report(spark, sf, gbt(SHAPE, "quality", key="doc_id"))


@query
def boosted_trees_multiclass(spark, sf):
    return language_report(spark, sf, gbt(VOWELS, "y", weighting=None, key="doc_id"))


@query
def boosted_trees_regularised(spark, sf):
    return binary_report(spark, sf, large_gbt(SHAPE, "quality", key="doc_id"))


@query
def adaptive_boosting(spark, sf):
    return language_report(spark, sf, adaboost(VOWELS, "y", key="doc_id"))


def first_cuts(spark, model, trees) -> DataFrame:
    """Feature, cut value and both sides of the first split of each ``(tree, left, right, extra)``."""
    rows = []
    for i, (tree, left, right, extra) in enumerate(trees):
        f = tree.feature[0]
        rows.append((i, SHAPE[f] if f >= 0 else None, float(model.cuts[f][tree.bin[0]]) if f >= 0 else None, float(left), float(right), extra))
    return spark.createDataFrame(rows, "round int, feature string, cut double, left double, right double, extra double")


@query
def boosted_stumps(spark, sf):
    """Three rounds of one cut on all rows, with both penalties: small enough to be written out in SQL."""
    learner = gbt(SHAPE, "quality", rounds=3, depth=1, rows=1.0, cols=1.0, l1=0.5, l2=2.0, key="doc_id")
    model = learner.fit(quality(spark, sf))
    return rounded(first_cuts(spark, model, [(t[0], v[0][1], v[0][2], None) for t, v in model.trees]).drop("extra"), 4)


@query
def adaptive_stumps(spark, sf):
    """Three adaptive rounds of one cut, with the weight of each vote."""
    model = adaboost(SHAPE, "quality", rounds=3, depth=1, key="doc_id").fit(quality(spark, sf))
    return rounded(first_cuts(spark, model, [(t, guess[1], guess[2], alpha) for t, guess, alpha in model.trees]).withColumnRenamed("extra", "alpha"), 4)


def scaled_languages(spark, sf) -> DataFrame:
    df = cached(languages(spark, sf))
    return fit_scaler(df, VOWELS).transform(df)


@query
def neural_network(spark, sf):
    train, test = split.train_test(scaled_languages(spark, sf), "doc_id", "y")
    model = mlp(VOWELS, "y", "doc_id", hidden=(128, 64), lr=0.3, dropout=0.1, epochs=50, batch=64).fit(train, test)
    return rounded(metrics.classification_report(model.transform(test), "y"), 4)


@query
def network_history(spark, sf):
    df = cached(quality(spark, sf))
    train, test = split.train_test(fit_scaler(df, SHAPE).transform(df), "doc_id", "quality")
    return rounded(mlp(SHAPE, "quality", "doc_id", hidden=(128, 64), lr=0.3, epochs=50, batch=32).fit(train, test).history_frame(spark), 4)


@query
def network_ensemble(spark, sf):
    df = cached(quality(spark, sf))
    data = fit_scaler(df, SHAPE).transform(df)
    bases = mlp_ensemble(SHAPE, "quality", "doc_id", epochs=6, batch=32)
    choice = workflows.choose_ensemble(bases, data, "doc_id", "quality", stacking_folds=None)
    return rounded(choice.scores, 4)


@query
def metric_learning(spark, sf):
    df = scaled_languages(spark, sf).select("doc_id", "y", F.array(*VOWELS).alias("x"))
    model = nca_fit(df, "doc_id", "x", "y", dim=2)
    steps = [(i, float(v)) for i, v in enumerate(model.objective)]
    return rounded(spark.createDataFrame(steps, "step int, objective double"))


@query
def bagged_neighbours(spark, sf):
    df = cached(languages(spark, sf))
    train, test = split.train_test(df, "doc_id", "y")
    out = bagged_knn(train, test, "doc_id", VOWELS, "y", k=5)
    return rounded(metrics.classification_report(out.join(test.select("doc_id", "y"), "doc_id"), "y"), 4)


@query
def cross_validation(spark, sf):
    df = cached(split.kfold(quality(spark, sf), "doc_id", 5))
    grid = [{"C": c, "penalty": p} for p, c in (("l2", 0.1), ("l2", 1.0), ("l2", 10.0), ("l1", 0.1), ("l1", 1.0))]
    report = tune.cv_report(lambda p: logreg(SHAPE, "quality", **p), grid, df, "quality")
    return rounded(tune.cv_means(report), 4)


@query
def best_single_fold(spark, sf):
    df = cached(split.kfold(quality(spark, sf), "doc_id", 5))
    report = tune.cv_report(lambda p: GaussianNB(SHAPE, "quality", **p), [{}, *[{"smoothing": s} for s in (0.1, 0.01, 0.001, 1e-6)]], df, "quality")
    return rounded(tune.best_fold(report), 4)


@query
def cross_validated_score(spark, sf):
    df = cached(split.stratified_folds(languages(spark, sf), "doc_id", "y", 5, shuffle=False))
    return rounded(tune.cross_val(GaussianNB(VOWELS, "y"), df, "y"), 4)


@query
def grid_search(spark, sf):
    df = cached(split.stratified_folds(languages(spark, sf), "doc_id", "y", 5))
    grid = [{"C": c} for c in (0.01, 0.1, 1.0, 10.0, 100.0)]
    best, model, _ = tune.grid_search(lambda p: logreg(VOWELS, "y", **p), grid, df, "y", "f1_macro")
    out = predict(model, df, "doc_id")
    return out.groupBy("prediction").agg(F.count("*").alias("n")).withColumn("best_c", F.lit(best["C"]))


@query
def svm_search(spark, sf):
    df = cached(quality(spark, sf))
    train, valid = split.train_test(df, "doc_id", "quality")
    grid = [{"C": c} for c in (0.25, 0.5, 1.0, 2.0)]
    _, scores = tune.holdout_search(lambda p: linear_svm(SHAPE, "quality", **p), grid, train, valid, "quality")
    return rounded(spark.createDataFrame([(p["C"], f) for p, f in scores], "c double, f1 double"), 4)


@query
def rbf_search(spark, sf):
    """Penalties and kernel widths, five folds: 125 fits."""
    df = cached(split.stratified_folds(languages(spark, sf), "doc_id", "y"))
    outer = [{"gamma": g} for g in tune.RBF_GRID["gamma"]]
    _, report = tune.penalty_search(lambda p: rbf_svm(VOWELS, "y", n_components=50, probability=False, **p), outer, tune.RBF_GRID["C"], df, "y")
    return rounded(tune.cv_means(report, "f1_macro"), 4)


@query
def stacking(spark, sf):
    df = cached(split.stratified_folds(quality(spark, sf), "doc_id", "quality", 5, shuffle=False))
    bases = {"forest": random_forest(SHAPE, "quality", key="doc_id"), "bayes": GaussianNB(SHAPE, "quality")}
    return rounded(metrics.metric_summary(ens.stack(bases, df, "quality", 2).transform(df), "quality"), 4)


@query
def ensemble_choice(spark, sf):
    df = cached(quality(spark, sf))
    bases = {"forest": random_forest(SHAPE, "quality", key="doc_id"), "logistic": logreg(SHAPE, "quality")}
    return rounded(workflows.choose_ensemble(bases, df, "doc_id", "quality").scores, 4)
