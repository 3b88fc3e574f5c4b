"""Evaluation of predictions.

Everything except the curves follows from counts per (label, prediction), a
table of classes squared. The curves use running totals in two levels, so that
no task has to hold all distinct scores.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from sparktab.functions.expressions import safe_share

MAX_BUCKETS = 10_000
BUCKET_ROWS = 1_000_000  # distinct scores that one task may have to sort


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return safe_share(F.lit(2) * tp, F.lit(2) * tp + fp + fn)


def confusion_counts(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction); pairs that do not occur are absent."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Counts over the full class grid, zeros kept, classes in order."""
    cells = confusion_counts(df, label, prediction)
    both = cells.select(F.explode(F.array("label", "prediction")).alias("c")).where(F.col("c").isNotNull())
    grid = both.agg(F.array_sort(F.collect_set("c")).alias("classes"))  # one row, one entry per class
    grid = grid.select(F.explode("classes").alias("label"), "classes")
    grid = grid.select("label", F.explode("classes").alias("prediction"))
    out = grid.join(cells, ["label", "prediction"], "left")
    return out.select("label", "prediction", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")).orderBy("label", "prediction")


def _per_class(df: DataFrame, label: str, prediction: str) -> DataFrame:
    cells = confusion_counts(df, label, prediction)

    def row(c: str, tp: Column, fp: Column, fn: Column) -> Column:
        return F.struct(F.col(c).cast("string").alias("class"), tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))

    n, zero = F.col("n"), F.lit(0).cast("bigint")
    hit = F.array(row("label", n, zero, zero))
    miss = F.array(row("label", zero, zero, n), row("prediction", zero, n, zero))
    parts = cells.select(F.inline(F.when(F.col("label") == F.col("prediction"), hit).otherwise(miss)))
    return parts.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])


def class_scores(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support of every class seen in labels or predictions."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return _per_class(df, label, prediction).select(
        "class", safe_share(tp, tp + fp).alias("precision"), safe_share(tp, tp + fn).alias("recall"),
        _f1(tp, fp, fn).alias("f1"), (tp + fn).alias("support"), "tp",
    )


def classification_report(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """Per-class rows, then accuracy, macro average and support-weighted average."""
    scores = class_scores(df, label, prediction)
    names = ("precision", "recall", "f1")
    per_class = scores.select("class", *names, "support")
    total = F.sum("support")
    share = F.sum("tp") / total
    averages = scores.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("class"), *[share.alias(c) for c in names], total.alias("support")),
            F.struct(F.lit("macro avg").alias("class"), *[F.avg(c).alias(c) for c in names], total.alias("support")),
            F.struct(
                F.lit("weighted avg").alias("class"),
                *[(F.sum(F.col(c) * F.col("support")) / total).alias(c) for c in names], total.alias("support"),
            ),
        ).alias("rows")
    )
    return per_class.unionByName(averages.select(F.inline("rows")))


def accuracy(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def f1_macro(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return class_scores(df, label, prediction).agg(F.avg("f1").alias("f1_macro"))


def _counts(label: str, prediction: str | Column, positive) -> tuple[Column, Column, Column]:
    y = F.col(label) == F.lit(positive)
    p = (F.col(prediction) if isinstance(prediction, str) else prediction) == F.lit(positive)
    return F.count_if(y & p), F.count_if(~y & p), F.count_if(y & ~p)


def f1_binary(df: DataFrame, label: str, prediction: str = "prediction", positive=1) -> DataFrame:
    return df.agg(_f1(*_counts(label, prediction, positive)).alias("f1"))


def precision(df: DataFrame, label: str, prediction: str = "prediction", positive=1) -> DataFrame:
    tp, fp, _ = _counts(label, prediction, positive)
    return df.agg(safe_share(tp, tp + fp).alias("precision"))


def recall(df: DataFrame, label: str, prediction: str = "prediction", positive=1) -> DataFrame:
    tp, _, fn = _counts(label, prediction, positive)
    return df.agg(safe_share(tp, tp + fn).alias("recall"))


def f1_auto(df: DataFrame, label: str, prediction: str = "prediction", positive=1) -> DataFrame:
    """F1 of the positive class for at most two true classes, else the macro average."""
    few = df.select(label).distinct().limit(3).count() <= 2
    out = f1_binary(df, label, prediction, positive) if few else f1_macro(df, label, prediction)
    return out.toDF("f1_auto")


def metric_summary(df: DataFrame, label: str, prediction: str = "prediction", positive=1) -> DataFrame:
    """Accuracy, precision, recall and F1 as rows, from one aggregation."""
    tp, fp, fn = _counts(label, prediction, positive)
    hits = F.avg((F.col(label) == F.col(prediction)).cast("double"))
    values = {
        "accuracy": hits, "precision": safe_share(tp, tp + fp),
        "recall": safe_share(tp, tp + fn), "f1": _f1(tp, fp, fn),
    }
    cells = [F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in values.items()]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def model_scores(df: DataFrame, label: str, predictions: Mapping[str, str], positive=1) -> DataFrame:
    """Accuracy and F1 of several prediction columns, all from one pass."""
    cells = []
    for i, (model, col) in enumerate(predictions.items()):
        f1 = _f1(*_counts(label, col, positive))
        hits = F.avg((F.col(label) == F.col(col)).cast("double"))
        cells.append(F.struct(F.lit(i).alias("ordinal"), F.lit(model).alias("model"), hits.alias("accuracy"), f1.alias("f1")))
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def log_loss(df: DataFrame, p: str, y: str, w: str | None = None) -> DataFrame:
    """Mean weighted log-loss; probabilities clipped to [1e-15, 1 - 1e-15]."""
    q = F.greatest(F.least(F.col(p), F.lit(1 - 1e-15)), F.lit(1e-15))
    t = F.col(y).cast("double")
    loss = t * F.log(q) + (F.lit(1.0) - t) * F.log(F.lit(1.0) - q)
    return df.agg((-F.avg(F.col(w) * loss if w else loss)).alias("log_loss"))


def _scored(df: DataFrame, score: str, label: str) -> DataFrame:
    """Rows with a label and a score that is a number."""
    s = F.col(score).cast("double")
    return df.where(s.isNotNull() & ~F.isnan(s) & F.col(label).isNotNull())


def _score_counts(df: DataFrame, score: str, label: str, positive) -> DataFrame:
    y = F.col(label) == F.lit(positive)
    return _scored(df, score, label).groupBy(F.col(score).cast("double").alias("score")).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))


def _splits(df: DataFrame, score: str, bucket_rows: int) -> list[float]:
    """Score values that cut the table into buckets of roughly ``bucket_rows`` rows."""
    n = df.count()
    parts = min(MAX_BUCKETS, -(-n // bucket_rows))
    if parts <= 1:
        return []
    probs = [i / parts for i in range(1, parts)]
    row = df.agg(F.percentile_approx(F.col(score).cast("double"), probs, 10 * parts).alias("s")).first()
    return sorted({s for s in row["s"] or [] if math.isfinite(s)})


def running_counts(
    df: DataFrame, score: str, label: str, positive=1, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Per distinct score, highest first: positives and negatives at or above it.

    Running totals inside a bucket are added to the totals of the buckets
    before it; only the table of bucket totals is handled by one task.
    """
    counts = _score_counts(df, score, label, positive)
    splits = _splits(_scored(df, score, label), score, bucket_rows)
    down = W.partitionBy("bucket").orderBy(F.desc("score")) if splits else W.orderBy(F.desc("score"))
    upto = down.rowsBetween(W.unboundedPreceding, 0)
    if splits:
        cut = Bucketizer(splits=[-float("inf"), *splits, float("inf")], inputCol="score", outputCol="bucket")
        counts = cut.transform(counts)
    inner = counts.select(
        "*", F.sum("pos").over(upto).alias("tp"), F.sum("neg").over(upto).alias("fp"),
        F.lead(F.struct("pos", "neg")).over(down).alias("after"),
    )
    if not splits:
        return inner
    above = W.orderBy(F.desc("bucket"))
    before = above.rowsBetween(W.unboundedPreceding, -1)
    totals = (
        counts.groupBy("bucket")
        .agg(F.sum("pos").alias("p"), F.sum("neg").alias("q"), F.max_by(F.struct("pos", "neg"), "score").alias("first"))
        .select(
            "bucket", F.coalesce(F.sum("p").over(before), F.lit(0)).alias("p0"),
            F.coalesce(F.sum("q").over(before), F.lit(0)).alias("q0"), F.lead("first").over(above).alias("next"),
        )
    )
    joined = inner.join(F.broadcast(totals), "bucket")  # at most MAX_BUCKETS rows
    return joined.select(
        "score", "pos", "neg", (F.col("tp") + F.col("p0")).alias("tp"), (F.col("fp") + F.col("q0")).alias("fp"),
        F.coalesce("after", "next").alias("after"),
    )


def _class_totals(df: DataFrame, score: str, label: str, positive) -> tuple[int, int]:
    y = F.col(label) == F.lit(positive)
    row = _scored(df, score, label).agg(F.count_if(y).alias("p"), F.count_if(~y).alias("n")).first()
    return row["p"], row["n"]


def roc_curve(
    df: DataFrame, score: str, label: str, positive=1, drop_intermediate: bool = True, bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Points ``(threshold, fpr, tpr)`` from (0, 0); points on a straight run are left out."""
    p, n = _class_totals(df, score, label, positive)
    run = running_counts(df, score, label, positive, bucket_rows)
    if drop_intermediate:
        corner = F.col("after").isNull() | (F.col("after.pos") != F.col("pos")) | (F.col("after.neg") != F.col("neg"))
        first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
        run = run.where(corner | first)
    points = run.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp").cast("double"), F.lit(n)).alias("fpr"),
        F.try_divide(F.col("tp").cast("double"), F.lit(p)).alias("tpr"),
    )
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return start.unionByName(points)


def roc_auc(df: DataFrame, score: str, label: str, positive=1, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Area under the ROC curve: each score adds a trapezoid of its own width."""
    run = running_counts(df, score, label, positive, bucket_rows)
    slab = F.col("neg") * (F.col("tp") - F.col("pos") / F.lit(2.0))
    return run.agg(F.try_divide(F.sum(slab), (F.sum("pos").cast("double") * F.sum("neg").cast("double"))).alias("roc_auc"))


def pr_curve(df: DataFrame, score: str, label: str, positive=1, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Points ``(threshold, precision, recall)``, ending at precision 1 and recall 0."""
    p, _ = _class_totals(df, score, label, positive)
    run = running_counts(df, score, label, positive, bucket_rows)
    points = run.select(
        F.col("score").alias("threshold"), safe_share(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        F.coalesce(F.try_divide(F.col("tp").cast("double"), F.lit(p)), F.lit(1.0)).alias("recall"),
    )
    end = df.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return points.unionByName(end)


def pr_auc(df: DataFrame, score: str, label: str, positive=1, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Trapezoid area of precision over recall."""
    run = running_counts(df, score, label, positive, bucket_rows)
    tp0, fp0 = F.col("tp") - F.col("pos"), F.col("fp") - F.col("neg")
    now = safe_share(F.col("tp"), F.col("tp") + F.col("fp"))
    past = F.when(tp0 + fp0 > 0, safe_share(tp0, tp0 + fp0)).otherwise(F.lit(1.0))
    slab = F.col("pos") * (now + past) / F.lit(2.0)
    return run.agg(F.try_divide(F.sum(slab), F.sum("pos").cast("double")).alias("pr_auc"))


def evaluate(df: DataFrame, label: str, prediction: str = "prediction", positive=1) -> dict[str, float]:
    """Accuracy and F1 (binary up to two true classes, else macro) as plain numbers."""
    cells = confusion_counts(df, label, prediction).collect()  # classes squared rows
    return scores_of(cells, positive)


def scores_of(cells: Sequence, positive=1) -> dict[str, float]:
    total = sum(r["n"] for r in cells)
    hits = sum(r["n"] for r in cells if r["label"] == r["prediction"])
    classes = {r["label"] for r in cells} | {r["prediction"] for r in cells}

    def f1(c) -> float:
        tp = sum(r["n"] for r in cells if r["label"] == c and r["prediction"] == c)
        wrong = sum(r["n"] for r in cells if (r["label"] == c) != (r["prediction"] == c))
        return 2 * tp / (2 * tp + wrong) if tp or wrong else 0.0

    macro = sum(f1(c) for c in classes) / len(classes) if classes else 0.0
    binary = f1(positive)
    auto = binary if len({r["label"] for r in cells}) <= 2 else macro
    return {"accuracy": hits / total if total else 0.0, "f1": auto, "f1_binary": binary, "f1_macro": macro}
