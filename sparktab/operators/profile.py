"""Profiling reports. Every report is a DataFrame; sizes follow columns and classes."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from sparktab.functions.expressions import finite, hash60, known, missing
from sparktab.operators.moments import FEW_COLUMNS, pairwise_corr
from sparktab.operators.ranking import DIRECT_ROWS, exact_quantiles, largest_group
from sparktab.session import small_side

QUARTILES = (0.25, 0.5, 0.75)


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def table_info(df: DataFrame) -> DataFrame:
    """Position, name, type, rows and non-null rows of every column."""
    counts = [F.count("*").alias("rows")]
    counts += [F.count(known(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    cells = [
        F.struct(
            F.lit(i).alias("ordinal"), F.lit(c).alias("feature"), F.lit(t).alias("dtype"),
            F.col("rows"), F.col(f"n{i}").alias("non_null"),
        )
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return df.agg(*counts).select(F.inline(F.array(*cells)))


def missing_counts(df: DataFrame, only_positive: bool = False) -> DataFrame:
    """Missing values per column and, as ``__total__``, overall."""
    counts = [F.count_if(missing(df, c)).alias(f"n{i}") for i, c in enumerate(df.columns)]
    total = sum((F.col(f"n{i}") for i in range(len(df.columns))), F.lit(0))
    cells = [F.struct(F.lit(c).alias("feature"), F.col(f"n{i}").alias("n_missing")) for i, c in enumerate(df.columns)]
    cells.append(F.struct(F.lit("__total__").alias("feature"), total.cast("bigint").alias("n_missing")))
    out = df.agg(*counts).select(F.inline(F.array(*cells)))
    return out.where((F.col("n_missing") > 0) | (F.col("feature") == "__total__")) if only_positive else out


def value_counts(df: DataFrame, col: str, sort: str = "count") -> DataFrame:
    """Count and percent of each value (NULL left out), by count or by value.

    The total comes from the counted values, so no row window is needed.
    """
    counts = df.where(_q(col).isNotNull()).groupBy(_q(col).alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    out = counts.select("value", "n", (F.lit(100.0) * F.col("n") / total).alias("pct"))
    return out.orderBy(F.desc("n"), "value") if sort == "count" else out.orderBy("value")


def _moments(df: DataFrame, cols: Sequence[str], by: Sequence[str], probs: Sequence[float], limit: int) -> DataFrame:
    """count, mean, std, min, max and quantiles per class and column, in long form; finite values only."""
    direct = largest_group(df, by) * len(cols) <= limit
    spots = F.array(*[F.lit(float(p)) for p in probs])
    cells = []
    for c in cols:
        x = finite(_q(c))
        parts = [
            F.lit(c).alias("feature"), F.count(x).alias("n"), F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
        ]
        if direct:
            parts.append(F.percentile(x, spots).alias("q"))
        cells.append(F.struct(*parts))
    keys = [_q(b) for b in by]
    wide = df.groupBy(*keys).agg(F.array(*cells).alias("cells"))
    long = wide.select(*keys, F.inline("cells"))
    if direct:
        return long
    q = exact_quantiles(df, cols, probs, by, limit).withColumnsRenamed({b: f"__{b}" for b in by} | {"feature": "__feature"})
    match = F.col("feature") == F.col("__feature")
    for b in by:
        match &= _q(b).eqNullSafe(_q(f"__{b}"))
    return long.join(q, match, "left").drop("__feature", *[f"__{b}" for b in by])


def describe(df: DataFrame, cols: Sequence[str], by: str | None = None, limit: int = DIRECT_ROWS) -> DataFrame:
    """count, mean, std (n-1), min, exact quartiles and max; optionally per class."""
    keys = [by] if by else []
    q = [F.col("q")[i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))]
    out = _moments(df, cols, keys, QUARTILES, limit)
    return out.select(*keys, "feature", "n", "mean", "std", "min", *q, "max")


def stats_by_group(df: DataFrame, by: str, cols: Sequence[str], limit: int = DIRECT_ROWS) -> DataFrame:
    """The named group table: count, mean, std, min, max, median, q1, q3."""
    out = _moments(df, cols, [by], QUARTILES, limit)
    q = F.col("q")
    return out.select(by, "feature", "n", "mean", "std", "min", "max", q[1].alias("median"), q[0].alias("q1"), q[2].alias("q3"))


def nunique(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column.

    Each column is counted from its own de-duplicated values, so the rows are
    not multiplied by the number of columns as a joint distinct count would.
    """
    parts = [
        df.select(_q(c).alias("v")).where(F.col("v").isNotNull()).distinct()
        .agg(F.lit(c).alias("feature"), F.count("*").alias("n_distinct"))
        for c in cols
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct().orderBy(col)


def duplicate_counts(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows beyond the first of each set of equal rows, and the same for the key."""
    def extra(cols: Sequence[str], kind: str) -> DataFrame:
        groups = df.groupBy(*[_q(c) for c in cols]).count()
        beyond = F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint")
        return groups.agg(F.lit(kind).alias("kind"), beyond.alias("n_duplicates"))

    out = extra(df.columns, "rows")
    return out.unionByName(extra([key], "keys")) if key else out


def crosstab(df: DataFrame, a: str, b: str, levels: Sequence | None = None, margins: bool = True) -> DataFrame:
    """Counts of ``a`` by ``b``; with margins, an ``All`` row and column.

    Pairs are counted first; the cube then runs over the counts.
    """
    pairs = df.where(_q(a).isNotNull() & _q(b).isNotNull()).groupBy(_q(a).cast("string").alias(a), _q(b).cast("string").alias(b)).count()
    if levels is None:
        levels = [r[0] for r in pairs.select(b).distinct().orderBy(b).collect()]
    names = [str(v) for v in levels]
    if not margins:
        return pairs.groupBy(a).pivot(b, names).sum("count").na.fill(0, names)
    cube = pairs.cube(a, b).agg(F.sum("count").alias("n"), F.grouping(a).alias("ga"), F.grouping(b).alias("gb"))
    tagged = cube.select(
        F.when(F.col("ga") == 1, "All").otherwise(F.col(a)).alias(a),
        F.when(F.col("gb") == 1, "All").otherwise(F.col(b)).alias(b),
        "n",
    )
    return tagged.groupBy(a).pivot(b, [*names, "All"]).sum("n").na.fill(0, [*names, "All"])


def _corr(df: DataFrame, a: str, b: str) -> Column:
    return F.corr(finite(_q(a)), finite(_q(b)))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, both halves and the diagonal, in long form."""
    cols = list(cols)
    if len(cols) > FEW_COLUMNS:
        table = pairwise_corr(df, cols)
        rows = [(a, b, None if math.isnan(v) else v) for a, line in zip(cols, table.tolist()) for b, v in zip(cols, line)]
        return df.sparkSession.createDataFrame(rows, "feature_a string, feature_b string, corr double")
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    aggs = [_corr(df, a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)]
    cells = []
    for i, (a, b) in enumerate(pairs):
        for x, y in {(a, b), (b, a)}:
            cells.append(F.struct(F.lit(x).alias("feature_a"), F.lit(y).alias("feature_b"), F.col(f"c{i}").alias("corr")))
    return df.agg(*aggs).select(F.inline(F.array(*cells)))


def target_corr(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Correlation of each column with the target, highest first."""
    if len(cols) > FEW_COLUMNS:
        table = corr_matrix(df, [*cols, target])
        out = table.where((F.col("feature_b") == target) & (F.col("feature_a") != target)).select(F.col("feature_a").alias("feature"), "corr")
    else:
        cells = [F.struct(F.lit(c).alias("feature"), _corr(df, c, target).alias("corr")) for c in cols]
        out = df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))
    return out.orderBy(F.desc("corr"), "feature")


def top_corr(df: DataFrame, cols: Sequence[str], target: str, k: int = 10) -> DataFrame:
    """The ``k`` columns with the largest absolute correlation; the sign is kept too."""
    out = target_corr(df, cols, target).withColumn("abs_corr", F.abs("corr"))
    return out.orderBy(F.desc_nulls_last("abs_corr"), "feature").limit(k)


def _fences(df: DataFrame, cols: Sequence[str], by: Sequence[str], k: float, limit: int) -> DataFrame:
    q = exact_quantiles(df, cols, QUARTILES, by, limit)
    q1, q2, q3 = F.col("q")[0], F.col("q")[1], F.col("q")[2]
    iqr = q3 - q1
    return q.select(
        *by, "feature", q1.alias("q1"), q2.alias("median"), q3.alias("q3"), iqr.alias("iqr"),
        (q1 - F.lit(k) * iqr).alias("lower"), (q3 + F.lit(k) * iqr).alias("upper"),
    )


def _bounds(df: DataFrame, cols: Sequence[str], k: float, limit: int) -> dict[str, tuple[float, float]]:
    rows = _fences(df, cols, [], k, limit).collect()  # one row per column
    return {r["feature"]: (r["lower"], r["upper"]) for r in rows}


def outlier_rows(df: DataFrame, cols: Sequence[str], k: float = 1.5, limit: int = DIRECT_ROWS) -> DataFrame:
    """Rows outside the quartile fences in at least one of the columns."""
    out = F.lit(False)
    for c, (low, high) in _bounds(df, cols, k, limit).items():
        if low is not None:
            out |= F.coalesce((known(df, c) < F.lit(low)) | (known(df, c) > F.lit(high)), F.lit(False))
    return df.where(out)


def outlier_summary(df: DataFrame, cols: Sequence[str], k: float = 1.5, limit: int = DIRECT_ROWS) -> DataFrame:
    """Quartiles, fences, number and percent of outliers and their range, per column."""
    fences = {r["feature"]: r for r in _fences(df, cols, [], k, limit).collect()}
    cells = []
    for c in cols:
        f, x = fences[c], finite(_q(c))
        bad = (x < F.lit(f["lower"])) | (x > F.lit(f["upper"])) if f["q1"] is not None else F.lit(False)
        n = F.count_if(bad)
        cells.append(
            F.struct(
                F.lit(c).alias("feature"),
                *[F.lit(f[name]).cast("double").alias(name) for name in ("q1", "q3", "iqr", "lower", "upper")],
                n.alias("n"), F.try_divide(F.lit(100.0) * n, F.count("*")).alias("pct"),
                F.min(F.when(bad, x)).alias("outlier_min"), F.max(F.when(bad, x)).alias("outlier_max"),
            )
        )
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def compare_tables(a: DataFrame, b: DataFrame, cols: Sequence[str], first: int | None = None) -> DataFrame:
    """Mean and std on both sides and the absolute difference of the means.

    Columns that ``b`` lacks are skipped; ``first`` keeps the leading columns only.
    """
    shared = [c for c in list(cols)[:first] if c in b.columns]

    def side(df: DataFrame, tag: str) -> DataFrame:
        cells = []
        for c in shared:
            x = known(df, c).cast("double")
            cells.append(F.struct(F.lit(c).alias("feature"), F.avg(x).alias(f"mean_{tag}"), F.stddev_samp(x).alias(f"std_{tag}")))
        return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))

    both = side(a, "a").join(side(b, "b"), "feature")
    return both.withColumn("mean_diff", F.abs(F.col("mean_a") - F.col("mean_b")))


def ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    cells = [
        F.struct(F.lit(c).alias("feature"), F.min(known(df, c)).cast("double").alias("min"), F.max(known(df, c)).cast("double").alias("max"))
        for c in cols
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def summary_report(
    train: DataFrame, test: DataFrame, key: str, target: str,
    numeric: Sequence[str], categorical: Sequence[str], range_cols: int | None = None,
) -> DataFrame:
    """Sizes, feature counts by role, class mix, ranges, missing values, duplicates."""
    spark = train.sparkSession
    roles = spark.createDataFrame(
        [("features", "numeric", float(len(numeric))), ("features", "categorical", float(len(categorical))),
         ("features", "total", float(len(numeric) + len(categorical)))],
        "section string, name string, value double",
    )

    def rows(df: DataFrame, section: str, name: Column | str, value: str) -> DataFrame:
        label = F.lit(name) if isinstance(name, str) else name
        return df.select(F.lit(section).alias("section"), label.alias("name"), F.col(value).cast("double").alias("value"))

    def total_missing(df: DataFrame) -> DataFrame:
        return missing_counts(df).where(F.col("feature") == "__total__")

    mix = value_counts(train, target)
    ext = ranges(train, list(numeric)[:range_cols])
    parts = [
        rows(train.agg(F.count("*").alias("n")), "rows", "train", "n"),
        rows(test.agg(F.count("*").alias("n")), "rows", "test", "n"),
        roles,
        rows(nunique(train, [target]), "classes", "distinct", "n_distinct"),
        rows(mix, "class_count", F.col("value").cast("string"), "n"),
        rows(mix, "class_pct", F.col("value").cast("string"), "pct"),
        rows(ext, "range_min", F.col("feature"), "min"),
        rows(ext, "range_max", F.col("feature"), "max"),
        rows(total_missing(train), "missing", "train", "n_missing"),
        rows(total_missing(test), "missing", "test", "n_missing"),
        rows(duplicate_counts(train, key), "duplicates", F.col("kind"), "n_duplicates"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def histogram(df: DataFrame, col: str, bins: int = 50, by: str | None = None) -> DataFrame:
    """Equal-width bin counts, the last bin closed; each class uses its own range.

    A constant gets a range one unit wide around it.
    """
    keys = [by] if by else []
    x = finite(_q(col))
    data = df.select(*[_q(k) for k in keys], x.alias("x")).where(F.col("x").isNotNull())
    spans = data.groupBy(*keys).agg(F.min("x").alias("low"), F.max("x").alias("high"))
    if by:
        side = small_side(spans.withColumnRenamed(by, "__by"))
        data = data.join(side, _q(by).eqNullSafe(F.col("__by")))
    else:
        span = spans.first()
        data = data.select("x", *[F.lit(span[c]).cast("double").alias(c) for c in ("low", "high")])
    half = F.when(F.col("low") == F.col("high"), 0.5).otherwise(0.0)
    data = data.select(*[_q(k) for k in keys], "x", (F.col("low") - half).alias("low"), (F.col("high") + half).alias("high"))
    step = (F.col("high") - F.col("low")) / F.lit(bins)
    cell = F.least(F.lit(bins - 1), F.floor((F.col("x") - F.col("low")) / step))
    counts = data.groupBy(*keys, "low", "high", cell.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    edge = F.col("low") + F.col("bin") * step
    return counts.select(*keys, "bin", edge.alias("bin_low"), (edge + step).alias("bin_high"), "n")


def box_stats(df: DataFrame, cols: Sequence[str], by: str, k: float = 1.5, limit: int = DIRECT_ROWS) -> DataFrame:
    """Quartiles, whiskers at the last value inside the fences, and flier counts."""
    cells = [F.struct(F.lit(c).alias("feature"), finite(_q(c)).alias("x")) for c in cols]
    long = df.select(_q(by), F.inline(F.array(*cells))).where(F.col("x").isNotNull())
    fences = _fences(df, cols, [by], k, limit).withColumnsRenamed({by: "__by", "feature": "__feature"})
    match = F.col(by).eqNullSafe(F.col("__by")) & (F.col("feature") == F.col("__feature"))
    inside = F.col("x").between(F.col("lower"), F.col("upper"))
    return (
        long.join(small_side(fences), match)
        .groupBy(by, "feature", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
            F.count_if(~inside).alias("n_fliers"),
        )
    )


def scatter_sample(df: DataFrame, x: str, y: str, by: str, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """``n`` points of each class in a repeatable random order.

    The rank filter is applied inside each task before the shuffle.
    """
    keys = [_q(k) for k in key]
    order = W.partitionBy(by).orderBy("__h", *keys)
    picked = (
        df.select(*keys, by, x, y, hash60(seed, *keys).alias("__h"))
        .withColumn("point", F.row_number().over(order))
        .where(F.col("point") <= n)
    )
    return picked.drop("__h")
