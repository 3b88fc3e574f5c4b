"""The registered queries as SQL for a second engine."""

from __future__ import annotations

import math

import numpy as np

ORACLES: dict[str, str] = {}
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
NEIGHBOURS = (7, 11, 15, 21, 31)


def h60(key: str, seed: int = 42) -> str:
    return f"('0x' || substr(md5(concat_ws('|', '{seed}', {key})), 1, 15))::BIGINT"


def unit(seed: str, keys: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', '{seed}', {keys})), 1, 8))::BIGINT / 4294967296.0::DOUBLE)"


def unit52(seed: str, keys: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', '{seed}', {keys})), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


def r(x: str, digits: int = 6) -> str:
    return f"round({x}, {digits}) + 0.0"


def share(chars: str) -> str:
    n = "length(text)"
    return f"coalesce(({n} - length(translate(text, '{chars}', '')))::DOUBLE / nullif({n}, 0), 0)"


SHAPES = f"""shapes AS (
  SELECT doc_id, lang, {share(LETTERS)} AS letter_share,
    len(list_distinct(string_split(text, ' ')))::DOUBLE / len(string_split(text, ' ')) AS word_share,
    ln(1 + n_chars) AS log_chars,
    {', '.join(f"{share(c + c.upper())} AS share_{c}" for c in 'aeno')}
  FROM documents)"""
QUALITY = SHAPES + ", data AS (SELECT shapes.*, quality, toxic FROM shapes JOIN labels USING (doc_id))"
LANGUAGES = SHAPES + ", data AS (SELECT *, (dense_rank() OVER (ORDER BY lang) - 1)::INTEGER AS y FROM shapes)"
SHAPE = ("letter_share", "word_share", "log_chars")
VOWELS = ("share_a", "share_e", "share_n", "share_o")

ITEMS = """items AS (SELECT *, (s1 > 0.5)::INTEGER AS p1, (s2 > 0.5)::INTEGER AS p2, (s3 > 0.5)::INTEGER AS p3 FROM (
  SELECT (l_linestatus = 'O')::INTEGER AS y, l_returnflag, l_quantity / 50.0::DOUBLE AS s1,
    l_extendedprice / 105000.0::DOUBLE AS s2, l_discount * 4.0::DOUBLE + l_tax * 5.0::DOUBLE AS s3 FROM lineitem))"""
CLASSED = ITEMS + """, classed AS (SELECT l_returnflag AS label,
  CASE WHEN s1 > 0.6::DOUBLE THEN 'A' WHEN s2 > 0.5 THEN 'N' ELSE 'R' END AS prediction FROM items)"""


def split_cte(table: str, key: str, label: str, name: str = "marked", frac: float = 0.2) -> str:
    return f"""{name} AS (SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY {h60(key)}, {key})
      <= floor({frac} * count(*) OVER (PARTITION BY {label}) + 0.5) AS is_test FROM {table})"""


def naive_bayes_cte(features, label: str, train: str, query: str, key: str) -> str:
    aggs = ", ".join(f"avg({f}) AS m_{f}, var_pop({f}) AS v_{f}" for f in features)
    top = ", ".join(f"var_pop({f})" for f in features)
    top = f"greatest({top})" if len(features) > 1 else top
    terms = " - ".join(
        f"(0.5 * ln(2 * pi() * (v_{f} + eps)) + (q.{f} - m_{f}) * (q.{f} - m_{f}) / (2 * (v_{f} + eps)))" for f in features
    )
    return f"""st AS (SELECT {label} AS c, count(*) AS n, {aggs} FROM {train} GROUP BY 1),
    ov AS (SELECT {top} * 1e-9 AS eps, count(*) AS total FROM {train}),
    ll AS (SELECT {key}, q.{label} AS truth, c, ln(n::DOUBLE / total) - {terms} AS s FROM {query} q, st, ov),
    pr AS (SELECT *, exp(s - max(s) OVER w) AS e, row_number() OVER (PARTITION BY {key} ORDER BY s DESC, c) AS best FROM ll
      WINDOW w AS (PARTITION BY {key})),
    ps AS (SELECT *, e / sum(e) OVER (PARTITION BY {key}) AS p FROM pr)"""


def report(source: str, label: str, prediction: str, digits: int = 6) -> str:
    """Classification report over a table or subquery."""
    return f"""cl AS (SELECT DISTINCT c FROM (SELECT {label}::VARCHAR AS c FROM {source} UNION ALL SELECT {prediction}::VARCHAR FROM {source})),
    cnt AS (SELECT c, count(*) FILTER ({label}::VARCHAR = c AND {prediction}::VARCHAR = c) AS tp,
      count(*) FILTER ({prediction}::VARCHAR = c) AS g, count(*) FILTER ({label}::VARCHAR = c) AS support FROM cl, {source} GROUP BY c),
    rep AS (SELECT *, coalesce(tp::DOUBLE / nullif(g, 0), 0) AS precision, coalesce(tp::DOUBLE / nullif(support, 0), 0) AS recall,
      coalesce(2.0 * tp / nullif(g + support, 0), 0) AS f1 FROM cnt)
    SELECT class, {r('precision', digits)} AS precision, {r('recall', digits)} AS recall, {r('f1', digits)} AS f1, support FROM (
      SELECT c AS class, precision, recall, f1, support FROM rep
      UNION ALL SELECT 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support)::BIGINT FROM rep
      UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM rep
      UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)::BIGINT FROM rep)"""


def counts(p: str, y: str = "y") -> tuple[str, str, str]:
    return (f"count(*) FILTER ({y} = 1 AND {p} = 1)", f"count(*) FILTER ({y} <> 1 AND {p} = 1)", f"count(*) FILTER ({y} = 1 AND {p} <> 1)")


def f1_sql(p: str, y: str = "y") -> str:
    tp, fp, fn = counts(p, y)
    return f"coalesce(2.0 * {tp} / nullif(2 * {tp} + {fp} + {fn}, 0), 0)"


def add(name: str, sql: str) -> None:
    ORACLES[name] = sql


# --- sources, projections --------------------------------------------------------
add("csv_round_trip", "SELECT * FROM customer")
add("keyed_load", f"WITH {QUALITY} SELECT doc_id, quality, {', '.join(f'{r(c)} AS {c}' for c in SHAPE)} FROM data")
add("load_with_fallback", """SELECT o_orderkey, o_orderstatus, o_totalprice, 'embedded' AS origin FROM orders
  UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, 'table' FROM orders""")
add("build_if_missing", f"SELECT p_partkey, {r('p_retailprice * p_size', 4)} AS value FROM part")
add("prediction_sink", "SELECT o_orderkey, (o_totalprice / 500000.0 > 0.5)::INTEGER AS label FROM orders")
add("select_and_drop", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
add("column_roles", """SELECT column_name AS feature, CASE WHEN column_type = 'VARCHAR' OR (column_type LIKE 'TIMESTAMP%' AND
  (SELECT count(DISTINCT o_orderdate) FROM orders) <= 10) THEN 'categorical' ELSE 'numeric' END AS role
  FROM (DESCRIBE orders) WHERE column_name <> 'o_orderkey'""")
add("sanitized", f"""SELECT c_custkey, CASE WHEN c_acctbal > 709.78 THEN 0.0 ELSE {r('ln(1 + exp(least(c_acctbal, 709.78)))')} END AS grown,
  CASE WHEN c_acctbal > 0 THEN {r('ln(greatest(c_acctbal, 0.001))')} ELSE 0.0 END AS logged,
  {r('sqrt(greatest(c_acctbal, 0))')} AS root FROM customer""")
add("rows_of_one_class", "SELECT c_custkey, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'")
add("outlier_rows", """WITH b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
  SELECT event_id, value FROM events, b WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
add("holdout_by_ids", "SELECT doc_id, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'held' ELSE 'train' END AS part FROM documents")
add("thresholded", "SELECT o_orderkey, (o_totalprice / 500000.0 > 0.4)::INTEGER AS prediction FROM orders")
add("aligned_columns", "SELECT p_partkey, p_size, 0.0::DOUBLE AS not_there, p_retailprice FROM part")
add("preview", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
add("mapped_values", """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1.0 WHEN 'O' THEN 0.0 END::DOUBLE AS o_orderstatus_encoded,
  CASE o_orderpriority WHEN '1-URGENT' THEN 1.0 WHEN '5-LOW' THEN 0.0 END::DOUBLE AS o_orderpriority_encoded FROM orders""")
add("table_lookup", "SELECT c_custkey, n_name AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")

# --- profiling ---------------------------------------------------------------------
ORDER_TYPES = (("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"),
               ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"))
add("table_info", " UNION ALL ".join(
    f"SELECT {i} AS ordinal, '{c}' AS feature, '{t}' AS dtype, count(*) AS rows, count({c}) AS non_null FROM orders"
    for i, (c, t) in enumerate(ORDER_TYPES)))
LINE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "l_shipdate")
MISSING = f"""WITH t AS (SELECT *, CASE WHEN l_discount <> 0 THEN l_tax / l_discount END AS ratio FROM lineitem), m AS (
  {' UNION ALL '.join(f"SELECT '{c}' AS feature, count(*) - count({c}) AS n_missing FROM t" for c in (*LINE, 'ratio'))})
  SELECT * FROM (SELECT * FROM m UNION ALL SELECT '__total__', sum(n_missing)::BIGINT FROM m)"""
add("missing_counts", MISSING)
add("missing_counts_positive", MISSING + " WHERE n_missing > 0 OR feature = '__total__'")


def value_counts_sql(table: str, col: str) -> str:
    return f"SELECT {col} AS value, count(*) AS n, {r('100.0 * count(*) / sum(count(*)) OVER ()')} AS pct FROM {table} GROUP BY 1"


add("value_counts", value_counts_sql("events", "event_type"))
add("value_counts_by_value", value_counts_sql("customer", "c_mktsegment"))


def moments(table: str, col: str, by: str | None, names=("q25", "q50", "q75")) -> str:
    keys = f"{by}, " if by else ""
    q = ", ".join(f"{r(f'quantile_cont({col}, {p})', 4)} AS {n}" for p, n in zip((0.25, 0.5, 0.75), names))
    return f"""SELECT {keys}'{col}' AS feature, count({col}) AS n, {r(f'avg({col})', 4)} AS mean, {r(f'stddev_samp({col})', 4)} AS std,
      {r(f'min({col})', 4)} AS min, {q}, {r(f'max({col})', 4)} AS max FROM {table} {f'GROUP BY {by}' if by else ''}"""


add("describe", " UNION ALL ".join(moments("lineitem", c, None) for c in ("l_quantity", "l_extendedprice", "l_discount")))
add("describe_by_class", " UNION ALL ".join(moments("lineitem", c, "l_returnflag") for c in ("l_quantity", "l_extendedprice")))
add("stats_by_group", moments("customer", "c_acctbal", "c_mktsegment", ("q1", "median", "q3")))
add("distinct_counts", " UNION ALL ".join(f"SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_distinct FROM part" for c in ("p_brand", "p_type", "p_size", "p_name")))
add("distinct_values", "SELECT DISTINCT o_orderpriority FROM orders")
add("duplicate_rows", """SELECT 'rows' AS kind, (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem)))::BIGINT AS n_duplicates FROM lineitem
  UNION ALL SELECT 'keys', count(*) - count(DISTINCT l_orderkey) FROM lineitem""")
add("crosstab", """SELECT coalesce(l_returnflag, 'All') AS l_returnflag, count(*) FILTER (l_linestatus = 'F') AS F,
  count(*) FILTER (l_linestatus = 'O') AS O, count(*) AS "All" FROM lineitem GROUP BY GROUPING SETS ((l_returnflag), ())""")
add("corr_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {r(f'corr({a}, {b})')} AS corr FROM lineitem" for a in MEASURES for b in MEASURES))
add("target_corr", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {r(f'''corr({c}, (l_linestatus = 'O')::INTEGER)''')} AS corr FROM lineitem" for c in MEASURES))
add("top_corr", f"WITH {QUALITY}, c AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, quality) AS corr FROM data" for c in (*SHAPE, *VOWELS)) +
    f") SELECT feature, {r('corr')} AS corr, {r('abs(corr)')} AS abs_corr FROM c ORDER BY abs(corr) DESC, feature LIMIT 4")
add("outlier_summary", " UNION ALL ".join(f"""SELECT '{c}' AS feature, {r('q1', 4)} AS q1, {r('q3', 4)} AS q3, {r('q3 - q1', 4)} AS iqr,
  {r('lo', 4)} AS lower, {r('hi', 4)} AS upper, count(*) FILTER ({c} < lo OR {c} > hi) AS n,
  {r(f'100.0 * count(*) FILTER ({c} < lo OR {c} > hi) / count(*)', 4)} AS pct, {r(f'min({c}) FILTER ({c} < lo OR {c} > hi)::DOUBLE', 4)} AS outlier_min,
  {r(f'max({c}) FILTER ({c} < lo OR {c} > hi)::DOUBLE', 4)} AS outlier_max
  FROM events, (SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
    (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM events)) GROUP BY q1, q3, lo, hi""" for c in ("value", "user_id")))


def compare_sql(c: str) -> str:
    early, late = f"{c}) FILTER (o_orderdate < '1998-01-01'", f"{c}) FILTER (o_orderdate >= '1998-01-01'"
    return f"""SELECT '{c}' AS feature, {r(f'avg({early})', 4)} AS mean_a, {r(f'stddev_samp({early})', 4)} AS std_a, {r(f'avg({late})', 4)} AS mean_b,
      {r(f'stddev_samp({late})', 4)} AS std_b, {r(f'abs(avg({early}) - avg({late}))', 4)} AS mean_diff FROM orders"""


add("compare_tables", " UNION ALL ".join(compare_sql(c) for c in ("o_totalprice", "o_custkey")))
add("value_ranges", " UNION ALL ".join(f"SELECT '{c}' AS feature, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max FROM customer" for c in ("c_acctbal", "c_nationkey")))
add("summary_report", f"""SELECT section, name, {r('value::DOUBLE', 4)} AS value FROM (
  SELECT 'rows' AS section, 'train' AS name, count(*)::DOUBLE AS value FROM orders UNION ALL SELECT 'rows', 'test', count(*) FROM customer
  UNION ALL SELECT * FROM (VALUES ('features', 'numeric', 2), ('features', 'categorical', 1), ('features', 'total', 3))
  UNION ALL SELECT 'classes', 'distinct', count(DISTINCT o_orderstatus) FROM orders
  UNION ALL SELECT 'class_count', o_orderstatus, count(*) FROM orders GROUP BY 2
  UNION ALL SELECT 'class_pct', o_orderstatus, 100.0 * count(*) / sum(count(*)) OVER () FROM orders GROUP BY 2
  UNION ALL SELECT 'range_min', 'o_totalprice', min(o_totalprice) FROM orders UNION ALL SELECT 'range_max', 'o_totalprice', max(o_totalprice) FROM orders
  UNION ALL SELECT 'range_min', 'o_custkey', min(o_custkey) FROM orders UNION ALL SELECT 'range_max', 'o_custkey', max(o_custkey) FROM orders
  UNION ALL SELECT 'missing', 'train', {' + '.join(f'count(*) - count({c})' for c, _ in ORDER_TYPES)} FROM orders
  UNION ALL SELECT 'missing', 'test', {' + '.join(f'count(*) - count({c})' for c in ('c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment'))} FROM customer
  UNION ALL SELECT 'duplicates', 'rows', count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM orders)) FROM orders
  UNION ALL SELECT 'duplicates', 'keys', count(*) - count(DISTINCT o_orderkey) FROM orders)""")


def histogram_sql(table: str, col: str, bins: int, by: str | None) -> str:
    keys, part = (f"{by}, ", f"PARTITION BY {by}") if by else ("", "")
    return f"""WITH b AS (SELECT {keys}{col} AS x, min({col}) OVER ({part}) AS low, max({col}) OVER ({part}) AS high FROM {table}),
      s AS (SELECT *, (high - low) / {bins} AS step FROM b)
      SELECT {keys}least({bins - 1}, floor((x - low) / step))::INTEGER AS bin, {r('low + bin * step', 4)} AS bin_low,
        {r('low + bin * step + step', 4)} AS bin_high, count(*) AS n FROM s GROUP BY ALL"""


add("histogram", histogram_sql("lineitem", "l_extendedprice", 50, None))
add("histogram_by_class", histogram_sql("customer", "c_acctbal", 30, "c_mktsegment"))
add("box_stats", f"""WITH q AS (SELECT event_type AS t, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
  j AS (SELECT *, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS ok FROM events JOIN q ON event_type = t)
  SELECT event_type, 'value' AS feature, {r('q1', 4)} AS q1, {r('median', 4)} AS median, {r('q3', 4)} AS q3, {r('min(value) FILTER (ok)', 4)} AS whisker_low,
    {r('max(value) FILTER (ok)', 4)} AS whisker_high, count(*) FILTER (NOT ok) AS n_fliers FROM j GROUP BY ALL""")
add("scatter_sample", f"""SELECT * FROM (SELECT o_orderkey, o_orderstatus, o_totalprice, o_custkey,
  row_number() OVER (PARTITION BY o_orderstatus ORDER BY {h60('o_orderkey')}, o_orderkey)::INTEGER AS point FROM orders) WHERE point <= 20""")
add("class_weights", f"""SELECT doc_id, quality, {r('(count(*) OVER ())::DOUBLE / ((SELECT count(DISTINCT quality) FROM labels) * count(*) OVER (PARTITION BY quality))')} AS weight FROM labels""")
add("class_ratio", f"""SELECT quality, CASE WHEN quality = 1 THEN {r('(SELECT count(*) FILTER (quality = 0)::DOUBLE / count(*) FILTER (quality = 1) FROM labels)')} ELSE 1.0 END AS weight, count(*) AS n FROM labels GROUP BY 1""")

# --- features ----------------------------------------------------------------------
A, B, SA, SB = "c_acctbal", "c_nationkey", "balance", "nation"


def pair_parts(blocks) -> list[tuple[str, str]]:
    ma, mb = "(a - la + 1)", "(b - lb + 1)"
    parts = {
        "linear": [(A, "a"), (B, "b")],
        "quadratic": [
            (f"{A}_squared", "a * a"), (f"{B}_squared", "b * b"), (f"{SA}_{SB}_interaction", "a * b"), (f"{SA}_{SB}_ratio", "a / (b + 1e-8)"),
            (f"{SB}_{SA}_ratio", "b / (a + 1e-8)"), (f"{SA}_{SB}_diff", "a - b"), (f"{SA}_{SB}_sum", "a + b"), (f"{SA}_{SB}_abs_diff", "abs(a - b)")],
        "logarithmic": [
            (f"log_{A}", f"ln(1 + {ma})"), (f"log_{B}", f"ln(1 + {mb})"), (f"log10_{A}", f"log10({ma})"), (f"log10_{B}", f"log10({mb})"),
            (f"log_{SA}_squared", f"ln(1 + {ma} * {ma})"), (f"log_{SB}_squared", f"ln(1 + {mb} * {mb})"), (f"log_{SA}_{SB}_interaction", f"ln(1 + {ma} * {mb})")],
        "other": [
            (f"sqrt_{A}", f"sqrt(abs({ma}))"), (f"sqrt_{B}", f"sqrt(abs({mb}))"), (f"exp_{SA}_normalized", "exp(a / 100)"), (f"exp_{SB}_normalized", "exp(b / 100)"),
            (f"sin_{SA}", "sin(a / 100)"), (f"cos_{SA}", "cos(a / 100)"), (f"sin_{SB}", "sin(b / 100)"), (f"cos_{SB}", "cos(b / 100)"),
            (f"{SA}_power_1_5", f"pow(abs({ma}), 1.5)"), (f"{SB}_power_1_5", f"pow(abs({mb}), 1.5)"), (f"{SA}_power_0_5", f"sqrt(abs({ma}))"), (f"{SB}_power_0_5", f"sqrt(abs({mb}))"),
            (f"reciprocal_{SA}", "1 / (abs(a) + 1e-8)"), (f"reciprocal_{SB}", "1 / (abs(b) + 1e-8)")],
        "statistical": [
            (f"{SA}_normalized", "(a - la) / (ha - la + 1e-8)"), (f"{SB}_normalized", "(b - lb) / (hb - lb + 1e-8)"),
            (f"{SA}_distance_from_mean", "abs(a - ea)"), (f"{SB}_distance_from_mean", "abs(b - eb)")],
    }
    return [p for block in blocks for p in parts[block]]


ALL_BLOCKS = ("linear", "quadratic", "logarithmic", "other", "statistical")


ACCOUNTS = "SELECT c_custkey, c_mktsegment, c_acctbal / 100 AS c_acctbal, c_nationkey + 1 AS c_nationkey FROM customer"


def pair_sql(blocks, scaler: str | None, digits: int, source: str = ACCOUNTS, head: str = "") -> str:
    parts = pair_parts(blocks)
    raw = f"""{head}src AS ({source}), st AS (SELECT min({A}) AS la, max({A}) AS ha, avg({A}) AS ea, min({B}) AS lb, max({B}) AS hb, avg({B}) AS eb FROM src),
      x AS (SELECT c_custkey, {A}::DOUBLE AS a, {B}::DOUBLE AS b, la::DOUBLE AS la, ha::DOUBLE AS ha, ea, lb::DOUBLE AS lb, hb::DOUBLE AS hb, eb FROM src, st),
      f AS (SELECT c_custkey, {', '.join(f'{v} AS {n}' for n, v in parts)} FROM x)"""
    if scaler is None:
        return f"WITH {raw} SELECT c_custkey, {', '.join(f'{r(n, digits)} AS {n}' for n, _ in parts)} FROM f"
    centre, scale = {
        "standard": ("avg({0})", "stddev_pop({0})"), "minmax": ("min({0})", "max({0}) - min({0})"),
        "robust": ("quantile_cont({0}, 0.5)", "quantile_cont({0}, 0.75) - quantile_cont({0}, 0.25)")}[scaler]
    aggs = ", ".join(f"{centre.format(n)} AS c_{i}, coalesce(nullif({scale.format(n)}, 0), 1) AS s_{i}" for i, (n, _) in enumerate(parts))
    cols = ", ".join(f"{r(f'({n} - c_{i}) / s_{i}', digits)} AS {n}" for i, (n, _) in enumerate(parts))
    return f"WITH {raw}, sc AS (SELECT {aggs} FROM f) SELECT c_custkey, {cols} FROM f, sc"


add("pair_features_minmax", pair_sql(("linear", "logarithmic", "statistical"), "minmax", 6))
add("pair_features_robust", pair_sql(("linear", "quadratic", "other"), "robust", 4))
add("pair_features_standard", pair_sql(ALL_BLOCKS, "standard", 4))
add("pair_features", pair_sql(ALL_BLOCKS, None, 6))
add("batch_statistics", pair_sql(("statistical",), None, 6, "SELECT * FROM marked WHERE is_test", f"acc AS ({ACCOUNTS}), " + split_cte("acc", "c_custkey", "c_mktsegment") + ", "))


def wide_parts(cols) -> list[tuple[str, str]]:
    out = [(c, f"{c}::DOUBLE") for c in cols] + [(f"{c}_squared", f"{c}::DOUBLE * {c}") for c in cols]
    out += [(f"{a}_{b}_interaction", f"{a} * {b}") for i, a in enumerate(cols) for b in cols[i + 1:]]
    for c in cols:
        out += [(f"log_{c}", f"ln(1 + ({c} - l_{c} + 1))"), (f"log10_{c}", f"log10({c} - l_{c} + 1)")]
    for c in cols:
        m = f"({c} - l_{c} + 1)"
        out += [(f"sqrt_{c}", f"sqrt(abs({m}))"), (f"{c}_power_1_5", f"pow(abs({m}), 1.5)"), (f"{c}_power_0_5", f"sqrt(abs({m}))"),
                (f"exp_{c}_normalized", f"exp(({c} - m_{c}) / (s_{c} + 1e-8) / 3)")]
    for c in cols:
        out += [(f"{c}_normalized", f"({c} - l_{c}) / (h_{c} - l_{c} + 1e-8)"), (f"{c}_distance_from_mean", f"abs({c} - m_{c})"),
                (f"{c}_zscore", f"({c} - m_{c}) / s_{c}")]
    return out


PART_COLS = ("p_retailprice", "p_size")
add("wide_features", f"""SELECT p_partkey, {', '.join(f'{r(v, 4)} AS {n}' for n, v in wide_parts(PART_COLS))} FROM part,
  (SELECT {', '.join(f'min({c}) AS l_{c}, max({c}) AS h_{c}, avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in PART_COLS)} FROM part)""")
# levels of the generated tables
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def onehot_sql(col: str, levels) -> list[tuple[str, str]]:
    return [(f"{col}_{v}", f"({col} = '{v}')::INTEGER::DOUBLE") for v in levels]


ONEHOT = [("p_size", "p_size::DOUBLE"), *onehot_sql("p_type", PART_TYPES)]
add("onehot_standard", f"""WITH f AS (SELECT p_partkey, {', '.join(f'{v} AS "{n}"' for n, v in ONEHOT)} FROM part),
  s AS (SELECT {', '.join(f'avg("{n}") AS m{i}, stddev_pop("{n}") AS s{i}' for i, (n, _) in enumerate(ONEHOT))} FROM f)
  SELECT p_partkey, {', '.join(f'{r(f"""("{n}" - m{i}) / s{i}""")} AS "{n}"' for i, (n, _) in enumerate(ONEHOT))} FROM f, s""")
add("label_codes", """SELECT p_partkey, (dense_rank() OVER (ORDER BY p_brand) - 1)::DOUBLE AS p_brand_encoded,
  (dense_rank() OVER (ORDER BY p_type) - 1)::DOUBLE AS p_type_encoded FROM part""")
add("label_codes_many", """WITH fitted AS (SELECT DISTINCT p_name FROM part WHERE p_partkey % 10 <> 0),
  coded AS (SELECT p_name, (row_number() OVER (ORDER BY p_name) - 1)::DOUBLE AS code FROM fitted)
  SELECT p_partkey, part.p_name, coalesce(code, -1.0)::DOUBLE AS p_name_code FROM part LEFT JOIN coded ON part.p_name = coded.p_name""")
add("both_encodings", f"""SELECT c_custkey, {', '.join(f'{v} AS "{n}"' for n, v in onehot_sql('c_mktsegment', SEGMENTS))},
  (dense_rank() OVER (ORDER BY c_mktsegment) - 1)::DOUBLE AS c_mktsegment_encoded FROM customer""")
add("unseen_levels", """WITH l AS (SELECT p_brand AS b, (row_number() OVER (ORDER BY p_brand) - 1)::DOUBLE AS code FROM (SELECT DISTINCT p_brand FROM part WHERE p_size <= 1))
  SELECT p_partkey, coalesce(code, -1.0)::DOUBLE AS p_brand_encoded FROM part LEFT JOIN l ON p_brand = b""")
HEALTH = """h AS (SELECT c_custkey, (c_nationkey + 150)::DOUBLE AS height, abs(c_acctbal) / 100 + 40 AS weight, (c_nationkey * 3 + 90)::DOUBLE AS sys,
  (c_nationkey + 60)::DOUBLE AS dia, abs(c_acctbal) / 90 + 30 AS hdl, (c_nationkey * 4 + 1)::DOUBLE AS ldl, abs(c_acctbal) / 50 AS chol, c_nationkey / 10.0::DOUBLE AS vl,
  abs(c_acctbal) / 9000 AS vr, (c_nationkey % 2 + 1)::DOUBLE AS hl, (c_nationkey % 3)::DOUBLE AS hr, (c_nationkey + 10)::DOUBLE AS ast, abs(c_acctbal) / 200 + 5 AS alt FROM customer)"""
add("health_ratios", f"""WITH {HEALTH} SELECT c_custkey, {r('weight / pow(height / 100, 2)')} AS bmi, {r('(sys + dia) / 2')} AS bp_mean, {r('sys - dia')} AS bp_pulse_pressure,
  {r('hdl / (ldl + 1e-8)')} AS cholesterol_ratio, {r('chol / (hdl + 1e-8)')} AS cholesterol_hdl_ratio, {r('(vl + vr) / 2')} AS vision_avg,
  {r('abs(vl - vr)')} AS vision_diff, {r('(hl + hr) / 2')} AS hearing_avg, {r('ast / (alt + 1e-8)')} AS ast_alt_ratio FROM h""")
FEATURE_ROWS = [(n, b) for b in ALL_BLOCKS for n, _ in pair_parts((b,))]
add("feature_list", "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{n}', '{b}')" for i, (n, b) in enumerate(FEATURE_ROWS, 1)) + ") t(ordinal, feature, block) WHERE EXISTS (SELECT 1 FROM customer)")
PRE = [("o_totalprice", "x"), ("log_o_totalprice", "ln(1 + (x - l + 1))"), ("log10_o_totalprice", "log10(x - l + 1)"),
       ("o_totalprice_normalized", "(x - l) / (h - l + 1e-8)"), ("o_totalprice_distance_from_mean", "abs(x - m)"), ("o_totalprice_zscore", "(x - m) / s")]
add("preprocess_train_test", f"""WITH {split_cte('orders', 'o_orderkey', 'o_orderstatus')},
  st AS (SELECT min(o_totalprice) AS l, max(o_totalprice) AS h, avg(o_totalprice) AS m, stddev_samp(o_totalprice) AS s FROM marked WHERE NOT is_test),
  x AS (SELECT *, o_totalprice AS x FROM marked, st),
  f AS (SELECT o_orderkey, o_orderstatus, is_test, {', '.join(f'''CASE WHEN isfinite({v}) THEN {v} END AS f_{n}''' if 'log' not in n else f'''CASE WHEN x - l + 1 > {-1 if 'log_' in n else 0} THEN {v.replace('x - l + 1', 'greatest(x - l + 1, 1e-300)') if 'log10' in n else v.replace('(x - l + 1)', 'greatest(x - l + 1, -0.999999)')} END AS f_{n}''' for n, v in PRE)} FROM x),
  sc AS (SELECT {', '.join(f'avg(f_{n}) AS c{i}, stddev_pop(f_{n}) AS d{i}' for i, (n, _) in enumerate(PRE))} FROM f WHERE NOT is_test)
  SELECT o_orderkey, o_orderstatus, {', '.join(f'{r(f"coalesce((f_{n} - c{i}) / d{i}, 0)")} AS {n}' for i, (n, _) in enumerate(PRE))},
    CASE WHEN is_test THEN 'test' ELSE 'train' END AS part FROM f, sc""")
add("target_codes", "SELECT c_custkey, c_mktsegment, (dense_rank() OVER (ORDER BY c_mktsegment) - 1)::DOUBLE AS code, c_mktsegment AS decoded FROM customer")
SIMPLE = "SELECT o_orderkey, o_totalprice, CASE o_orderstatus WHEN 'F' THEN 1.0 WHEN 'O' THEN 0.0 END::DOUBLE AS o_orderstatus_encoded FROM orders"
add("simple_preprocess", f"{SIMPLE} UNION ALL {SIMPLE}")

# --- splits ------------------------------------------------------------------------
add("stratified_split", f"WITH {split_cte('orders', 'o_orderkey', 'o_orderstatus')} SELECT o_orderkey, o_orderstatus, is_test FROM marked")
add("stratified_folds", f"SELECT o_orderkey, (ntile(5) OVER (PARTITION BY o_orderstatus ORDER BY {h60('o_orderkey')}, o_orderkey) - 1)::INTEGER AS fold FROM orders")
add("ordered_folds", "SELECT o_orderkey, (ntile(5) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) - 1)::INTEGER AS fold FROM orders")
add("plain_folds", f"SELECT o_orderkey, (ntile(5) OVER (ORDER BY {h60('o_orderkey')}, o_orderkey) - 1)::INTEGER AS fold FROM orders")
add("stratified_bootstrap", f"""WITH c AS (SELECT o_orderstatus AS s, count(*) AS n, 800.0 * count(*) / sum(count(*)) OVER () AS share FROM orders GROUP BY 1),
  q AS (SELECT *, floor(share) + (row_number() OVER (ORDER BY share - floor(share) DESC, s) <= 800 - sum(floor(share)) OVER ())::INTEGER AS quota FROM c),
  p AS (SELECT *, sum(quota) OVER (ORDER BY s) - quota AS lo FROM q),
  d AS (SELECT range AS draw, s, floor({unit52('42-draw', 'range')} * n) AS rk FROM range(800), p WHERE range >= lo AND range < lo + quota),
  o AS (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {h60('o_orderkey')}, o_orderkey) - 1 AS rk FROM orders)
  SELECT draw, o_orderkey, o_orderstatus FROM d JOIN o ON s = o_orderstatus AND d.rk = o.rk""")


def poisson_sql(rate: float, terms: int = 12) -> str:
    total, parts = 0.0, []
    for i in range(terms):
        total += math.exp(-rate) * rate**i / math.factorial(i)
        parts.append(f"(u >= {total!r}::DOUBLE)::INTEGER")
    return " + ".join(parts)


add("bootstrap_replicas", f"""SELECT c_custkey, replica, copies FROM (SELECT *, ({poisson_sql(0.8)})::INTEGER AS copies FROM (
  SELECT c_custkey, range::INTEGER AS replica, {unit('42', 'range, c_custkey')} AS u FROM customer, range(20))) WHERE copies > 0""")

# --- metrics -----------------------------------------------------------------------
add("accuracy", f"WITH {CLASSED} SELECT {r('avg((label = prediction)::INTEGER)')} AS accuracy FROM classed")
add("f1_binary", f"WITH {ITEMS} SELECT {r(f1_sql('p1'))} AS f1 FROM items")
MACRO = """cl AS (SELECT DISTINCT label AS c FROM classed UNION SELECT DISTINCT prediction FROM classed),
  fc AS (SELECT c, coalesce(2.0 * count(*) FILTER (label = c AND prediction = c) / nullif(count(*) FILTER (label = c) + count(*) FILTER (prediction = c), 0), 0) AS f FROM cl, classed GROUP BY c)"""
add("f1_macro", f"WITH {CLASSED}, {MACRO} SELECT {r('avg(f)')} AS f1_macro FROM fc")
add("f1_auto", f"WITH {CLASSED}, {MACRO} SELECT {r(f1_sql('p2'))} AS f1_auto, 'binary' AS task FROM items UNION ALL SELECT {r('avg(f)')}, 'multi' FROM fc")
add("classification_report", f"WITH {CLASSED}, {report('classed', 'label', 'prediction')}")
add("confusion_matrix", f"""WITH {ITEMS}, cl AS (SELECT DISTINCT l_returnflag AS c FROM items UNION SELECT 'A')
  SELECT a.c AS label, b.c AS prediction, (SELECT count(*) FROM items WHERE l_returnflag = a.c AND b.c = 'A') AS n FROM cl a, cl b""")
P_TP, P_FP, P_FN = counts("p3")
add("precision_recall", f"""WITH {ITEMS} SELECT {r(f'coalesce({P_TP}::DOUBLE / nullif({P_TP} + {P_FP}, 0), 0)')} AS value, 'precision' AS metric FROM items
  UNION ALL SELECT {r(f'coalesce({P_TP}::DOUBLE / nullif({P_TP} + {P_FN}, 0), 0)')}, 'recall' FROM items""")


def curve_cte(score: str) -> str:
    return f"""c AS (SELECT {score} AS s, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y <> 1) AS neg FROM items GROUP BY 1),
      k AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, row_number() OVER w AS rn, lead(pos) OVER w AS np, lead(neg) OVER w AS nn,
        lag(s) OVER w AS before, (SELECT sum(pos) FROM c) AS p, (SELECT sum(neg) FROM c) AS n FROM c WINDOW w AS (ORDER BY s DESC))"""


add("roc_curve", f"""WITH {ITEMS}, {curve_cte('s3')} SELECT {r('s', 8)} AS threshold, {r('fp / n', 8)} AS fpr, {r('tp / p', 8)} AS tpr FROM k
  WHERE rn = 1 OR np IS NULL OR np <> pos OR nn <> neg UNION ALL SELECT 'Infinity'::DOUBLE, 0.0, 0.0""")
add("roc_auc", f"WITH {ITEMS}, {curve_cte('s2')} SELECT {r('sum(neg * (tp - pos / 2.0)) / (max(p) * max(n))')} AS roc_auc FROM k")
add("pr_curve", f"""WITH {ITEMS}, {curve_cte('s1')} SELECT {r('s', 8)} AS threshold, {r('tp / (tp + fp)', 8)} AS precision, {r('tp / p', 8)} AS recall FROM k
  UNION ALL SELECT NULL, 1.0, 0.0""")
add("pr_auc", f"""WITH {ITEMS}, {curve_cte('s2')}, t AS (SELECT rn, p, pos, tp / (tp + fp) AS pr, lag(tp / (tp + fp)) OVER (ORDER BY rn) AS past FROM k)
  SELECT {r('sum(pos * (pr + coalesce(past, 1)) / 2) / max(p)')} AS pr_auc FROM t""")
LOSS = "(y * ln(q) + (1 - y) * ln(1 - q))"
add("log_loss", f"""WITH {ITEMS}, l AS (SELECT *, greatest(least(s1, 1 - 1e-15), 1e-15) AS q,
    (count(*) OVER ())::DOUBLE / (2 * count(*) OVER (PARTITION BY y)) AS w FROM items)
  SELECT {r(f'-avg{LOSS}')} AS log_loss, 'plain' AS kind FROM l UNION ALL SELECT {r(f'-avg(w * {LOSS})')}, 'weighted' FROM l""")


def summary_sql(source: str, p: str, y: str = "y") -> str:
    tp, fp, fn = counts(p, y)
    rows = {"accuracy": f"avg(({p} = {y})::INTEGER)", "precision": f"coalesce({tp}::DOUBLE / nullif({tp} + {fp}, 0), 0)",
            "recall": f"coalesce({tp}::DOUBLE / nullif({tp} + {fn}, 0), 0)", "f1": f1_sql(p, y)}
    return " UNION ALL ".join(f"SELECT '{m}' AS metric, {r(v)} AS value FROM {source}" for m, v in rows.items())


add("metric_summary", f"WITH {ITEMS} {summary_sql('items', 'p1')}")
MODELS = " UNION ALL ".join(f"SELECT {i} AS ordinal, '{m}' AS model, avg((p{i + 1} = y)::INTEGER) AS accuracy, {f1_sql(f'p{i + 1}')} AS f1 FROM items"
                            for i, m in enumerate(("quantity", "price", "discount")))
add("model_scores", f"WITH {ITEMS}, m AS ({MODELS}) SELECT ordinal, model, {r('accuracy')} AS accuracy, {r('f1')} AS f1 FROM m")

# --- models ------------------------------------------------------------------------
QSPLIT = f"{QUALITY}, {split_cte('data', 'doc_id', 'quality')}, tr AS (SELECT * FROM marked WHERE NOT is_test), te AS (SELECT * FROM marked WHERE is_test)"
add("naive_bayes", f"""WITH {QSPLIT}, {naive_bayes_cte(SHAPE, 'quality', 'tr', 'te', 'doc_id')}
  SELECT a.doc_id, a.c AS prediction, {r('b.p')} AS p1 FROM ps a JOIN ps b ON a.doc_id = b.doc_id AND b.c = 1 WHERE a.best = 1""")
add("naive_bayes_multiclass", f"""WITH {LANGUAGES}, {naive_bayes_cte(VOWELS, 'y', 'data', 'data', 'doc_id')}
  SELECT a.doc_id, a.c AS prediction, {r('b.p', 5)} AS p0 FROM ps a JOIN ps b ON a.doc_id = b.doc_id AND b.c = 0 WHERE a.best = 1""")
add("training_metrics", f"""WITH {QUALITY}, {naive_bayes_cte(SHAPE, 'quality', 'data', 'data', 'doc_id')},
  g AS (SELECT truth AS y, c AS guess FROM ps WHERE best = 1) {summary_sql('g', 'guess')}""")
add("decision_surface", f"""WITH src AS (SELECT l_extendedprice / 1000 AS price, l_quantity AS quantity, l_linestatus FROM lineitem),
  b AS (SELECT min(price) - 1 AS x0, max(price) + 1 AS x1, min(quantity) - 1 AS y0, max(quantity) + 1 AS y1 FROM src),
  g AS (SELECT x0 + i.range * 2.0::DOUBLE AS price, y0 + j.range * 2.0::DOUBLE AS quantity, i.range * 100000 + j.range AS id, 'F' AS l_linestatus
    FROM b, range(100000) i, range(100000) j WHERE i.range < ceil((x1 - x0) / 2) AND j.range < ceil((y1 - y0) / 2)),
  {naive_bayes_cte(('price', 'quantity'), 'l_linestatus', 'src', 'g', 'id')}
  SELECT {r('g.price')} AS price, {r('g.quantity')} AS quantity, c AS prediction FROM ps JOIN g USING (id) WHERE best = 1""")


def neighbours(k: int, dist: str, train: str = "embeddings", query: str = "embeddings") -> str:
    return f"""nb AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY dist, tid) AS rank FROM (
      SELECT q.vec_id AS qid, t.vec_id AS tid, t.label, {dist} AS dist FROM {query} q, {train} t) QUALIFY rank <= {k})"""


L2 = "sqrt(list_sum(list_transform(list_zip(q.embedding, t.embedding), lambda z: (z[1]::DOUBLE - z[2]::DOUBLE) * (z[1]::DOUBLE - z[2]::DOUBLE))))"
L1 = "list_sum(list_transform(list_zip(q.embedding, t.embedding), lambda z: abs(z[1]::DOUBLE - z[2]::DOUBLE)))"
add("nearest_neighbours", f"WITH {neighbours(5, L2)} SELECT qid, tid, {r('dist')} AS dist, rank::INTEGER AS rank FROM nb")
ORACLES["nearest_neighbours_pivots"] = ORACLES["nearest_neighbours"]
add("nearest_neighbours_manhattan", f"WITH {neighbours(3, L1)} SELECT qid, tid, {r('dist')} AS dist, rank::INTEGER AS rank FROM nb")
add("knn_classify", f"""WITH {split_cte('embeddings', 'vec_id', 'label')}, tr AS (SELECT * FROM marked WHERE NOT is_test), te AS (SELECT * FROM marked WHERE is_test),
  {neighbours(15, L2, 'tr', 'te')}, v AS (SELECT qid, label, CASE WHEN bool_or(min(dist) = 0) OVER (PARTITION BY qid) THEN sum((dist = 0)::INTEGER)::DOUBLE ELSE sum(1 / nullif(dist, 0)) END AS w FROM nb GROUP BY qid, label),
  s AS (SELECT *, w / sum(w) OVER (PARTITION BY qid) AS share, row_number() OVER (PARTITION BY qid ORDER BY w DESC, label) AS best FROM v)
  SELECT qid AS vec_id, label AS prediction, {r('share')} AS top_share FROM s WHERE best = 1""")
GAPS = {p: " + ".join(f"pow(abs((q.{c} - m_{c}) / s_{c} - (t.{c} - m_{c}) / s_{c}), {p})" for c in SHAPE) for p in (1, 2)}
add("knn_settings", f"""WITH {QUALITY}, f AS (SELECT *, (ntile(5) OVER (PARTITION BY quality ORDER BY {h60('doc_id')}, doc_id) - 1)::INTEGER AS fold FROM data),
  st AS (SELECT g.fold AS sf, {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in SHAPE)} FROM (SELECT DISTINCT fold FROM f) g JOIN f ON f.fold <> g.fold GROUP BY 1),
  d AS (SELECT q.fold, q.doc_id AS qid, q.quality AS y, t.doc_id AS tid, t.quality AS l, u.p AS used, CASE u.p WHEN 1 THEN {GAPS[1]} ELSE sqrt({GAPS[2]}) END AS dist
    FROM f q JOIN f t ON q.fold <> t.fold JOIN st ON sf = q.fold, (VALUES (1), (2)) u(p)),
  n AS (SELECT *, row_number() OVER (PARTITION BY qid, used ORDER BY dist, tid) AS rank FROM d QUALIFY rank <= {max(NEIGHBOURS)}),
  v AS (SELECT fold, qid, y, used, k, sum((dist = 0 AND l = 1)::INTEGER) AS z1, sum((dist = 0 AND l = 0)::INTEGER) AS z0, sum(CASE WHEN l = 1 THEN 1 / nullif(dist, 0) END) AS s1,
    sum(CASE WHEN l = 0 THEN 1 / nullif(dist, 0) END) AS s0, sum((l = 1)::INTEGER) AS u1, sum((l = 0)::INTEGER) AS u0
    FROM n, (VALUES {', '.join(f'({k})' for k in NEIGHBOURS)}) ks(k) WHERE rank <= k GROUP BY ALL),
  g AS (SELECT fold, y, used, k, 'uniform' AS weights, (u1 > u0)::INTEGER AS guess FROM v UNION ALL
    SELECT fold, y, used, k, 'distance', CASE WHEN z1 + z0 > 0 THEN (z1 > z0)::INTEGER ELSE (coalesce(s1, 0) > coalesce(s0, 0))::INTEGER END FROM v),
  e AS (SELECT fold, used, k, weights, {f1_sql('guess')} AS f1, avg((guess = y)::INTEGER) AS accuracy FROM g GROUP BY ALL)
  SELECT k, weights, metric, p, fold, {r('f1')} AS f1, {r('accuracy')} AS accuracy FROM e
    JOIN (VALUES ('minkowski', 1, 1), ('minkowski', 2, 2), ('manhattan', 1, 1), ('manhattan', 2, 1)) c(metric, p, uses) ON used = uses""")
add("holdout_report", f"""WITH {QUALITY}, tr AS (SELECT * FROM data WHERE toxic <> 1), te AS (SELECT * FROM data WHERE toxic = 1),
  {naive_bayes_cte(SHAPE, 'quality', 'tr', 'te', 'doc_id')}, best AS (SELECT truth, c AS guess FROM ps WHERE best = 1), {report('best', 'truth', 'guess')}""")
SCALED = ", ".join(f"({c} - avg({c}) FILTER (NOT is_test) OVER ()) / (stddev_pop({c}) FILTER (NOT is_test) OVER ()) AS {c}" for c in SHAPE)
add("naive_bayes_report", f"""WITH {QUALITY}, {split_cte('data', 'doc_id', 'quality')}, sc AS (SELECT doc_id, quality, is_test, {SCALED} FROM marked),
  tr AS (SELECT * FROM sc WHERE NOT is_test), te AS (SELECT * FROM sc WHERE is_test),
  {naive_bayes_cte(SHAPE, 'quality', 'tr', 'te', 'doc_id')}, best AS (SELECT truth, c AS guess FROM ps WHERE best = 1), {report('best', 'truth', 'guess')}""")


def bayes_folds_cte(features, label: str, folded: str, grid: dict[int, str], binary: bool) -> str:
    """Scores of naive Bayes on every fold, for each smoothing of the grid: ``fs(param_id, f, f1, f1_macro, accuracy)``."""
    aggs = ", ".join(f"avg({f}) AS m_{f}, var_pop({f}) AS v_{f}" for f in features)
    top = ", ".join(f"var_pop({f})" for f in features)
    terms = " - ".join(f"(0.5 * ln(2 * pi() * (v_{f} + top * smooth)) + (q.{f} - m_{f}) * (q.{f} - m_{f}) / (2 * (v_{f} + top * smooth)))" for f in features)
    settings = " UNION ALL ".join(f"SELECT {i} AS param_id, {s}::DOUBLE AS smooth" for i, s in grid.items())
    f1 = "max(f1) FILTER (c = 1)" if binary else "avg(f1)"
    return f"""kf AS (SELECT DISTINCT fold AS f FROM {folded}), pg AS ({settings}),
    st AS (SELECT f, {label} AS c, count(*) AS n, {aggs} FROM kf JOIN {folded} ON fold <> f GROUP BY 1, 2),
    ov AS (SELECT f, greatest({top}) AS top, count(*) AS total FROM kf JOIN {folded} ON fold <> f GROUP BY 1),
    ll AS (SELECT param_id, st.f, q.doc_id, q.{label} AS truth, c, ln(n::DOUBLE / total) - {terms} AS s
      FROM {folded} q JOIN st ON st.f = q.fold JOIN ov ON ov.f = q.fold CROSS JOIN pg),
    gs AS (SELECT param_id, f, truth, c AS guess FROM ll QUALIFY row_number() OVER (PARTITION BY param_id, f, doc_id ORDER BY s DESC, c) = 1),
    cs AS (SELECT param_id, f, truth AS c FROM gs UNION SELECT param_id, f, guess FROM gs),
    pc AS (SELECT param_id, f, c, coalesce(2.0 * count(*) FILTER (truth = c AND guess = c) / nullif(count(*) FILTER (truth = c) + count(*) FILTER (guess = c), 0), 0)::DOUBLE AS f1
      FROM cs JOIN gs USING (param_id, f) GROUP BY 1, 2, 3),
    fs AS (SELECT param_id, f, {f1} AS f1, avg(f1) AS f1_macro, any_value(hit) AS accuracy
      FROM pc JOIN (SELECT param_id, f, avg((truth = guess)::INTEGER) AS hit FROM gs GROUP BY 1, 2) USING (param_id, f) GROUP BY 1, 2)"""


add("cross_validated_score", f"""WITH {LANGUAGES}, folded AS (SELECT *, (ntile(5) OVER (PARTITION BY y ORDER BY doc_id) - 1)::INTEGER AS fold FROM data),
  {bayes_folds_cte(VOWELS, 'y', 'folded', {0: '1e-9'}, False)}
  SELECT f AS fold, {r('f1', 4)} AS f1, {r('f1_macro', 4)} AS f1_macro, {r('accuracy', 4)} AS accuracy FROM fs""")
add("best_single_fold", f"""WITH {QUALITY}, folded AS (SELECT *, (ntile(5) OVER (ORDER BY {h60('doc_id')}, doc_id) - 1)::INTEGER AS fold FROM data),
  {bayes_folds_cte(SHAPE, 'quality', 'folded', {0: '1e-9', 1: '0.1', 2: '0.01', 3: '0.001', 4: '1e-6'}, True)}
  SELECT param_id, CASE param_id WHEN 0 THEN '{{}}' WHEN 1 THEN '{{"smoothing": 0.1}}' WHEN 2 THEN '{{"smoothing": 0.01}}' WHEN 3 THEN '{{"smoothing": 0.001}}' ELSE '{{"smoothing": 1e-06}}' END AS params,
    f AS fold, {r('f1', 4)} AS f1, {r('f1_macro', 4)} AS f1_macro, {r('accuracy', 4)} AS accuracy FROM fs ORDER BY fs.f1 DESC, param_id, f LIMIT 1""")

# --- combining ---------------------------------------------------------------------


def mixed(cols, weights) -> str:
    return "(" + " + ".join(f"{c} * {w!r}::DOUBLE" for c, w in zip(cols, weights)) + f") / {float(sum(weights))!r}::DOUBLE"


ONES, ZEROS = ("s1", "s2", "s3"), ("(1.0::DOUBLE - s1)", "(1.0::DOUBLE - s2)", "(1.0::DOUBLE - s3)")
SOFT = mixed(ONES, (1.0, 1.0, 1.0)), mixed(ZEROS, (1.0, 1.0, 1.0))
add("soft_vote", f"WITH {ITEMS} SELECT y, ({SOFT[0]} > {SOFT[1]})::INTEGER AS prediction, count(*) AS n FROM items GROUP BY 1, 2")
add("hard_vote", f"WITH {ITEMS} SELECT y, (p1 + p2 + p3 >= 2)::INTEGER AS prediction, count(*) AS n FROM items GROUP BY 1, 2")
WEIGHTS = f"""f AS (SELECT '1' AS model, {f1_sql('p1')} AS f1 FROM items UNION ALL SELECT '2', {f1_sql('p2')} FROM items UNION ALL SELECT '3', {f1_sql('p3')} FROM items),
  w AS (SELECT model, f1, pow(f1 / (SELECT sum(f1) FROM f), 2) / (SELECT sum(f1 * f1) / pow(sum(f1), 2) FROM f) AS weight FROM f)"""
add("vote_weights", f"WITH {ITEMS}, {WEIGHTS} SELECT model, {r('f1')} AS f1, {r('weight')} AS weight FROM w")
add("weighted_vote", f"""WITH {ITEMS}, {WEIGHTS}, x AS (SELECT max(weight) FILTER (model = '1') AS w1, max(weight) FILTER (model = '2') AS w2, max(weight) FILTER (model = '3') AS w3 FROM w)
  SELECT y, (s1 * w1 + s2 * w2 + s3 * w3 > (1.0 - s1) * w1 + (1.0 - s2) * w2 + (1.0 - s3) * w3)::INTEGER AS prediction, count(*) AS n FROM items, x GROUP BY 1, 2""")


def blend_cte(grid, cols) -> str:
    names = [f"w{i}" for i in range(1, len(cols) + 1)]
    rows = ", ".join("(" + ", ".join([str(i), *[f"{v!r}::DOUBLE" for v in w], f"{t!r}::DOUBLE"]) + ")" for i, (w, t) in enumerate(grid))
    blend = " + ".join(f"{w} * {c}" for w, c in zip(names, cols))
    return f"""g(ordinal, {', '.join(names)}, threshold) AS (VALUES {rows}),
      e AS (SELECT ordinal, {', '.join(names)}, threshold, coalesce(2.0 * count(*) FILTER ({blend} > threshold AND y = 1) /
        nullif(count(*) FILTER ({blend} > threshold) + count(*) FILTER (y = 1), 0), 0) AS f1 FROM items, g GROUP BY ALL)"""


def blend_sql(grid, cols, tail: str = "") -> str:
    names = [f"w{i}" for i in range(1, len(cols) + 1)]
    cols_out = ", ".join(f"{r(n)} AS {n}" for n in (*names, "threshold", "f1"))
    return f"WITH {ITEMS}, {blend_cte(grid, cols)} SELECT ordinal, {cols_out} FROM e {tail}"


# The grids are written out here once more, so that a wrong one in the library shows.
FIVE = [((w, 1.0 - w), t) for w in np.arange(0.2, 0.9, 0.05).tolist() for t in (0.4, 0.45, 0.5, 0.55, 0.6)]
FINE = [((w, 1.0 - w), t) for w in np.arange(0.2, 0.8, 0.05).tolist() for t in np.arange(0.4, 0.6, 0.02).tolist()]
THREE = [((a, b, 1.0 - a - b), 0.5) for a in np.arange(0.2, 0.9, 0.1).tolist() for b in np.arange(0.1, 0.8, 0.1).tolist() if 1.0 - a - b > 0]
add("blend_search_pair", blend_sql(FIVE, ("s1", "s2")))
add("blend_search_fine", blend_sql(FINE, ("s2", "s3")))
add("blend_search_triple", blend_sql(THREE, ("s1", "s2", "s3")))
add("blend_search_classes", f"""WITH {ITEMS},
  n AS (SELECT unnest(range(1, 8)) AS i),
  grid AS (SELECT (row_number() OVER (ORDER BY a.i, b.i, c.i) - 1)::INTEGER AS ordinal, a.i / 10.0::DOUBLE AS w1, b.i / 10.0::DOUBLE AS w2, c.i / 10.0::DOUBLE AS w3,
      (10 - a.i - b.i - c.i) / 10.0::DOUBLE AS w4 FROM n a, n b, n c WHERE a.i + b.i + c.i < 10),
  mixed AS (SELECT ordinal, l_returnflag AS y, w1 * s1 + w2 * 0.4::DOUBLE + w3 * (1 - s3) + w4 * 0.3::DOUBLE AS a, w1 * (1 - s1) + w2 * s2 + w3 * 0.5::DOUBLE + w4 * (1 - s1) AS n,
      w1 * 0.4::DOUBLE + w2 * (1 - s2) + w3 * s3 + w4 * s2 AS r FROM items, grid),
  guessed AS (SELECT ordinal, y, CASE WHEN a >= n AND a >= r THEN 'A' WHEN n >= r THEN 'N' ELSE 'R' END AS g FROM mixed),
  f AS (SELECT ordinal, c, 2.0::DOUBLE * count(*) FILTER (y = c AND g = c) / nullif(count(*) FILTER (y = c) + count(*) FILTER (g = c), 0) AS f
    FROM guessed, (VALUES ('A'), ('N'), ('R')) k(c) GROUP BY ordinal, c)
SELECT ordinal, {r('any_value(w1)')} AS w1, {r('any_value(w2)')} AS w2, {r('any_value(w3)')} AS w3, {r('any_value(w4)')} AS w4, {r('avg(f)')} AS f1 FROM grid JOIN f USING (ordinal) GROUP BY ordinal""")
add("best_blend", blend_sql(FIVE, ("s1", "s2"), "ORDER BY e.f1 DESC, ordinal LIMIT 1"))
add("blended", f"WITH {ITEMS} SELECT y, (0.35::DOUBLE * s1 + 0.65::DOUBLE * s2 > 0.45::DOUBLE)::INTEGER AS prediction, count(*) AS n FROM items GROUP BY 1, 2")
add("best_method", f"WITH {ITEMS}, m AS ({MODELS}) SELECT model, {r('f1')} AS f1 FROM m ORDER BY m.f1 DESC, ordinal LIMIT 1")

# Stumps: cut values are the values at ranks i * n // 256; every cut of every feature is tried.
CUTS = f"""{QUALITY}, long AS ({" UNION ALL ".join(f"SELECT doc_id, {i} AS f, '{c}' AS feature, {c}::DOUBLE AS v FROM data" for i, c in enumerate(SHAPE))}),
  ranked AS (SELECT f, feature, v, row_number() OVER (PARTITION BY f ORDER BY v) - 1 AS spot, count(*) OVER (PARTITION BY f) AS n FROM long),
  cuts AS (SELECT DISTINCT f, feature, v AS cut FROM (SELECT *, greatest(1, (spot * 256 + n - 1) // n) AS i FROM ranked) WHERE i < 256 AND (i * n) // 256 = spot)"""


def soft(g: str) -> str:
    return f"(sign({g}) * greatest(abs({g}) - 0.5, 0))"


def newton_round(k: int) -> str:
    score = lambda g, h: f"pow({soft(g)}, 2) / ({h} + 2)"
    leaf = lambda g, h: f"-0.1 * {soft(g)} / ({h} + 2)"
    return f"""g{k} AS (SELECT doc_id, w * (p - quality) AS g, w * p * (1 - p) AS h FROM (SELECT *, 1 / (1 + exp(-margin)) AS p FROM m{k})),
  c{k} AS (SELECT f, feature, cut, coalesce(sum(g) FILTER (v < cut), 0) AS gl, coalesce(sum(h) FILTER (v < cut), 0) AS hl, sum(g) AS g, sum(h) AS h
    FROM long JOIN cuts USING (f, feature) JOIN g{k} USING (doc_id) GROUP BY ALL),
  b{k} AS (SELECT {k} AS round, f, feature, cut, {leaf('gl', 'hl')} AS "left", {leaf('(g - gl)', '(h - hl)')} AS "right" FROM c{k}
    WHERE hl >= 1 AND h - hl >= 1 ORDER BY {score('gl', 'hl')} + {score('(g - gl)', '(h - hl)')} - {score('g', 'h')} DESC, f, cut LIMIT 1),
  m{k + 1} AS (SELECT m.doc_id, quality, w, margin + CASE WHEN v < cut THEN "left" ELSE "right" END AS margin FROM m{k} m JOIN long USING (doc_id) JOIN b{k} USING (f, feature))"""


def adaptive_round(k: int) -> str:
    side = lambda a, b: f"({a} * {a} + {b} * {b}) / nullif({a} + {b}, 0)"
    return f"""c{k} AS (SELECT f, feature, cut, coalesce(sum(w * x) FILTER (v < cut AND quality = 0), 0) AS l0, coalesce(sum(w * x) FILTER (v < cut AND quality = 1), 0) AS l1,
      sum(w * x) FILTER (quality = 0) AS t0, sum(w * x) FILTER (quality = 1) AS t1, count(*) FILTER (v < cut) AS nl, count(*) AS n
    FROM long JOIN cuts USING (f, feature) JOIN m{k} USING (doc_id) GROUP BY ALL),
  b{k} AS (SELECT f, feature, cut, (l1 > l0)::INTEGER AS "left", (t1 - l1 > t0 - l0)::INTEGER AS "right" FROM c{k}
    WHERE nl >= 2 AND n - nl >= 2 ORDER BY {side('l0', 'l1')} + {side('(t0 - l0)', '(t1 - l1)')} DESC, f, cut LIMIT 1),
  s{k} AS (SELECT m.doc_id, quality, w, x, f, (CASE WHEN v < cut THEN "left" ELSE "right" END) <> quality AS miss FROM m{k} m JOIN long USING (doc_id) JOIN b{k} USING (f, feature)),
  e{k} AS (SELECT 0.1 * ln((1 - e) / e) AS alpha, mean FROM (SELECT sum(x) FILTER (miss) / sum(x) AS e, avg(x) AS mean FROM s{k})),
  m{k + 1} AS (SELECT doc_id, quality, w, x * CASE WHEN miss THEN exp(alpha) ELSE 1 END / mean AS x FROM s{k}, e{k})"""


add("boosted_stumps", f"""WITH {CUTS}, m0 AS (SELECT doc_id, quality, CASE WHEN quality = 1 THEN (SELECT count(*) FILTER (quality = 0)::DOUBLE / count(*) FILTER (quality = 1) FROM data) ELSE 1 END AS w, 0.0::DOUBLE AS margin FROM data),
  {", ".join(newton_round(k) for k in range(3))}
  {" UNION ALL ".join(f"SELECT round, feature, {r('cut', 4)} AS cut, {r(chr(34) + 'left' + chr(34), 4)} AS left, {r(chr(34) + 'right' + chr(34), 4)} AS right FROM b{k}" for k in range(3))}""")
add("adaptive_stumps", f"""WITH {CUTS}, m0 AS (SELECT doc_id, quality, count(*) OVER ()::DOUBLE / (2 * count(*) OVER (PARTITION BY quality)) AS w, 1.0::DOUBLE AS x FROM data),
  {", ".join(adaptive_round(k) for k in range(3))}
  {" UNION ALL ".join(f"SELECT {k} AS round, feature, {r('cut', 4)} AS cut, b.left::DOUBLE AS left, b.right::DOUBLE AS right, {r('alpha', 4)} AS alpha FROM b{k} b, e{k}" for k in range(3))}""")

# Newton steps on slope and intercept, 40 of them; the two equations of a step are solved by Cramer's rule.
add("squared_hinge_line", f"""WITH RECURSIVE {QUALITY},
  pts AS (SELECT (log_chars - avg(log_chars) OVER ()) / stddev_pop(log_chars) OVER () AS x, 2 * quality - 1 AS s, count(*) OVER ()::DOUBLE / (2 * count(*) OVER (PARTITION BY quality)) AS w FROM data),
  steps AS (
    SELECT c::DOUBLE AS c, 0 AS k, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b FROM (VALUES (0.001), (0.25), (4.0)) t(c)
    UNION ALL
    SELECT c, any_value(k) + 1, any_value(a) - ((ga + any_value(a)) * (1 + hbb) - (gb + any_value(b)) * hab) / ((1 + haa) * (1 + hbb) - hab * hab),
      any_value(b) - ((gb + any_value(b)) * (1 + haa) - (ga + any_value(a)) * hab) / ((1 + haa) * (1 + hbb) - hab * hab)
    FROM (SELECT c, k, a, b, sum(-2 * c * w * s * gap * x * on_) OVER p AS ga, sum(-2 * c * w * s * gap * on_) OVER p AS gb, sum(2 * c * w * x * x * on_) OVER p AS haa,
        sum(2 * c * w * x * on_) OVER p AS hab, sum(2 * c * w * on_) OVER p AS hbb
      FROM (SELECT *, 1 - s * (a * x + b) AS gap, (1 - s * (a * x + b) > 0)::INTEGER AS on_ FROM steps, pts WHERE k < 40) WINDOW p AS (PARTITION BY c))
    GROUP BY c, ga, gb, haa, hab, hbb)
SELECT c, {r('a', 5)} AS slope, {r('b', 5)} AS intercept FROM steps WHERE k = 40""")

# The same for the logistic loss; the intercept carries no penalty.
add("logistic_line", f"""WITH RECURSIVE {QUALITY},
  pts AS (SELECT (log_chars - avg(log_chars) OVER ()) / stddev_pop(log_chars) OVER () AS x, quality AS y, count(*) OVER ()::DOUBLE / (2 * count(*) OVER (PARTITION BY quality)) AS w FROM data),
  steps AS (
    SELECT c::DOUBLE AS c, 0 AS k, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b FROM (VALUES (0.01), (0.25), (4.0)) t(c)
    UNION ALL
    SELECT c, any_value(k) + 1, any_value(a) - ((ga + any_value(a)) * hbb - gb * hab) / ((1 + haa) * hbb - hab * hab),
      any_value(b) - (gb * (1 + haa) - (ga + any_value(a)) * hab) / ((1 + haa) * hbb - hab * hab)
    FROM (SELECT c, k, a, b, sum(c * w * (p - y) * x) OVER q AS ga, sum(c * w * (p - y)) OVER q AS gb, sum(c * w * p * (1 - p) * x * x) OVER q AS haa,
        sum(c * w * p * (1 - p) * x) OVER q AS hab, sum(c * w * p * (1 - p)) OVER q AS hbb
      FROM (SELECT *, 1 / (1 + exp(-(a * x + b))) AS p FROM steps, pts WHERE k < 30) WINDOW q AS (PARTITION BY c))
    GROUP BY c, ga, gb, haa, hab, hbb)
SELECT c, {r('a', 4)} AS slope, {r('b', 4)} AS intercept FROM steps WHERE k = 30""")
