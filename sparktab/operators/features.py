"""Feature engineering: fit a few scalars in one pass, transform by projection.

A fitted model holds a list of named column expressions. ``transform`` is one
narrow projection (two with a scaler), so it needs no shuffle at any size and
also works on a streaming DataFrame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.functions.expressions import EPS, finite_sql, name, num
from sparktab.operators.clean import infer_roles
from sparktab.operators.encode import fit_levels, label_code, onehot_columns
from sparktab.operators.moments import column_moments
from sparktab.operators.ranking import DIRECT_ROWS, exact_quantiles

BLOCKS = ("linear", "quadratic", "logarithmic", "other", "statistical", "categorical")

# Names and formulas of the health ratios, in output order. Each
# one is built only if every column it reads exists.
HEALTH_RATIOS = (
    ("bmi", "try_divide(weight_kg, pow(height_cm / 100, 2))", ("weight_kg", "height_cm")),
    ("bp_mean", "(bp_systolic + bp_diastolic) / 2", ("bp_systolic", "bp_diastolic")),
    ("bp_pulse_pressure", "bp_systolic - bp_diastolic", ("bp_systolic", "bp_diastolic")),
    ("cholesterol_ratio", "try_divide(hdl_cholesterol, ldl_cholesterol + 1e-8D)", ("hdl_cholesterol", "ldl_cholesterol")),
    ("cholesterol_hdl_ratio", "try_divide(total_cholesterol, hdl_cholesterol + 1e-8D)", ("total_cholesterol", "hdl_cholesterol")),
    ("vision_avg", "(vision_left + vision_right) / 2", ("vision_left", "vision_right")),
    ("vision_diff", "abs(vision_left - vision_right)", ("vision_left", "vision_right")),
    ("hearing_avg", "(hearing_left + hearing_right) / 2", ("hearing_left", "hearing_right")),
    ("ast_alt_ratio", "try_divide(ast_enzyme_level, alt_enzyme_level + 1e-8D)", ("ast_enzyme_level", "alt_enzyme_level")),
)


@dataclass(frozen=True)
class Stats:
    """Fitted scalars of one numeric column (missing and infinite values left out)."""

    low: float | None
    high: float | None
    mean: float | None
    std: float | None
    complete: bool = True  # no value was missing or infinite


@dataclass(frozen=True)
class Feature:
    name: str
    block: str
    value: str  # SQL text


def domain_features(df: DataFrame, specs: Sequence[tuple[str, str, Sequence[str]]]) -> list[tuple[str, str]]:
    """Named SQL expressions whose input columns all exist."""
    have = set(df.columns)
    return [(label, sql) for label, sql, needs in specs if set(needs) <= have]


def fit_stats(df: DataFrame, cols: Sequence[str]) -> dict[str, Stats]:
    """min, max, mean and std (n-1) of all columns in one pass."""
    found = column_moments(df, cols)
    return {c: Stats(m.low, m.high, m.mean, m.std(1), m.n == m.rows) for c, m in found.items()}


def _shift(c: str, s: Stats) -> str:
    """The value moved so that the fitted minimum becomes 1."""
    return f"({name(c)} - {num(s.low)} + 1D)"


def _span(c: str, s: Stats) -> str:
    return f"({name(c)} - {num(s.low)}) / {num(s.high - s.low + EPS)}"


def _away(c: str, s: Stats) -> str:
    return f"abs({name(c)} - {num(s.mean)})"


class _Blocks:
    """Collects the features of the selected blocks in order."""

    def __init__(self, chosen: Sequence[str]):
        self.chosen, self.out = set(chosen), []

    def add(self, block: str, label: str, sql: str) -> None:
        if block in self.chosen:
            self.out.append(Feature(label, block, sql))


def wide_features(df: DataFrame, spec: FeatureSpec, numeric: Sequence[str], stats: Mapping[str, Stats]) -> list[Feature]:
    """The blocks of a table with many numeric columns, in block order.

    A conditional feature exists if its condition held when the model was fitted.
    """
    usable = [c for c in numeric if stats[c].low is not None]
    known = set(usable)
    blocks = _Blocks(spec.blocks)
    add = blocks.add
    for c in numeric:
        add("linear", c, name(c))
    for c in numeric:
        add("quadratic", f"{c}_squared", f"{name(c)} * {name(c)}")
    for a, b in combinations(numeric[: spec.max_interact], 2):
        add("quadratic", f"{a}_{b}_interaction", f"{name(a)} * {name(b)}")
    for label, sql in domain_features(df, spec.domain):
        add("quadratic", label, f"double({sql})")
    for c in [c for c in numeric[: spec.max_log] if c in known]:
        add("logarithmic", f"log_{c}", f"log1p({_shift(c, stats[c])})")
        if stats[c].complete:
            add("logarithmic", f"log10_{c}", f"log10({_shift(c, stats[c])})")
    for c in [c for c in numeric[: spec.max_other] if c in known]:
        s, size = stats[c], f"abs({_shift(c, stats[c])})"
        add("other", f"sqrt_{c}", f"sqrt({size})")
        add("other", f"{c}_power_1_5", f"pow({size}, 1.5D)")
        add("other", f"{c}_power_0_5", f"sqrt({size})")
        if s.std:
            add("other", f"exp_{c}_normalized", f"exp(({name(c)} - {num(s.mean)}) / {num(s.std + EPS)} / 3D)")
    for c in usable:
        s = stats[c]
        if s.high > s.low:
            add("statistical", f"{c}_normalized", _span(c, s))
        add("statistical", f"{c}_distance_from_mean", _away(c, s))
        if s.std:
            add("statistical", f"{c}_zscore", f"({name(c)} - {num(s.mean)}) / {num(s.std)}")
    return blocks.out


def pair_features(spec: FeatureSpec, numeric: Sequence[str], stats: Mapping[str, Stats]) -> list[Feature]:
    """The 35 features of a table with two measures, in block order.

    ``spec.short`` gives the names used where a feature is not named after the
    full column.
    """
    a, b = numeric
    sa, sb = spec.short or (a, b)
    x, y = name(a), name(b)
    both = ((a, sa), (b, sb))
    moved = {c: _shift(c, stats[c]) for c in (a, b)}
    blocks = _Blocks(spec.blocks)
    add = blocks.add

    def each(block: str, pattern: str, sql: str) -> None:
        """The same formula for both measures: {x} value, {m} shifted value."""
        for c, s in both:
            add(block, pattern.format(c=c, s=s), sql.format(x=name(c), m=moved[c]))

    each("linear", "{c}", "{x}")
    each("quadratic", "{c}_squared", "{x} * {x}")
    add("quadratic", f"{sa}_{sb}_interaction", f"{x} * {y}")
    add("quadratic", f"{sa}_{sb}_ratio", f"try_divide({x}, {y} + {num(EPS)})")
    add("quadratic", f"{sb}_{sa}_ratio", f"try_divide({y}, {x} + {num(EPS)})")
    add("quadratic", f"{sa}_{sb}_diff", f"{x} - {y}")
    add("quadratic", f"{sa}_{sb}_sum", f"{x} + {y}")
    add("quadratic", f"{sa}_{sb}_abs_diff", f"abs({x} - {y})")
    each("logarithmic", "log_{c}", "log1p({m})")
    each("logarithmic", "log10_{c}", "log10({m})")
    each("logarithmic", "log_{s}_squared", "log1p({m} * {m})")
    add("logarithmic", f"log_{sa}_{sb}_interaction", f"log1p({moved[a]} * {moved[b]})")
    each("other", "sqrt_{c}", "sqrt(abs({m}))")
    each("other", "exp_{s}_normalized", "exp({x} / 100D)")
    for c, s in both:
        add("other", f"sin_{s}", f"sin({name(c)} / 100D)")
        add("other", f"cos_{s}", f"cos({name(c)} / 100D)")
    each("other", "{s}_power_1_5", "pow(abs({m}), 1.5D)")
    each("other", "{s}_power_0_5", "sqrt(abs({m}))")
    each("other", "reciprocal_{s}", "1D / (abs({x}) + " + num(EPS) + ")")
    for c, s in both:
        add("statistical", f"{s}_normalized", _span(c, stats[c]))
    for c, s in both:
        add("statistical", f"{s}_distance_from_mean", _away(c, stats[c]))
    return blocks.out


@dataclass(frozen=True)
class ScalerModel:
    """Centre and scale per column; a constant column maps to 0."""

    centre: dict[str, float]
    scale: dict[str, float]

    def sql(self, c: str) -> str:
        return f"(double({name(c)}) - {num(self.centre[c])}) / {num(self.scale[c])}"

    def value(self, c: str) -> Column:
        return F.expr(self.sql(c))

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.value(c) for c in self.centre if c in df.columns})


def fit_scaler(df: DataFrame, cols: Sequence[str], mode: str | None = "standard", limit: int = DIRECT_ROWS) -> ScalerModel | None:
    """``standard`` (population std), ``minmax`` to [0, 1] or ``robust`` (median, IQR).

    Any other mode means no scaling. Missing and infinite values are left out.
    """
    if mode not in ("standard", "minmax", "robust") or not cols:
        return None
    if mode == "robust":
        found = {r["feature"]: r["q"] for r in exact_quantiles(df, cols, (0.25, 0.5, 0.75), (), limit).collect()}
        pairs = {c: (found[c][1], found[c][2] - found[c][0]) if found.get(c) else (None, None) for c in cols}
    else:
        found = column_moments(df, list(cols))
        if mode == "standard":
            pairs = {c: (m.mean, m.std(0)) for c, m in found.items()}
        else:
            pairs = {c: (m.low, m.high - m.low if m.n else None) for c, m in found.items()}
    return ScalerModel({c: p[0] or 0.0 for c, p in pairs.items()}, {c: p[1] or 1.0 for c, p in pairs.items()})


@dataclass(frozen=True)
class FeatureSpec:
    """What to build. ``layout='pair'`` is the two-measure table, ``'wide'`` any other.

    ``stats_scope='batch'`` refits the statistics on each table it transforms
    (min, max, mean and std of the scored table); the default keeps the fitted ones.
    """

    key: str
    target: str | None = None
    layout: str = "wide"
    blocks: tuple[str, ...] = BLOCKS
    numeric: tuple[str, ...] | None = None
    categorical: tuple[str, ...] | None = None
    short: tuple[str, str] | None = None
    scaler: str | None = "standard"
    encoding: str = "onehot"
    scale_onehot: bool = True
    max_interact: int = 10
    max_log: int = 15
    max_other: int = 10
    domain: tuple = HEALTH_RATIOS
    stats_scope: str = "fit"
    fill: float | None = 0.0

    def fit(self, df: DataFrame) -> FeatureModel:
        skip = [self.key] + ([self.target] if self.target else [])
        found = ([], [])
        if self.numeric is None or self.categorical is None:
            found = infer_roles(df, skip)
        numeric = list(found[0] if self.numeric is None else self.numeric)
        categorical = list(found[1] if self.categorical is None else self.categorical)
        if self.layout == "pair" and len(numeric) != 2:
            raise ValueError("the pair layout needs exactly two numeric columns")
        stats = fit_stats(df, numeric)
        levels = fit_levels(df, categorical) if "categorical" in self.blocks and self.layout == "wide" else {}
        model = FeatureModel(self, tuple(numeric), stats, levels)
        model = replace(model, names=tuple(f.name for f in model.features(df)))
        if self.scaler:
            raw = model.engineered(df)
            model = replace(model, scaler=fit_scaler(raw, model.scaled_names(), self.scaler))
        return model


@dataclass(frozen=True)
class FeatureModel:
    spec: FeatureSpec
    numeric: tuple[str, ...]
    stats: dict[str, Stats]
    levels: dict[str, list[str]]
    names: tuple[str, ...] = ()
    scaler: ScalerModel | None = None

    def features(self, df: DataFrame, stats: Mapping[str, Stats] | None = None) -> list[Feature]:
        stats = stats or self.stats
        if self.spec.layout == "pair":
            return pair_features(self.spec, self.numeric, stats)
        out = wide_features(df, self.spec, self.numeric, stats)
        if self.spec.encoding in ("onehot", "both"):
            out += [Feature(n, "categorical", v) for c, lv in self.levels.items() for n, v in onehot_columns(c, lv)]
        if self.spec.encoding in ("label", "both"):
            out += [Feature(f"{c}_encoded", "categorical", label_code(c, lv)) for c, lv in self.levels.items()]
        return out

    def scaled_names(self) -> list[str]:
        if self.spec.scale_onehot:
            return list(self.names)
        onehot = {f"{c}_{v}" for c, levels in self.levels.items() for v in levels}
        return [n for n in self.names if n not in onehot]

    def _carried(self, df: DataFrame) -> list[str]:
        return [c for c in (self.spec.key, self.spec.target) if c and c in df.columns]

    def engineered(self, df: DataFrame) -> DataFrame:
        """Key, target and the unscaled features; what cannot be computed is NULL.

        The columns are those of the fitted table: one that is missing here is 0.
        """
        fitted = self.features(df)
        have = {f.name: f.value for f in fitted}
        if self.spec.stats_scope == "batch":
            fresh = {f.name: f.value for f in self.features(df, fit_stats(df, self.numeric))}
            # shifts keep the fitted minimum; only these features look at the batch
            scoped = [f.name for f in fitted if f.block == "statistical" or f.name.startswith("exp_")]
            have.update({n: fresh.get(n, "0D") for n in scoped})
        carried = [name(c) for c in self._carried(df)]
        needed = {c for _, _, needs in self.spec.domain for c in needs} | set(self.levels)
        rest = [name(c) for c in df.columns if c in needed - set(self.numeric)]
        inputs = [finite_sql(f"double({name(c)})") + f" AS {name(c)}" for c in self.numeric]
        cols = [f"{have.get(n, '0D')} AS {name(n)}" for n in self.names or have]
        return df.selectExpr(*carried, *rest, *inputs).selectExpr(*carried, *cols)

    def transform(self, df: DataFrame) -> DataFrame:
        """Features scaled with the fitted scaler; what is missing or infinite becomes ``fill``."""
        raw, cols = self.engineered(df), []
        for n in self.names:
            value = self.scaler.sql(n) if self.scaler and n in self.scaler.centre else f"double({name(n)})"
            cols.append((value if self.spec.fill is None else finite_sql(value, num(self.spec.fill))) + f" AS {name(n)}")
        return raw.selectExpr(*[name(c) for c in self._carried(df)], *cols)

    def summary(self, df: DataFrame) -> DataFrame:
        """Position, name and block of every feature."""
        by_name = {f.name: f.block for f in self.features(df)}
        rows = [(i, n, by_name[n]) for i, n in enumerate(self.names, 1)]
        return df.sparkSession.createDataFrame(rows, "ordinal int, feature string, block string")
