"""Quality scores by co-training of a text view and a metadata view.

Two logistic regressions that see different columns start from the same labelled rows. In each round either one labels the rows of an unlabelled pool
that it is sure of, for the other to learn from. Both are then calibrated on labelled rows that neither has learned from, and
a last regression on the two calibrated scores gives the score of a document. Fitting uses bounded hash samples (``Settings``);
scoring covers all rows in one narrow pass.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import small_batches



@dataclass(frozen=True)
class Settings:
    """Bounds of the labelled sample and of the pool in rows, and how co-training runs."""

    labelled: int = 12_000
    pool: int = 8_000
    rounds: int = 3
    sure: float = 0.97
    most_per_class: int = 400
    penalty: float = 1.0


# Classes of bytes whose pairs are counted. Letters above ASCII count as lower-case ones.
CLASSES = np.full(256, 1, dtype=np.int64)
CLASSES[:128] = 15
for _i, _some in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r", b".", b",", b"!?", b"*#$%&@", b"|", b"\"'`", b"()[]{}", b"<>=/\\", b"-_+~^:;", b"\t"), 1):
    CLASSES[list(_some)] = _i
PAIRS = 256
# Log-likelihood on the held rows that two fitted numbers may explain by chance.
NATS = 2.0
SUMMARY = 10
META = 64 + 16 + 4


def text_features(body: bytes) -> np.ndarray:
    """Shares of byte-class pairs, and how much the text repeats itself. Over the whole text."""
    out = np.zeros(PAIRS + SUMMARY, dtype=np.float32)
    if not body:
        return out
    kinds = CLASSES[np.frombuffer(body, np.uint8)]
    if len(kinds) > 1:
        out[:PAIRS] = np.sqrt(np.bincount(kinds[:-1] * 16 + kinds[1:], minlength=PAIRS) / (len(kinds) - 1))
    words = body.lower().split()
    n = max(len(words), 1)
    codes = np.fromiter(map(hash_word, words), np.uint64, len(words))
    threes = codes[2:] * np.uint64(3) + codes[1:-1] * np.uint64(5) + codes[:-2] * np.uint64(7) if len(words) > 2 else codes
    lines = body.split(b"\n")
    distinct = len(np.unique(codes)) / n
    repeats = 1 - len(np.unique(threes)) / max(len(threes), 1)
    out[PAIRS:] = (
        np.log1p(len(body)), np.log1p(n), distinct, distinct * np.log1p(n), repeats, repeats > 0.3,
        1 - len(set(lines)) / len(lines), len(body) / n / 10, np.log1p(len(lines)), max(map(len, words), default=0) > 40,
    )
    return out


def hash_word(word: bytes) -> int:
    return zlib.crc32(word)


def meta_features(lang: str | None, source: str | None, n_chars: float | None) -> np.ndarray:
    """Hashed source and language, and the length that the page's record states."""
    out = np.zeros(META, dtype=np.float32)
    out[zlib.crc32((source or "").encode()) % 64] = 1
    out[64 + zlib.crc32((lang or "").encode()) % 16] = 1
    known = n_chars is not None and n_chars == n_chars
    length = np.log1p(max(float(n_chars), 0.0)) / 10 if known else 0.0
    out[80:] = (length, length * length, not known, source is None)
    return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def log_loss(p: np.ndarray, y: np.ndarray) -> float:
    """Mean log-loss of the chances ``p`` of label 1."""
    p = np.clip(p, 1e-9, 1 - 1e-9)
    return float(-np.mean(np.where(y > 0, np.log(p), np.log1p(-p))))


class Regression:
    """L2 logistic regression on standardised columns by Newton steps with a line search."""

    def __init__(self, penalty: float):
        self.penalty, self.w = penalty, None

    def _x(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.clip((x - self.mean) / self.scale, -8, 8), np.ones((len(x), 1))])

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 100) -> Regression:
        """From zero to the optimum: steps are halved until the objective falls."""
        x = x.astype(np.float64)
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        a, w = self._x(x), np.zeros(x.shape[1] + 1)
        ridge = np.full(a.shape[1], self.penalty)
        ridge[-1] = 1e-6

        def objective(v: np.ndarray) -> float:
            z = a @ v
            return float(np.sum(np.logaddexp(0, z) - y * z) + 0.5 * np.sum(ridge * v * v))

        now = objective(w)
        for _ in range(steps):
            p = sigmoid(a @ w)
            step = np.linalg.solve((a * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ a + np.diag(ridge), a.T @ (y - p) - ridge * w)
            size = 1.0
            while (after := objective(w + size * step)) > now and size > 1e-6:
                size /= 2
            if after > now:
                break
            w, gain, now = w + size * step, now - after, after
            if gain < 1e-9:
                break
        self.w = w
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self._x(x.astype(np.float64)) @ self.w


def calibrated(raw: np.ndarray, line: np.ndarray) -> np.ndarray:
    return sigmoid(line[0] * raw + line[1])


def platt(raw: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope and offset that turn raw scores into probabilities; targets drawn in a little.

    Scores that would count against themselves say nothing: their slope is zero.
    """
    high, low = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    target = np.where(y > 0, high, low)
    a, w = np.stack([raw, np.ones(len(raw))], axis=1), np.array([1.0, 0.0])
    for _ in range(30):
        p = sigmoid(a @ w)
        h = (a * np.maximum(p * (1 - p), 1e-9)[:, None]).T @ a + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, a.T @ (target - p))
        w = w + step * min(1.0, 2 / (np.abs(step).max() + 1e-12))
    return w if w[0] > 0 else np.array([0.0, logit(target.mean())])


@dataclass
class Model:
    """Two calibrated views and their combination. ``prior`` alone if the labels hold one class or none."""

    prior: float
    views: tuple | None = None
    lines: tuple | None = None
    blend: np.ndarray | None = None
    added: tuple = (0, 0)

    def scores(self, text: np.ndarray, meta: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if self.views is None:
            same = np.full(len(text), self.prior)
            return same, same, same
        p, q = (calibrated(v.raw(x), line) for v, x, line in zip(self.views, (text, meta), self.lines, strict=True))
        return p, q, sigmoid(np.stack([logit(p), logit(q), np.ones(len(p))], axis=1) @ self.blend)


def in_mix(rows: list[np.ndarray], share: float) -> list[np.ndarray]:
    """The first rows of either class (0, 1), as many as keep label 1 at ``share`` of them."""
    least = min(len(rows[0]) / (1 - share), len(rows[1]) / share)
    return [rows[0][: int(least * (1 - share) + 1e-9)], rows[1][: int(least * share + 1e-9)]]


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, held: np.ndarray, pool: tuple[np.ndarray, np.ndarray], s: Settings) -> Model:
    """``y``: labels; ``held``: rows kept for calibration. ``pool``: both views of unlabelled rows.

    In each round a view hands its surest rows of the pool, in the labels' mix of classes, to the other one. Only a view that tells something about the held rows may teach
    (its likelihood beats the labels' share by more than its two calibration parameters explain), and a view keeps what it learned only if its likelihood of the held rows did not fall
    by more than that below its best.
    """
    prior = (y.sum() + 1) / (len(y) + 2)
    if len(np.unique(y[~held])) < 2 or len(np.unique(y[held])) < 2:
        return Model(float(prior))
    inputs, seen = (text, meta), y[held]
    data = [[x[~held], y[~held].astype(float)] for x in inputs]
    share = float(y[~held].mean())
    none = log_loss(np.full(len(seen), seen.mean()), seen)

    def judged(view: Regression, k: int) -> tuple[np.ndarray, float]:
        raw = view.raw(inputs[k][held])
        line = platt(raw, seen)
        return line, log_loss(calibrated(raw, line), seen)

    views = [Regression(s.penalty).fit(*d) for d in data]
    lines, losses = map(list, zip(*(judged(v, k) for k, v in enumerate(views)), strict=True))
    best, free, added = list(losses), np.ones(len(pool[0]), dtype=bool), [0, 0]
    for _ in range(s.rounds):
        news = []
        for k in (0, 1):
            if len(seen) * (none - losses[k]) <= NATS:
                continue
            p = calibrated(views[k].raw(pool[k]), lines[k])
            sure = []
            for chance in (1 - p, p):
                rows = np.flatnonzero(free & (chance >= s.sure))
                sure.append(rows[np.argsort(-chance[rows], kind="stable")][: s.most_per_class])
            news.append((1 - k, in_mix(sure, share)))
        for k, rows in news:
            some = np.concatenate(rows)
            if not len(some):
                continue
            more = [np.vstack([data[k][0], pool[k][some]]), np.concatenate([data[k][1], np.zeros(len(rows[0])), np.ones(len(rows[1]))])]
            view = Regression(s.penalty).fit(*more)
            line, loss = judged(view, k)
            if len(seen) * (loss - best[k]) <= NATS:
                data[k], views[k], lines[k], losses[k] = more, view, line, loss
                best[k] = min(best[k], loss)
                added[k] += len(some)
            free[some] = False
        if not any(len(r) for _, rows in news for r in rows):
            break
    p, q = (calibrated(v.raw(x[held]), line) for v, x, line in zip(views, inputs, lines, strict=True))
    return Model(float(prior), tuple(views), tuple(lines), blended(np.stack([logit(p), logit(q)], axis=1), seen), tuple(added))


def blended(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the two scores and an offset, drawn to (1, 0, 0). A view that would count against itself is left out."""
    start = np.array([1.0, 0.0, 0.0])
    a, w = np.hstack([x, np.ones((len(x), 1))]), start
    for _ in range(20):
        z = sigmoid(a @ w)
        w = w + np.linalg.solve((a * np.maximum(z * (1 - z), 1e-9)[:, None]).T @ a + np.eye(3), a.T @ (y - z) - (w - start))
    return blended(x * (w[:2] > 0), y) * np.append(w[:2] > 0, True) if (w[:2] < 0).any() and (w[:2] > 0).any() else w


def _frames(text: pd.Series, lang: pd.Series, source: pd.Series, n_chars: pd.Series) -> tuple[np.ndarray, np.ndarray]:
    a = np.stack([text_features(b if b is not None else b"") for b in text]) if len(text) else np.zeros((0, PAIRS + SUMMARY))
    b = [meta_features(g if isinstance(g, str) else None, s if isinstance(s, str) else None, n) for g, s, n in zip(lang, source, n_chars, strict=True)]
    return a, np.stack(b) if b else np.zeros((0, META))


def _inputs(df: DataFrame, text: str = "text", meta: tuple[str, str, str] = ("lang", "source", "n_chars")) -> list[Column]:
    return [df[text].cast("binary"), df[meta[0]].cast("string"), df[meta[1]].cast("string"), df[meta[2]].cast("double")]


def fit_quality(df: DataFrame, labels: DataFrame, settings: Settings | None = None, key: str = "doc_id", text: str = "text", label: str = "quality", meta: tuple[str, str, str] = ("lang", "source", "n_chars")) -> Model:
    """Fit on at most about ``settings.labelled`` labelled rows and ``settings.pool`` others, chosen by hashes of the key.

    A key with several labels counts as 0 if any of them is 0; null labels and keys are left out. The chosen labels (a bounded number) are broadcast to the
    documents, so that these need not be shuffled.
    """
    s = settings or Settings()
    small_batches(df)
    known = labels.where(labels[key].isNotNull() & labels[label].isNotNull()).groupBy(labels[key].alias("key")).agg(F.min(labels[label].cast("int")).alias("y"))
    share = lambda bound, n: int(min(1.0, bound / max(n, 1)) * (1 << 30))
    rank = lambda c, salt: F.pmod(F.xxhash64(c, F.lit(salt)), F.lit(1 << 30))
    # only what is needed, under own names: other columns of the documents may be called anything
    base = df.select(df[key].alias("key"), df[text].alias("text"), *[df[c].alias(n) for c, n in zip(meta, ("lang", "source", "n_chars"), strict=True)])
    counted = known.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    chosen = known.where(rank(F.col("key"), "labelled") < share(s.labelled, counted))

    @F.pandas_udf("struct<text: binary, meta: binary>")
    def packed(t: pd.Series, g: pd.Series, o: pd.Series, n: pd.Series) -> pd.DataFrame:
        a, b = _frames(t, g, o, n)
        return pd.DataFrame({"text": [r.tobytes() for r in a], "meta": [r.tobytes() for r in b]})

    x = packed(*_inputs(base)).alias("x")
    # one row for each key, so that a key of very many rows does not fill the sample
    one = lambda d, *by: d.groupBy(*by).agg(F.min("x").alias("x"))
    both = one(base.join(F.broadcast(chosen), "key").select("key", "y", x), "key", "y")
    others = base.where(rank(F.col("key"), "pool") < share(s.pool, base.count())).join(F.broadcast(chosen.select("key")), "key", "left_anti")
    rows = sorted(both.collect(), key=lambda r: (r["key"], bytes(r["x"]["text"])))
    free = sorted((r["x"] for r in one(others.select("key", x), "key").collect()), key=lambda r: bytes(r["text"]))
    matrix = lambda xs, name, width: np.frombuffer(b"".join(bytes(x[name]) for x in xs), np.float32).reshape(-1, width)
    features = [r["x"] for r in rows]
    held = np.array([zlib.crc32(str(r["key"]).encode()) % 5 == 0 for r in rows], dtype=bool)
    y = np.array([r["y"] for r in rows], dtype=np.int64)
    return co_train(matrix(features, "text", PAIRS + SUMMARY), matrix(features, "meta", META), y, held, (matrix(free, "text", PAIRS + SUMMARY), matrix(free, "meta", META)), s)


def quality_scores(df: DataFrame, model: Model, text: str = "text", meta: tuple[str, str, str] = ("lang", "source", "n_chars")) -> Column:
    """A struct of ``text_score, meta_score, score`` for each row of ``df``: chance of label 1 by either view and by both.

    Null texts and metadata are allowed (null text: as empty); repeated rows score alike.
    """
    small_batches(df)
    held = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<text_score: double, meta_score: double, score: double>")
    def scored(t: pd.Series, g: pd.Series, o: pd.Series, n: pd.Series) -> pd.DataFrame:
        p, q, z = held.value.scores(*_frames(t, g, o, n))
        return pd.DataFrame({"text_score": p, "meta_score": q, "score": z})

    return scored(*_inputs(df, text, meta))


def score_quality(df: DataFrame, labels: DataFrame, settings: Settings | None = None, threshold: float = 0.5, key: str = "doc_id") -> DataFrame:
    """``key, text_score, meta_score, score, keep`` for every row; keep if the score reaches the threshold.

    Without labels of both classes all rows get the share of label 1 (one half without any) and the result keeps them.
    Other columns are ignored; an empty table gives no rows.
    """
    model = fit_quality(df, labels, settings, key)
    out = df.select(df[key], quality_scores(df, model).alias("s"))
    sure = F.lit(model.views is None)
    return out.select(key, "s.text_score", "s.meta_score", "s.score", (sure | (F.col("s.score") >= threshold)).alias("keep"))


def keep_quality(df: DataFrame, labels: DataFrame, settings: Settings | None = None, threshold: float = 0.5, key: str = "doc_id") -> DataFrame:
    """The rows of ``df``, all columns, that ``score_quality`` keeps."""
    model = fit_quality(df, labels, settings, key)
    return df if model.views is None else df.where(quality_scores(df, model)["score"] >= threshold)
