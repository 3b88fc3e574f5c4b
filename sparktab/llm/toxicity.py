"""Toxicity: a bidirectional gated recurrent network with attention pooling over words and their characters.

A word enters as the embedding of the word and the mean embedding of its character n-grams (both hashed). Windows of words are read in both
directions, pooled by attention and scored; a document's score comes from its highest window. The network is
trained in numpy on a bounded hash sample of labelled rows; all windows of all documents are scored, in Arrow batches.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import pa_type, rows_of, texts


@dataclass(frozen=True)
class Settings:
    """Sizes of the network, windows, and the bounds of the training sample (rows of either class, windows of a row)."""

    window: int = 32
    stride: int = 24
    hidden: int = 12
    word_width: int = 12
    char_width: int = 16
    attention: int = 8
    hash_bits: int = 14
    toxic_rows: int = 1_000
    other_rows: int = 2_000
    row_windows: int = 48
    epochs: int = 7
    batch: int = 48
    bag: int = 6
    rate: float = 0.01
    seed: int = 1


EDGES = b".,;:!?*#$%&|\"'()[]{}<>~`^_=+-/\\"
LONGEST = 64
# Words whose gate inputs a worker remembers.
MEMO_WORDS = 150_000
_LONG = re.compile(rb"(?s).{1,%d}" % LONGEST)


def words_of(body: bytes) -> list[bytes]:
    """Lower-cased words; runs of over 64 bytes in pieces."""
    found = body.decode("utf-8", "replace").lower().encode().split()
    if found and max(map(len, found)) > LONGEST:
        found = [p for w in found for p in (_LONG.findall(w) if len(w) > LONGEST else (w,))]
    return found


def starts_of(n: int, window: int, stride: int) -> list[int]:
    """First words of overlapping windows that cover all n words."""
    last = max(n - window, 0)
    return [*range(0, last, stride), last]


def features(words: list[bytes], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed word of each word, hashed n-grams (3 to 5 bytes, with ends) of all, and where each word's begin."""
    bare = [w.strip(EDGES) or w for w in words]
    mask = (1 << bits) - 1
    word = np.fromiter(map(zlib.crc32, bare), np.int64, len(bare)) & mask
    line = np.frombuffer(b"".join(b"<" + w + b">" for w in bare), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, bare), np.int64, len(bare)) + 2
    ends = np.repeat(np.cumsum(sizes), sizes)
    place = np.arange(len(line))
    owner = np.repeat(np.arange(len(bare)), sizes)
    grams, owners = [], []
    code = line.copy()
    for n in range(2, 6):
        code = code[: len(line) - n + 1] * np.uint64(0x100000001B3) ^ line[n - 1 :]
        if n >= 3:
            ok = place[: len(code)] + n <= ends[: len(code)]
            grams.append(((code[ok] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64))
            owners.append(owner[: len(code)][ok])
    gram, whose = np.concatenate(grams), np.concatenate(owners)
    order = np.argsort(whose, kind="stable")
    return word, gram[order], np.searchsorted(whose[order], np.arange(len(bare)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


@dataclass
class Network:
    s: Settings
    p: dict[str, np.ndarray] = field(default_factory=dict)
    line: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.0, 0.0]))

    @classmethod
    def fresh(cls, s: Settings) -> Network:
        g = np.random.default_rng(s.seed)
        h, d = s.hidden, s.word_width + s.char_width
        draw = lambda *shape, scale: (g.standard_normal(shape) * scale).astype(np.float32)
        p = {"word": draw(1 << s.hash_bits, s.word_width, scale=0.1), "char": draw(1 << s.hash_bits, s.char_width, scale=0.3)}
        for way in ("f", "b"):
            p |= {f"x{way}": draw(d, 3 * h, scale=1 / np.sqrt(d)), f"c{way}": np.zeros(3 * h, np.float32), f"u{way}": draw(h, 3 * h, scale=1 / np.sqrt(h))}
        p |= {"aw": draw(2 * h, s.attention, scale=1 / np.sqrt(2 * h)), "ab": np.zeros(s.attention, np.float32), "av": draw(s.attention, scale=1.0), "o": draw(2 * h, scale=0.5), "ob": np.full(1, -1.0, np.float32)}
        return cls(s, p)

    def inputs(self, words: list[bytes]) -> tuple[np.ndarray, tuple]:
        """Vectors of the words: own embedding, mean of the n-grams."""
        word, gram, first = features(words, self.s.hash_bits)
        number = np.diff(np.append(first, len(gram)))
        mean = np.add.reduceat(self.p["char"][gram], first, axis=0) / number[:, None]
        return np.hstack([self.p["word"][word], mean]).astype(np.float32), (word, gram, number)

    def gates(self, x: np.ndarray, way: str) -> np.ndarray:
        return x @ self.p[f"x{way}"] + self.p[f"c{way}"]

    def run(self, table: dict[str, np.ndarray], ids: np.ndarray, keep: bool = False) -> tuple[np.ndarray, dict | None]:
        """States of both directions for windows of rows of ``table`` (gate inputs; the last row is padding): n, window, 2 h."""
        n, t_all = ids.shape
        h = self.s.hidden
        out = np.empty((t_all, n, 2 * h), np.float32)
        kept: dict = {}
        for k, way in enumerate(("f", "b")):
            u, gate, state = self.p[f"u{way}"], table[way], np.zeros((n, h), np.float32)
            kept[way] = []
            for t in range(t_all) if way == "f" else range(t_all - 1, -1, -1):
                x = gate[ids[:, t]]
                own = state @ u
                zr = x[:, : 2 * h] + own[:, : 2 * h]
                zr *= 0.5
                np.tanh(zr, out=zr)
                zr += 1
                zr *= 0.5
                z, r = zr[:, :h], zr[:, h:]
                new = np.tanh(x[:, 2 * h :] + r * own[:, 2 * h :])
                before = state
                state = new + z * (state - new)
                out[t, :, k * h : (k + 1) * h] = state
                if keep:
                    kept[way].append((t, before, z, r, new, own[:, 2 * h :]))
        return out, kept if keep else None

    def pooled(self, states: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Logit of each window. ``real``: window, n; padding gets no attention (all of it if there is nothing else)."""
        q = np.tanh(states @ self.p["aw"] + self.p["ab"])
        e = q @ self.p["av"]
        e = np.where(real | ~real.any(axis=0), e, -1e9)
        a = np.exp(e - e.max(axis=0))
        a /= a.sum(axis=0)
        c = np.einsum("tn,tnh->nh", a, states)
        return c @ self.p["o"] + self.p["ob"][0], (q, a, c)

    def logits(self, table: dict[str, np.ndarray], ids: np.ndarray) -> np.ndarray:
        states, _ = self.run(table, ids)
        return self.pooled(states, ids.T != len(table["f"]) - 1)[0]

    def gradients(self, words: list[bytes], ids: np.ndarray, weight) -> tuple[np.ndarray, dict[str, np.ndarray]]:  # noqa: ANN001
        """Logits, and the gradient of a loss whose derivative by the logits is ``weight(logits)``."""
        p, h, g = self.p, self.s.hidden, {}
        x, (word, gram, number) = self.inputs(words)
        zero = np.zeros((1, x.shape[1]), np.float32)
        full = np.vstack([x, zero])
        table = {w: self.gates(full, w) for w in "fb"}
        states, kept = self.run(table, ids, keep=True)
        real = ids.T != len(words)
        logit, (q, a, c) = self.pooled(states, real)
        d = np.asarray(weight(logit), np.float32)
        g["o"], g["ob"] = c.T @ d, d.sum(keepdims=True)
        dc = d[:, None] * p["o"]
        da = np.einsum("nh,tnh->tn", dc, states)
        de = a * (da - (a * da).sum(axis=0))
        dq = de[:, :, None] * p["av"] * (1 - q * q)
        g["av"] = np.einsum("tn,tna->a", de, q)
        g["ab"] = dq.sum(axis=(0, 1))
        g["aw"] = np.einsum("tnh,tna->ha", states, dq, optimize=True)
        ds = a[:, :, None] * dc + dq @ p["aw"].T
        dx_all = np.zeros_like(full)
        for k, way in enumerate("fb"):
            u, dh, du = p[f"u{way}"], np.zeros((ids.shape[0], h), np.float32), 0
            dgate = np.zeros((ids.shape[1], ids.shape[0], 3 * h), np.float32)
            for t, before, z, r, new, own_n in reversed(kept[way]):
                dh = dh + ds[t, :, k * h : (k + 1) * h]
                dn = dh * (1 - z) * (1 - new * new)
                dz = dh * (before - new) * z * (1 - z)
                dr = dn * own_n * r * (1 - r)
                dgate[t] = np.hstack([dz, dr, dn])
                down = np.hstack([dz, dr, dn * r])
                du = du + before.T @ down
                dh = dh * z + down @ u.T
            flat = np.stack([np.bincount(ids.T.ravel(), weights=dgate[:, :, i].ravel(), minlength=len(full)) for i in range(3 * h)], axis=1).astype(np.float32)
            g[f"u{way}"], g[f"c{way}"], g[f"x{way}"] = du, flat.sum(axis=0), full.T @ flat
            dx_all += flat @ p[f"x{way}"].T
        dx, size = dx_all[:-1], 1 << self.s.hash_bits
        ww = self.s.word_width
        g["word"] = np.stack([np.bincount(word, weights=dx[:, i], minlength=size) for i in range(ww)], axis=1).astype(np.float32)
        share = dx[:, ww:] / number[:, None]
        spread = np.repeat(np.arange(len(words)), number)
        g["char"] = np.stack([np.bincount(gram, weights=share[spread, i], minlength=size) for i in range(share.shape[1])], axis=1).astype(np.float32)
        return logit, g


def indexed(windows: list[list[bytes]], width: int) -> tuple[list[bytes], np.ndarray]:
    """Distinct words and the windows as their numbers; padding is the number after the last."""
    words = sorted(set().union(*windows)) or [b"<>"]
    at = {w: i for i, w in enumerate(words)}
    ids = np.full((len(windows), width), len(words), dtype=np.int64)
    for row, ws in zip(ids, windows, strict=True):
        row[: len(ws)] = [at[w] for w in ws]
    return words, ids


def train(rows: list[tuple[list[list[bytes]], int]], s: Settings) -> Network:
    """``rows``: windows of a document and its label. Documents are bags of windows, joined by log-sum-exp."""
    net = Network.fresh(s)
    g = np.random.default_rng(s.seed)
    y = np.array([label for _, label in rows], dtype=np.float32)
    if len(set(y.tolist())) < 2:
        rate = float(np.clip(y.mean() if len(y) else 0.0, 0.01, 0.99))
        net.line = np.array([0.0, 0.0, np.log(rate / (1 - rate))])
        return net
    held = g.random(len(rows)) < 0.15
    seen = [np.zeros(len(w), np.float32) for w, _ in rows]
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    step, own = 0, np.flatnonzero(~held)
    for epoch in range(s.epochs):
        order = g.permutation(own)
        for at in range(0, len(order), s.batch):
            part = order[at : at + s.batch]
            picks = []
            for i in part:
                n = len(seen[i])
                top = np.argsort(-seen[i], kind="stable")[: s.bag // 2] if epoch else np.zeros(0, np.int64)
                picks.append(np.unique(np.concatenate([top, g.choice(n, min(n, s.bag - len(top)), replace=False)])).astype(np.int64))
            bag = np.repeat(np.arange(len(part)), [len(k) for k in picks])
            words, ids = indexed([rows[i][0][j] for i, ks in zip(part, picks, strict=True) for j in ks], s.window)

            def weight(logit: np.ndarray) -> np.ndarray:
                top = np.full(len(part), -np.inf)  # noqa: B023
                np.maximum.at(top, bag, logit)  # noqa: B023
                e = np.exp(logit - top[bag])  # noqa: B023
                total = np.bincount(bag, weights=e)  # noqa: B023
                label = y[part]  # noqa: B023
                return (e / total[bag] * ((sigmoid(top + np.log(total)) - label) * np.where(label > 0, 2.0, 1.0) / len(part))[bag])  # noqa: B023

            logit, grads = net.gradients(words, ids, weight)
            for (i, k), value in zip([(i, k) for i, ks in zip(part, picks, strict=True) for k in ks], logit, strict=True):
                seen[i][k] = value
            step += 1
            rate = s.rate * min(1.0, step / 20) * (1 - 0.8 * epoch / s.epochs)
            norm = np.sqrt(sum(float((x.astype(np.float64) ** 2).sum()) for x in grads.values()))
            for k, grad in grads.items():
                grad = grad * min(1.0, 5.0 / (norm + 1e-9))
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.99 * v[k] + 0.01 * grad * grad
                net.p[k] = (net.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    scored = Scorer(net)
    both = np.flatnonzero(held) if len(set(y[held].tolist())) == 2 else np.arange(len(rows))
    top = np.array([scored.windows(rows[i][0]).max() for i in both])
    number = np.log([len(rows[i][0]) for i in both])
    net.line = fitted_line(np.stack([top, number, np.ones(len(both))], axis=1), y[both].astype(np.float64))
    return net


def fitted_line(a: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic calibration of the highest logit and the number of windows; drawn to the logit itself."""
    start = np.array([1.0, 0.0, 0.0])
    w = start
    for _ in range(30):
        z = sigmoid(a @ w)
        step = np.linalg.solve((a * np.maximum(z * (1 - z), 1e-6)[:, None]).T @ a + np.diag([1.0, 5.0, 0.5]), a.T @ (y - z) - np.array([1.0, 5.0, 0.5]) * (w - start))
        w = w + step * min(1.0, 2 / (np.abs(step).max() + 1e-12))
    return w


class Scorer:
    """Scores documents; remembers the gate inputs of words."""

    def __init__(self, net: Network):
        self.net = net
        self._empty()

    def _empty(self) -> None:
        self.at: dict[bytes, int] = {}
        width = 3 * self.net.s.hidden
        self.table = {w: np.zeros((1024, width), np.float32) for w in "fb"}

    def _learn(self, words: set[bytes]) -> None:
        new = [w for w in words if w not in self.at]
        if not new:
            return
        if len(self.at) > MEMO_WORDS:
            self._empty()
            new = list(words)
        first = len(self.at)
        need = first + len(new) + 1
        for way in "fb":
            if need > len(self.table[way]):
                self.table[way] = np.vstack([self.table[way], np.zeros((max(need, 2 * len(self.table[way])) - len(self.table[way]), self.table[way].shape[1]), np.float32)])
        for s in range(0, len(new), 20_000):
            x, _ = self.net.inputs(new[s : s + 20_000])
            for way in "fb":
                self.table[way][first + s : first + s + len(x)] = self.net.gates(x, way)
        self.at.update(zip(new, range(first, first + len(new)), strict=True))
        for way in "fb":
            self.table[way][len(self.at)] = self.net.p[f"c{way}"]

    def windows(self, windows: list[list[bytes]]) -> np.ndarray:
        words = set().union(*windows)
        self._learn(words or {b"<>"})
        ids = np.full((len(windows), self.net.s.window), len(self.at), np.int64)
        for row, ws in zip(ids, windows, strict=True):
            row[: len(ws)] = [self.at[w] for w in ws]
        return self._logits(ids)

    def _logits(self, ids: np.ndarray) -> np.ndarray:
        table = {w: self.table[w][: len(self.at) + 1] for w in "fb"}
        return np.concatenate([self.net.logits(table, ids[k : k + 2048]) for k in range(0, len(ids), 2048)])

    def documents(self, bodies: list[bytes]) -> np.ndarray:
        """Calibrated scores from the highest of all windows of each document."""
        s, lists = self.net.s, [words_of(b) for b in bodies]
        self._learn(set().union(*lists) or {b"<>"})
        get, pad = self.at.__getitem__, len(self.at)
        ids, owner = [], []
        for k, ws in enumerate(lists):
            own = np.fromiter(map(get, ws), np.int64, len(ws))
            if len(own) < s.window:
                own = np.append(own, np.full(s.window - len(own), pad))
            starts = np.array(starts_of(len(own), s.window, s.stride))
            ids.append(own[starts[:, None] + np.arange(s.window)])
            owner.append(len(starts))
        logit = self._logits(np.concatenate(ids))
        first = np.concatenate([[0], np.cumsum(owner)[:-1]])
        top = np.maximum.reduceat(logit, first)
        return sigmoid(self.net.line[0] * top + self.net.line[1] * np.log(owner) + self.net.line[2])


def fit_toxicity(df: DataFrame, labels: DataFrame, settings: Settings | None = None, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Network:
    """Train on labelled rows whose crc32 of the key as text is not divisible by 5.

    At most about ``toxic_rows`` and ``other_rows`` of them are chosen by hashes of the key, and of each at most ``row_windows`` windows, by hashes too. A key with several labels counts as toxic
    if any of them says so; null labels and keys are left out.
    """
    s = settings or Settings()
    known = labels.where(labels[key].isNotNull() & labels[label].isNotNull() & ~is_held_out(labels[key])).groupBy(labels[key].alias("k")).agg(F.max(labels[label].cast("int")).alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {y: int(min(1.0, bound / max(counts.get(y, 0), 1)) * (1 << 30)) for y, bound in ((1, s.toxic_rows), (0, s.other_rows))}
    limit = F.when(F.col("y") == 1, F.lit(share[1])).otherwise(F.lit(share[0]))
    chosen = F.broadcast(known.where(F.pmod(F.xxhash64(F.col("k"), F.lit("toxicity")), F.lit(1 << 30)) < limit))

    def cut_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, bodies in rows_of(batches):
            out = []
            for k, b in zip(keys, bodies, strict=True):
                ws = words_of(b)
                starts = sorted(starts_of(len(ws), s.window, s.stride), key=lambda a, k=k: zlib.crc32(f"{k}/{a}".encode()))[: s.row_windows]
                out.append([b" ".join(ws[a : a + s.window]) for a in sorted(starts)])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa_type(kind)), pa.array(out, pa.list_(pa.binary()))], ["key", "windows"])

    kind = df.schema[key].dataType.simpleString()
    own = texts(df.join(chosen, df[key] == chosen["k"], "left_semi"), key, text).mapInArrow(cut_windows, f"key {kind}, windows array<binary>")
    found = own.join(chosen, F.col("key") == F.col("k")).groupBy("key", "y").agg(F.min("windows").alias("windows")).collect()  # one row for each key
    found.sort(key=lambda r: (r["key"], [bytes(w) for w in r["windows"]]))
    return train([([bytes(w).split(b" ") if w else [] for w in r["windows"]], r["y"]) for r in found], s)


def is_held_out(key):  # noqa: ANN001, ANN201
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


def score_toxicity(df: DataFrame, labels: DataFrame, settings: Settings | None = None, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """``key, held_out, score, predicted`` for every row, from its text alone.

    All overlapping windows of the whole text are scored. Null and empty texts are scored as one empty window; repeated rows alike; a null
    key is not held out. Without labels of both classes every score is the share of label 1 (at least 0.01). Other columns are
    ignored; an empty table gives no rows.
    """
    kind = df.schema[key].dataType.simpleString()
    held = df.sparkSession.sparkContext.broadcast(fit_toxicity(df, labels, settings, key, text, label))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(held.value)
        for keys, bodies in rows_of(batches):
            scores = scorer.documents(bodies)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa_type(kind)), pa.array(scores.astype(np.float64))], ["key", "score"])

    out = texts(df, key, text).mapInArrow(scan, f"key {kind}, score double")
    held_out = F.coalesce(is_held_out(F.col("key")), F.lit(False))
    return out.select(F.col("key").alias(key), held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
