"""Multi-layer perceptron by data-parallel mini-batch SGD.

Every epoch each partition starts from the shared weights, runs mini-batches
over its own rows, and the results are averaged by row count (parameter
averaging, Zinkevich et al. 2010). The average is computed by a distributed
aggregation over weight positions: only one set of weights reaches the driver,
however many partitions there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.functions.expressions import best_index, hash60, vector_of
from sparktab.operators.metrics import scores_of
from sparktab.operators.split import per_class, weight_table
from sparktab.session import cached

CLIP = 1e-15  # fixed value: probabilities are clipped by this much before the log


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def initial_weights(sizes: Sequence[int], activation: str, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """He scale for ReLU layers, Xavier scale for sigmoid layers, zero biases."""
    rng = np.random.default_rng(seed)
    gain = 2.0 if activation == "relu" else 1.0
    return [(rng.normal(scale=math.sqrt(gain / a), size=(a, b)), np.zeros(b)) for a, b in zip(sizes, sizes[1:])]


def flatten(weights) -> np.ndarray:
    return np.concatenate([part.ravel() for layer in weights for part in layer])


def unflatten(flat: np.ndarray, sizes: Sequence[int]):
    out, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        w, at = flat[at : at + a * b].reshape(a, b), at + a * b
        out.append((w, flat[at : at + b]))
        at += b
    return out


def forward(x: np.ndarray, weights, activation: str, drop: float = 0.0, rng=None):
    """Class scores in [0, 1] and what the backward step needs."""
    steps = []
    for i, (w, b) in enumerate(weights):
        z = x @ w + b
        if i == len(weights) - 1:
            steps.append((x, z, None))
            break
        a = np.maximum(z, 0.0) if activation == "relu" else _sigmoid(z)
        mask = None
        if drop > 0 and rng is not None:
            mask = (rng.random(a.shape) > drop) / (1.0 - drop)
            a = a * mask
        steps.append((x, z, mask))
        x = a
    if z.shape[1] == 1:
        return _sigmoid(z), steps
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True), steps


def one_hot(y: np.ndarray, outputs: int) -> np.ndarray:
    return y.reshape(-1, 1).astype("float64") if outputs == 1 else np.eye(outputs)[y.astype(int)]


def batch_loss(out: np.ndarray, target: np.ndarray, w: np.ndarray) -> float:
    q = np.clip(out, CLIP, 1.0 - CLIP)
    rows = (target * np.log(q)).sum(1)
    if out.shape[1] == 1:
        rows = rows + ((1.0 - target) * np.log(1.0 - q)).sum(1)
    return float(-(w * rows).mean())


def backward(out, target, w, steps, weights, activation):
    """Gradients of the weighted mean log-loss."""
    n = len(out)
    dz = (out - target) * w.reshape(-1, 1)
    grads = [None] * len(weights)
    for i in range(len(weights) - 1, -1, -1):
        x, _, _ = steps[i]
        grads[i] = (x.T @ dz / n, dz.sum(0) / n)
        if i:
            _, z, mask = steps[i - 1]
            slope = (z > 0).astype("float64") if activation == "relu" else _sigmoid(z) * (1.0 - _sigmoid(z))
            dz = dz @ weights[i][0].T * slope
            if mask is not None:
                dz = dz * mask
    return grads


@dataclass
class MLPModel:
    features: tuple[str, ...]
    sizes: list[int]
    weights: list
    activation: str
    classes: int
    history: list[dict] = field(default_factory=list)

    def probabilities(self, df: DataFrame) -> DataFrame:
        weights, activation = self.weights, self.activation

        @F.pandas_udf("array<double>")
        def score(x: pd.Series) -> pd.Series:
            out, _ = forward(np.array(x.tolist(), dtype="float64").reshape(len(x), -1), weights, activation)
            return pd.Series(list(np.hstack([1.0 - out, out]) if out.shape[1] == 1 else out))

        return df.withColumn("probability", score(vector_of(self.features)))

    def transform(self, df: DataFrame) -> DataFrame:
        """Strictly above one half is class 1; several classes take the largest share."""
        p = F.col("probability")
        pick = (p[1] > 0.5).cast("int") if self.classes == 2 else best_index(p)
        return self.probabilities(df).select(*df.columns, pick.alias("prediction"), "probability")

    def history_frame(self, spark) -> DataFrame:
        names = ("epoch", "train_loss", "val_loss", "val_accuracy", "val_f1", "lr")
        schema = "epoch int, train_loss double, val_loss double, val_accuracy double, val_f1 double, lr double"
        return spark.createDataFrame([tuple(h.get(n) for n in names) for h in self.history], schema)


def whole_shards(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame]]:
    """Frames sorted by ``shard``, put together again shard by shard; one shard is held at a time."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        for shard, rows in frame.groupby("shard", sort=False):
            if held and held[0]["shard"].iloc[0] != shard:
                yield int(held[0]["shard"].iloc[0]), pd.concat(held)
                held = []
            held.append(rows)
    if held:
        yield int(held[0]["shard"].iloc[0]), pd.concat(held)


@dataclass(frozen=True)
class MLP:
    features: tuple[str, ...]
    label: str
    key: str
    hidden: tuple[int, ...] = (128, 64)
    lr: float = 0.002
    dropout: float = 0.2
    activation: str = "relu"
    epochs: int = 50
    batch: int = 512
    decay: float = 0.95
    patience: int = 8
    weighting: str | None = "balanced"
    seed: int = 42
    shard_rows: int = 32_768

    def fit(self, df: DataFrame, valid: DataFrame | None = None) -> MLPModel:
        """Train; with ``valid``, stop early on its F1 and keep the best weights."""
        table = weight_table(df, self.label)
        classes = max(2, int(max(table)) + 1)
        if self.weighting is None:
            table = {c: 1.0 for c in table}
        sizes = [len(self.features), *self.hidden, 1 if classes == 2 else classes]
        model = MLPModel(self.features, sizes, initial_weights(sizes, self.activation, self.seed), self.activation, classes)
        train = self._sharded(df, table)
        held = cached(self._columns(valid, table)) if valid is not None else None
        best, best_f1, waited = model.weights, 0.0, 0
        try:
            for epoch in range(self.epochs):
                lr = self.lr * self.decay**epoch
                model.weights, loss = self._epoch(train, model.weights, sizes, lr, epoch)
                entry = {"epoch": epoch + 1, "train_loss": loss, "lr": lr}
                model.history.append(entry)
                if held is None:
                    continue
                entry.update(self._validate(held, model))
                if entry["val_f1"] > best_f1:
                    best, best_f1, waited = model.weights, entry["val_f1"], 0
                else:
                    waited += 1
                    if waited >= self.patience:
                        break
        finally:
            train.unpersist()
            if held is not None:
                held.unpersist()
        if held is not None and best_f1 > 0:
            model.weights = best
        return model

    def _columns(self, df: DataFrame, table: dict) -> DataFrame:
        label = F.col(self.label)
        return df.select(
            hash60(self.seed, F.col(self.key)).alias("h"), vector_of(self.features).alias("x"),
            label.cast("int").alias("y"), per_class(label, table).alias("w"),
        )

    def _sharded(self, df: DataFrame, table: dict) -> DataFrame:
        """Rows by shard, in a repeatable random order.

        A shard is one averaged network. How many there are follows from the rows alone and who is in them from the hash of the key,
        so neither cores nor Arrow batches change the result.
        """
        shards = max(1, -(-df.count() // self.shard_rows))
        data = self._columns(df, table).withColumn("shard", F.pmod(F.col("h"), F.lit(shards)))
        return cached(data.repartition("shard").sortWithinPartitions("shard", "h"))

    def _epoch(self, train: DataFrame, weights, sizes, lr: float, epoch: int):
        batch, drop, activation, seed, outputs = self.batch, self.dropout, self.activation, self.seed, sizes[-1]
        shared = train.sparkSession.sparkContext.broadcast(flatten(weights))

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = None
            for shard, frame in whole_shards(frames):
                rng = np.random.default_rng([seed, epoch, shard])
                mine = [(w.copy(), b.copy()) for w, b in unflatten(shared.value, sizes)]
                loss = batches = 0.0
                x = np.array(frame["x"].tolist(), dtype="float64").reshape(len(frame), -1)
                y, w = frame["y"].to_numpy(), frame["w"].to_numpy()
                order = rng.permutation(len(frame))
                for at in range(0, len(frame), batch):
                    pick = order[at : at + batch]
                    target = one_hot(y[pick], outputs)
                    out, steps = forward(x[pick], mine, activation, drop, rng)
                    loss += batch_loss(out, target, w[pick])
                    for (mw, mb), (gw, gb) in zip(mine, backward(out, target, w[pick], steps, mine, activation)):
                        mw -= lr * gw
                        mb -= lr * gb
                    batches += 1
                own = np.concatenate([flatten(mine) * len(frame), [len(frame), loss, batches]])
                total = own if total is None else total + own
            if total is not None:
                yield pd.DataFrame({"v": [total]})

        local = train.select("shard", "x", "y", "w").mapInPandas(run, "v array<double>")
        summed = local.select(F.posexplode("v")).groupBy("pos").agg(F.sum("col").alias("s")).toPandas()
        flat = summed.sort_values("pos")["s"].to_numpy()
        shared.destroy()
        rows, loss, batches = flat[-3:]
        return unflatten(flat[:-3] / rows, sizes), float(loss / batches)

    def _validate(self, held: DataFrame, model: MLPModel) -> dict:
        """Loss, accuracy and F1 of the held-out rows in one job."""
        weights, activation, binary = model.weights, model.activation, model.classes == 2

        @F.pandas_udf("prediction int, loss double")
        def score(x: pd.Series, y: pd.Series, w: pd.Series) -> pd.DataFrame:
            out, _ = forward(np.array(x.tolist(), dtype="float64").reshape(len(x), -1), weights, activation)
            target = one_hot(y.to_numpy(), out.shape[1])
            q = np.clip(out, CLIP, 1.0 - CLIP)
            loss = (target * np.log(q)).sum(1)
            if binary:
                loss = loss + ((1.0 - target) * np.log(1.0 - q)).sum(1)
            pick = (out[:, 0] > 0.5).astype("int32") if binary else out.argmax(1).astype("int32")
            return pd.DataFrame({"prediction": pick, "loss": -loss * w.to_numpy()})

        cells = (
            held.select("y", score("x", "y", "w").alias("s"))
            .groupBy(F.col("y").alias("label"), F.col("s.prediction").alias("prediction"))
            .agg(F.count("*").alias("n"), F.sum("s.loss").alias("loss")).collect()
        )
        scores = scores_of(cells)
        loss = sum(c["loss"] for c in cells) / sum(c["n"] for c in cells)
        return {"val_loss": loss, "val_accuracy": scores["accuracy"], "val_f1": scores["f1"]}


def mlp(features: Sequence[str], label: str, key: str, **options) -> MLP:
    return MLP(tuple(features), label, key, **options)


# The three networks of the ensemble (hidden layers, rate, dropout).
ENSEMBLE = (
    ("mlp_small", (128, 64), 0.002, 0.2),
    ("mlp_medium", (256, 128), 0.0015, 0.25),
    ("mlp_deep", (128, 64, 32), 0.001, 0.3),
)


def mlp_ensemble(features: Sequence[str], label: str, key: str, **options) -> dict[str, MLP]:
    return {name: mlp(features, label, key, hidden=h, lr=lr, dropout=d, **options) for name, h, lr, d in ENSEMBLE}
