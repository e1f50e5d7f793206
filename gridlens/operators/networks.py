"""Small neural networks trained by synchronous gradient descent over partitions.

ReLU layers with dropout, Adam, a log loss (classes 0 / 1) or squared loss.  The
scaled rows are stored once as blocks.  A step sums the gradients of its rows:
every task adds up its blocks and hands on one vector as long as the model, the
vectors are added in groups until a few are left, and the driver moves the
weights, which go out again with the next step.  Which rows a step takes and
which units a row drops are hashes of the row's key, so neither partitions nor
the order of rows show (but for rounding in the last digits of a sum).

There is a model after every epoch; all of them score the validation rows in
one pass at the end, and the losses and the exact AUC of all epochs come from
one grouped prefix sum.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlens.operators.ordered import prefix_sums
from gridlens.session import materialize, ship_package

BLOCK_ROWS = 16_384
BLOCKS_PER_PARTITION = 8
# Gradient vectors that are added in one task, or on the driver.
FAN_IN = 32
KINDS = ("classes", "numbers")


@dataclass(frozen=True)
class Settings:
    kind: str  # "classes": log loss of 0 / 1 labels; "numbers": squared loss
    hidden: tuple[int, ...] = (64, 64)
    dropout: float = 0.0
    rate: float = 0.01
    decay: float = 0.0
    epochs: int = 30
    steps: int = 4  # an epoch's rows are dealt to so many steps
    seed: int = 42

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"kind: one of {KINDS}")


def _mixed(x: np.ndarray, seed: int) -> np.ndarray:
    x = x + np.uint64(seed * 0x9E3779B97F4A7C15 & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Network:
    """The weights in one flat vector, layer by layer: (inputs + 1, outputs), the last row being the bias."""

    def __init__(self, n_inputs: int, settings: Settings) -> None:
        widths = [n_inputs, *settings.hidden, 1]
        self.shapes = [(a + 1, b) for a, b in zip(widths, widths[1:], strict=False)]
        self.settings = settings

    def start(self) -> np.ndarray:
        rng = np.random.default_rng(self.settings.seed)
        parts = [np.vstack([rng.normal(0, np.sqrt(2 / (a - 1)), (a - 1, b)), np.zeros((1, b))]) for a, b in self.shapes]
        return np.concatenate([p.ravel() for p in parts])

    def layers(self, flat: np.ndarray) -> list[np.ndarray]:
        ends = np.cumsum([a * b for a, b in self.shapes])
        return [flat[e - a * b : e].reshape(a, b) for e, (a, b) in zip(ends, self.shapes, strict=True)]

    def outputs(self, flat: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The prediction per row: a probability, or a number."""
        for i, w in enumerate(layers := self.layers(flat)):
            x = x @ w[:-1] + w[-1]
            if i < len(layers) - 1:
                x = np.maximum(x, 0)
        return 1 / (1 + np.exp(-np.clip(x[:, 0], -60, 60))) if self.settings.kind == "classes" else x[:, 0]

    def gradient(self, flat: np.ndarray, x: np.ndarray, y: np.ndarray, key: np.ndarray, epoch: int) -> tuple[np.ndarray, float]:
        """The summed gradient and loss of some rows."""
        layers, inputs, kept = self.layers(flat), [x], []
        keep = 1 - self.settings.dropout
        for i, w in enumerate(layers[:-1]):
            z = np.maximum(inputs[-1] @ w[:-1] + w[-1], 0)
            if keep < 1:
                units = _mixed(np.arange(z.shape[1], dtype=np.uint64), 101 + i)
                coin = _mixed(key[:, None] ^ units[None, :], self.settings.seed + 1000 * epoch + 7)
                kept.append(((coin >> np.uint64(32)) < np.uint64(int(keep * 2**32))) / keep)
                z = z * kept[-1]
            inputs.append(z)
        z = (inputs[-1] @ layers[-1][:-1] + layers[-1][-1])[:, 0]
        if self.settings.kind == "classes":
            p = 1 / (1 + np.exp(-np.clip(z, -60, 60)))
            loss = float((np.logaddexp(0, z) - y * z).sum())
            back = (p - y)[:, None]
        else:
            loss = float(((z - y) ** 2).sum())
            back = 2 * (z - y)[:, None]
        out = []
        for i in range(len(layers) - 1, -1, -1):
            out.append(np.vstack([inputs[i].T @ back, back.sum(0)]).ravel())
            if i:
                back = (back @ layers[i][:-1].T) * (inputs[i] > 0)
                if kept:
                    back = back * kept[i - 1]
        return np.concatenate(out[::-1]), loss


@dataclass
class Adam:
    rate: float
    decay: float
    first: np.ndarray | float = 0.0
    second: np.ndarray | float = 0.0
    n: int = 0

    def move(self, flat: np.ndarray, grad: np.ndarray) -> np.ndarray:
        grad = grad + self.decay * flat
        self.n += 1
        self.first = 0.9 * self.first + 0.1 * grad
        self.second = 0.999 * self.second + 0.001 * grad * grad
        up, down = self.first / (1 - 0.9**self.n), self.second / (1 - 0.999**self.n)
        return flat - self.rate * up / (np.sqrt(down) + 1e-8)


@dataclass
class Trained:
    network: Network
    weights: list[np.ndarray] = field(default_factory=list)  # after each epoch
    train_loss: list[float] = field(default_factory=list)
    mean: float = 0.0  # of the labels: numbers are learned as (label - mean) / spread
    spread: float = 1.0


class Rows:
    """The scaled rows as blocks ``(x, y, key, train, valid)``, all as bytes."""

    def __init__(self, data: DataFrame, features: Sequence[str], label: str, key: Column, train: Column, valid: Column, kind: str) -> None:
        spark = data.sparkSession
        ship_package(spark)
        known = data.filter(F.col(label).isNotNull())
        y = F.col(label).cast("double")
        number = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features}
        number = {c: F.when(F.isnan(x) | (F.abs(x) == float("inf")), 0.0).otherwise(x) for c, x in number.items()}
        of = lambda f, x: f(F.when(train, x))
        stats = known.agg(
            F.count(F.lit(1)).alias("n"), of(F.avg, y).alias("y"), of(F.stddev_pop, y).alias("ys"),
            F.array(*[of(F.avg, x) for x in number.values()]).alias("m"), F.array(*[of(F.stddev_pop, x) for x in number.values()]).alias("s"),
        ).first()  # one row, as wide as the features
        self.n_features, self.rows = len(features), stats["n"]
        self.mean, self.spread = (stats["y"] or 0.0, stats["ys"] or 1.0) if kind == "numbers" else (0.0, 1.0)
        scaled = [(x - F.lit(m or 0.0)) / F.lit(s or 1.0) for x, m, s in zip(number.values(), stats["m"], stats["s"], strict=True)]
        side = [F.coalesce(c, F.lit(False)) for c in (train, valid)]
        src = known.select(F.array(*scaled).alias("x"), y.alias("y"), key.cast("long").alias("key"), *[c.alias(n) for c, n in zip(side, ("train", "valid"), strict=True)])
        parts = max(1, -(-self.rows // (BLOCK_ROWS * BLOCKS_PER_PARTITION)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if len(b):
                    x = b.column(0).flatten().to_numpy(zero_copy_only=False)
                    cells = [x, b.column(1).to_numpy(), b.column(2).to_numpy(), *(b.column(i).to_numpy(zero_copy_only=False) for i in (3, 4))]
                    yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in cells], BLOCK)

        self.blocks = materialize(src.coalesce(parts).mapInArrow(run, ", ".join(f"{c} binary" for c in BLOCK)))
        self.parts = parts

    def reader(self):
        n_features, mean, spread = self.n_features, self.mean, self.spread

        def read(row: dict) -> tuple:
            x, y = np.frombuffer(row["x"], np.float64).reshape(-1, n_features), np.frombuffer(row["y"], np.float64)
            return x, (y - mean) / spread, np.frombuffer(row["key"], np.uint64), *(np.frombuffer(row[c], bool) for c in ("train", "valid"))

        return read


BLOCK = ["x", "y", "key", "train", "valid"]


def _summed(parts: DataFrame, count: int) -> tuple[np.ndarray | None, float, int]:
    """The sum of the tasks' ``(g, n, loss, grad)`` rows, added in groups until few are left."""

    def add(table: pa.Table) -> pa.Table:
        rows = sorted(table.select(["g", "n", "loss", "grad"]).to_pylist(), key=lambda r: r["g"])
        total = sum(np.frombuffer(r["grad"], np.float64) for r in rows)
        return pa.table({
            "g": pa.array([rows[0]["g"] // FAN_IN], pa.int64()), "n": pa.array([sum(r["n"] for r in rows)], pa.int64()),
            "loss": pa.array([sum(r["loss"] for r in rows)]), "grad": pa.array([total.tobytes()], pa.binary()),
        })

    while count > FAN_IN:
        parts = parts.groupBy(F.floor(F.col("g") / FAN_IN).alias("up")).applyInArrow(add, parts.schema)
        count = -(-count // FAN_IN)
    rows = sorted(parts.collect(), key=lambda r: r["g"])
    if not rows:
        return None, 0.0, 0
    return sum(np.frombuffer(r["grad"], np.float64) for r in rows), sum(r["loss"] for r in rows), sum(r["n"] for r in rows)


def train(rows: Rows, settings: Settings) -> Trained:
    """The weights and the mean training loss after every epoch."""
    network = Network(rows.n_features, settings)
    out, flat, adam, read = Trained(network, mean=rows.mean, spread=rows.spread), network.start(), Adam(settings.rate, settings.decay), rows.reader()

    def gradients(flat: np.ndarray, epoch: int, step: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            total, n, loss = np.zeros(len(flat)), 0, 0.0
            for row in (r for b in batches for r in b.to_pylist()):
                x, y, key, train, _ = read(row)
                mine = train & (_mixed(key, 31 * epoch + settings.seed) % np.uint64(settings.steps) == step)
                if mine.any():
                    g, part = network.gradient(flat, x[mine], y[mine], key[mine], epoch)
                    total, n, loss = total + g, n + int(mine.sum()), loss + part
            if n:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([n], pa.int64()), pa.array([loss]), pa.array([total.tobytes()], pa.binary())],
                    ["g", "n", "loss", "grad"],
                )

        return rows.blocks.mapInArrow(run, "g long, n long, loss double, grad binary")

    for epoch in range(settings.epochs):
        seen, lost = 0, 0.0
        for step in range(settings.steps):
            grad, loss, n = _summed(gradients(flat, epoch, step), rows.parts)
            if n:
                flat = adam.move(flat, grad / n)
                seen, lost = seen + n, lost + loss
        out.weights.append(flat)
        out.train_loss.append(lost / seen if seen else float("nan"))
    return out


def epoch_predictions(rows: Rows, model: Trained) -> DataFrame:
    """``(epoch, label, prediction)`` of the validation rows by the model of every epoch."""
    read, network, weights, mean, spread = rows.reader(), model.network, model.weights, model.mean, model.spread

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for b in batches for r in b.to_pylist()):
            x, y, _, _, valid = read(row)
            for epoch, flat in enumerate(weights, 1):
                p = network.outputs(flat, x[valid])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), epoch, np.int32)), pa.array(y[valid] * spread + mean), pa.array(p * spread + mean)], ["epoch", "label", "prediction"])

    return rows.blocks.mapInArrow(run, "epoch int, label double, prediction double")


def grouped_auc(scored: DataFrame, groups: Sequence[str], label: str, score: str) -> DataFrame:
    """``groups..., auc``: the exact rank-sum AUC of every group, ties counted half; NULL with one class only."""
    per = scored.groupBy(*groups, score).agg(F.count_if(F.col(label) == 1).alias("_pos"), F.count_if(F.col(label) != 1).alias("_neg"))
    cum = prefix_sums(per, score, ["_neg"], groups, distinct_order=True)
    wins = F.sum(F.col("_pos") * (F.col("cum__neg") - F.col("_neg") / 2.0))
    return cum.groupBy(*groups).agg(F.try_divide(wins, F.sum("_pos").cast("double") * F.sum("_neg")).alias("auc"))


def epoch_curve(data: DataFrame, features: Sequence[str], label: str, key: Column, train_rows: Column, valid_rows: Column, settings: Settings) -> DataFrame:
    """A row per epoch: ``epoch, train_loss, val_loss`` and, for classes, ``val_auc``; for numbers the losses are RMSE.

    ``key`` is a hash that tells rows apart; rows without a label are left out,
    missing numbers count as 0.  Without training rows or epochs there are no rows."""
    spark = data.sparkSession
    rows = Rows(data, features, label, key, train_rows, valid_rows, settings.kind)
    model = train(rows, settings)
    lost = [(i, float(x)) for i, x in enumerate(model.train_loss, 1) if x == x]  # as many rows as epochs
    curve = spark.createDataFrame(lost, "epoch int, train_loss double")
    scored = materialize(epoch_predictions(rows, model))
    if settings.kind == "numbers":
        spread = F.lit(float(rows.spread))
        val = scored.groupBy("epoch").agg(F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("label"), 2))).alias("val_loss"))
        return curve.withColumn("train_loss", F.sqrt("train_loss") * spread).join(val, "epoch", "left")
    p = F.least(F.greatest("prediction", F.lit(1e-12)), F.lit(1 - 1e-12))
    val = scored.groupBy("epoch").agg(F.avg(-F.when(F.col("label") == 1, F.log(p)).otherwise(F.log(1 - p))).alias("val_loss"))
    auc = grouped_auc(scored, ["epoch"], "label", "prediction").withColumnRenamed("auc", "val_auc")
    return curve.join(val, "epoch", "left").join(auc, "epoch", "left")
