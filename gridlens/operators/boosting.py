"""Boosted regression trees for many fits side by side, on one binned matrix.

Model selection fits the same table over and over: other folds, sizes, depths,
rates, feature sets.  Here the table is binned once into blocks (a byte per
feature, a bit per fit that learns from or is judged on the row) that every
fit reads.  A tree's split comes from counts and residual sums per node,
feature and bin.  Residuals are rounded to integers on a fixed grid, so sums
are exact and the trees do not depend on partitions or the order of rows.

* A matrix of at most ``TASK_ROWS`` rows fits a task: every fit is grown whole
  by one task, all fits side by side, in one Spark job.
* A larger one is grown level by level: each pass sums the histograms of all
  fits over all blocks (tasks add up their own blocks first), picks the best
  split of every open node in tasks, and returns one row per node.  The margins
  are cut into a stored table every ``CUT`` trees.

Both take the same splits from the same sums, hence give the same trees.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridlens.session import materialize, ship_package

BINS = 32
TASK_ROWS = 100_000
BLOCK_ROWS = 65_536
BLOCKS_PER_PARTITION = 8
CUT = 10
SAMPLE_RANGE = 1 << 32


@dataclass(frozen=True)
class Fit:
    """One model: the rows it learns from, the rows it is judged on, and its parameters."""

    name: str
    train: Column
    judge: Column
    features: tuple[str, ...]
    depth: int = 6
    rate: float = 0.1
    trees: int = 100
    subsample: float = 1.0
    colsample: float = 1.0
    seed: int = 42

    def spec(self, at: int, columns: Sequence[str]) -> Spec:
        used = tuple(i for i, c in enumerate(columns) if c in set(self.features))
        return Spec(at, used, self.depth, self.rate, self.trees, self.subsample, self.colsample, self.seed)


@dataclass(frozen=True)
class Spec:
    """What a task needs to know of a fit."""

    at: int
    features: tuple[int, ...]
    depth: int
    rate: float
    trees: int
    subsample: float
    colsample: float
    seed: int

    def drawn(self, tree: int) -> np.ndarray:
        """The features that one tree may split on."""
        k = max(1, round(self.colsample * len(self.features)))
        return np.sort(np.random.default_rng([self.seed, tree]).permutation(self.features)[:k])

    def sampled(self, key: np.ndarray, tree: int) -> np.ndarray:
        """The rows that one tree learns from: a hash of the row's key and the tree's number."""
        if self.subsample >= 1:
            return np.ones(len(key), bool)
        h = key.astype(np.uint64) + np.uint64((self.seed * 1_000_003 + tree + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (h >> np.uint64(32)) < np.uint64(int(self.subsample * SAMPLE_RANGE))


@dataclass
class Tree:
    """Nodes in the order they came up; a split node's children are ``left`` and ``left + 1``."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    open: list[int] = field(default_factory=lambda: [0])

    def grow(self, found: dict[int, tuple], scale: float) -> None:
        """Split the open nodes that have a best split: (feature, bin, n, s, n left, s left)."""
        fresh = []
        for node in self.open:
            if node not in found:
                continue
            f, b, n, s, nl, sl = found[node]
            self.value[node] = s / n / scale
            if f < 0:
                continue
            self.feature[node], self.bin[node], self.left[node] = f, b, len(self.value)
            fresh += [len(self.value), len(self.value) + 1]
            self.value += [sl / nl / scale, (s - sl) / (n - nl) / scale]
            self.feature += [-1, -1]
            self.bin += [0, 0]
            self.left += [0, 0]
        self.open = fresh

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row ends in."""
        feature, edge, left = map(np.array, (self.feature, self.bin, self.left))
        at = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        while len(rows):
            f = feature[at[rows]]
            rows = rows[f >= 0]
            here, f = at[rows], f[f >= 0]
            at[rows] = left[here] + (bins[rows, f] > edge[here])
        return at

    def values(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.nodes(bins)]


def histograms(bins: np.ndarray, q: np.ndarray, node: np.ndarray, wanted: Sequence[int], features: np.ndarray) -> np.ndarray:
    """Counts and sums of ``q`` as ``[node, feature, bin, 2]`` for the wanted nodes: exact integers."""
    slot = np.full(int(max(node.max(initial=0), max(wanted))) + 1, -1)
    slot[np.array(wanted)] = np.arange(len(wanted))
    at = slot[node]
    rows = at >= 0
    at, q = at[rows], q[rows].astype(np.float64)  # integers below 2^53 and their sums here are exact
    out = np.zeros((len(wanted), len(features), BINS, 2), np.int64)
    for i, f in enumerate(features):
        cell = at * BINS + bins[rows, f]
        out[:, i, :, 0] = np.bincount(cell, minlength=len(wanted) * BINS).reshape(-1, BINS)
        out[:, i, :, 1] = np.bincount(cell, weights=q, minlength=len(wanted) * BINS).reshape(-1, BINS).astype(np.int64)
    return out


def best_split(hist: np.ndarray, features: np.ndarray) -> tuple:
    """Of one node's histogram: (feature, bin, n, s, n left, s left); feature -1 if no split gains."""
    n, s = (int(x) for x in hist[0].sum(0))
    left = hist.cumsum(1)[:, :-1].astype(np.float64)
    nl, sl = left[..., 0], left[..., 1]
    ok = (nl > 0) & (nl < n)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(ok, sl * sl / nl + (s - sl) * (s - sl) / (n - nl), -np.inf)
    at = int(gain.argmax())
    i, b = divmod(at, BINS - 1)
    if not ok.any() or gain.flat[at] <= s * s / n * (1 + 1e-12) + 1e-9:
        return -1, 0, n, s, 0, 0
    return int(features[i]), b, n, s, int(nl[i, b]), int(sl[i, b])


def residuals(y: np.ndarray, margin: np.ndarray, scale: float) -> np.ndarray:
    return np.rint((y - margin) * scale).astype(np.int64)


def boosted(bins: np.ndarray, y: np.ndarray, key: np.ndarray, spec: Spec, base: float, scale: float) -> list[Tree]:
    """All trees of one fit on rows that a task holds."""
    trees, margin = [], np.full(len(y), base)
    for t in range(spec.trees):
        tree, q, features = Tree(), residuals(y, margin, scale), spec.drawn(t)
        part = spec.sampled(key, t)
        sub, sub_q = bins[part], q[part]
        for _ in range(spec.depth):
            if not tree.open or not len(sub):
                break
            hist = histograms(sub, sub_q, tree.nodes(sub), tree.open, features)
            tree.grow({node: best_split(h, features) for node, h in zip(tree.open, hist, strict=True) if h[0, :, 0].sum()}, scale)
        trees.append(tree)
        margin += spec.rate * tree.values(bins)
    return trees


class Matrix:
    """The binned table as blocks: ``(bins, y, key, train, judge, margin)``, all as bytes."""

    def __init__(self, data: DataFrame, fits: Sequence[Fit], label: str, key: Column) -> None:
        spark = data.sparkSession
        ship_package(spark)
        self.fits = fits
        self.features = list(dict.fromkeys(c for f in fits for c in f.features))
        self.specs = [f.spec(i, self.features) for i, f in enumerate(fits)]
        probs = [i / BINS for i in range(1, BINS)]
        known = data.filter(F.col(label).isNotNull())
        cuts = F.array(*[F.percentile_approx(F.col(c).cast("double"), probs, 100_000) for c in self.features])
        y = F.col(label).cast("double")
        masks = [F.coalesce(f.train, F.lit(False)) for f in fits]
        sums = F.array(*[F.struct(F.count_if(m).alias("n"), F.sum(F.when(m, y)).alias("s")) for m in masks])
        head = known.agg(cuts.alias("cuts"), F.count(F.lit(1)).alias("n"), F.max(F.abs(y)).alias("top"), sums.alias("sums")).first()
        self.rows = head["n"]
        self.edges = [np.unique(np.array(c or [], float)) for c in head["cuts"]]
        # residuals are below 2 * top: integers of at most 31 bits, exact in every sum
        self.scale = float(2.0 ** (30 - int(np.ceil(np.log2(max(head["top"] or 1.0, 1e-300))))))
        # rounded like the residuals: the order of a sum's rows does not show
        self.base = [round(s["s"] / s["n"] * self.scale) / self.scale if s["n"] else 0.0 for s in head["sums"]]
        self.blocks = materialize(self._packed(known, y, masks, key))

    def _packed(self, known: DataFrame, y: Column, masks: list[Column], key: Column) -> DataFrame:
        edges, n_features = self.edges, len(self.features)
        x = F.array(*[F.col(c).cast("double") for c in self.features])
        judge = F.array(*[F.coalesce(f.judge, F.lit(False)) for f in self.fits])
        src = known.select(x.alias("x"), y.alias("y"), key.cast("long").alias("key"), F.array(*masks).alias("train"), judge.alias("judge"))
        parts = max(1, -(-self.rows // (BLOCK_ROWS * BLOCKS_PER_PARTITION)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, n = [], 0
            for b in batches:
                held.append(b)
                n += len(b)
                if n >= BLOCK_ROWS:
                    yield packed(held)
                    held, n = [], 0
            if n:
                yield packed(held)

        def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            t = pa.Table.from_batches(held).combine_chunks()
            wide = lambda c: t[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(t), -1)
            x = wide("x").astype(np.float64)
            bins = np.empty((len(t), n_features), np.uint8)
            for i, e in enumerate(edges):  # a missing number lies above all
                bins[:, i] = np.searchsorted(e, np.where(np.isnan(x[:, i]), np.inf, x[:, i]), "left")
            cells = [bins, t["y"].to_numpy(), t["key"].to_numpy(), np.packbits(wide("train").astype(bool), axis=1), np.packbits(wide("judge").astype(bool), axis=1), np.empty(0)]
            return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in cells], BLOCK)

        return src.coalesce(parts).mapInArrow(run, ", ".join(f"{c} binary" for c in BLOCK))

    def _read(self):
        """A function that gives a block's arrays; it carries numbers alone into the tasks."""
        n_features, n_fits = len(self.features), len(self.fits)

        def read(row: dict) -> tuple:
            y = np.frombuffer(row["y"], np.float64)
            bits = [np.unpackbits(np.frombuffer(row[c], np.uint8).reshape(len(y), -1), axis=1, count=n_fits).astype(bool) for c in ("train", "judge")]
            margin = np.frombuffer(row["margin"], np.float64).reshape(len(y), -1) if row["margin"] else None
            return np.frombuffer(row["bins"], np.uint8).reshape(-1, n_features), y, np.frombuffer(row["key"], np.int64), *bits, margin

        return read

    def fit(self) -> list[list[Tree]]:
        """The trees of every fit: as many numbers as the models have."""
        if not self.rows:
            return [[] for _ in self.fits]
        return self._in_tasks() if self.rows <= TASK_ROWS else self._by_levels()

    def _in_tasks(self) -> list[list[Tree]]:
        read, specs, base, scale = self._read(), self.specs, self.base, self.scale

        def run(key: tuple, table: pa.Table) -> pa.Table:
            spec = specs[key[0].as_py()]
            parts = [(b[m], y[m], k[m]) for b, y, k, train, _, _ in map(read, table.to_pylist()) for m in (train[:, spec.at],)]
            bins, y, k = (np.concatenate(c) for c in zip(*parts, strict=True))
            return pa.table({"fit": pa.array([spec.at], pa.int32()), "trees": pa.array([pickle.dumps(boosted(bins, y, k, spec, base[spec.at], scale))], pa.binary())})

        each = self.blocks.withColumn("fit", F.explode(F.array(*[F.lit(s.at) for s in specs])))
        width = max(1, min(len(specs), self.blocks.sparkSession.sparkContext.defaultParallelism))
        out = each.repartitionByRange(width, "fit").groupBy("fit").applyInArrow(run, "fit int, trees binary").collect()
        trees = {r["fit"]: pickle.loads(r["trees"]) for r in out}
        return [trees[s.at] for s in specs]

    def _by_levels(self) -> list[list[Tree]]:
        done: list[list[Tree]] = [[] for _ in self.specs]
        since = [0] * len(self.specs)  # trees already in the stored margins
        blocks, now, level = self.blocks, {s.at: Tree() for s in self.specs if s.trees}, dict.fromkeys(range(len(self.specs)), 0)
        while now:
            found = self._level(blocks, now, {at: done[at][since[at] :] for at in now}, {at: len(done[at]) for at in now})
            for at, tree in list(now.items()):
                tree.grow(found.get(at, {}), self.scale)
                level[at] += 1
                if level[at] >= self.specs[at].depth or not tree.open:
                    done[at].append(tree)
                    level[at], now[at] = 0, Tree()
                    if len(done[at]) == self.specs[at].trees:
                        del now[at]
            if any(len(done[at]) - since[at] >= CUT for at in now):
                blocks = materialize(self._moved(blocks, [d[n:] for d, n in zip(done, since, strict=True)]))
                since = [len(d) for d in done]
        return done

    def _level(self, blocks: DataFrame, now: dict[int, Tree], later: dict[int, list[Tree]], number: dict[int, int]) -> dict[int, dict[int, tuple]]:
        read, specs, base, scale = self._read(), self.specs, self.base, self.scale

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[tuple[int, int], np.ndarray] = {}
            for row in (r for b in batches for r in b.to_pylist()):
                bins, y, key, train, _, margin = read(row)
                for at, tree in now.items():
                    spec = specs[at]
                    m = train[:, at] & spec.sampled(key, number[at])
                    sub = bins[m]
                    if not len(sub):
                        continue
                    f = margin[m, at].copy() if margin is not None else np.full(len(sub), base[at])
                    for t in later[at]:
                        f += spec.rate * t.values(sub)
                    hist = histograms(sub, residuals(y[m], f, scale), tree.nodes(sub), tree.open, spec.drawn(number[at]))
                    for node, h in zip(tree.open, hist, strict=True):
                        if h[0, :, 0].any():
                            total[at, node] = total.get((at, node), 0) + h
            cells = list(total.items())
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k, _ in cells], pa.int32()), pa.array([k[1] for k, _ in cells], pa.int32()), pa.array([h.tobytes() for _, h in cells], pa.binary())],
                ["fit", "node", "hist"],
            )

        def best(key: tuple, table: pa.Table) -> pa.Table:
            at, node = (k.as_py() for k in key)
            features = specs[at].drawn(number[at])
            hist = sum(np.frombuffer(h.as_py(), np.int64) for h in table["hist"]).reshape(len(features), BINS, 2)
            return pa.table({"fit": pa.array([at], pa.int32()), "node": pa.array([node], pa.int32()), "split": pa.array([best_split(hist, features)], pa.list_(pa.int64()))})

        parts = blocks.mapInArrow(run, "fit int, node int, hist binary")
        out: dict[int, dict[int, tuple]] = {}
        for r in parts.groupBy("fit", "node").applyInArrow(best, "fit int, node int, split array<long>").collect():
            out.setdefault(r["fit"], {})[r["node"]] = tuple(r["split"])
        return out

    def _moved(self, blocks: DataFrame, later: list[list[Tree]]) -> DataFrame:
        """The blocks with the margins of all fits moved on by some trees."""
        read, specs, base = self._read(), self.specs, self.base

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for row in b.to_pylist():
                    bins, y, _, _, _, margin = read(row)
                    margin = np.tile(base, (len(y), 1)) if margin is None else margin.copy()
                    for at, trees in enumerate(later):
                        for t in trees:
                            margin[:, at] += specs[at].rate * t.values(bins)
                    row["margin"] = margin.tobytes()
                    yield pa.RecordBatch.from_pylist([row], pa.schema([(c, pa.binary()) for c in BLOCK]))

        return blocks.mapInArrow(run, blocks.schema)

    def scores(self, models: list[list[Tree]], at: Sequence[int] | None = None) -> DataFrame:
        """``(fit, trees, part, n, rmse, r2)`` of the train and judge rows, after each wanted number of trees."""
        read, specs, base = self._read(), self.specs, self.base
        marks = [sorted(set(at)) if at else [s.trees] for s in specs]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = []
                for row in b.to_pylist():
                    bins, y, _, train, judge, _ = read(row)
                    for spec, trees, wanted in zip(specs, models, marks, strict=True):
                        f = np.full(len(y), base[spec.at])
                        for n, t in enumerate(trees, 1):
                            f += spec.rate * t.values(bins)
                            if n in wanted:
                                for part, m in (("train", train[:, spec.at]), ("judge", judge[:, spec.at])):
                                    e = y[m] - f[m]
                                    rows.append((spec.at, n, part, int(m.sum()), float(y[m].sum()), float((y[m] ** 2).sum()), float((e * e).sum())))
                columns = list(zip(*rows, strict=True)) or [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, SCORE_TYPES, strict=True)], SCORE)

        schema = "fit int, trees int, part string, n long, y double, yy double, sse double"
        s = self.blocks.mapInArrow(run, schema).groupBy("fit", "trees", "part").agg(*[F.sum(c).alias(c) for c in SCORE[3:]])
        sst = F.col("yy") - F.col("y") * F.col("y") / F.col("n")
        names = F.array(*[F.lit(f.name) for f in self.fits])
        return s.filter("n > 0").select(
            F.element_at(names, F.col("fit") + 1).alias("fit"), "trees", "part", "n",
            F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
            F.when(sst > 0, 1 - F.col("sse") / sst).alias("r2"),
        )


BLOCK = ["bins", "y", "key", "train", "judge", "margin"]
SCORE = ["fit", "trees", "part", "n", "y", "yy", "sse"]
SCORE_TYPES = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]


def fit_scores(data: DataFrame, fits: Sequence[Fit], label: str, key: Column, at: Sequence[int] | None = None) -> DataFrame:
    """Fit all models on one matrix and score each on its own rows (see ``Matrix.scores``).

    ``key`` is a hash that tells rows apart; rows without a label are left out.
    """
    matrix = Matrix(data, fits, label, key)
    return matrix.scores(matrix.fit(), at)
