"""Second-order gradient boosting over quantile bins (ML10).

Features are cut into at most ``bins`` bins at quantiles. Every tree grows level
by level: each task sums gradients and hessians of its rows by (node, feature,
bin), the sums of all tasks are exchanged, and every task finds the same splits. The
split of a node maximises

    GL^2 / (HL + l) + GR^2 / (HR + l) - G^2 / (H + l)

(gain, with the regularisation l); a leaf's weight is -G / (H + l), times the
learning rate. For squared error the gradient is prediction - label, the hessian
1. Ties go to the smaller feature, then the smaller bin.

A fit is a few barrier jobs, not a job for each level: a task keeps its rows as one
binned array (a byte for each value) and exchanges histograms with the others, in
pieces of bounded size. A job grows ``roundsPerJob`` trees and starts from the
trees before, so a lost executor repeats these rounds at most. Rows are dealt by
their content over as many tasks as they need (at most the cluster's slots), so a
fit does not depend on how its input was partitioned. Only trees reach the driver.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import BarrierTaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

LEAST_GAIN = 1e-9
ROWS_PER_TASK = 250_000
PIECE_BYTES = 32 << 20       # of all tasks' sums, sent at once


@dataclass
class Tree:
    """Nodes of a binary tree in arrays; node k has children 2k + 1 and 2k + 2.
    ``feature`` is -1 in leaves; a row goes left if its bin is at most ``bin``."""
    feature: np.ndarray
    bin: np.ndarray
    weight: np.ndarray

    def text(self) -> str:
        return json.dumps([self.feature.tolist(), self.bin.tolist(), self.weight.tolist()])

    @classmethod
    def parsed(cls, text: str) -> "Tree":
        feature, cut, weight = json.loads(text)
        return cls(np.array(feature, np.int64), np.array(cut, np.int64), np.array(weight, np.float64))

    def leaves(self, binned: np.ndarray, levels: int) -> np.ndarray:
        """The node at which each row (columns: features) stands after ``levels`` levels."""
        node = np.zeros(binned.shape[0], np.int64)
        for _ in range(levels):
            feature = self.feature[node]
            value = binned[np.arange(len(node)), np.maximum(feature, 0)]
            below = 2 * node + 1 + (value > self.bin[node])
            node = np.where(feature >= 0, below, node)
        return node


def cut_points(rows: DataFrame, n_features: int, bins: int, accuracy: int = 10_000) -> list[list[float]]:
    """Upper ends of the bins but the last of each feature in ``values``: distinct quantiles, one aggregate over a bounded sketch."""
    values = F.col("values")
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    row = rows.select(*[values[k].alias(f"v{k}") for k in range(n_features)]).agg(
        *[F.percentile_approx(f"v{k}", shares, accuracy).alias(f"q{k}") for k in range(n_features)],
        *[F.max(f"v{k}").alias(f"m{k}") for k in range(n_features)]).first()
    # a bin ends at its quantile; nothing lies beyond the largest value
    return [sorted({q for q in row[f"q{k}"] or [] if q < row[f"m{k}"]}) for k in range(n_features)]


def binned(values: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin of each value (rows x features): the first whose upper end is not smaller (at most 256 bins)."""
    out = np.empty(values.shape, np.uint8)
    for k, own in enumerate(cuts):
        out[:, k] = np.searchsorted(own, values[:, k], "left")
    return out


class Bins:
    """Places of all features' bins in one row of sums."""

    def __init__(self, cuts: list[list[float]]):
        self.ends = [np.array(c, np.float64) for c in cuts]
        self.at = np.concatenate(([0], np.cumsum([len(c) + 1 for c in cuts]))).astype(np.int64)
        self.feature = np.repeat(np.arange(len(cuts)), np.diff(self.at))

    def sums(self, x: np.ndarray, node: np.ndarray, gradient: np.ndarray, width: int) -> np.ndarray:
        """(2: gradient and hessian, nodes, bins of all features) over rows at ``node`` (below 0: left out)."""
        own = node >= 0
        at = (node[own, None] * self.at[-1] + self.at[:-1] + x[own]).ravel()
        size = width * int(self.at[-1])
        return np.stack([np.bincount(at, w, size).reshape(width, -1) for w in (np.repeat(gradient[own], x.shape[1]), None)])

    def best(self, sums: np.ndarray, penalty: float, least_weight: float) -> list[tuple]:
        """(gain, feature, bin, GL, HL, GR, HR) of the best split of each node."""
        left, total = np.empty_like(sums), np.empty_like(sums)
        for a, b in zip(self.at[:-1], self.at[1:]):
            left[:, :, a:b] = np.cumsum(sums[:, :, a:b], axis=2)
            total[:, :, a:b] = left[:, :, b - 1:b]
        right = total - left
        score = lambda s: s[0] ** 2 / (s[1] + penalty)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = score(left) + score(right) - score(total)
        gain[(left[1] < least_weight) | (right[1] < least_weight)] = -np.inf
        out = []
        for node, k in enumerate(np.argmax(gain, axis=1).tolist()):       # the first of equal gains
            f = int(self.feature[k])
            out.append((float(gain[node, k]), f, k - int(self.at[f]), *(float(s[i, node, k]) for s in (left, right) for i in (0, 1))))
        return out


def exchanged(local: np.ndarray, context: BarrierTaskContext) -> np.ndarray:
    """The sum of all tasks' arrays, in task order; sent in pieces along the nodes."""
    tasks = len(context.getTaskInfos())
    if tasks == 1:
        return local
    out, step = np.empty_like(local), max(1, PIECE_BYTES // (tasks * local[:, :1].nbytes))
    for a in range(0, local.shape[1], step):
        piece = np.ascontiguousarray(local[:, a:a + step])
        sent = context.allGather(base64.b64encode(zlib.compress(piece.tobytes(), 1)).decode())
        out[:, a:a + step] = sum(np.frombuffer(zlib.decompress(base64.b64decode(m)), piece.dtype).reshape(piece.shape) for m in sent)
    return out


@dataclass(frozen=True)
class Growth:
    depth: int
    rate: float
    penalty: float
    least_weight: float
    least_gain: float

    def tree(self, x: np.ndarray, gradient: np.ndarray, bins: Bins, exchange: Callable[[np.ndarray], np.ndarray]) -> Tree:
        """One tree over this task's rows and those behind ``exchange``."""
        n = (1 << self.depth + 1) - 1
        tree, node = Tree(np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n)), np.zeros(len(gradient), np.int64)
        for level in range(self.depth):
            first, grown = (1 << level) - 1, False
            sums = exchange(bins.sums(x, node - first, gradient, 1 << level))
            held = sums[1, :, :bins.at[1]].sum(axis=1)
            if level == 0:
                tree.weight[0] = -self.rate * sums[0, 0, :bins.at[1]].sum() / (held[0] + self.penalty)
            for k, (gain, f, b, gl, hl, gr, hr) in enumerate(bins.best(sums, self.penalty, self.least_weight)):
                if held[k] and gain > self.least_gain:
                    at = first + k
                    tree.feature[at], tree.bin[at], grown = f, b, True
                    tree.weight[2 * at + 1], tree.weight[2 * at + 2] = -self.rate * gl / (hl + self.penalty), -self.rate * gr / (hr + self.penalty)
            if not grown:
                break
            node = tree.leaves(x, level + 1)
        return tree


class _BoostingParams(HasFeaturesCol, HasLabelCol, HasPredictionCol):
    rounds = Param(Params._dummy(), "rounds", "number of trees", typeConverter=TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "levels of splits of a tree", typeConverter=TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "learning rate", typeConverter=TypeConverters.toFloat)
    penalty = Param(Params._dummy(), "penalty", "l2 regularisation of leaf weights", typeConverter=TypeConverters.toFloat)
    leastWeight = Param(Params._dummy(), "leastWeight", "least hessian of a child", typeConverter=TypeConverters.toFloat)
    leastGain = Param(Params._dummy(), "leastGain", "a split gains more than this", typeConverter=TypeConverters.toFloat)
    bins = Param(Params._dummy(), "bins", "most bins of a feature (256 at most)", typeConverter=TypeConverters.toInt)
    roundsPerJob = Param(Params._dummy(), "roundsPerJob", "trees grown by one job", typeConverter=TypeConverters.toInt)


class HistogramBoosting(Estimator, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    """Squared-error regressor of ``rounds`` second-order trees; starts from the labels' mean."""

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", rounds=100, depth=6, rate=0.3, penalty=1.0, leastWeight=1.0,
                 leastGain=LEAST_GAIN, bins=256, roundsPerJob=50):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction", rounds=100, depth=6, rate=0.3, penalty=1.0, leastWeight=1.0,
                         leastGain=LEAST_GAIN, bins=256, roundsPerJob=50)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "HistogramBoostingModel":
        rows = dataset.select(vector_to_array(self.getFeaturesCol()).alias("values"), F.col(self.getLabelCol()).cast("double").alias("label"))
        first = rows.select(F.size("values").alias("n")).first()
        if first is None:
            raise ValueError("HistogramBoosting: no training rows")
        cuts, size = cut_points(rows, first["n"], self.getOrDefault(self.bins)), rows.agg(F.avg("label").alias("mean"), F.count(F.lit(1)).alias("n")).first()
        tasks = max(1, min(-(-size["n"] // ROWS_PER_TASK), dataset.sparkSession.sparkContext.defaultParallelism))      # all run at once
        dealt = rows.repartition(tasks, F.xxhash64("label", "values")).sortWithinPartitions("label", "values")
        growth = Growth(*(self.getOrDefault(p) for p in (self.depth, self.rate, self.penalty, self.leastWeight, self.leastGain)))
        trees: list[Tree] = []
        while len(trees) < self.getOrDefault(self.rounds):
            n = min(self.getOrDefault(self.roundsPerJob), self.getOrDefault(self.rounds) - len(trees))
            made = dealt.mapInArrow(partial(_rounds, cuts=cuts, start=size["mean"], trees=trees, growth=growth, rounds=n), "tree string", barrier=True).collect()     # one task sends its trees
            trees = trees + [Tree.parsed(r["tree"]) for r in made]
        fitted = json.dumps({"start": size["mean"], "cuts": cuts, "trees": [t.text() for t in trees]})
        return HistogramBoostingModel(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol(), depth=growth.depth, fitted=fitted)


def _rounds(batches: Iterator[pa.RecordBatch], cuts: list[list[float]], start: float, trees: list[Tree], growth: Growth, rounds: int) -> Iterator[pa.RecordBatch]:
    """``rounds`` further trees, sent by the first task."""
    context, bins = BarrierTaskContext.get(), Bins(cuts)
    x, label = [np.empty((0, len(cuts)), np.uint8)], [np.empty(0)]
    for batch in batches:
        label.append(batch["label"].to_numpy())
        x.append(binned(batch["values"].flatten().to_numpy().reshape(-1, len(cuts)), bins.ends))
    x, label = np.concatenate(x), np.concatenate(label)
    margin = np.full(len(label), start)
    for tree in trees:
        margin += tree.weight[tree.leaves(x, growth.depth)]
    made = []
    for _ in range(rounds):
        tree = growth.tree(x, margin - label, bins, lambda sums: exchanged(sums, context))
        margin += tree.weight[tree.leaves(x, growth.depth)]
        made.append(tree.text())
    if context.partitionId() == 0:
        yield pa.RecordBatch.from_pydict({"tree": made})


class HistogramBoostingModel(Model, _BoostingParams, DefaultParamsReadable, DefaultParamsWritable):
    fitted = Param(Params._dummy(), "fitted", "start, cut points and trees as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", predictionCol="prediction", depth=6, fitted=None):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction", depth=6)
        self._set(**self._input_kwargs)

    def parsed(self) -> tuple[float, list[list[float]], list[Tree]]:
        raw = json.loads(self.getOrDefault(self.fitted))
        return raw["start"], raw["cuts"], [Tree.parsed(t) for t in raw["trees"]]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        start, cuts, trees = self.parsed()
        depth, ends = self.getOrDefault(self.depth), [np.array(c, np.float64) for c in cuts]

        @F.pandas_udf(DoubleType())
        def predict(values: pd.Series) -> pd.Series:
            x = binned(np.array(values.tolist(), np.float64).reshape(len(values), len(ends)), ends)
            return pd.Series(sum((t.weight[t.leaves(x, depth)] for t in trees), np.full(len(values), start)))

        return dataset.withColumn(self.getPredictionCol(), predict(vector_to_array(self.getFeaturesCol())))
