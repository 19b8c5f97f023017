"""Boosted trees on many rows (F7): one barrier stage whose tasks keep their binned rows over all rounds and exchange histograms.

MLlib starts a job for each level of each tree and passes over all rows as objects in it. Here a stage's tasks run together: each bins its
rows once (a byte a feature) and keeps them with their residuals, 15 bytes a row of 6 features. For a level they add up histograms of the open
nodes' rows, tell them to each other (2 doubles for each node, feature and bin), and all find the same splits from the same sums. At
the end the first task writes the trees.

They tell each other by small files in the shared folder, of which each task keeps two: the stage's ``allGather`` takes a second, whatever it
carries, and 300 trees of 4 levels need 1,200 exchanges.

The trees are those of MLlib: squared loss, whose negative gradient is twice the residual, a first tree of weight 1 and others of
``stepSize``; splits by variance, ``minInstancesPerNode`` rows at least, positive gain. Only the cuts differ, since both take them from a
sample: here the ``CUT_ROWS`` rows of least hash. Every row is binned and learned from in every round. The number of tasks alters no more
than the order in which sums are taken.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.forest import BLOCK, F64, I32, LEAST_GAIN, TREE, BoostedTrees, _cuts, _matrix

MANY_ROWS = 200_000  # rows up to which MLlib's own ensemble is fitted
MOST_TASKS = 64  # each task gets the histograms of all
TASK_ROWS = 50_000


def many_rows(est, rows: int, spark: SparkSession) -> bool:
    """Whether ``est`` (a GBTRegressor) is to be fitted here: enough rows, a configuration that is the same here, and tasks that can run together."""
    comes_and_goes = spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true"
    plain = est.getSubsamplingRate() == 1.0 and est.getFeatureSubsetStrategy() in ("all", "1.0") and est.getLossType() == "squared" and est.getMinInfoGain() == 0.0
    small = 1 <= est.getMaxDepth() <= 6 and est.getMaxBins() <= 256
    return rows > MANY_ROWS and plain and small and not comes_and_goes and not est.isSet("weightCol") and not est.isSet("validationIndicatorCol")


def fit(rows: DataFrame, est, path: str, count: int) -> BoostedTrees:
    """The ensemble that ``est`` configures, on (features, label), as a table at ``path``."""
    from pyspark.ml.functions import vector_to_array

    spark = rows.sparkSession
    rows = rows.select(vector_to_array("features").alias("x"), "label")
    cuts = _cuts(rows.withColumn("w", F.lit(1.0)), est.getMaxBins())
    slots = spark.sparkContext.defaultParallelism // int(spark.conf.get("spark.task.cpus", "1"))
    tasks = max(1, min(slots, MOST_TASKS, count // TASK_ROWS))
    run = _rounds(f"{path}-told", tasks, cuts, est.getMaxIter(), est.getStepSize(), est.getMaxDepth(), est.getMinInstancesPerNode())
    # a stage that ends in a shuffle is run again if a task fails; one that ends in a write is not
    rows.repartition(tasks).mapInArrow(run, TREE, barrier=True).repartition(1).write.parquet(path)
    return BoostedTrees(spark, path)


class _Talk:
    """Sums of arrays over the tasks of a stage: each task writes its own and reads those of all, in the same order."""

    def __init__(self, path: str, task: int, tasks: int):
        from pyarrow import fs

        self.fs, self.path = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
        self.task, self.tasks, self.n = task, tasks, 0
        self.fs.create_dir(self.path, recursive=True)

    def _file(self, n: int, task: int) -> str:
        return f"{self.path}/{n}-{task}"

    def total(self, h: np.ndarray) -> np.ndarray:
        if self.n > 1:
            self.fs.delete_file(self._file(self.n - 2, self.task))  # all have read it, since all have written the one after it
        own = self._file(self.n, self.task)
        with self.fs.open_output_stream(f"{own}.part") as f:
            f.write(h.tobytes())
        self.fs.move(f"{own}.part", own)
        out = np.zeros_like(h)
        for t in range(self.tasks):
            out += np.frombuffer(self._read(self._file(self.n, t))).reshape(h.shape)
        self.n += 1
        return out

    def _read(self, name: str) -> bytes:
        wait = 0.001
        while True:
            try:
                with self.fs.open_input_stream(name) as f:
                    return f.read()
            except FileNotFoundError:  # not written yet; if that task has failed, Spark ends this one too
                time.sleep(wait)
                wait = min(0.05, 1.5 * wait)


def _rounds(told: str, tasks: int, cuts: list[np.ndarray], trees: int, rate: float, depth: int, least: int):
    d, nb = len(cuts), max(len(t) for t in cuts) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import BarrierTaskContext

        context = BarrierTaskContext.get()
        held = _binned(batches, cuts)
        folder = context.allGather(uuid.uuid4().hex)[0]  # another one if Spark runs the stage again
        talk = _Talk(f"{told}/{folder}", context.partitionId(), tasks)

        made = []
        for t in range(trees):
            feature, cut, left, mean = _tree(held, talk.total, d, nb, depth, least)
            value = mean * (1.0 if t == 0 else 2.0 * rate)
            for _, r, at in held:
                r -= value[at]
                at[:] = 0
            threshold = [cuts[f][b] if f >= 0 else 0.0 for f, b in zip(feature, cut, strict=True)]
            made.append((t, feature, threshold, left, value))
        if context.partitionId() == 0:
            kinds = (("tree", pa.int32()), ("feature", I32), ("threshold", F64), ("left", I32), ("value", F64))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(zip(*made, strict=True), kinds, strict=True)], names=[c for c, _ in kinds])

    return run


def _binned(batches: Iterator[pa.RecordBatch], cuts: list[np.ndarray]) -> list[tuple]:
    """(bins by feature, residual, node) of a task's rows, ``BLOCK`` or fewer at a time."""
    held, some = [], []

    def close() -> None:
        bins, y = (np.concatenate(p, axis=-1) for p in zip(*some, strict=True))
        held.append((bins, y, np.zeros(len(y), np.uint8)))
        some.clear()

    for b in batches:
        if not b.num_rows:
            continue
        x, y = _matrix(b.column("x")), b.column("label").to_numpy(zero_copy_only=False).astype(float)
        if np.isnan(x).any() or np.isnan(y).any():
            raise ValueError("a feature or label is null or NaN")
        if some and sum(len(s[1]) for s in some) + len(y) > BLOCK:
            close()
        some.append((np.stack([np.searchsorted(t, x[:, f], side="left") for f, t in enumerate(cuts)]).astype(np.uint8), y))
    if some:
        close()
    return held


def _tree(held: list[tuple], total, d: int, nb: int, depth: int, least: int):
    """One tree of all tasks' rows: (feature or -1, bin, left child, mean) of its nodes; leaves each row at its leaf."""
    feature, cut, left, mean = [-1], [0], [-1], [0.0]
    nodes = [0]  # to be split
    for level in range(depth):
        h = total(_histograms(held, nodes, len(feature), d, nb))
        n, s = (h[:, i, 0].sum(axis=1) for i in (0, 1))
        nl, sl = (np.cumsum(h[:, i], axis=2) for i in (0, 1))
        n_, s_ = n[:, None, None], s[:, None, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            own = np.where(n > 0, s * s / n, 0.0)
            gain = sl * sl / nl + (s_ - sl) ** 2 / (n_ - nl) - own[:, None, None]
        gain = np.where((nl >= max(1, least)) & (n_ - nl >= max(1, least)), gain, -np.inf)
        below = []
        for i, node in enumerate(nodes):
            if level == 0 and n[i]:
                mean[node] = float(s[i] / n[i])
            f, b = np.unravel_index(int(np.argmax(gain[i])), (d, nb))
            if gain[i, f, b] > LEAST_GAIN * (own[i] + 1):
                child = len(feature)
                feature[node], cut[node], left[node] = int(f), int(b), child
                feature += [-1, -1]
                cut += [0, 0]
                left += [-1, -1]
                mean += [float(sl[i, f, b] / nl[i, f, b]), float((s[i] - sl[i, f, b]) / (n[i] - nl[i, f, b]))]
                below += [child, child + 1]
        if not below:
            break
        _move(held, np.array(feature), np.array(cut), np.array(left), nodes)
        nodes = below
    return feature, cut, left, np.array(mean)


def _histograms(held: list[tuple], nodes: list[int], size: int, d: int, nb: int) -> np.ndarray:
    """(node, rows and sum of residuals, feature, bin) of a task's rows."""
    first = np.full(size, len(nodes) * nb, np.int64)  # rows of other nodes go behind
    first[nodes] = np.arange(len(nodes)) * nb
    h = np.zeros((2, d, (len(nodes) + 1) * nb))
    for bins, r, at in held:
        base = first[at]
        for f in range(d):
            k = base + bins[f]
            h[0, f] += np.bincount(k, minlength=h.shape[2])
            h[1, f] += np.bincount(k, r, h.shape[2])
    return np.ascontiguousarray(h.reshape(2, d, -1, nb)[:, :, : len(nodes)].transpose(2, 0, 1, 3))


def _move(held: list[tuple], feature: np.ndarray, cut: np.ndarray, left: np.ndarray, nodes: list[int]) -> None:
    """Sends the rows of the nodes that were split to their children."""
    split = np.zeros(len(feature), bool)
    split[[i for i in nodes if feature[i] >= 0]] = True
    for bins, _, at in held:
        row = np.arange(len(at))
        where = np.where(split, feature, 0)[at] * len(at) + row
        right = bins.ravel()[where] > np.where(split, cut, 255)[at]  # no bin is above 255
        at[:] = np.where(split, left, np.arange(len(feature)))[at] + right
