"""Deep random forests on many rows (F6): trees grown in two phases, kept and scored as a table with one row a tree.

MLlib builds a histogram for every node of every tree, down to nodes of a handful of rows: 18 kB a node (6 features, 128 bins), for
millions of nodes, from each partition. Here that is done for nodes of more than ``SMALL`` rows alone. The rows of a smaller
node are shuffled to one group, which grows the rest of its branch: by histograms while its nodes have as many rows as there are bins, then by
sorting them, so the work of a level is that of its rows. Trees are dealt in waves: no more than ``WAVE`` bytes of rows wait in the shuffle at once.

The forest is the one that is configured: Poisson(1) bags, all features at every node, at most ``maxBins`` bins a
feature, weighted variance, ``minInstancesPerNode`` counted in bagged rows, splits of positive gain. Its random numbers are not MLlib's, so
trees differ as by another seed; they depend on the seed, the rows and their partitions, not on the cluster. Cuts
are taken from ``CUT_ROWS`` rows of least hash, as MLlib takes them from a sample; every row is binned, bagged and learned from.

The driver holds the nodes above ``SMALL`` rows (some ``rows * trees / SMALL``), a task the rows of a partition or of one
such node. Scoring reads the trees a few at a time, for blocks of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

SMALL = 2_000_000  # rows of a node that one task grows on
WAVE = 8e9  # bytes of rows dealt to branches at once
AT_ONCE = 16_384  # rows of a branch that are added to histograms at once
REGROUP = 2  # levels after which the rows of a branch are put in the order of its nodes
DENSE = 0.5  # rows for each bin of a node from which on histograms are made
MLLIB_LEAVES = 1_000_000  # leaves that MLlib's own forest is left with
BLOCK = 65_536
CUT_ROWS = 65_536
LEAST_GAIN = 1e-10  # of a node's sum of squares: what rounding alone can give
TREE = "tree int, feature array<int>, threshold array<double>, left array<int>, value array<double>"


def many_leaves(est, rows: int) -> bool:
    """Whether the forest may have more leaves than MLlib's histograms are good for."""
    return est.getNumTrees() * min(2.0 ** est.getMaxDepth(), rows / max(1, est.getMinInstancesPerNode())) > MLLIB_LEAVES


# -------------------------------------------------------------- one branch


def best_cuts(at, order, cols, c, cw, cs, n, w, s, least: int):
    """(feature, bin, gain) of the best split of each node; ``order`` has the rows of each feature by (node, bin), ``cols`` their bins, -1 where there is none."""
    m = len(n)
    feature, cut, gain = np.full(m, -1, np.int32), np.zeros(m, np.int32), np.zeros(m)
    own = s * s / w
    floor = LEAST_GAIN * (own + 1)
    before = [np.concatenate(([0], np.cumsum(t)))[:-1] for t in (n, w, s)]
    for f, o in enumerate(order):
        a, b = at[o], cols[f][o]
        ends = np.flatnonzero((a[1:] == a[:-1]) & (b[1:] != b[:-1]))  # the last row of a bin that has others of its node behind it
        if not len(ends):
            continue
        k = a[ends]
        nl, wl, sl = (np.cumsum(t[o])[ends] - z[k] for t, z in zip((c, cw, cs), before, strict=True))
        ok = (nl >= least) & (n[k] - nl >= least)
        ends, k, wl, sl = ends[ok], k[ok], wl[ok], sl[ok]
        if not len(ends):
            continue
        g = sl * sl / wl + (s[k] - sl) ** 2 / (w[k] - wl) - own[k]
        starts = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1])))
        top = np.full(m, -np.inf)
        top[k[starts]] = np.maximum.reduceat(g, starts)
        first = np.flatnonzero(g == top[k])[::-1]
        won = np.zeros(m, np.int64)
        won[k[first]] = ends[first]
        better = np.flatnonzero((top > floor) & (top > gain))
        feature[better], cut[better], gain[better] = f, b[won[better]], top[better]
    return feature, cut, gain


def dense_cuts(at, nb: int, cols, c, cw, cs, n, w, s, least: int):
    """The same, from histograms of ``nb`` bins of each node."""
    m = len(n)
    feature, cut, gain = np.full(m, -1, np.int32), np.zeros(m, np.int32), np.zeros(m)
    own = s * s / w
    floor = LEAST_GAIN * (own + 1)
    n, w, s = n[:, None], w[:, None], s[:, None]
    runs = [slice(i, i + AT_ONCE) for i in range(0, len(at), AT_ONCE)]
    spans = [(int(at[r].min()), int(at[r].max()) + 1) for r in runs]
    for f, bins in enumerate(cols):
        h = np.zeros((3, m * nb))
        for r, (low, high) in zip(runs, spans, strict=True):
            k = (at[r] - low).astype(np.int64) * nb + bins[r]
            for i, t in enumerate((c, cw, cs)):
                h[i, low * nb : high * nb] += np.bincount(k, t[r], (high - low) * nb)
        nl, wl, sl = np.cumsum(h.reshape(3, m, nb), axis=2)
        ok = (nl >= least) & (n - nl >= least)
        with np.errstate(divide="ignore", invalid="ignore"):
            g = np.where(ok, sl * sl / wl + (s - sl) ** 2 / (w - wl) - own[:, None], -np.inf)
        won = np.argmax(g, axis=1)
        top = g[np.arange(m), won]
        better = np.flatnonzero((top > floor) & (top > gain))
        feature[better], cut[better], gain[better] = f, won[better], top[better]
    return feature, cut, gain


def _short(at: np.ndarray, m: int) -> np.ndarray:
    return at.astype(np.uint16 if m < 65_536 else np.int32)  # short keys are sorted by radix


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, c: np.ndarray, depth: int, least: int):
    """A branch of at most ``depth`` levels: (feature or -1, bin, left child, value) of its nodes; the right child follows the left one."""
    c = c.astype(float)
    cw = c * w
    middle = float((cw * y).sum() / cw.sum())
    cs = cw * (y - middle)
    at = np.zeros(len(y), np.int32)
    cols, nb = np.ascontiguousarray(bins.T), int(bins.max(initial=0)) + 1
    order = None  # made once nodes are too small for histograms
    parts, first, m = [], 0, 1
    for level in range(depth + 1):
        n, ww, ss = (np.bincount(at, t, m) for t in (c, cw, cs))
        feature, cut = np.full(m, -1, np.int32), np.zeros(m, np.int32)
        if level < depth and order is None and m * nb * DENSE <= len(at):
            feature, cut, _ = dense_cuts(at, nb, cols, c, cw, cs, n, ww, ss, least)
        elif level < depth:
            if order is None:
                node = _short(at, m)
                order = [np.argsort(col, kind="stable") for col in cols]
                order = [o[np.argsort(node[o], kind="stable")] for o in order]
            feature, cut, _ = best_cuts(at, order, cols, c, cw, cs, n, ww, ss, least)
        inner = feature >= 0
        rank = np.cumsum(inner) - 1
        parts.append((feature, cut, np.where(inner, first + m + 2 * rank, -1).astype(np.int32), middle + ss / ww))
        first, m = first + m, 2 * int(inner.sum())
        if not m:
            break
        kept = inner[at]
        if not kept.all():
            if order is not None:
                moved = np.cumsum(kept) - 1
                order = [moved[o[kept[o]]] for o in order]
            cols, c, cw, cs, at = cols[:, kept], c[kept], cw[kept], cs[kept], at[kept]
        right = cols.ravel()[feature[at] * np.int64(len(at)) + np.arange(len(at))] > cut[at]
        at = (2 * rank[at] + right).astype(np.int32)
        if order is None and level % REGROUP == REGROUP - 1:  # a node's rows together, in their order: its histogram stays in the cache
            by = np.argsort(_short(at, m), kind="stable")
            cols, c, cw, cs, at = np.stack([col[by] for col in cols]), c[by], cw[by], cs[by], at[by]
        if order is not None:
            node = _short(at, m)
            order = [o[np.argsort(node[o], kind="stable")] for o in order]
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


# ------------------------------------------------------------- all branches


def _cuts(rows: DataFrame, most: int) -> list[np.ndarray]:
    """The thresholds of each feature: between all values if they are few, else at equal steps of weight."""
    some = rows.select(F.col("x"), "w").orderBy(F.xxhash64("x", "label"), "x").limit(CUT_ROWS).toArrow()
    x, w = _matrix(some["x"].combine_chunks()), some["w"].to_numpy()
    out = []
    for col in x.T:
        v, at = np.unique(col, return_inverse=True)
        middles = (v[1:] + v[:-1]) / 2
        if len(v) > most:
            share = np.cumsum(np.bincount(at, w, len(v)))[:-1] / w.sum()
            middles = middles[np.unique(np.searchsorted(share, np.arange(1, most) / most).clip(0, len(middles) - 1))]
        out.append(middles)
    return out


def _matrix(x: pa.Array) -> np.ndarray:
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def _blocks(rows: DataFrame, cuts: list[np.ndarray]) -> DataFrame:
    """The binned rows, ``BLOCK`` at a time: (part, block, bins, y, w), the same blocks whatever the batches were."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block, held = TaskContext.get().partitionId(), 0, []

        def one(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal block, held
            while held and (last or sum(len(h[1]) for h in held) >= BLOCK):
                bins, y, w = (np.concatenate(p) for p in zip(*held, strict=True))
                held = [(bins[BLOCK:], y[BLOCK:], w[BLOCK:])] if len(y) > BLOCK else []
                bins, y, w = bins[:BLOCK], y[:BLOCK], w[:BLOCK]
                yield pa.RecordBatch.from_pylist([{"part": part, "block": block, "bins": bins.tobytes(), "y": y.tobytes(), "w": w.tobytes()}], pa.schema([("part", pa.int32()), ("block", pa.int32()), ("bins", pa.binary()), ("y", pa.binary()), ("w", pa.binary())]))
                block += 1

        for b in batches:
            if b.num_rows:
                x = _matrix(b.column("x"))
                bins = np.stack([np.searchsorted(t, x[:, f], side="left") for f, t in enumerate(cuts)], axis=1).astype(np.uint8)
                held.append((bins, b.column("label").to_numpy(), b.column("w").to_numpy()))
                yield from one(False)
        yield from one(True)

    return rows.mapInArrow(pack, "part int, block int, bins binary, y binary, w binary")


def _unpacked(batches: Iterator[pa.RecordBatch], d: int) -> list[tuple]:
    """(part, block, bins, y, w) of the blocks of a partition."""
    return [(r["part"], r["block"], np.frombuffer(r["bins"], np.uint8).reshape(-1, d), np.frombuffer(r["y"]), np.frombuffer(r["w"])) for b in batches for r in b.to_pylist()]


_SHARES = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])  # of a Poisson(1) number's values
_LOW, _HIGH = (np.searchsorted(_SHARES, np.arange(z, z + 65_536) / 65_536, side=e) for z, e in ((0, "right"), (1, "left")))
_DRAWN = np.where(_LOW == _HIGH, _LOW, 255).astype(np.uint8)  # 255 where 16 bits do not tell


def _bag(seed: int, tree: int, part: int, block: int, n: int) -> np.ndarray:
    """How often each row is in the tree's bag: Poisson(1) numbers, by the inverse of their distribution."""
    rng = np.random.default_rng([seed & 0xFFFFFFFF, tree, part, block])
    u = rng.integers(0, 65_536, n, np.uint16)
    c = _DRAWN[u]
    open_ = np.flatnonzero(c == 255)
    c[open_] = np.searchsorted(_SHARES, (u[open_] + rng.random(len(open_))) / 65_536, side="right")
    return c


class _Top:
    """The nodes of one tree that have more than ``SMALL`` rows, and those right below them: ``open`` are to be split next, ``branches`` are small."""

    def __init__(self, small: bool):
        self.feature, self.cut, self.left, self.value, self.depth = [-1], [0], [-1], [0.0], [0]
        self.open, self.branches = ([], [0]) if small else ([0], [])

    def split(self, node: int, feature: int, cut: int, value: float, below: tuple[float, float], most: int, small: int) -> None:
        """What has been found for an open node: a split with so many rows on either side, or (feature -1) that it is a leaf."""
        self.value[node] = value
        if feature < 0:
            return
        self.feature[node], self.cut[node], self.left[node] = feature, cut, len(self.feature)
        for n in below:
            child = len(self.feature)
            for have, new in ((self.feature, -1), (self.cut, 0), (self.left, -1), (self.value, 0.0), (self.depth, self.depth[node] + 1)):
                have.append(new)
            (self.open if n > small and self.depth[child] < most else self.branches).append(child)

    def arrays(self) -> tuple:
        return tuple(np.array(v, np.int32) for v in (self.feature, self.cut, self.left))


def _descend(top: tuple, bins: np.ndarray) -> np.ndarray:
    feature, cut, left = top
    at = np.zeros(len(bins), np.int32)
    while (inner := np.flatnonzero(feature[at] >= 0)).size:
        a = at[inner]
        at[inner] = left[a] + (bins[inner, feature[a]] > cut[a])
    return at


def _split_open(blocks: DataFrame, tops: list[_Top], d: int, nb: int, seed: int, least: int) -> list:
    """The best split of every open node, from the histograms of all its rows: (tree, node, feature, cut, value, left, right)."""
    trees = {t: (top.arrays(), top.open) for t, top in enumerate(tops) if top.open}

    def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _unpacked(batches, d)
        for tree, (top, nodes) in trees.items():
            slot = np.full(len(top[0]), -1, np.int64)
            slot[nodes] = np.arange(len(nodes))
            h = np.zeros((len(nodes), 3, d, nb))
            for part, block, bins, y, w in held:
                c = _bag(seed, tree, part, block, len(y))
                k = slot[_descend(top, bins)]
                on = (k >= 0) & (c > 0)
                k, b, cc = k[on], bins[on], c[on].astype(float)
                cw = cc * w[on]
                cs = cw * y[on]
                for f in range(d):
                    at = k * nb + b[:, f]
                    for i, t in enumerate((cc, cw, cs)):
                        h[:, i, f] += np.bincount(at, t, len(nodes) * nb).reshape(-1, nb)
            yield pa.RecordBatch.from_arrays([pa.array([tree] * len(nodes), pa.int32()), pa.array(nodes, pa.int32()), pa.array([x.tobytes() for x in h], pa.binary())], names=["tree", "node", "h"])

    def choose(key: tuple, t: pa.Table) -> pa.Table:
        parts = sorted(x.as_py() for x in t["h"])  # the same sums in whatever order they come
        h = np.sum([np.frombuffer(x).reshape(3, d, nb) for x in parts], axis=0)
        n, w, s = h[:, 0].sum(axis=1)
        nl, wl, sl = np.cumsum(h, axis=2)
        ok = (nl >= least) & (n - nl >= least)
        with np.errstate(divide="ignore", invalid="ignore"):
            g = np.where(ok, sl * sl / wl + (s - sl) ** 2 / (w - wl) - s * s / w, -np.inf)
        f, b = np.unravel_index(int(np.argmax(g)), g.shape)
        found = bool(g[f, b] > LEAST_GAIN * (s * s / w + 1))
        row = (key[0].as_py(), key[1].as_py(), int(f) if found else -1, int(b), float(s / w), float(nl[f, b]), float(n - nl[f, b]))
        return pa.table([[v] for v in row], schema=pa.schema([("tree", pa.int32()), ("node", pa.int32()), ("feature", pa.int32()), ("cut", pa.int32()), ("value", pa.float64()), ("nl", pa.float64()), ("nr", pa.float64())]))

    cores = blocks.sparkSession.sparkContext.defaultParallelism
    sums = blocks.coalesce(max(8, cores)).mapInArrow(histograms, "tree int, node int, h binary").repartition(4 * cores, "tree", "node")
    return sums.groupBy("tree", "node").applyInArrow(choose, "tree int, node int, feature int, cut int, value double, nl double, nr double").collect()  # a row for each open node


def fit(rows: DataFrame, est, path: str, small: int = SMALL) -> GrownForest:
    """The forest that ``est`` (a RandomForestRegressor with all features at a node) configures, on (features, label, w), as a table at ``path``."""
    from pyspark.ml.functions import vector_to_array

    if est.getFeatureSubsetStrategy() not in ("all", "1.0") or est.getSubsamplingRate() != 1.0 or not est.getBootstrap() or not 0 <= est.getMaxDepth() <= 30 or est.getMaxBins() > 256:
        raise ValueError("a forest of bagged trees on all features, of at most 30 levels and 256 bins")
    spark, trees, depth, least, seed = rows.sparkSession, est.getNumTrees(), est.getMaxDepth(), est.getMinInstancesPerNode(), est.getSeed()
    rows = rows.select(vector_to_array("features").alias("x"), "label", "w")
    cuts = _cuts(rows, est.getMaxBins())
    d, nb = len(cuts), max(len(t) for t in cuts) + 1
    blocks = _blocks(rows, cuts).cache()
    try:
        total = blocks.agg(F.sum(F.octet_length("y") / 8)).first()[0]
        tops = [_Top(total <= small) for _ in range(trees)]
        while any(t.open for t in tops):
            found = _split_open(blocks, tops, d, nb, seed, least)
            for t in tops:
                t.open = []
            for r in sorted(found):
                tops[r.tree].split(r.node, r.feature, r.cut, r.value, (r.nl, r.nr), depth, small)
        wave = max(1, int(WAVE / max(1.0, total * (1 - math.exp(-1)) * (d + 17))))
        for t in range(0, trees, wave):
            _branches(blocks, tops, range(t, min(t + wave, trees)), cuts, seed, depth, least).write.mode("append").parquet(path)
    finally:
        blocks.unpersist()
    return GrownForest(spark, path)


def _branches(blocks: DataFrame, tops: list[_Top], wave: range, cuts: list[np.ndarray], seed: int, depth: int, least: int) -> DataFrame:
    """The whole trees of a wave: each small node's rows go to one group, which grows its branch; a tree's branches are put below its top."""
    d, before = len(cuts), np.cumsum([0, *map(len, cuts)])
    shapes = {t: (tops[t].arrays(), sorted(tops[t].branches)) for t in wave}
    levels = {t: tops[t].depth for t in wave}
    values = {t: tops[t].value for t in wave}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _unpacked(batches, d)
        for part, block, bins, y, w in held:
            for tree, (top, nodes) in shapes.items():
                c = _bag(seed, tree, part, block, len(y))
                at = _descend(top, bins)
                on = np.flatnonzero(c)
                on = on[np.argsort(_short(at, len(top[0]))[on], kind="stable")]
                low, high = (np.searchsorted(at[on], nodes, side=s) for s in ("left", "right"))
                cols = [[z[on[i:j]].tobytes() for i, j in zip(low, high, strict=True)] for z in (bins, y, w, c)]
                yield pa.RecordBatch.from_arrays([pa.array([z] * len(nodes), pa.int32()) for z in (tree, part, block)] + [pa.array(nodes, pa.int32())] + [pa.array(z, pa.binary()) for z in cols], names=["tree", "part", "block", "node", "bins", "y", "w", "c"])

    def branch(key: tuple, t: pa.Table) -> pa.Table:
        tree, node = key[0].as_py(), key[1].as_py()
        t = t.sort_by([("part", "ascending"), ("block", "ascending")])
        bins, y, w, c = (np.frombuffer(b"".join(t[z].to_pylist()), k) for z, k in (("bins", np.uint8), ("y", float), ("w", float), ("c", np.uint8)))
        if not len(y):
            raise ValueError(f"tree {tree}: node {node} has no rows")
        feature, cut, left, value = grow(bins.reshape(-1, d), y, w, c, depth - levels[tree][node], least)
        return pa.table({"tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int32()), **{z: pa.array([v], k) for z, v, k in (("feature", feature, I32), ("cut", cut, I32), ("left", left, I32), ("value", value, F64))}})

    def whole(key: tuple, t: pa.Table) -> pa.Table:
        tree = key[0].as_py()
        cols = [[np.array(v)] for v in (*shapes[tree][0], values[tree])]
        have = len(values[tree])
        t = t.sort_by("node").combine_chunks()
        for i, node in enumerate(t["node"].to_pylist()):
            part = [t[z][i].values.to_numpy() for z in ("feature", "cut", "left", "value")]
            part[2] = np.where(part[2] > 0, part[2] + have - 1, -1)  # a branch's root takes the place of the node; the others follow
            for all_, p in zip(cols, part, strict=True):
                all_[0][node] = p[0]
                all_.append(p[1:])
            have += len(part[0]) - 1
        feature, cut, left, value = (np.concatenate(z) for z in cols)
        threshold, inner = np.zeros(len(feature)), feature >= 0
        threshold[inner] = np.concatenate(cuts)[before[feature[inner]] + cut[inner]]
        return pa.table({"tree": pa.array([tree], pa.int32()), **{z: pa.array([v], k) for z, v, k in (("feature", feature, I32), ("threshold", threshold, F64), ("left", left, I32), ("value", value, F64))}})

    cores = blocks.sparkSession.sparkContext.defaultParallelism
    many = sum(len(nodes) for _, nodes in shapes.values())
    dealt = blocks.mapInArrow(deal, "tree int, part int, block int, node int, bins binary, y binary, w binary, c binary").repartition(max(1, min(many, max(16 * cores, many // 8))), "tree", "node")
    grown = dealt.groupBy("tree", "node").applyInArrow(branch, "tree int, node int, feature array<int>, cut array<int>, left array<int>, value array<double>")
    tops_alone = [t for t, (_, nodes) in shapes.items() if not nodes]  # trees that are whole already
    if tops_alone:
        empty = blocks.sparkSession.createDataFrame([(t,) for t in tops_alone], "tree int").select("tree", *[F.lit(None).cast(k).alias(z) for z, k in (("node", "int"), ("feature", "array<int>"), ("cut", "array<int>"), ("left", "array<int>"), ("value", "array<double>"))])
        grown = grown.unionByName(empty)
    return grown.repartition(min(len(wave), 2 * cores), "tree").groupBy("tree").applyInArrow(lambda key, t: whole(key, t.filter(pa.compute.is_valid(t["node"]))), TREE)


I32, F64 = pa.list_(pa.int32()), pa.list_(pa.float64())

# ------------------------------------------------------------------- model


@dataclass(frozen=True)
class GrownForest:
    """A stored forest: ``path`` has a row for each tree. Executors must be able to read it."""

    spark: SparkSession
    path: str

    def trees(self) -> DataFrame:
        return self.spark.read.schema(TREE).parquet(self.path)

    def nodes(self) -> DataFrame:
        """The node table of ``trees.score_nodes``."""
        n = self.trees().select("tree", F.posexplode(F.arrays_zip("feature", "threshold", "left", "value")).alias("node", "n"))
        inner = lambda c: F.when(F.col("n.feature") >= 0, c)
        return n.select("tree", F.lit(1.0).alias("weight"), "node", inner(F.col("n.feature")).alias("feature"), inner(F.col("n.threshold")).alias("threshold"), inner(F.col("n.left")).alias("left_child"), inner(F.col("n.left") + 1).alias("right_child"), F.col("n.value").alias("value"))

    def write(self) -> GrownForest:
        return self

    def save(self, path: str) -> None:
        self.trees().write.parquet(path)

    @classmethod
    def load(cls, path: str) -> GrownForest:
        spark = SparkSession.getActiveSession()
        spark.read.schema(TREE).parquet(path)  # raises if it is not there
        return cls(spark, path)

    def score(self, df: DataFrame, features, out: str) -> DataFrame:
        """``df`` with the mean (boosting: the sum) of the trees' values; a missing feature is an error, as it is to MLlib's assembler."""
        path, names, mean, schema = self.path, list(features), not isinstance(self, BoostedTrees), StructType([*df.schema.fields, StructField(out, DoubleType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            for b in batches:
                held.append(b)
                if sum(h.num_rows for h in held) >= BLOCK:
                    yield from _scored(held, names, path, out, mean)
                    held = []
            if any(h.num_rows for h in held):
                yield from _scored(held, names, path, out, mean)

        # a small file is read in one task, but its rows times the trees are work for all
        return df.repartition(2 * self.spark.sparkContext.defaultParallelism).mapInArrow(run, schema)


@dataclass(frozen=True)
class BoostedTrees(GrownForest):
    """A stored boosted ensemble: the values are those of the trees times their weights, so their sum is the score."""


def _levels(leaf: np.ndarray, left: np.ndarray) -> int:
    """Levels below the root of a tree."""
    levels, nodes = 0, np.zeros(1, np.int64)
    while (nodes := nodes[~leaf[nodes]]).size:
        levels, nodes = levels + 1, np.concatenate([left[nodes], left[nodes] + 1])
    return levels


def _scored(held: list[pa.RecordBatch], names: list[str], path: str, out: str, mean: bool) -> Iterator[pa.RecordBatch]:
    import pyarrow.dataset as ds
    from pyarrow import fs

    t = pa.Table.from_batches(held)
    x = np.stack([t[c].cast(pa.float64()).to_numpy() for c in names], axis=1)
    if np.isnan(x).any():
        raise ValueError("a feature is null or NaN")
    where, at_path = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
    total, count, d = np.zeros(len(x)), 0, x.shape[1]
    flat, row = x.ravel(), np.arange(len(x)) * d
    found = []
    for b in ds.dataset(at_path, filesystem=where, format="parquet").to_batches(batch_size=8, fragment_readahead=1, batch_readahead=1):
        for i in range(b.num_rows):
            tree, feature, threshold, left, value = b["tree"][i].as_py(), *(b[c][i].values.to_numpy() for c in ("feature", "threshold", "left", "value"))
            leaf = feature < 0  # a row at a leaf stays there
            child, feature, threshold = np.where(leaf, np.arange(len(left)), left), np.where(leaf, 0, feature), np.where(leaf, np.inf, threshold)
            at = np.zeros(len(x), np.int64)
            for _ in range(_levels(leaf, left)):
                at = child[at] + (flat[row + feature[at]] > threshold[at])
            found.append(tree)
            total += value[at]
            count += 1
    if count == 0 or len(set(found)) != count:
        raise ValueError(f"not a forest: {path}")
    score = pa.chunked_array([pa.array(total / count if mean else total)])
    yield from t.append_column(out, score).to_batches()
