"""Hard negatives of anchors by rotated one-bit codes and integer scores.

Components become the integers floor(``scale`` * x); a score is an inner product of two such
vectors. A vector v is rotated (rounds of signs and Walsh-Hadamard transforms, the same for all) and
stored with its signs as a one-bit code, c = signs / sqrt(D), and its alignment a = <v, c>. What is left, v - a c, is coded in the same way
by its own signs after a further rotation, ``LAYERS`` times in all: v = sum a_k c_k + r, where the rest r is orthogonal to the last code and its length is stored.
Each layer leaves some six tenths of the length before it.

An anchor q is rotated too and cut to ``PLANES`` bit planes, so each t_k = <q, c_k> is estimated by counting the
bits that its planes and a code share; e_k is the length of what the cut left over. Since r sees only the part of q
orthogonal to the last code, Cauchy-Schwarz gives

    |<q, v> - sum a_k t_k|  <=  |r| sqrt(|q|^2 - t^2) + sum a_k e_k

without any probability. Rows whose interval cannot reach what is asked for are left out; the
integer scores of all others decide, so results are exact.

Two searches: the ``positives`` best other rows of an anchor's label, then for each of them, with score p, the
``negatives`` best rows of other labels whose score n has low * p <= 100 * n <= high * p. Both deal rows and
anchors to chunks of bounded size by a hash (the first within a label), compare every chunk of anchors with every
chunk of rows, and merge the few best of each; the anchors are the stated query set, so work is anchors times rows.

Defined cases: rows with a null id or label, a null vector, or a null or non-finite component take no part;
repeated rows count once, and different rows of one id are rows of their own (an id may be returned for
another row of the same id); vectors of other lengths are not compared; higher scores come first, ties by smaller id,
then by the vector's bytes; integers and scores beyond 64 bits stop at the ends of their range; an anchor
without positives, or a positive without negatives, gives no row. Only the named columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved, table

PLANES = 8
LAYERS = 4
MOST = 2**63 - 1
EDGE = 2.0**63 - 1024  # the last double that fits 64 bits


@lru_cache(maxsize=32)
def rotation(dim: int, layer: int = 0) -> np.ndarray:
    """An isometry of ``dim`` axes into the next power of two, as a matrix to multiply with from the right; one for each layer."""
    size = 1 << max(0, dim - 1).bit_length()
    h = np.ones((1, 1))
    while len(h) < size:
        h = np.block([[h, h], [h, -h]]) / math.sqrt(2)
    signs = np.random.RandomState(20_113 + layer).randint(0, 2, (3, size)) * 2.0 - 1
    out = np.eye(dim, size)
    for s in signs:
        out = (out * s) @ h
    return out


def _bits(b: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words."""
    packed = np.packbits(b, axis=1, bitorder="little")
    packed = np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8)))
    return np.ascontiguousarray(packed).view("<u8")


def layers(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes (rows of words), alignments and the length of the rest, of rows; what a layer leaves is rotated anew for the next."""
    rest, codes, align = v, [], []
    for k in range(LAYERS):
        rest = rest @ rotation(rest.shape[1], k)
        up, root = rest >= 0, math.sqrt(rest.shape[1])
        a = np.abs(rest).sum(axis=1) / root
        rest = rest - np.where(up, 1.0, -1.0) * (a / root)[:, None]
        codes.append(_bits(up))
        align.append(a)
    return np.concatenate(codes, axis=1), np.stack(align, axis=1), np.sqrt((rest * rest).sum(axis=1))


def coded(rows: DataFrame, scale: int) -> DataFrame:
    """(id, label, anchor, dim, v, code, align, norm, rest) of every different row that takes part: v are integers as bytes, code 64-bit words, layer by layer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            off = lists.offsets.to_numpy().astype(np.int64)
            off = off - off[0]
            value = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # null: nan
            odd = np.concatenate(([0], np.cumsum(~np.isfinite(value))))
            size, fine = np.diff(off), odd[off[1:]] == odd[off[:-1]]
            for dim in np.unique(size[fine]).tolist():
                at = np.flatnonzero(fine & (size == dim))
                with np.errstate(over="ignore"):
                    v = np.floor(value[off[at][:, None] + np.arange(dim)] * scale)
                whole = np.clip(v, -EDGE, EDGE).astype(np.int64)
                v = whole.astype(np.float64)
                code, align, rest = layers(v)
                narrow = (np.abs(v) < 2.0**31).all(axis=1)
                raw = [(x.astype("<i4") if n else x.astype("<i8")).tobytes() for x, n in zip(whole, narrow.tolist(), strict=True)]
                own = [batch.column(c).take(pa.array(at)) for c in ("id", "label", "anchor")]
                cols = [*own, pa.array(np.full(len(at), dim, np.int32)), pa.array(raw, pa.binary()), pa.array([c.tobytes() for c in code], pa.binary()), pa.array([a.tobytes() for a in align], pa.binary()), pa.array(np.sqrt((v * v).sum(axis=1))), pa.array(rest)]
                yield pa.RecordBatch.from_arrays(cols, names=["id", "label", "anchor", "dim", "v", "code", "align", "norm", "rest"])

    rows = rows.where("id is not null and label is not null and embedding is not null")
    rows = rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("string").alias("label"), F.coalesce("anchor", F.lit(False)).alias("anchor"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.mapInArrow(run, "id long, label string, anchor boolean, dim int, v binary, code binary, align binary, norm double, rest double").distinct()


class Block:
    """Coded rows of one length in memory, by id, then bytes."""

    def __init__(self, t: pa.Table, dim: int):
        raw = t.column("v").to_pylist()
        ids = t.column("id").to_numpy()
        order = sorted(range(len(raw)), key=lambda i: (ids[i], raw[i]))
        self.dim, self.t = dim, t.take(pa.array(order, pa.int64()))
        self.raw, self.id = [raw[i] for i in order], ids[order]
        self.v = np.array([np.frombuffer(b, "<i4" if len(b) == 4 * dim else "<i8") for b in self.raw], np.int64).reshape(len(raw), dim)
        words = lambda c, t: np.frombuffer(b"".join(self.t.column(c).to_pylist()), t).reshape(len(raw), LAYERS, -1) if raw else np.zeros((0, LAYERS, 1), t)
        self.code, self.align = words("code", "<u8"), words("align", "<f8")[:, :, 0]
        self.norm, self.rest = self.t.column("norm").to_numpy(), self.t.column("rest").to_numpy()
        self.label = np.array(self.t.column("label").to_pylist(), object)

    def intervals(self, rows: Block, at: slice) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of each anchor ``at`` with each of ``rows``, by the codes alone."""
        q, total, cut_off = self.v[at].astype(np.float64), np.zeros((at.stop - at.start, len(rows.id))), 0.0
        for k in range(LAYERS):
            q = q @ rotation(q.shape[1], k)
            low = q.min(axis=1, keepdims=True)
            unit = (q.max(axis=1, keepdims=True) - low) / (2**PLANES - 1)
            unit = np.where(unit > 0, unit, 1.0)
            level = np.rint((q - low) / unit).astype(np.int64)
            cut = low + unit * level
            e = np.sqrt(((q - cut) ** 2).sum(axis=1))[:, None]
            code = np.ascontiguousarray(rows.code[:, k])
            shared = low * np.bitwise_count(code).sum(axis=1)[None, :]
            for j in range(PLANES):
                plane = _bits(level >> j & 1 == 1)
                count = np.zeros(shared.shape, np.uint16)
                for w in range(plane.shape[1]):
                    count += np.bitwise_count(plane[:, w, None] & code[None, :, w])
                shared += count * (unit * 2**j)
            t = (2 * shared - cut.sum(axis=1, keepdims=True)) / math.sqrt(q.shape[1])
            total += rows.align[:, k] * t
            cut_off = cut_off + rows.align[:, k] * e
        norm = self.norm[at][:, None]
        wide = rows.rest * np.sqrt(np.maximum(norm**2 - np.maximum(np.abs(t) - e, 0) ** 2, 0))
        wide += cut_off + 1e-9 * norm * rows.norm + 1e-6  # and for rounding
        return total - wide, total + wide

    def scores(self, rows: Block, at: slice, take: np.ndarray) -> np.ndarray:
        """Exact integer scores of the anchors ``at`` with the rows ``take``."""
        a, b = self.v[at], rows.v[take]
        bound = float(self.norm[at].max(initial=0)) * float(rows.norm[take].max(initial=0))
        if bound < 2.0**52:
            return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
        if bound < 2.0**61 and max(float(np.abs(x).max(initial=0)) for x in (a, b)) < 2.0**61:
            return a @ b.T
        return np.clip(a.astype(object) @ b.T.astype(object), -MOST, MOST).astype(np.int64).reshape(len(a), len(b))


def _best(score: np.ndarray, fit: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` greatest of ``score`` where ``fit``, the greatest first, then the smaller place."""
    c = np.flatnonzero(fit)
    if len(c) > k:
        c = c[score[c] >= np.partition(score[c], len(c) - k)[len(c) - k]]
    return c[np.argsort(-score[c], kind="stable")][:k]


def best_of_label(anchors: Block, rows: Block, k: int, batch: int = 64) -> Iterator[tuple[int, int, int]]:
    """(anchor, row, score): the ``k`` best other rows of every anchor."""
    for s in range(0, len(anchors.id), batch):
        at = slice(s, min(s + batch, len(anchors.id)))
        lo, hi = anchors.intervals(rows, at)
        other = np.ones(lo.shape, bool)
        for i in range(at.start, at.stop):
            for j in range(*np.searchsorted(rows.id, [anchors.id[i], anchors.id[i] + 1])):
                other[i - s, j] = rows.raw[j] != anchors.raw[i]
        lo = np.where(other, lo, -np.inf)
        if lo.shape[1] > k:
            other &= hi >= np.partition(lo, lo.shape[1] - k, axis=1)[:, lo.shape[1] - k, None]
        take = np.flatnonzero(other.any(axis=0))
        score = anchors.scores(rows, at, take)
        for i in range(at.start, at.stop):
            for j in _best(score[i - s], other[i - s, take], k).tolist():
                yield i, int(take[j]), int(score[i - s, j])


def best_between(anchors: Block, rows: Block, asked: list[list[dict]], k: int, low: int, high: int, batch: int = 64) -> Iterator[tuple[int, dict, int, int]]:
    """(anchor, positive, row, score): for every positive of an anchor the ``k`` best rows of other labels in its range."""
    for s in range(0, len(anchors.id), batch):
        at = slice(s, min(s + batch, len(anchors.id)))
        lo, hi = anchors.intervals(rows, at)
        fit, ranges = np.zeros(lo.shape, bool), []
        for i in range(at.start, at.stop):
            ranges.append([(p, -(-low * p["score"] // 100), high * p["score"] // 100) for p in asked[i]])
            for _, least, most in ranges[-1]:
                if least <= most:
                    fit[i - s] |= (hi[i - s] >= least) & (lo[i - s] <= most)
            fit[i - s] &= rows.label != anchors.label[i]
        take = np.flatnonzero(fit.any(axis=0))
        score = anchors.scores(rows, at, take)
        for i in range(at.start, at.stop):
            mine, own = score[i - s], fit[i - s, take]
            for p, least, most in ranges[i - s]:
                if least <= most:
                    for j in _best(mine, own & (mine >= least) & (mine <= most), k).tolist():
                        yield i, p, int(take[j]), int(mine[j])


def _dealt(rows: DataFrame, anchors: DataFrame, key: list[str], chunk_rows: int, chunk_anchors: int):
    """Both sides grouped by chunk: every chunk of anchors meets every chunk of rows of the same key."""
    n = lambda c, size: F.ceil(F.count(F.lit(1)) / size).cast("int").alias(c)
    sizes = rows.groupBy(*key).agg(n("_r", chunk_rows)).join(anchors.groupBy(*key).agg(n("_a", chunk_anchors)), key)
    deal = lambda c: F.pmod(F.xxhash64("id", "v"), F.col(c)).cast("int")
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    group = [*key, "a", "r"]
    anchors = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])  # columns of their own, as both come from one table
    left = anchors.join(sizes, key).withColumn("a", deal("_a")).withColumn("r", each("_r")).drop("_a", "_r")
    right = rows.join(sizes, key).withColumn("r", deal("_r")).withColumn("a", each("_a")).drop("_a", "_r")
    return left.groupBy(*group).cogroup(right.groupBy(*group))


def _ranked(rows: DataFrame, by: list[str], score: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), "other", "other_v")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, chunk_rows: int = 4096, chunk_anchors: int = 8192) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the ``anchor`` rows of ``rows`` (id, label, anchor, embedding)."""
    every = saved(coded(rows, scale), "hardneg-codes")
    anchors = every.where("anchor")

    def near(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = Block(left, key[1].as_py()), Block(right, key[1].as_py())
        found = list(best_of_label(a, b, positives))
        return pa.table(
            {
                "id": pa.array([int(a.id[i]) for i, _, _ in found], pa.int64()),
                "v": pa.array([a.raw[i] for i, _, _ in found], pa.binary()),
                "other": pa.array([int(b.id[j]) for _, j, _ in found], pa.int64()),
                "other_v": pa.array([b.raw[j] for _, j, _ in found], pa.binary()),
                "score": pa.array([s for _, _, s in found], pa.int64()),
                "label": pa.array([str(a.label[i]) for i, _, _ in found], pa.string()),
            }
        )

    found = _dealt(every, anchors, ["label", "dim"], chunk_rows, chunk_anchors).applyInArrow(near, "id long, v binary, other long, other_v binary, score long, label string")
    found = _ranked(found, ["id", "label", "v"], "score", positives)
    asked = found.groupBy("id", "label", "v").agg(F.array_sort(F.collect_list(F.struct("rank", F.col("other").alias("id"), "score"))).alias("asked"))  # at most ``positives``
    asked = saved(anchors.join(asked, ["id", "label", "v"]), "hardneg-asked")

    def hard(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        a, b = Block(left, key[0].as_py()), Block(right, key[0].as_py())
        found = list(best_between(a, b, a.t.column("asked").to_pylist(), negatives, low, high))
        return pa.table(
            {
                "id": pa.array([int(a.id[i]) for i, _, _, _ in found], pa.int64()),
                "label": pa.array([str(a.label[i]) for i, _, _, _ in found], pa.string()),
                "v": pa.array([a.raw[i] for i, _, _, _ in found], pa.binary()),
                "place": pa.array([p["rank"] for _, p, _, _ in found], pa.int32()),
                "positive_id": pa.array([p["id"] for _, p, _, _ in found], pa.int64()),
                "positive_score": pa.array([p["score"] for _, p, _, _ in found], pa.int64()),
                "other": pa.array([int(b.id[j]) for _, _, j, _ in found], pa.int64()),
                "other_v": pa.array([b.raw[j] for _, _, j, _ in found], pa.binary()),
                "score": pa.array([s for _, _, _, s in found], pa.int64()),
            }
        )

    schema = "id long, label string, v binary, place int, positive_id long, positive_score long, other long, other_v binary, score long"
    got = _dealt(every, asked, ["dim"], chunk_rows, chunk_anchors).applyInArrow(hard, schema)
    got = _ranked(got, ["id", "label", "v", "place"], "score", negatives)
    return got.select(F.col("id").alias("anchor_id"), "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of five positives of every fiftieth row; every seventh row's label is moved by one first."""
    rows = table(spark, sf_dir, "embeddings")
    label: Column = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.select(F.col("vec_id").alias("id"), label.alias("label"), (F.col("vec_id") % 50 == 0).alias("anchor"), "embedding"))
