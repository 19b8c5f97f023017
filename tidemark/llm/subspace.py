"""Embedding near-duplicates by a screen in the leading principal axes, over chunks that tasks read.

Two unit vectors have cosine >= c exactly when their squared distance is at most t = 2 - 2c, and their distance
in some of the principal axes is no greater. Equal vectors of a label are one class with a multiplicity beforehand, so
copies are never paired with each other.

The classes of a label are ordered by where they lie in the first principal axes and cut into chunks of ``cell_rows``, which are
written once to the shared folder, in the components' own type, each with the box around its vectors. Tasks read
chunks from there: no row is copied for a cell or a partner, so the disk taken is in proportion to the table, whatever the number of
comparisons. Of two chunks whose boxes are farther apart than t no rows are read. Of the others the rows
out of reach of the other's box are left out; the rest are screened in the first of ``blocks`` blocks of principal axes,
in 32 bits and a margin for their error, and the pairs that it leaves are verified over all dimensions in double precision. A task returns, for
each vector, its number of links and the smallest id of its local component, never pairs.

Work is that of chunks whose boxes are within reach: near all pairs of a label if its vectors lie evenly in all dimensions.

Defined cases: a vector that is null, empty, zero, or holds a null or a non-finite
component, and one with a null label, links with nothing; vectors of one label link
only with those of as many components; repeated rows count once; different vectors of
one vec_id are vectors of their own, whose links to other ids that
id adds up; rows with a null vec_id are left out, since a result row is named by
an id. Only the named columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import components, saved, shared, table

KEEP = 24  # chunks that a task keeps read
CODED = 8  # axes that chunks are ordered by, 4 bits each
AT_ONCE = 512  # rows of a chunk that meet another chunk at once


def _keyed(rows: DataFrame) -> DataFrame:
    """(vec_id, label, dim, h1, h2, x): the components as bytes of their own type, and 128 bits of the unit vector; x is null where nothing can link."""
    single = rows.schema["embedding"].dataType.simpleString() == "array<float>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dim, h1, h2, out = [], [], [], []
            for v, label in zip(batch.column("embedding").to_pylist(), batch.column("label").to_pylist(), strict=True):
                x = np.array(v, np.float64) if v and label is not None and None not in v else np.zeros(0)
                top = np.abs(x).max() if len(x) and np.isfinite(x).all() else 0.0
                if top > 0:
                    raw = x.astype(np.float32 if single else np.float64).tobytes()
                    x = x / top  # no overflow of the squares
                    d = xxhash.xxh3_128_digest((x / math.sqrt(float(x @ x)) + 0.0).tobytes())
                    dim.append(len(x))
                    h1.append(int.from_bytes(d[:8], "little", signed=True))
                    h2.append(int.from_bytes(d[8:], "little", signed=True))
                    out.append(raw)
                else:
                    for a in (dim, h1, h2, out):
                        a.append(None)
            cols = [batch.column("vec_id"), batch.column("label"), pa.array(dim, pa.int32()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(out, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["vec_id", "label", "dim", "h1", "h2", "x"])

    own = F.col("embedding") if single else F.col("embedding").cast("array<double>").alias("embedding")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), own)
    return rows.where("vec_id is not null").mapInArrow(run, "vec_id long, label string, dim int, h1 long, h2 long, x binary")


def _units(column, dim: int) -> np.ndarray:
    """Unit vectors from the bytes of their components."""
    raw = b"".join(b.as_buffer() for b in column)
    x = np.frombuffer(raw, np.float32 if len(raw) == 4 * dim * len(column) else np.float64).reshape(len(column), dim).astype(np.float64)
    x /= np.abs(x).max(axis=1, initial=0)[:, None]
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _axes(vectors: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(variances, principal axes as columns, mean), the largest first, of the unit vectors of one dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, c = 0, np.zeros(dim), np.zeros((dim, dim))
        for batch in batches:
            if batch.num_rows:
                x = _units(batch.column("x"), dim)
                n, s, c = n + len(x), s + x.sum(axis=0), c + x.T @ x
        if n:
            value = np.concatenate(([n], s, c.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(value))), pa.array(value)], names=["i", "v"])

    got = vectors.where(F.col("dim") == dim).select("x").mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas().sort_values("i")["v"].to_numpy()
    n, s, c = got[0], got[1 : dim + 1], got[dim + 1 :].reshape(dim, dim)
    value, axes = np.linalg.eigh(c / n - np.outer(s, s) / n**2)
    return np.maximum(value[::-1], 0), axes[:, ::-1], s / n


class Plan:
    """Rotation, order and screen for vectors of one dimension."""

    def __init__(self, variance: np.ndarray, axes: np.ndarray, mean: np.ndarray, cosine: float, blocks: int):
        dim = len(variance)
        self.axes = np.ascontiguousarray(axes)
        self.lead = -(-dim // max(1, min(blocks, dim)))
        self.reach = (2 - 2 * cosine) * (1 + 1e-9) + 1e-12
        self.near = 16 * (dim + 8) * 2.0**-23  # more than the screen's 32-bit sums can be wrong by
        self.mean = mean @ axes
        self.spread = np.sqrt(variance) + 1e-12

    def code(self, x: np.ndarray) -> np.ndarray:
        """Where rotated rows lie: the bits of their places on the first axes, taken in turn."""
        z = (x - self.mean)[:, :CODED] / self.spread[:CODED]
        at = np.clip((8 * (1 + np.tanh(0.8 * z))).astype(np.int64), 0, 15)
        out = np.zeros(len(x), np.int64)
        for bit in (3, 2, 1, 0):
            for a in at.T:
                out = 2 * out + (a >> bit & 1)
        return out

    def screened(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Leading components of both, with which one product gives squared distances."""
        x, y = x[:, : self.lead], y[:, : self.lead]
        one = np.ones((len(x), 1)), np.ones((len(y), 1))
        square = (np.einsum("ij,ij->i", v, v)[:, None] for v in (x, y))
        return np.hstack([-2 * x, next(square), one[0]]).astype(np.float32), np.hstack([y, one[1], next(square)]).astype(np.float32)


def _apart(low, high, low2, high2) -> np.ndarray:
    """Squared distances of boxes (rows of ``low2`` and ``high2``) from a box."""
    d = np.maximum(0, np.maximum(low2 - high, low - high2))
    return np.einsum("ij,ij->i", d, d)


def _laid(classes: DataFrame, plans, cell_rows: int) -> DataFrame:
    """The classes in chunks, written to the shared folder: (label, dim, chunk, rep, copies, x), and the box of a chunk at its first row."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, at = batch.column("dim").to_numpy(), np.zeros(batch.num_rows, np.int64)
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                at[own] = plans.value[int(dim)].code(_units(batch.column("x").take(pa.array(own)), int(dim)) @ plans.value[int(dim)].axes)
            yield batch.append_column("code", pa.array(at))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, held = TaskContext.get().partitionId() << 32, []

        def close() -> pa.RecordBatch:
            nonlocal chunk, held
            t = pa.Table.from_batches(held).drop_columns(["code"]).combine_chunks()
            dim, n = t["dim"][0].as_py(), t.num_rows
            x = _units(t["x"].combine_chunks(), dim) @ plans.value[dim].axes
            box = np.concatenate([x.min(axis=0), x.max(axis=0)]).tobytes()
            t = t.append_column("chunk", pa.array(np.full(n, chunk, np.int64))).append_column("box", pa.array([box, *[None] * (n - 1)], pa.binary()))
            chunk, held = chunk + 1, []
            return t.combine_chunks().to_batches()[0]

        for batch in batches:
            while batch.num_rows:
                if held and any(held[0].column(c)[0] != batch.column(c)[0] for c in ("label", "dim")):
                    yield close()
                same = np.ones(batch.num_rows, bool)
                for c in ("label", "dim"):
                    same &= pa.compute.equal(batch.column(c), batch.column(c)[0]).to_numpy(zero_copy_only=False)
                n = min(int(np.append(np.flatnonzero(~same), batch.num_rows)[0]), cell_rows - sum(h.num_rows for h in held))
                held.append(batch.slice(0, n))
                batch = batch.slice(n)
                if sum(h.num_rows for h in held) == cell_rows:
                    yield close()
        if held:
            yield close()

    fields = "label string, dim int, rep long, copies long, x binary"
    order = ["label", "dim", "code", "rep"]
    rows = classes.select("label", "dim", "rep", "copies", "x").mapInArrow(code, f"{fields}, code long").repartitionByRange(*order).sortWithinPartitions(*order)
    # small row groups: a task reads single chunks
    return saved(rows.mapInArrow(pack, f"{fields}, chunk long, box binary"), "subspace-chunks", **{"parquet.block.size": str(1 << 20)})


class _Chunks:
    """Chunks read from the files that have them, the last ``KEEP`` of them kept."""

    def __init__(self, plans):
        self.plans, self.parts, self.held = plans, {}, OrderedDict()

    def __getitem__(self, which: tuple[int, int, str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rep, copies, x rotated) of a chunk (its number, its dimension, its file)."""
        chunk, dim, file = which
        if chunk not in self.held:
            if file not in self.parts:
                parts = []
                for fragment in shared(file).get_fragments():
                    for part in fragment.split_by_row_group():
                        at = part.row_groups[0].statistics["chunk"]
                        parts.append((at["min"], at["max"], part))
                self.parts[file] = parts
            import pyarrow.dataset as ds

            found = [p.to_table(columns=["rep", "copies", "x"], filter=ds.field("chunk") == chunk) for low, high, p in self.parts[file] if low <= chunk <= high]
            t = pa.concat_tables(found).combine_chunks()
            self.held[chunk] = t["rep"].to_numpy(), t["copies"].to_numpy(), _units(t["x"].combine_chunks(), dim) @ self.plans[dim].axes
            while len(self.held) > KEEP:
                self.held.popitem(last=False)
        self.held.move_to_end(chunk)
        return self.held[chunk]


def _compared(plan: Plan, cosine: float, x: np.ndarray, y: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (of x, of y) that link."""
    left, right = np.arange(len(x)), np.arange(len(y))
    if not same:
        k = plan.lead
        right = np.flatnonzero(_apart(x[:, :k].min(axis=0), x[:, :k].max(axis=0), y[:, :k], y[:, :k]) <= plan.reach)
        if not len(right):
            return left[:0], right
        near = y[right, :k]
        left = np.flatnonzero(_apart(near.min(axis=0), near.max(axis=0), x[:, :k], x[:, :k]) <= plan.reach)
    u, v = plan.screened(x[left], y[right])
    v, found = np.ascontiguousarray(v.T), []
    for at in range(0, len(left), AT_ONCE):
        some = left[at : at + AT_ONCE]
        pairs = np.flatnonzero(u[at : at + AT_ONCE] @ v <= np.float32(plan.reach + plan.near))
        if len(pairs) * 20 > len(some) * len(right):  # so many are verified together
            pairs = np.flatnonzero(x[some] @ y[right].T >= cosine)
            a, b = some[pairs // len(right)], right[pairs % len(right)]
            keep = a < b if same else slice(None)
            found.append((a[keep], b[keep]))
            continue
        a, b = some[pairs // len(right)], right[pairs % len(right)]
        if same:
            a, b = a[a < b], b[a < b]
        for s in range(0, len(a), 200_000):
            p, q = a[s : s + 200_000], b[s : s + 200_000]
            keep = np.einsum("ij,ij->i", x[p], y[q]) >= cosine
            found.append((p[keep], q[keep]))
    return tuple(np.concatenate([f[i] for f in found]) if found else left[:0] for i in (0, 1))


def _partners(i: int, m: int) -> np.ndarray:
    """The chunks, of ``m``, that chunk ``i`` meets: each two meet once, and all have as many."""
    steps = np.arange((m - 1) // 2 + 1)
    if m % 2 == 0 and i < m // 2:
        steps = np.append(steps, m // 2)
    return (i + steps) % m


def links(classes: DataFrame, plans, cosine: float, cell_rows: int) -> DataFrame:
    """(rep, links, low): links of a class to others (copies counted) and the smallest id it reaches in two chunks."""
    rows = _laid(classes, plans, cell_rows)
    chunks = saved(rows.where("box is not null").select("label", "dim", "chunk", "box", F.input_file_name().alias("file")), "subspace-boxes")  # a row for each chunk
    path = chunks.inputFiles()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.dataset as ds

        read, boxes, of = _Chunks(plans.value), None, None
        for batch in batches:
            for label, dim, chunk in zip(*(batch.column(c).to_pylist() for c in ("label", "dim", "chunk")), strict=True):
                if of != (label, dim):
                    of, boxes = (label, dim), shared(path).to_table(filter=(ds.field("label") == label) & (ds.field("dim") == dim)).sort_by("chunk")
                    numbers, files = boxes["chunk"].to_numpy(), boxes["file"]
                    box = np.frombuffer(b"".join(boxes["box"].to_pylist())).reshape(len(numbers), 2, dim)
                plan, i = plans.value[dim], int(np.searchsorted(numbers, chunk))
                others = _partners(i, len(numbers))
                others = others[_apart(box[i, 0], box[i, 1], box[others, 0], box[others, 1]) <= plan.reach]
                for j in np.sort(others).tolist():
                    rep, copies, x = read[int(chunk), dim, files[i].as_py()]
                    rep2, copies2, y = read[int(numbers[j]), dim, files[j].as_py()]
                    a, b = _compared(plan, cosine, x, y, i == j)
                    if i != j:
                        rep, copies, b = np.concatenate([rep, rep2]), np.concatenate([copies, copies2]), b + len(rep)
                    other = rep[a] != rep[b]
                    a, b = a[other], b[other]
                    if len(a):
                        n = np.zeros(len(rep), np.int64)
                        np.add.at(n, a, copies[b])
                        np.add.at(n, b, copies[a])
                        hit = n > 0
                        yield pa.RecordBatch.from_arrays([pa.array(c[hit]) for c in (rep, n, _lowest(rep, a, b))], names=["rep", "links", "low"])

    tasks = max(1, min(chunks.count(), 1024))
    return chunks.select("label", "dim", "chunk").repartition(tasks).mapInArrow(compare, "rep long, links long, low long")


def _lowest(rep: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest id that each row reaches by the pairs."""
    low = rep.copy()
    while True:
        before, least = low.copy(), np.minimum(low[a], low[b])
        np.minimum.at(low, a, least)
        np.minimum.at(low, b, least)
        if (before == low).all():
            return low


def near_duplicates(rows: DataFrame, cosine: float = 0.93, blocks: int = 4, cell_rows: int = 2000) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vec_id of ``rows`` (vec_id, embedding, label)."""
    key = ["label", "dim", "h1", "h2"]
    keyed = _keyed(rows)
    units = saved(keyed.select("vec_id", *key).distinct(), "subspace-units")  # without the vectors, which are read again
    able, vectors = units.where("dim is not null"), keyed.where("x is not null")
    spark = rows.sparkSession
    dims = [r["dim"] for r in able.select("dim").distinct().collect()]  # a row for each dimension
    plans = spark.sparkContext.broadcast({d: Plan(*_axes(vectors, d), cosine, blocks) for d in dims})
    named = able.groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = vectors.groupBy(*key).agg(F.first("x").alias("x")).join(named, key)
    got = saved(links(classes, plans, cosine, cell_rows), "subspace-links")
    total = got.groupBy("rep").agg(F.sum("links").alias("links"))
    member = able.join(named, key)
    member = saved(member.join(total, "rep", "left").select("vec_id", "rep", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")), "subspace-members")
    edges = got.select(F.col("low").alias("a"), F.col("rep").alias("b")).union(member.select(F.col("rep").alias("a"), F.col("vec_id").alias("b")))
    comp = components(edges.where("a < b"), "subspace")
    each = units.select("vec_id").distinct().join(member.groupBy("vec_id").agg(F.sum("links").alias("links")), "vec_id", "left")
    each = each.join(comp, F.col("vec_id") == F.col("node"), "left")
    return each.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("comp", "vec_id").alias("component_id"),
        (F.coalesce("comp", "vec_id") == F.col("vec_id")).alias("kept"),
    )


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of equally labelled vectors of cosine 0.93 or more, and the groups they form."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
