"""N-gram Jaccard join by parity sketches, and the groups that its links form.

A document's set is its distinct shingles of ``width`` words, as 64-bit hashes.
Two documents link when 100 * |A & B| >= ``percent`` * |A | B|.

Method. Every shingle flips one bit of a sketch of ``blocks`` * 2**32 bits (held
sparsely: a block's key is the XOR of its odd bits' hashes), so a shingle that both
documents have leaves no trace in the XOR of their sketches, and the Hamming
distance of two sketches is at most the size D of the symmetric difference. A
linked pair of sizes a and b has D <= (100 - percent) (a + b) / (100 + percent). So
of the blocks of the pair's size band at most D differ (pigeonhole): under
any one order of keys, the first D + 1 keys of both documents have one in
common. The order puts keys with many shingles first, which few documents share. Bands are octaves of the set size; a document whose
partners may lie in the next octave has keys there as well.

Pairs. Equal word sequences are one class beforehand. In each bucket of a key
the class with the smallest id is first compared with every other, exactly;
the components of these links are found; then only pairs of one bucket that are
still in different components are looked at: their dense sketches (two bits for each
shingle of the octave) are XORed where they are, and a pair goes on to
the exact comparison only if its Hamming distance is at most D. So a large group of copies costs a link for
each member and no rows for its pairs, and no link between different components is lost. A bucket above
``bucket_rows`` rows is cut into chunks, and its pairs of chunks are groups of their own.

Defined cases: null, empty and blank texts have the empty set and link with
nothing; a text with fewer than ``width`` words is one shingle; rows with a null
doc_id are left out, since a group is named by an id; repeated rows count once, and
rows that repeat an id with another text are that id's texts: they are
compared separately and link the id (n_shingles is that of the largest set). Only the named columns
are read. An empty table gives an empty result of the same schema.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tidemark.llm.common import components, saved, table

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case; separators are the six ASCII white-space bytes."""
    return text.encode().lower().split() if text else []


def shingles(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(h) - width + 1
    out = np.zeros(n, np.uint64)
    for i in range(width):
        out = _mix(out + h[i : i + n] * _ODD[i % len(_ODD)])
    return np.unique(out)


def _blocks(top: int, percent: int) -> int:
    """Blocks of the band of sizes up to ``top``: more than its greatest D, few enough to hold several shingles each."""
    return int(top * 2 * (100 - percent) / (100 + percent) * 1.35) + 2


def prefix_keys(s: np.ndarray, percent: int) -> np.ndarray:
    """Keys under which a set is to be found by all sets that link with it."""
    n = len(s)
    if not n:
        return np.zeros(0, np.uint64)
    largest = n * 100 // percent
    differ = (100 - percent) * (n + largest) // (100 + percent)
    level = max(3, (n - 1).bit_length())
    out = []
    for k in (level, level + 1):
        if k > level and largest <= 1 << level:
            break
        b = _blocks(1 << k, percent)
        at = ((s >> np.uint64(32)) * np.uint64(b)) >> np.uint64(32)  # blocks follow the order of s
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        bits = _mix((s & np.uint64(0xFFFFFFFF)) + np.uint64(1))
        key = np.bitwise_xor.reduceat(bits, first)
        size = np.diff(np.append(first, n))
        own = np.uint64(k << 40)
        key = _mix(key ^ _mix(at[first] + own))
        if len(key) <= differ:  # some blocks without shingles have to count too
            none = np.setdiff1d(np.arange(b, dtype=np.uint64), at[first])
            key = np.concatenate((key, _mix(_mix(none + own))))
            size = np.concatenate((size, np.zeros(len(none), size.dtype)))
        out.append(key[np.lexsort((key, -size))[: differ + 1]])
    return np.concatenate(out)


def _fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, f1, f2): size of the set, and 128 bits of the word sequence; these are null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, f1, f2 = [], [], []
            for text in batch.column("text"):
                w = words_of(text.as_py())
                n.append(len(shingles(w, width)))
                d = xxhash.xxh3_128_digest(b" ".join(w)) if w else b""
                f1.append(int.from_bytes(d[:8], "little", signed=True) if w else None)
                f2.append(int.from_bytes(d[8:], "little", signed=True) if w else None)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64())], names=["doc_id", "n", "f1", "f2"])

    return docs.mapInArrow(run, "doc_id long, n long, f1 long, f2 long")


def _keys(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(key, doc_id, n) for every prefix key; a document without shingles has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            key, doc, size, held = [], [], [], 0
            for i, text in zip(ids, batch.column("text"), strict=True):
                s = shingles(words_of(text.as_py()), width)
                k = prefix_keys(s, percent)
                key.append(k)
                doc.append(np.full(len(k), i, np.int64))
                size.append(np.full(len(k), len(s), np.int32))
                held += len(k)
                if held > 500_000:
                    yield _rows(key, doc, size)
                    key, doc, size, held = [], [], [], 0
            if key:
                yield _rows(key, doc, size)

    def _rows(key: list, doc: list, size: list) -> pa.RecordBatch:
        arrays = [pa.array(np.concatenate(key).view(np.int64)), pa.array(np.concatenate(doc)), pa.array(np.concatenate(size))]
        return pa.RecordBatch.from_arrays(arrays, names=["key", "doc_id", "n"])

    return docs.mapInArrow(run, "key long, doc_id long, n int")


def sketch(s: np.ndarray) -> np.ndarray:
    """Parity of the shingles in each of 2**j cells, as 64-bit words; at least two cells for each shingle."""
    bits = 1 << max(6, len(s).bit_length() + 1)
    odd = np.bincount((_mix(s ^ np.uint64(0xA0761D6478BD642F)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def _folded(words: np.ndarray, size: int) -> np.ndarray:
    """A sketch of fewer cells: the XOR of its parts, since a cell is the low bits of a hash."""
    return np.bitwise_xor.reduce(words.reshape(-1, size), axis=0)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, s, sketch): the sorted shingle hashes, and their dense sketch, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out, dense = [], [], []
            for i, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                s = shingles(words_of(text.as_py()), width)
                ids.append(i.as_py())
                out.append(s.tobytes())
                dense.append(sketch(s).tobytes())
                if len(out) >= 500:
                    yield _rows(ids, out, dense)
                    ids, out, dense = [], [], []
            if out:
                yield _rows(ids, out, dense)

    def _rows(ids: list, out: list, dense: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary()), pa.array(dense, pa.binary())], names=["doc_id", "s", "sketch"])

    return docs.mapInArrow(run, "doc_id long, s binary, sketch binary")


def _close(rows: DataFrame, percent: int, bucket_rows: int) -> DataFrame:
    """Pairs (a, b) of one bucket of ``rows`` (key, doc_id, n, comp, sketch) in different components that sketches do not rule out."""
    large = rows.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > bucket_rows).select("key", F.ceil(F.col("c") / bucket_rows).cast("int").alias("chunks"))
    rows = rows.join(large, "key", "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "doc_id", "n", "comp", "sketch")

    def fits(x: int, y: int) -> bool:
        return 100 * min(x, y) >= percent * max(x, y)

    def few(p: int, q: int, rows: list) -> list[tuple[int, int]]:
        """Pairs of a small group, with sketches as whole numbers."""
        size = min(len(r[4]) for r in rows)
        folded = []
        for r in rows:
            x = int.from_bytes(r[4], "little")
            bits = 8 * len(r[4])
            while bits > 8 * size:
                bits //= 2
                x = (x >> bits) ^ (x & ((1 << bits) - 1))
            folded.append(x)
        out = []
        for i, (own, doc, n, comp, _) in enumerate(rows):
            for k in range(i):
                own2, doc2, n2, comp2, _ = rows[k]
                if comp != comp2 and doc != doc2 and (p == q or own != own2) and fits(n, n2) and (folded[i] ^ folded[k]).bit_count() <= (100 - percent) * (n + n2) // (100 + percent):
                    out.append((min(doc, doc2), max(doc, doc2)))
        return out

    def many(p: int, q: int, rows: list) -> Iterator[tuple[int, int]]:
        """Pairs of a group by rows of a matrix of distances."""
        own, doc, n, comp = (np.array([r[c] for r in rows]) for c in range(4))
        raw = [np.frombuffer(r[4], np.uint64) for r in rows]
        size = min(map(len, raw))
        words = np.stack([_folded(x, size) for x in raw])
        left = np.flatnonzero(own == p)
        right = left if p == q else np.flatnonzero(own == q)
        step = max(1, 4_000_000 // max(1, len(right) * size))
        for at in range(0, len(left), step):
            x = left[at : at + step]
            most = (100 - percent) * (n[x][:, None] + n[right]) // (100 + percent)
            ok = np.bitwise_count(words[x][:, None, :] ^ words[right]).sum(axis=2, dtype=np.int64) <= most
            ok &= comp[x][:, None] != comp[right]
            ok &= 100 * np.minimum(n[x][:, None], n[right]) >= percent * np.maximum(n[x][:, None], n[right])
            i, j = np.nonzero(ok)
            a, b = doc[x[i]], doc[right[j]]
            keep = a != b if p != q else a < b
            yield from zip(np.minimum(a, b)[keep].tolist(), np.maximum(a, b)[keep].tolist(), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Groups one after the other, as the rows of a partition are sorted; only one is held."""
        now, held, found = None, [], set()
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("key", "p", "q", "own", "doc_id", "n", "comp", "sketch")]
            for key, p, q, *row in zip(*cols, strict=True):
                if (key, p, q) != now:
                    if len(held) > 1:
                        found.update((few if len(held) <= 8 else many)(now[1], now[2], held))
                    now, held = (key, p, q), []
                held.append(row)
            if len(found) > 50_000:
                yield pairs(found)
                found = set()
        if len(held) > 1:
            found.update((few if len(held) <= 8 else many)(now[1], now[2], held))
        yield pairs(found)

    def pairs(found: set) -> pa.RecordBatch:
        a, b = zip(*found, strict=True) if found else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return rows.repartition("key", "p", "q").sortWithinPartitions("key", "p", "q").mapInArrow(run, "a long, b long").distinct()


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by exact intersection."""
    a = sets.select(F.col("doc_id").alias("a"), F.col("s").alias("sa"))
    b = sets.select(F.col("doc_id").alias("b"), F.col("s").alias("sb"))
    both = pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "sa", "sb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(p) + len(q) - len(np.unique(np.concatenate((p, q))))
                keep.append(100 * common >= percent * (len(p) + len(q) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def groups(docs: DataFrame, width: int = 5, percent: int = 80, bucket_rows: int = 1000) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every id of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(F.col("doc_id").isNotNull())
    marks = saved(_fingerprints(docs, width).distinct(), "parity-marks")
    first = marks.groupBy("f1", "f2").agg(F.min("doc_id").alias("rep"))
    member = saved(marks.join(first.where(F.col("f1").isNotNull()), ["f1", "f2"]).select("doc_id", "rep"), "parity-classes")
    # one text for each class: its smallest id
    texts = docs.join(member.where("doc_id = rep").select("doc_id").distinct(), "doc_id", "left_semi")
    by_key = Window.partitionBy("key")
    keys = _keys(texts, width, percent)
    found = keys.withColumn("hub", F.min("doc_id").over(by_key)).withColumn("last", F.max("doc_id").over(by_key)).where("hub < last").drop("last")
    buckets = saved(found, "parity-buckets")
    fits = lambda x, y: (100 * F.least(x, y) >= percent * F.greatest(x, y))
    hubs = buckets.where("doc_id = hub").select("key", F.col("n").alias("m")).distinct()
    star = saved(buckets.where("doc_id > hub").join(hubs, "key").where(fits(F.col("n"), F.col("m"))).select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct(), "parity-star")
    near = buckets.select("doc_id").distinct()
    sets = saved(_sets(texts.join(near, "doc_id", "left_semi"), width), "parity-sets")
    links = saved(_linked(star, sets, percent), "parity-links")
    comp = components(links, "parity-one")
    # pairs of a bucket that are still apart
    of = buckets.join(comp, F.col("doc_id") == F.col("node"), "left").select("key", "doc_id", "n", F.coalesce("comp", "doc_id").alias("comp"))
    of = saved(of.withColumn("lo", F.min("comp").over(by_key)).withColumn("hi", F.max("comp").over(by_key)).where("lo < hi").select("key", "doc_id", "n", "comp"), "parity-apart")
    apart = _close(of.join(sets.select("doc_id", "sketch"), "doc_id"), percent, bucket_rows)
    apart = saved(apart.join(star, ["a", "b"], "left_anti"), "parity-pairs")
    more = saved(_linked(apart, sets, percent), "parity-more")
    alias = member.where("doc_id > rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    comp = components(links.union(more).union(alias), "parity-all")
    ids = marks.groupBy("doc_id").agg(F.max("n").alias("n_shingles")).join(comp, F.col("doc_id") == F.col("node"), "left")
    return ids.select("doc_id", "n_shingles", F.coalesce("comp", "doc_id").alias("component_id"))


#: Above all ids that documents have: rows that share an id, or have none, are numbered from here on.
SURROGATE = 1 << 62


def one_of_each_group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each group: that of the smallest id.

    Where an id stands for several texts, or is null, every different text is a document of its own: the one of lowest
    hash has the id, the others a number above all ids. Rows of equal id and text count once (the one of lowest hash of its other columns).
    """
    ids = docs.groupBy("doc_id").count().where("doc_id is null or count > 1")
    if ids.isEmpty():
        found = groups(docs.select("doc_id", "text"), width, percent)
        named = found.where("doc_id = component_id").select(F.col("doc_id").alias("__id"))
        return docs.join(named, F.col("doc_id") == F.col("__id"), "left_semi")
    whole = F.xxhash64(*[c for c in docs.columns if not isinstance(docs.schema[c].dataType, MapType)])
    rows = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("h"), F.col("text").isNull().alias("none"), whole.alias("w"), F.struct(*docs.columns).alias("row"))
    rows = rows.groupBy("doc_id", "h", "none").agg(F.min_by("row", "w").alias("row"))
    rows = saved(rows, "parity-rows")
    first = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("h", "none")).alias("first")).select(F.col("doc_id").alias("__id"), "first")
    rows = rows.join(first, F.col("doc_id") == F.col("__id"), "left")
    other = F.lit(SURROGATE) + F.shiftrightunsigned(F.xxhash64("doc_id", "h", "none"), 2)
    number = F.when(F.struct("h", "none") == F.col("first"), F.col("doc_id")).otherwise(other)
    rows = saved(rows.select(number.alias("number"), "row"), "parity-numbered")
    found = groups(rows.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text")), width, percent)
    named = found.where("doc_id = component_id").select(F.col("doc_id").alias("__id"))
    return rows.join(named, F.col("number") == F.col("__id"), "left_semi").select("row.*")


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that links of five-word shingles at 0.8 Jaccard form."""
    return groups(table(spark, sf_dir, "documents"))
