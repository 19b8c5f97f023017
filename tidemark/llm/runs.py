"""Periodic runs of words, by recompression.

A run is a stretch of words with smallest period q and at least max(``least``, ``times`` * q)
words that no neighbouring word extends keeping that period.

A block of texts becomes one sequence of word numbers, with a separator of its own between
texts. Rounds alternate until every text is one symbol: *block compression* makes a symbol of
every stretch of equal symbols (symbol, length), *pair compression* splits the symbols in two
sides and makes a symbol of every neighbouring pair (left, right). Equal symbols stand for
equal words and the rounds are the levels of a run-length grammar, in which both
depend on the neighbours alone: equal stretches get equal symbols but for their ends.

A common extension of two places climbs to the level above wherever both are at a border
and the symbols there are equal, goes on by a symbol (by a whole stretch in a block) where the
symbols are equal, and falls a level where they are not; it is exact whatever the symbols
are, and takes a logarithmic number of steps. It works in both directions on the same
levels. No suffix array is made.

Places to ask: words q apart are equal all over a run's first length - q words, so of the
multiples of that least length one lies in every run of period q. These harmonic
grids hold some n log n places a text; those whose word differs from the one q further on are
no candidates, every other one is extended to both sides. Stretches found with several periods have the
smallest one.

Defined cases: null and empty texts and texts without words have no run and collapse to an
empty text; a null id is an id; repeated rows are texts of their own. A text is
read whole, whatever its length, by one task; blocks of ``block_words`` words bound the memory beyond
it. Only the named columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import extended, table

WORD = r"[^\x20\x09-\x0D]+"
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Grammar:
    """Levels of a sequence in which the numbers below ``separators`` each stand once, the first and the last among them.

    The nodes of all levels are numbered through: level 0 first. ``up`` is the node above that begins where a node begins (or -1),
    ``down`` the first node below, ``ahead`` and ``back`` how many equal nodes follow from it or end in it on a level whose blocks are compressed.
    """

    def __init__(self, sequence: np.ndarray, separators: int):
        sym, fresh, level = sequence, int(sequence.max()) + 1, 0
        syms, starts, blocks = [sym], [], []
        while len(sym) > 2 * separators - 1 and level < 128:  # more than a symbol a text
            level += 1
            if level % 2:
                first = np.flatnonzero(np.concatenate(([True], sym[1:] != sym[:-1])))
                if len(first) == len(sym):
                    continue
                size = np.diff(np.append(first, len(sym)))
                many = np.flatnonzero(size > 1)
                key = sym[first[many]] * (int(size.max()) + 1) + size[many]
            else:
                first, many, key = self._paired(sym, fresh, separators, level)
                if not len(many):
                    continue
            names, name = np.unique(key, return_inverse=True)
            sym = sym[first]
            sym[many] = fresh + name
            fresh += len(names)
            syms.append(sym)
            starts.append(first)
            blocks.append(level % 2 == 1)
        sizes = [len(s) for s in syms]
        at = np.concatenate(([0], np.cumsum(sizes)))
        self.words = sizes[0]
        self.sym = np.concatenate(syms)
        self.up, self.down = np.full(at[-1], -1, np.int64), np.arange(at[-1])
        self.ahead, self.back = np.ones(at[-1], np.int64), np.ones(at[-1], np.int64)
        for k, (first, block) in enumerate(zip(starts, blocks, strict=True)):
            self.up[at[k] + first] = np.arange(at[k + 1], at[k + 2])
            self.down[at[k + 1] : at[k + 2]] = at[k] + first
            if block:
                size = np.diff(np.append(first, sizes[k]))
                place = np.arange(sizes[k]) - np.repeat(first, size)
                self.back[at[k] : at[k + 1]] = place + 1
                self.ahead[at[k] : at[k + 1]] = np.repeat(size, size) - place

    @staticmethod
    def _paired(sym: np.ndarray, fresh: int, separators: int, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First nodes of the next level, which of them are pairs, and the pairs; the sides are dealt by a hash, left and right so that more pairs are made."""
        mixed = (sym.astype(np.uint64) + np.uint64(level << 40)) * np.uint64(0x9E3779B97F4A7C15)
        side = ((mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(63)).astype(bool)
        text = sym >= separators
        a, b = side & text, ~side & text
        pair, other = a[:-1] & b[1:], b[:-1] & a[1:]
        if other.sum() > pair.sum():
            pair = other
        left = np.flatnonzero(pair)
        begins = np.ones(len(sym), bool)
        begins[left + 1] = False
        first = np.flatnonzero(begins)
        return first, np.cumsum(begins)[left] - 1, sym[left] * fresh + sym[left + 1]

    def after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i on equal those from j on (i < j, of one text)."""
        return self._extend(i, j, 0)

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words up to i, itself left out, equal those up to j."""
        return self._extend(i, j, 1)

    def _extend(self, i: np.ndarray, j: np.ndarray, left: int) -> np.ndarray:
        # a place is the border at which a node begins; its symbol is the node itself, or to the left the one before it
        many = self.back if left else self.ahead
        out, who = np.zeros(len(i), np.int64), np.arange(len(i))
        x, y = i.astype(np.int64), j.astype(np.int64)
        while len(who):
            ux, uy = self.up[x], self.up[y]
            rise = (ux >= 0) & (uy >= 0) & (self.sym[ux - left] == self.sym[uy - left])
            same = self.sym[x - left] == self.sym[y - left]
            stop = ~rise & ~same & (x < self.words)
            if stop.any():
                out[who[stop]] = np.abs(x[stop] - i[who[stop]])
                go = ~stop
                who, x, y, ux, uy, rise, same = who[go], x[go], y[go], ux[go], uy[go], rise[go], same[go]
            step = np.minimum(many[x - left], many[y - left])
            if left:
                step = -step
            x, y = np.where(rise, ux, np.where(same, x + step, self.down[x])), np.where(rise, uy, np.where(same, y + step, self.down[y]))
        return out


def _ragged(counts: np.ndarray) -> np.ndarray:
    """0 .. c - 1 for every count c, one after another."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def grid(sizes: np.ndarray, least: int, times: int, periods: int = 64) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(text, place, period) of every harmonic grid, ``periods`` periods at a time."""
    order = np.argsort(-sizes, kind="stable")
    longest, q = int(sizes.max(initial=0)), 1
    while max(least, times * q) <= longest:
        qs = np.arange(q, q + periods)
        text = order[: np.searchsorted(-sizes[order], -max(least, times * q), side="right")]
        d, p = np.repeat(text, len(qs)), np.tile(qs, len(text))
        fits = sizes[d] >= np.maximum(least, times * p)
        d, p = d[fits], p[fits]
        step = np.maximum(least, times * p) - p
        count = (sizes[d] - p - 1) // step + 1
        yield np.repeat(d, count), _ragged(count) * np.repeat(step, count), np.repeat(p, count)
        q += periods


def runs_of(texts: list[np.ndarray], least: int = 6, times: int = 4) -> list[np.ndarray]:
    """For every text (an array of word numbers) its runs: rows of start, length, period by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    if not sizes.size or max(least, times) > sizes.max():
        return [np.zeros((0, 3), np.int64) for _ in texts]
    separators = len(texts) + 1
    base = np.cumsum(sizes + 1) - sizes  # where each text begins
    sequence = np.zeros(int(sizes.sum()) + separators, np.int64)
    words = np.ones(len(sequence), bool)
    edges = np.append(base - 1, len(sequence) - 1)
    words[edges] = False
    sequence[edges] = np.arange(separators)
    sequence[words] = np.concatenate(texts) + separators
    levels = Grammar(sequence, separators)
    found = []
    for d, place, q in grid(sizes, least, times):
        i = base[d] + place
        hit = sequence[i] == sequence[i + q]
        d, i, q = d[hit], i[hit], q[hit]
        back, ahead = levels.before(i, i + q), levels.after(i, i + q)
        length = back + ahead + q
        long = length >= np.maximum(least, times * q)
        found.append(np.stack([d, i - back - base[d], length, q], axis=1)[long])
    every = np.concatenate(found)
    every = every[np.lexsort((every[:, 3], every[:, 2], every[:, 1], every[:, 0]))]
    new = np.ones(len(every), bool)
    new[1:] = (every[1:, :3] != every[:-1, :3]).any(axis=1)
    every = every[new]
    every = every[np.lexsort((every[:, 3], every[:, 1], every[:, 0]))]
    at = np.searchsorted(every[:, 0], np.arange(len(texts) + 1))
    return [every[a:b, 1:] for a, b in zip(at[:-1], at[1:], strict=True)]


def _collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    if not len(runs):
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])


def find_runs(docs: DataFrame, keep: list[str], text: str = "text", least: int = 6, times: int = 4, block_words: int = 200_000) -> DataFrame:
    """The columns ``keep`` of ``docs``, the runs of each whole text and ``collapsed``: the words left when of each run its first period stays, joined by one space."""
    schema = extended(docs, keep, runs=RUNS, collapsed="string")
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def searched(batch: pa.RecordBatch, words: list[list[bytes]]) -> pa.RecordBatch:
        number: defaultdict[bytes, int] = defaultdict()
        number.default_factory = number.__len__
        runs = runs_of([np.fromiter(map(number.__getitem__, w), np.int64, len(w)) for w in words], least, times)
        found = [[{"start": s, "length": n, "period": q} for s, n, q in r.tolist()] for r in runs]
        short = pa.array([_collapsed(w, r) for w, r in zip(words, runs, strict=True)], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(found, kind), short], names=[*keep, "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, words, size = 0, [], 0
            for n, b in enumerate(batch.column("_text").cast(pa.binary())):
                words.append((b.as_py() or b"").split())  # bytes split at the six ASCII spaces only
                size += len(words[-1])
                if size >= block_words or n + 1 == batch.num_rows:
                    yield searched(batch.slice(at, n + 1 - at), words)
                    at, words, size = n + 1, [], 0

    return docs.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def repeating(doc_id: Column, text: Column) -> Column:
    """The texts of the registered query: of every tenth id (by crc32) the words from one on repeat, others stay."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    w = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n = F.greatest(F.size(w), F.lit(1)).cast("long")
    a = g % n
    p = 1 + F.floor((n - a) / (3 + g % 8))
    period = F.slice(w, (a + 1).cast("int"), p.cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int"))), F.lit(1), (n - a).cast("int"))
    made = F.array_join(F.concat(F.slice(w, F.lit(1), a.cast("int")), tail), " ")
    return F.when((h % 10 == 0) & F.regexp_like(text, F.lit(WORD)), made).otherwise(text)


def op13_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words of every document, of which every tenth is made to repeat first. A null id takes no part in that."""
    docs = table(spark, sf_dir, "documents").select("doc_id", repeating(F.col("doc_id"), F.col("text")).alias("text"))
    found = find_runs(docs, ["doc_id"])
    first = F.expr("cast(null as struct<start:bigint,length:bigint,period:bigint>)")
    # lengths times periods compare the ratios exactly; runs come by start, then period
    best = F.aggregate("runs", first, lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    found = found.withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
