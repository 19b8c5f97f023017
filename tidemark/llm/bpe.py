"""Byte-level BPE encoding and decoding.

A text is cut by the tokenizer's split pattern. A word is held as a string with
one character (U+0000-U+00FF) for each of its UTF-8 bytes; the rank file is a
literal array of small maps, addressed by a hash of the piece, so a lookup
reads a few entries whatever the vocabulary's size. The merges of a word are an
``aggregate`` over its bytes whose state is (pieces, ranks of adjacent pairs):
each step joins the leftmost pair of lowest rank and looks up the two new pairs.

The fold runs on distinct words: words are counted over the whole corpus and
the ``dictionary`` most frequent ones folded by Spark (their table is bounded by
``dictionary`` rows of at most ``max_word`` bytes, and broadcast). The tail of
rare words is folded by the Arrow task that meets them, by the same merges:
Spark's interpreted fold takes about 100 microseconds a word, and most distinct
words of a corpus occur once. Ids do not depend on which of the two met a word.
Decoding is a Spark expression: the ids' pieces, concatenated, as binary.

Defined cases: a null text encodes as the empty text (no ids, the digest of
the empty string); rows are independent, so repeated rows and ids give repeated
results; only the named columns are read, other columns and their names do
not matter; an empty table gives an empty result of the same schema.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
import struct
import unicodedata
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import extended, saved, table

_BUCKETS = 16384


def _let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once inside an expression."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def _bucket(key: Column, n: int) -> Column:
    return (F.crc32(key.cast("binary")) % n + 1).cast("int")


def read_ranks(path: str) -> dict[str, int]:
    """Rank file -> {piece as a one-character-per-byte string: rank}."""
    with open(path, "rb") as f:
        return {base64.b64decode(a).decode("latin-1"): int(b) for a, b in map(bytes.split, f)}


class ByteBpe:
    """Encode and decode expressions for one rank file and split pattern."""

    def __init__(self, ranks: dict[str, int], pattern: str):
        self.ranks, self.split = ranks, pattern
        # Unicode classes, as the tokenizer's own regex engine has them.
        self.pattern = "(?U)" + pattern
        buckets: list[dict[str, int]] = [{} for _ in range(_BUCKETS)]
        for piece, rank in ranks.items():
            buckets[zlib.crc32(piece.encode()) % _BUCKETS][piece] = rank
        self._ranks = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,int>>")
        by_id = [""] * (max(ranks.values(), default=-1) + 1)
        for piece, rank in ranks.items():
            by_id[rank] = piece
        self._pieces = F.from_json(F.lit(json.dumps(by_id)), "array<string>")

    @staticmethod
    def rank(ranks: Column, piece: Column) -> Column:
        """Rank of a piece; null if it is no vocabulary entry."""
        return F.try_element_at(F.element_at(ranks, _bucket(piece, _BUCKETS)), piece)

    def words(self, text: Column) -> Column:
        """The matches of the split pattern, in order."""
        return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(self.pattern), F.lit(0))

    @staticmethod
    def as_bytes(word: Column) -> Column:
        """One character per UTF-8 byte."""
        return F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")

    def fold(self, word: Column) -> Column:
        """Ids of one non-empty word (as bytes): ranked merges, lowest rank first, leftmost on ties. The literal rank map is bound once."""
        return _let(self._ranks, lambda ranks: self._fold(word, lambda piece: self.rank(ranks, piece)))

    @staticmethod
    def _fold(word: Column, rank: Callable[[Column], Column]) -> Column:
        def step(s: Column, _: Column) -> Column:
            low = F.array_min(s["r"])
            return F.when(low.isNull(), s).otherwise(_let(F.struct(s["p"].alias("p"), s["r"].alias("r"), F.array_position(s["r"], low).cast("int").alias("i")), join))

        def join(t: Column) -> Column:
            p, r, i = t["p"], t["r"], t["i"]
            n = F.size(p)
            new = F.concat(F.element_at(p, i), F.element_at(p, i + 1))
            return _let(
                new,
                lambda w: F.struct(
                    F.concat(F.slice(p, F.lit(1), i - 1), F.array(w), F.slice(p, i + 2, n)).alias("p"),
                    F.concat(
                        F.when(i > 1, F.concat(F.slice(r, F.lit(1), i - 2 + F.when(i < 2, 1).otherwise(0)), F.array(rank(F.concat(F.try_element_at(p, i - 1 + F.when(i < 2, 1).otherwise(0)), w))))).otherwise(F.slice(r, F.lit(1), F.lit(0))),
                        F.when(i + 1 < n, F.array(rank(F.concat(w, F.try_element_at(p, i + 2))))).otherwise(F.slice(r, F.lit(1), F.lit(0))),
                        F.slice(r, i + 2, n),
                    ).alias("r"),
                ),
            )

        def merged(w: Column) -> Column:
            n = F.length(w)
            pieces = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(w, i, F.lit(1)))
            first = F.transform(F.sequence(F.lit(1), n - 1), lambda i: rank(F.substring(w, i, F.lit(2))))
            return F.aggregate(F.sequence(F.lit(1), n - 1), F.struct(pieces.alias("p"), first.alias("r")), step, lambda s: F.transform(s["p"], rank))

        # a whole vocabulary entry is one id, whatever its merges would give
        return _let(word, lambda w: _let(rank(w), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(merged(w))))

    def decode_ids(self, ids: Column) -> Column:
        """Bytes of an id sequence: the pieces, concatenated."""
        return F.encode(F.array_join(F.transform(ids, lambda i: F.element_at(self._pieces, i + 1)), ""), "ISO-8859-1")


def frequent_words(bpe: ByteBpe, docs: DataFrame, text_col: str, dictionary: int, max_word: int) -> list:
    """(word, ids as text) of the most frequent words of all texts; at most ``dictionary`` rows.

    A histogram of counts gives the least count that a word of the dictionary has, so
    only these words leave the executors, however many partitions the counts have.
    """
    words = docs.select(F.explode(bpe.words(F.col(text_col))).alias("w"))
    counts = words.groupBy("w").agg(F.count(F.lit(1)).alias("c")).where((F.octet_length("w") <= max_word) & (F.col("c") > 1))
    counts = saved(counts.withColumn("step", F.floor(F.log2("c") * 16)), "bpe-counts")
    steps = sorted(((r["step"], r["count"]) for r in counts.groupBy("step").count().collect()), reverse=True)
    room, least = dictionary, None
    for step, n in steps:
        room -= n
        if room < 0:
            break
        least = step
    if least is None:
        return []
    ids = F.array_join(bpe.fold(bpe.as_bytes(F.col("w"))).cast("array<string>"), ",")
    return [(r["w"], r["ids"]) for r in counts.where(F.col("step") >= least).select("w", ids.alias("ids")).collect()]


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: join the leftmost adjacent pair of lowest rank until none is in ``ranks``.

    A heap of pairs over a linked list of pieces, so a word of n bytes takes n log n steps.
    """
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    n = len(word)
    piece: list = [word[i : i + 1] for i in range(n)]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = after[i] if piece[i] is not None else n
        if j >= n or len(piece[i]) + len(piece[j]) != size:
            continue  # one of the two was joined with another piece meanwhile
        piece[i] += piece[j]
        piece[j] = None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            if (r := ranks.get(piece[i] + piece[k])) is not None:
                heapq.heappush(heap, (r, i, len(piece[i]) + len(piece[k])))
        h = before[i]
        if h >= 0 and (r := ranks.get(piece[h] + piece[i])) is not None:
            heapq.heappush(heap, (r, h, len(piece[h]) + len(piece[i])))
    return [ranks[p] for p in piece if p is not None]


class Words(dict):
    """Ids of words as little-endian bytes, by word: ``joined(map(words.__getitem__, ...))`` is a text's ids.

    A word that is not there comes from the ``fixed`` ones (folded by Spark), from those remembered before, or from its
    merges. Words are remembered in two generations of ``cache``: when the young one is full, it becomes the old one.
    """

    def __init__(self, fixed: dict[str, bytes], ranks: dict[bytes, int], cache: int, max_word: int):
        super().__init__()
        self.fixed, self.ranks, self.cache, self.max_word, self.old = fixed, ranks, cache, max_word, {}

    def __missing__(self, word: str) -> bytes:
        got = self.fixed.get(word) or self.old.get(word)
        if got is None:
            ids = merge_word(word.encode(), self.ranks)
            got = struct.pack(f"<{len(ids)}i", *ids)
            if len(word) > self.max_word:
                return got
        if len(self) >= self.cache:
            self.old = dict(self)
            self.clear()
        self[word] = got
        return got


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """findall of a split pattern, as the tokenizer's own engine does it.

    Texts up to U+024F are split by Python's standard engine, with the classes spelled out over these characters; others by one that knows the classes.
    """
    import regex

    # White_Space is what the tokenizer's engine takes for \s; Python's own class has four more characters
    whole = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
    kinds = {kind: "".join(re.escape(c) for c in map(chr, range(0x250)) if unicodedata.category(c)[0] == kind) for kind in "LN"}
    white = "\t\n\x0b\x0c\r \x85\xa0"
    some, inside = "", False
    for piece in re.findall(r"\\[pP]\{\w+\}|\\.|.", pattern, re.DOTALL):
        if piece in ("[", "]"):
            inside = piece == "["
        if piece in (r"\p{L}", r"\p{N}"):
            piece = kinds[piece[3]] if inside else f"[{kinds[piece[3]]}]"
        elif piece == r"\s":
            piece = white if inside else f"[{white}]"
        elif piece == r"\S" and not inside:
            piece = f"[^{white}]"
        elif re.fullmatch(r"\\[pPwWdDbBsS].*", piece):
            return whole  # a pattern with other classes
        some += piece
    plain, other = re.compile(some).findall, re.compile("[^\0-\u024f]").search
    return lambda text: whole(text) if other(text) else plain(text)


_WORKER: dict = {}


def _worker_state(shared, pattern: str, cache: int = 200_000, max_word: int = 64) -> tuple:
    """The splitter, the words folded by Spark, the ranks, and all words; built once per Python worker."""
    key = (shared.value["id"], pattern, cache, max_word)
    if _WORKER.get("key") != key:
        ranks = {k.encode("latin-1"): v for k, v in shared.value["ranks"].items()}
        fixed = {w: struct.pack(f"<{len(ids)}i", *ids) for w, ids in ((w, [int(i) for i in t.split(",")]) for w, t in shared.value["words"])}
        _WORKER.update(key=key, find=splitter(pattern), words=Words(fixed, ranks, cache, max_word))
    words = _WORKER["words"]
    return _WORKER["find"], words.fixed, words.ranks, words


def encode(docs: DataFrame, bpe: ByteBpe, text_col: str = "text", ids_col: str = "ids", dictionary: int = 65536, max_word: int = 64, cache: int = 400_000) -> DataFrame:
    """``docs`` with ``ids_col`` array<int>, the ids of each whole text.

    ``dictionary``: how many frequent words Spark folds beforehand; ``cache``: how many
    words of each of two generations a worker remembers. Neither changes an id.
    An existing column named ``ids_col`` is replaced.
    """
    import uuid

    spark = docs.sparkSession
    docs = docs.drop(ids_col)
    shared = spark.sparkContext.broadcast({"id": uuid.uuid4().hex, "ranks": bpe.ranks, "words": frequent_words(bpe, docs, text_col, dictionary, max_word)})
    pattern = bpe.split

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, _, _, words = _worker_state(shared, pattern, cache, max_word)
        get = words.__getitem__
        for batch in batches:
            out = [b"".join(map(get, find(text.as_py() or ""))) for text in batch.column(text_col)]
            ends = np.concatenate(([0], np.cumsum([len(x) // 4 for x in out]))).astype(np.int32)
            flat = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(out))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(ends), flat)], names=[*batch.schema.names, ids_col])

    return docs.mapInArrow(run, extended(docs, docs.columns, **{ids_col: "array<int>"}))


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document with the many-language rank file, decode the ids, and digest both."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""
    bpe = ByteBpe(read_ranks(path), pattern)
    ids = F.col("ids")
    return encode(docs.select("doc_id", "text"), bpe).select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(bpe.decode_ids(ids), 256).alias("decoded_sha256"),
    )
