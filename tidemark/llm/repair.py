"""Token ids as files: Re-Pair grammars of shards, with random access to a document.

Documents are range-partitioned by id, tokenised and cut into
shards of about ``shard_ids`` ids. In a shard, frequent adjacent pairs of ids are replaced by
new symbols, until none occurs ``least`` times: each round counts pairs and replaces the most
frequent ones that do not overlap each other (no symbol is the first of one pair and
the second of another). Pairs never reach over the end of a document, so a document
is a slice of the shard's symbols and is decoded alone.

The file format is a Parquet table with one row for a shard:
``part, seq``      place in the order of documents
``doc_id``         ids of the documents, ascending
``ends``           where each document ends in the symbols
``sizes``          how many ids each document has
``first_rule``     the least symbol that is a rule; smaller ones are ids
``rules``          two unsigned 32-bit symbols for each rule, in the order they were made
``lengths``        how many ids each rule expands to (unsigned 32 bits)
``symbols``        the shard's symbols, little-endian, 16 bits if they fit and else 32

Defined cases: a null or empty text has only the end id; a null doc_id comes first in
the order; repeated rows and ids are documents of their own, ordered by their text; only the named columns are
read. An empty table writes no shard and reads back as no row.
"""

from __future__ import annotations

import re
import struct
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.session import work_path

_SCHEMA = "part long, seq long, doc_id array<long>, ends array<int>, sizes array<int>, first_rule int, rules binary, lengths binary, symbols binary"
_STATE: dict = {}


#: Characters behind the last letter that has one code point, lower case by itself, and no combining form; and the one before it that has not.
_ODD = re.compile("[^\0-\u024f]|\u0130")


#: The byte-level step's letter for each byte: printable ones of Latin-1 for themselves, the others from U+0100 on.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: b if b in _PRINTABLE else 256 + len(set(range(b)) - _PRINTABLE) for b in range(256)}

_BLANK = re.compile(r"[ \t\n\r\x0b\x0c]+")


def _split(text: str) -> list[str]:
    """Parts between white space; four separators that Python counts as such are none to the tokenizer."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [p for p in _BLANK.split(text) if p]
    return text.split()


def _latin(text: str) -> bool:
    """Whether all characters are below U+0100: quicker than a search, and most texts of Latin letters are."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _plain_words(pattern: str):
    """findall of the tokenizer's split pattern by Python's own engine, for lowered texts without ``_ODD`` characters: its classes are spelled out over these characters."""
    seen = sorted({c for i in range(0x250) if i != 0x130 for c in chr(i).lower()})
    white = "\t\n\x0b\x0c\r \x85\xa0"  # White_Space among them
    spelled = {"\\s": white, "\\p{L}": [c for c in seen if unicodedata.category(c)[0] == "L"], "\\p{N}": [c for c in seen if unicodedata.category(c)[0] == "N"]}
    # what begins with an apostrophe may as well be tried after the letters, which do not
    pattern = re.sub(r"^((?:'\w+\|)+)(\[\\p\{L\}\]\+\|)", r"\2\1", pattern)
    for name, chars in spelled.items():
        pattern = pattern.replace(name, "".join(map(re.escape, chars)))
    return re.compile(pattern).findall


class Encoder(dict):
    """The tokenizers library behind a memory of what it has encoded: ids as bytes, by word.

    The vocabulary drops white space and never joins over it, so a text's ids are those of the words that the
    tokenizer's own pattern finds in it. A text of Latin letters is lowered and cut here, since that is what the
    tokenizer does first; of other texts, the white-space separated parts with other letters go to it as they are.
    Words are remembered in two generations of ``cache``: when the young one is full, it becomes the old one.
    """

    def __init__(self, path: str, cache: int):
        import json

        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.tokens = self.tokenizer.model.tokenize
        with open(path, encoding="utf-8") as f:
            split = json.load(f)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = _plain_words(split)
        self.old: dict[str, bytes] = {}
        self.cache = cache

    def __missing__(self, word: str) -> bytes:
        got = self.old.get(word)
        if got is None:
            if word.isascii() and word.isprintable():
                ids = [t.id for t in self.tokens(word)]
            elif _ODD.search(word):
                ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            else:  # its bytes, as the byte-level step spells them
                ids = [t.id for t in self.tokens(word.encode().decode("latin-1").translate(_BYTES))]
            got = array("I", ids).tobytes()
        if len(self) >= self.cache:
            self.old = dict(self)
            self.clear()
        self[word] = got
        return got

    def _cut(self, text: str) -> list[str]:
        """Words and other parts of a text in order."""
        if text.isascii() or _latin(text) or not _ODD.search(text):
            return self.words(text.lower())
        out = []
        for p in _split(text):
            if _ODD.search(p):
                out.append(p)
            else:
                out += self.words(p.lower())
        return out

    def texts(self, texts: list[str | None], end: bytes) -> list[bytes]:
        """Ids of each text and the end id, as little-endian unsigned 32-bit integers."""
        get = self.__getitem__
        return [b"".join(map(get, self._cut(x or ""))) + end for x in texts]


def _encoder(path: str, cache: int) -> Encoder:
    if _STATE.get("path") != path:
        _STATE.update(path=path, encoder=Encoder(path, cache))
    return _STATE["encoder"]


def _places(order: np.ndarray, x: np.ndarray, y: np.ndarray, symbols: int) -> np.ndarray:
    """Where each pair (x, y) stands in ``order`` (sorted keys of pairs of symbols below ``symbols``), or -1; by a table of all sides if that is small."""
    left, row = np.unique(order >> 32, return_inverse=True)
    right, column = np.unique(order & 0xFFFFFFFF, return_inverse=True)
    if len(left) * len(right) > 1 << 22:
        key = (x << 32) | y
        at = np.minimum(np.searchsorted(order, key), len(order) - 1)
        return np.where(order[at] == key, at, -1)
    table_ = np.full(len(left) * len(right), -1, np.int32)
    table_[row * len(right) + column] = np.arange(len(order))
    rows, columns = np.zeros(symbols, np.int64), np.zeros(symbols, np.int64)
    rows[left], columns[right] = np.arange(len(left)) * len(right), np.arange(len(right))
    return table_[rows[x] + columns[y]]


def compress(ids: np.ndarray, last: np.ndarray, rounds: int | None, least: int, most_rules: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(symbols, ends' mask, rules, first rule) of one shard; ``last`` marks the last id of each document.

    Rounds go on until no pair occurs ``least`` times (or for ``rounds`` of them). After the first, only pairs that can be frequent
    are counted: those with a symbol that the round before made, and those that were frequent and not replaced.
    """
    s = ids.astype(np.int64)
    first = int(s.max()) + 1 if len(s) else 0
    rules: list[tuple[int, int]] = []
    fresh, waits_left, waits_right, done = 0, np.zeros(0, bool), np.zeros(0, bool), 0
    while len(s) > 1 and (rounds is None or done < rounds):
        done += 1
        a, b = s[:-1], s[1:]
        counted = ~last[:-1]
        if fresh:
            new = s >= fresh
            fits = new[:-1] | new[1:]
            wait = np.flatnonzero(waits_left.take(a, mode="clip"))
            fits[wait[waits_right[b[wait]]]] = True
            counted &= fits
        pair, count = np.unique((a[counted] << 32) | b[counted], return_counts=True)
        fresh = first + len(rules)
        often = np.flatnonzero(count >= least)
        often = often[np.lexsort((pair[often], -count[often]))][: most_rules - len(rules)]
        left, right, chosen = set(), set(), []
        for p in pair[often].tolist():
            x, y = p >> 32, p & 0xFFFFFFFF
            if x not in right and y not in left:
                if x == y and (x in left or y in right):
                    continue
                left.add(x)
                right.add(y)
                chosen.append(p)
        if not chosen:
            break
        order = np.sort(np.array(chosen))
        is_left, is_right = np.zeros(fresh, bool), np.zeros(fresh, bool)
        is_left[list(left)], is_right[list(right)] = True, True
        hit = np.flatnonzero(is_left.take(a, mode="clip") & counted)
        hit = hit[is_right[b[hit]]]
        at = _places(order, a[hit], b[hit], fresh)
        hit, at = hit[at >= 0], at[at >= 0]
        # only runs of one symbol have hits next to each other: every second one of a run counts
        start = np.concatenate(([True], np.diff(hit) > 1))
        offset = np.arange(len(hit)) - np.maximum.accumulate(np.where(start, np.arange(len(hit)), 0))
        hit, at = hit[offset % 2 == 0], at[offset % 2 == 0]
        s[hit] = first + len(rules) + at
        last = last.copy()
        last[hit] = last[hit + 1]
        keep = np.ones(len(s), bool)
        keep[hit + 1] = False
        s, last = s[keep], last[keep]
        waits_left, waits_right = np.zeros(fresh + len(order), bool), np.zeros(fresh + len(order), bool)
        rest = np.setdiff1d(pair[often], order)
        waits_left[rest >> 32] = waits_right[rest & 0xFFFFFFFF] = True
        rules += [(int(p) >> 32, int(p) & 0xFFFFFFFF) for p in order]
    return s, last, np.array(rules, np.int64).reshape(-1, 2), first


def expand(symbols: np.ndarray, rules: np.ndarray, first: int) -> np.ndarray:
    """Ids of any slice of a shard's symbols: what each rule stands for is written out once, and gathered."""
    s = symbols.astype(np.int64)
    big = s >= first
    if not big.any():
        return s
    whole: list[bytes] = []
    for a, b in rules[: int(s.max()) - first + 1].tolist():
        whole.append((whole[a - first] if a >= first else struct.pack("<I", a)) + (whole[b - first] if b >= first else struct.pack("<I", b)))
    size = np.array([len(w) // 4 for w in whole], np.int64)
    begin = np.cumsum(size) - size
    rule = np.where(big, s - first, 0)
    length = np.where(big, size[rule], 1)
    at = np.cumsum(length) - length
    out = np.frombuffer(b"".join(whole), "<u4")[np.repeat(np.where(big, begin[rule], 0) - at, length) + np.arange(int(length.sum()))].astype(np.int64)
    out[at[~big]] = s[~big]
    return out


def expansion_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    n: list[int] = []
    for a, b in rules.tolist():
        n.append((n[a - first] if a >= first else 1) + (n[b - first] if b >= first else 1))
    return np.array(n, np.int64)


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, path: str, shard_ids: int = 500_000, rounds: int | None = None, least: int = 40, most_rules: int = 1 << 31, cache: int = 700_000) -> None:
    """Write the ids of (doc_id, text), an end id after each text, as shards in ascending doc_id order.

    Pairs are replaced until none occurs ``least`` times in its shard; a rule takes the room of some six occurrences, and rounds take their time.
    """
    # texts are dealt, not ids: the ranges are sampled beforehand, and that must not tokenise
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(tokenizer, cache), np.array([end_id], "<u4").tobytes()
        part, seq, doc, ids, held = TaskContext.get().partitionId(), 0, [], [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500)
                for i, x in zip(rows.column("doc_id").to_pylist(), encoder.texts(rows.column("text").to_pylist(), end), strict=True):
                    doc.append(i)
                    ids.append(np.frombuffer(x, "<u4"))
                    held += len(ids[-1])
                    if held >= shard_ids:
                        yield shard(part, seq, doc, ids)
                        seq, doc, ids, held = seq + 1, [], [], 0
        if doc:
            yield shard(part, seq, doc, ids)

    def shard(part: int, seq: int, doc: list, ids: list) -> pa.RecordBatch:
        sizes = np.array([len(x) for x in ids])
        last = np.zeros(sizes.sum(), bool)
        last[np.cumsum(sizes) - 1] = True
        s, last, rules, first = compress(np.concatenate(ids), last, rounds, least, most_rules)
        kind = "<u2" if first + len(rules) <= 1 << 16 else "<u4"
        row = {
            "part": part, "seq": seq, "doc_id": doc, "ends": (np.flatnonzero(last) + 1).tolist(), "sizes": sizes.tolist(), "first_rule": first,
            "rules": rules.astype("<u4").tobytes(), "lengths": expansion_lengths(rules, first).astype("<u4").tobytes(), "symbols": s.astype(kind).tobytes(),
        }
        return pa.RecordBatch.from_pylist([row], schema=schema)

    schema = pa.schema([("part", pa.int64()), ("seq", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("ends", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32())), ("first_rule", pa.int32()), ("rules", pa.binary()), ("lengths", pa.binary()), ("symbols", pa.binary())])
    ordered.mapInArrow(run, _SCHEMA).write.parquet(path)


def _parsed(first: int, rules: bytes, symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
    r = np.frombuffer(rules, "<u4").reshape(-1, 2)
    return r.astype(np.int64), np.frombuffer(symbols, "<u2" if first + len(r) <= 1 << 16 else "<u4")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document of the shards: ``start`` counts the ids of all documents before it."""
    shards = spark.read.schema(_SCHEMA).parquet(path)
    sizes = shards.select("part", "seq", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x).alias("n"))
    # one row for each task that wrote, then one for each shard of it
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("p"))
    inner = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    begin = sizes.withColumn("q", F.coalesce(F.sum("n").over(inner), F.lit(0))).join(parts, "part").select("part", "seq", (F.col("p") + F.col("q")).alias("begin"))
    shards = shards.join(begin, ["part", "seq"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in ("doc_id", "ends", "sizes", "first_rule", "rules", "symbols", "begin")}
                rules, symbols = _parsed(row["first_rule"], row["rules"], row["symbols"])
                ids = expand(symbols, rules, row["first_rule"]).astype("<u4")
                ends = np.cumsum(row["sizes"])
                starts = ends - row["sizes"]
                out = [ids[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_id"], pa.int64()), pa.array(starts + row["begin"], pa.int64()), pa.array(out, pa.binary())], names=["doc_id", "start", "ids"])

    return shards.mapInArrow(run, "doc_id long, start long, ids binary")


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """Ids of the documents with one id, from their slices of their shards alone."""
    rows = spark.read.schema(_SCHEMA).parquet(path).where(F.array_contains("doc_id", doc_id)).collect()
    out = []
    for r in rows:
        rules, symbols = _parsed(r["first_rule"], r["rules"], r["symbols"])
        for i, d in enumerate(r["doc_id"]):
            if d == doc_id:
                out.append(expand(symbols[r["ends"][i - 1] if i else 0 : r["ends"][i]], rules, r["first_rule"]).tolist())
    return out


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokenise every document, write the shards, read them back, and digest what was read."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = work_path(spark, "repair-shards")
    write_shards(docs, public_tokenizers.path("word_bpe_49k.json"), 2, path)
    return read_ids(spark, path).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
