"""Personal data: fixed patterns, and spans that a semi-Markov CRF adds.

The base spans are the leftmost non-overlapping matches of four patterns
(email, ip, card, phone), each with its check. The model looks for the same kinds
in forms that the patterns miss (``name (at) host dot com``, a card cut by dots, a phone
without a plus). It scores whole candidate segments: digit-group lengths,
separators, checksum, greatest part, what stands before and after. Dynamic programming over
segments of at most ``MAX_TOKENS`` tokens chooses boundaries and kinds together;
a token outside of every segment scores 0. A segment holds a digit, an at sign or the word
"at" with a dot after it, so only the tokens that a segment with one of these can reach
are visited, which gives the same best segmentation as the whole text. Spans of the model that touch a base span are left out: base ones stay.

The weights are trained here by the CRF's likelihood on a bounded sample
(``sample`` stretches around digits, at signs and the word "at", chosen by hash): base matches
are the labels, some rewritten into the other forms, with and without digits; all other digits and
"at", and numbers made invalid, are the negatives.

Defined cases: a null text is an empty one and has no spans; rows are
independent (repeated rows give repeated results); with nothing to learn from the
model adds nothing; only the named columns are read; an empty table gives
an empty result of the same schema. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import heapq
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import extended, table

KINDS = ("email", "ip", "card", "phone")
MAX_TOKENS, MAX_CHARS = 40, 90
_CELLS = 1 << 14

_ANY = re.compile(r"[0-9@]")
# What every candidate segment holds: a digit, an at sign, or the word "at" before a dot that a segment could reach.
_TRIGGER = re.compile(r"[0-9]|@|(?<![A-Za-z])[Aa][Tt](?![A-Za-z])(?=[A-Za-z0-9 .\-/()+\[\]_%]{0,90}?(?:\.|[Dd][Oo][Tt]))")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")  # a match cannot begin inside a run of digits
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_TOKEN = re.compile(r"[A-Za-z]+|[0-9]+|\s|[^A-Za-z0-9\s]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches, sorted."""
    if not _ANY.search(text):
        return []
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, 0, m.end()))
            last = m.end()
        else:
            last = max(last, at + 1)  # a local part does not reach over an at sign
        at = text.find("@", max(last, at + 1))
    for m in _IP.finditer(text):
        if all(int(p) <= 255 if len(p) < 10 else not p.lstrip("0")[3:] and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            d = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def stretches(text: str) -> list[list[tuple[int, int]]]:
    """Token runs (as (start, end) offsets) within ``MAX_CHARS`` of a trigger on its line; runs that meet are one.

    A candidate segment holds a trigger and has at most ``MAX_CHARS`` characters: it lies whole in one run."""
    runs: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        lo, hi = max(0, m.start() - MAX_CHARS), min(len(text), m.end() + MAX_CHARS)
        lo = text.rfind("\n", lo, m.start()) + 1 or lo
        line = text.find("\n", m.end(), hi)
        hi = line if line >= 0 else hi
        if runs and lo < runs[-1][1]:
            runs[-1][1] = hi
        else:
            runs.append([lo, hi])
    return [[(t.start(), t.end()) for t in _TOKEN.finditer(text, lo, hi)] for lo, hi in runs]


def _class(c: str) -> str:
    return "" if not c else "a" if c.isalpha() else "d" if c.isdigit() else "s" if c.isspace() else c


_AT, _DOT = re.compile(r"(?i)[\[(]at[\])]| at "), re.compile(r"(?i)[\[(]\.[\])]|[\[(]dot[\])]| dot ")
_SPOKEN = re.compile(r"(?i)[\[(]dot[\])]| dot ")


def span_features(text: str, a: int, b: int) -> np.ndarray:
    """Cells of the features of the segment text[a:b]."""
    s = text[a:b]
    runs = _DIGITS.findall(s)
    n = sum(map(len, runs))
    letters = any(c.isalpha() for c in s)
    at, dot = s.count("@") + len(_AT.findall(s)), len(_DOT.findall(s))
    seps = "".join(sorted({"a" if c.isalpha() else c for c in s if not c.isdigit()}))
    shape = "-".join(str(min(len(r), 9)) for r in runs[:8])
    small = all(len(r) < 4 and int(r) < 256 for r in runs)
    tail = s.rsplit(".", 1)[-1].rsplit(" ", 1)[-1]
    if letters:  # how an address is spelled: an end of a sentence is no dot of a host
        said, spoken = _AT.search(s), bool(_SPOKEN.search(s))
        form = "@" if not said else "b" if said[0][0] in "[(" else "w"
        own = [f"form{form}", f"spoken{spoken}", f"form{form}spoken{spoken}", f"stop{'. ' in s}", f"user{min(s.count(' ', 0, said.start()), 3) if said else ''}"]
    else:
        own = [f"runs{min(len(runs), 6)}", f"small{small}", f"luhn{12 <= n <= 19 and luhn(''.join(runs))}{'c' if 12 <= n <= 19 else ''}", f"runs{len(runs) == 4}small{small}", f"long{max(map(len, runs), default=0) > 4}"]
    f = [
        *own, "bias", f"n{min(n, 20)}", f"at{min(at, 2)}", f"let{letters}", f"sep{seps if len(seps) < 6 else 'many'}" if not letters else f"dots{min(s.count('.') + dot, 4)}",
        f"shape{shape}" if not letters else f"tail{tail.isalpha() and 1 < len(tail) < 7}",
        f"first{_class(s[0])}", f"last{_class(s[-1])}", f"prev{_class(text[a - 1 : a])}", f"next{_class(text[b : b + 1])}", f"paren{s.count('(') - s.count(')')}",
        f"at{min(at, 2)}dots{min(s.count('.') + dot, 3)}", f"w{min(s.count(' '), 6)}{letters}",
    ]
    return np.array([zlib.crc32(x.encode()) % _CELLS for x in f])


def segments(text: str, tokens: list[tuple[int, int]]) -> list[tuple[int, int, bool]]:
    """Candidate (first token, end token, whether letters are in): what an entity of some kind could be."""
    out = []
    for i, (a, b) in enumerate(tokens):
        c = text[a]
        if not (c.isascii() and (c.isalnum() or c in "+(")) or (a and text[a - 1].isalnum()):
            continue
        digits = letters = ats = dots = 0
        for j in range(i, min(len(tokens), i + MAX_TOKENS)):
            x, y = tokens[j]
            t = text[x:y]
            if y - a > MAX_CHARS or not t.isascii() or t == "\n":
                break
            if t[0].isdigit():
                digits += y - x
            elif t[0].isalpha():
                letters += 1
                ats += t.lower() == "at"
                dots += ats > 0 and t.lower() == "dot"
            elif t == "@":
                ats += 1
            elif t == ".":
                dots += ats > 0
            elif t not in " .-/()+[]_%":
                break
            if letters and not ats and text.count(" ", a, x) and digits == 0:
                if "at" not in text[x : x + 40].lower() and "@" not in text[x : x + 40]:
                    break
            if ats > 1 or letters and text.count(" ", a, y) > 6:
                break
            if (text[y - 1].isalnum() or text[y - 1] == ")") and not text[y : y + 1].isalnum():
                # an address has a dot after its at sign, and ends with a word after the dot
                if letters and ats == 1 and dots and t[0].isalpha() and t.lower() not in ("at", "dot") and y - a >= 6:
                    out.append((i, j + 1, True))
                elif not letters and not ats and 7 <= digits <= 19:
                    out.append((i, j + 1, False))
    return out


def _lattice(text: str, tokens: list, found: list) -> tuple[list, np.ndarray]:
    seg = [(i, j, k) for i, j, letters in found for k in ((0,) if letters else (1, 2, 3))]
    cache: dict = {}
    cells = [cache[i, j] if (i, j) in cache else cache.setdefault((i, j), span_features(text, tokens[i][0], tokens[j - 1][1])) for i, j, _ in seg]
    return seg, (np.array(cells) + np.array([k for *_, k in seg])[:, None] * _CELLS if seg else np.zeros((0, 0), np.int64))


def viterbi(n: int, seg: list, score: np.ndarray) -> list[tuple[int, int, int]]:
    """Segments (first, end, kind) of the best segmentation of n tokens; ties prefer no segment."""
    best, back = np.zeros(n + 1), [None] * (n + 1)
    ending: dict[int, list[int]] = {}
    for x, (_, j, _k) in enumerate(seg):
        ending.setdefault(j, []).append(x)
    for j in range(1, n + 1):
        best[j] = best[j - 1]
        for x in ending.get(j, ()):
            v = best[seg[x][0]] + score[x]
            if v > best[j] + 1e-12:
                best[j], back[j] = v, x
    out, j = [], n
    while j > 0:
        if back[j] is None:
            j -= 1
        else:
            out.append(seg[back[j]])
            j = seg[back[j]][0]
    return out[::-1]


def _expected(n: int, seg: list, score: np.ndarray) -> np.ndarray:
    """Probability of every segment: forward-backward over segment ends."""
    fwd, bwd = np.full(n + 1, -np.inf), np.full(n + 1, -np.inf)
    fwd[0] = bwd[n] = 0.0
    order = sorted(range(len(seg)), key=lambda x: seg[x][1])
    at = 0
    for j in range(1, n + 1):
        fwd[j] = fwd[j - 1]
        while at < len(order) and seg[order[at]][1] == j:
            x = order[at]
            fwd[j] = np.logaddexp(fwd[j], fwd[seg[x][0]] + score[x])
            at += 1
    order.sort(key=lambda x: -seg[x][0])
    at = 0
    for i in range(n - 1, -1, -1):
        bwd[i] = bwd[i + 1]
        while at < len(order) and seg[order[at]][0] == i:
            x = order[at]
            bwd[i] = np.logaddexp(bwd[i], bwd[seg[x][1]] + score[x])
            at += 1
    return np.array([np.exp(fwd[i] + s + bwd[j] - fwd[n]) for (i, j, _), s in zip(seg, score, strict=True)])


def _rewritten(s: str, kind: int, pick: int) -> str:
    """Another way to write an entity; pick 0 keeps it."""
    d = "".join(_DIGITS.findall(s))
    if kind == 0:
        user, host = s.split("@", 1)
        spoken = host.replace(".", " dot ")
        return [s, f"{user} [at] {host}", f"{user} (at) {host}", f"{user} at {spoken}", f"{user}@{spoken}", f"{user} (at) {host.replace('.', ' (dot) ')}"][pick % 6]
    if kind == 1:
        return [s, s.replace(".", "[.]"), s.replace(".", " . ")][pick % 3]
    if kind == 2:
        four = [d[i : i + 4] for i in range(0, len(d), 4)]
        return [s, ".".join(four), " - ".join(four), "/".join(four)][pick % 4]
    if len(d) < 10:
        return s
    a, b, c = d[-10:-7], d[-7:-4], d[-4:]
    return [s, f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"001 {a} {b} {c}", f"{a}.{b}.{c}"][pick % 5]


def _letters_only(s: str) -> str:
    """An address without its digits, if that leaves one."""
    user, host = _DIGITS.sub("", s).split("@", 1)
    user = user.strip("._%+-")
    return f"{user}@{host}" if user and all(host.split(".")) else s


def _spoiled(s: str, kind: int) -> str:
    """The same number made invalid: wrong checksum, part above 255, too few digits."""
    if kind == 2:
        return s[:-1] + str((int(s[-1]) + 1) % 10)
    if kind == 1:
        return "9" + s.replace(".", "9.", 2)
    return s if kind == 0 else "".join(_DIGITS.findall(s))[-6:]


def train(lines: list[str], rounds: int = 6, rate: float = 0.3) -> np.ndarray | None:
    """Weights of (kind, cell) by stochastic gradient ascent of the likelihood; None without an entity."""
    made = []
    for n, line in enumerate(lines):
        spans, kept = base_spans(line), []
        for a, k, b in spans:
            if not kept or a >= kept[-1][2]:
                kept.append((a, k, b))
        variants = range(6) if kept else (0,)
        for v in variants:
            text, gold, end = "", [], 0
            for a, k, b in kept:
                text += line[end:a]
                bad = v == 4 and k in (1, 2, 3) and n % 2
                s = _letters_only(line[a:b]) if k == 0 and n % 2 else line[a:b]
                s = _spoiled(s, k) if bad else _rewritten(s, k, v)
                if not bad:
                    gold.append((len(text), len(text) + len(s), k))
                text += s
                end = b
            text += line[end:]
            for tokens in stretches(text):
                seg, cells = _lattice(text, tokens, segments(text, tokens))
                if seg:
                    own = {(tokens[i][0], tokens[j - 1][1], k): x for x, (i, j, k) in enumerate(seg)}
                    y = np.zeros(len(seg))
                    y[[own[g] for g in gold if g in own]] = 1
                    made.append((len(tokens), seg, cells, y))
    if not any(y.any() for *_, y in made):
        return None
    w = np.zeros(len(KINDS) * _CELLS)
    rng, step = np.random.default_rng(7), 0
    for _ in range(rounds):
        for x in rng.permutation(len(made)):
            n, seg, cells, y = made[x]
            step += 1
            score = w[cells].sum(axis=1)
            grad = y - _expected(n, seg, score)
            hit = np.abs(grad) > 1e-3
            if hit.any():
                np.add.at(w, cells[hit], (rate / (1 + step / 2000)) * grad[hit, None])
    return w


def added_spans(text: str, w: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the best segmentations that touch no base span."""
    out = []
    starts, reach = [x for x, _, _ in base], list(accumulate((y for _, _, y in base), max))
    for tokens in stretches(text):
        found, seg, score = segments(text, tokens), [], []
        for at in range(0, len(found), 2000):  # features of a part of a long line at a time
            part, cells = _lattice(text, tokens, found[at : at + 2000])
            seg += part
            score.append(w[cells].sum(axis=1) - 1.0)
        if not seg:
            continue
        for i, j, k in viterbi(len(tokens), seg, np.concatenate(score)):
            a, b = tokens[i][0], tokens[j - 1][1]
            before = bisect_left(starts, b)
            if not before or reach[before - 1] <= a:
                out.append((a, k, b))
    return out


def _line_kind(line: str) -> int:
    """Which of six kinds of lines the sample takes it for."""
    if "@" in line:
        return 0
    for kind, pattern in ((1, r"[0-9]\.[0-9]+\.[0-9]"), (2, "[0-9]{12}"), (3, r"\+"), (4, "[0-9]")):
        if re.search(pattern, line):
            return kind
    return 5


def sample_lines(docs: DataFrame, sample: int) -> list[str]:
    """``sample`` different lines of at most 400 characters with a trigger: of each of six kinds those of lowest hash, over all texts.

    A batch hands on its own lowest ones, so the sample depends neither on batches nor on partitions.
    """
    each = sample // 6

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = set()
            for text in batch.column("text").to_pylist():
                for m in _TRIGGER.finditer(text):
                    a = max(text.rfind("\n", 0, m.start()) + 1, m.start() - 120)
                    b = text.find("\n", m.end(), m.end() + 120)
                    found.add(text[a : b if b >= 0 else m.end() + 120])
            of: list[list] = [[] for _ in range(6)]
            for line in found:
                of[_line_kind(line)].append((xxhash.xxh3_64_intdigest(line.encode()) >> 1, line))
            rows = [(k, h, line) for k, own in enumerate(of) for h, line in heapq.nsmallest(each, own)]
            kind, h, line = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(h, pa.int64()), pa.array(line, pa.string())], names=["kind", "h", "line"])

    has = docs.where(F.col("text").rlike(_TRIGGER.pattern)).select("text")
    order = Window.partitionBy("kind").orderBy("h", "line")  # six keys, cut to ``each`` rows before the shuffle
    rows = has.mapInArrow(lines, "kind int, h long, line string")
    # a line that several batches found stands once: equal lines have equal ranks
    rows = rows.withColumn("n", F.dense_rank().over(order)).where(F.col("n") <= each)
    return [r["line"] for r in rows.select("kind", "n", "line").distinct().orderBy("kind", "n").collect()]


def learn(docs: DataFrame, sample: int = 480) -> np.ndarray | None:
    """Weights from ``sample_lines``."""
    return train(sample_lines(docs, sample))


def find(docs: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """``docs`` with ``base`` and ``added``: arrays of (start, kind, end)."""
    model = docs.sparkSession.sparkContext.broadcast(weights)
    item = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
    own = [c for c in docs.columns if c not in ("base", "added")]
    docs = docs.select(*own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.value
        for batch in batches:
            base, more = [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                b = base_spans(text)
                m = added_spans(text, w, b) if w is not None else []
                base.append([dict(zip(("start", "kind", "end"), x, strict=True)) for x in b])
                more.append([dict(zip(("start", "kind", "end"), x, strict=True)) for x in m])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(base, item), pa.array(more, item)], names=[*batch.schema.names, "base", "added"])

    kind = "array<struct<start:int,kind:int,end:int>>"
    return docs.mapInArrow(run, extended(docs, own, base=kind, added=kind))


def redacted(text, spans):
    """A column: ``text`` with each span replaced by <KIND>; a span inside or across an earlier one goes with it."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    start = F.struct(F.lit("").alias("t"), F.lit(0).alias("at"))

    def step(s, x):
        cut = F.concat(s["t"], F.substring(text, s["at"] + 1, F.greatest(F.lit(0), x["start"] - s["at"])))
        first = F.struct(F.concat(cut, F.element_at(names, x["kind"] + 1)).alias("t"), x["end"].alias("at"))
        return F.when(x["start"] >= s["at"], first).otherwise(F.struct(s["t"].alias("t"), F.greatest(s["at"], x["end"]).alias("at")))

    return F.aggregate(F.array_sort(spans), start, step, lambda s: F.concat(s["t"], F.substring(text, s["at"] + 1, F.length(text))))


def without_personal_data(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with every span, of the patterns and the model, replaced; ``n_chars``, if there, is counted anew."""
    rest = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*rest).alias("row"), "text")
    text = F.col("text")
    found = find(rows, learn(rows))
    clean = F.when(F.size("base") + F.size("added") > 0, redacted(text, F.concat("base", "added"))).otherwise(text)
    # a column of its own: in one select, ``text`` inside a lambda would mean the new one
    found = found.select("row", clean.alias("clean"))
    new = {"text": F.col("clean"), **({"n_chars": F.char_length("clean").cast(docs.schema["n_chars"].dataType)} if "n_chars" in rest else {})}
    return found.select(*[new[c].alias(c) if c in new else F.col("row")[c].alias(c) for c in docs.columns])


def _joined(spans):
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def _is_kind(i: int):
    return lambda x: x["kind"] == i


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base spans, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, learn(docs))
    counts = [F.size(F.filter("base", _is_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), _joined(F.concat("base", "added")).alias("spans"))
