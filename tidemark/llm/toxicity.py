"""Toxicity by a subsequence string-kernel SVM with Nystroem landmarks.

The kernel compares two words by their common subsequences of three characters,
each weighted by ``DECAY`` to the length it spans (at most ``SPAN``), so a word
with characters put in between, or another ending, stays close to the word that was learned.
Words are what white space separates, lower case, with look-alike digits and signs read
as letters and other signs inside left out; a run of single characters is one word.

Instances are single words, not sentences: a text is the set of its distinct words and scores as
its highest one; order and context do not count, so an insult that is toxic only as a sequence of
words is not found. Training (labels of texts): in every toxic text the word that scores
highest is the positive instance, in every clean one it is the negative (the usual
rounds of multiple-instance SVMs, begun from words that toxic texts hold far more
often). The SVM is linear in the Nystroem features of ``landmarks`` words,
solved in its primal form; a logistic curve turns scores into probabilities. The
trained machine is a table of weights of three-character subsequences, of fixed
size; scoring a new word is a sum over it, exactly the kernel expansion.

Learned from at most ``per_class`` labelled texts of each class, first by a hash of
their id, none held out (a bounded, documented sample). Every whole text is scored.

Defined cases: a null or empty text has no word and gets the score of having none;
without both classes in the labels every score is 0; repeated label rows count once,
an id labelled both ways counts as toxic, and of several texts of one id one is learned from, by hash; rows are independent; a null doc_id is not held out and never learned from;
only the named columns are read. An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import extended, held_out, table

DECAY, SPAN, LETTERS = 0.7, 8, 42
_EDGE = LETTERS - 1
# Look-alikes: fixed values.
_ALIKE = str.maketrans("013457@$", "oieastas")
_SPACED = re.compile(r"(?<!\S)\S(?:\s{1,2}\S){2,}(?!\S)")
_OUTER = re.compile(r"^[\W_]+|[\W_]+$")
_CODE: dict[str, int] = {}


def _code(c: str) -> int:
    if c not in _CODE:
        _CODE[c] = ord(c) - 97 if "a" <= c <= "z" else 26 + ord(c) % (_EDGE - 26)
    return _CODE[c]


def unit(token: str) -> str:
    """The letters of a token."""
    if token.isalpha():
        return token.lower()
    t = _OUTER.sub("", token.lower())
    return t if t.isalpha() else "".join(c for c in t.translate(_ALIKE) if c.isalpha())


def tokens(text: str | None) -> set[str]:
    """Distinct tokens of a text; a run of single characters gives its joined form too."""
    if not text:
        return set()
    return set(text.split()) | {"".join(m.group().split()) for m in _SPACED.finditer(text)}


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words with edges, one after the other, and the word of each position."""
    flat = np.array([x for w in words for x in (_EDGE, *map(_code, w), _EDGE)], np.int64)
    return flat, np.repeat(np.arange(len(words)), [len(w) + 2 for w in words])


def _triples(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(word, subsequence) of every three positions within ``SPAN``, with their weight."""
    flat, of = _codes(words)
    for k in range(2, SPAN + 1):
        if len(flat) <= k:
            break
        same = np.flatnonzero(of[k:] == of[:-k])
        head, w = flat[same] * LETTERS * LETTERS + flat[same + k], of[same]
        for j in range(1, k):
            yield w, head + flat[same + j] * LETTERS, DECAY ** (k + 1)


def weighted(words: list[str], table_: np.ndarray) -> np.ndarray:
    """Sum of the table over each word's weighted subsequences, before normalisation."""
    out = np.zeros(len(words))
    for w, u, weight in _triples(words):
        out += weight * np.bincount(w, table_[u], len(words))
    return out


def features(words: list[str]) -> np.ndarray:
    """Dense kernel features of a few words, of length 1."""
    out = np.zeros((len(words), LETTERS**3), np.float32)
    for w, u, weight in _triples(words):
        np.add.at(out, (w, u), np.float32(weight))
    return out / np.maximum(np.sqrt(np.einsum("ij,ij->i", out, out)), 1e-12)[:, None]


def norms(words: list[str]) -> np.ndarray:
    parts = [(w * LETTERS**3 + u, np.full(len(u), weight)) for w, u, weight in _triples(words)]
    if not parts:
        return np.ones(len(words))
    key, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    value = np.bincount(at, np.concatenate([p[1] for p in parts]))
    return np.sqrt(np.maximum(np.bincount(key // LETTERS**3, value**2, len(words)), 1e-24))


class Machine:
    """A trained SVM as a table of subsequence weights, its bias, and its logistic curve."""

    def __init__(self, weights: np.ndarray, bias: float, slope: float = 0.0, shift: float = 0.0):
        self.weights, self.bias, self.slope, self.shift = weights, bias, slope, shift

    def score(self, words: list[str]) -> np.ndarray:
        """Decision value of each word; a word that has nothing in its favour gets the bias."""
        raw = weighted(words, self.weights)
        some = np.flatnonzero(raw > 0)
        out = np.full(len(words), self.bias)
        if len(some):
            out[some] += raw[some] / norms([words[i] for i in some])
        return out

    def probability(self, top: float) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * top + self.shift, -50, 50))))


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Primal squared-hinge SVM by Newton steps with halving: (weights, bias)."""
    x1 = np.hstack((x, np.ones((len(x), 1))))
    pull = ridge * weight.sum() * np.array([1.0] * x.shape[1] + [1e-3])
    loss = lambda w: float(weight @ np.maximum(0, 1 - y * (x1 @ w)) ** 2 + pull @ w**2)
    w = np.zeros(x1.shape[1])
    now = loss(w)
    for _ in range(60):
        inside = y * (x1 @ w) < 1
        a = x1[inside] * weight[inside, None]
        step = np.linalg.solve(x1[inside].T @ a + np.diag(pull), a.T @ y[inside]) - w
        size = 1.0
        while (new := loss(w + size * step)) > now and size > 1e-4:
            size /= 2
        if new >= now * (1 - 1e-7):
            break
        w, now = w + size * step, new
    return w[:-1], float(w[-1])


def _logistic(s: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of Platt's curve; the sample's toxic texts weigh as a quarter, for they are rarer in a corpus."""
    n1, n0 = y.sum(), len(y) - y.sum()
    t = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    c = np.where(y == 1, 0.25 / n1, 0.75 / n0) * len(y)
    x, w = np.stack((s, np.ones(len(s))), 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        h = x.T @ (x * (c * np.maximum(p * (1 - p), 1e-6))[:, None]) + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (c * (p - t)))
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def _inserted(word: str, rng: np.random.Generator) -> str:
    at = int(rng.integers(1, max(2, len(word))))
    return word[:at] + chr(97 + int(rng.integers(26))) + word[at:]


def _first_of_copies(texts: list[list[str]]) -> list[int]:
    """Indices of the sample's texts without near copies of earlier ones: a copied text's words are no evidence of their own."""
    seen, out = set(), []
    for i, t in enumerate(texts):
        marks = [(k, min(zlib.crc32(f"{k}{w}".encode()) for w in t)) for k in range(4)] if t else []
        if sum(m in seen for m in marks) < 2:
            out.append(i)
        seen.update(marks)
    return out


def train(texts: list[list[str]], toxic: list[int], landmarks: int = 320, rounds: int = 4) -> Machine | None:
    """A machine from the distinct units of each labelled text."""
    first = [*_first_of_copies([t if k == 1 else [] for t, k in zip(texts, toxic, strict=True)])]
    texts, toxic = [texts[i] for i in first], [toxic[i] for i in first]
    y = np.array(toxic)
    if not (y == 1).any() or not (y == 0).any():
        return None
    words = sorted({w for t in texts for w in t})
    if not words:
        return None
    at = {w: i for i, w in enumerate(words)}
    rows = [np.array([at[w] for w in t], np.int64) for t in texts]
    in1 = np.bincount(np.concatenate([r for r, k in zip(rows, y, strict=True) if k == 1] or [[]]).astype(int), minlength=len(words))
    in0 = np.bincount(np.concatenate([r for r, k in zip(rows, y, strict=True) if k == 0] or [[]]).astype(int), minlength=len(words))
    n1, n0 = (y == 1).sum(), (y == 0).sum()
    p, q = (in1 + 0.5) / (n1 + 1), (in0 + 0.5) / (n0 + 1)
    sure = np.log(p / q) * np.sqrt(in1)  # far more often in toxic texts, and often enough to tell
    liked = np.argsort(-sure, kind="stable")[: landmarks * 2 // 3]
    liked = liked[(sure[liked] > 0) & (p[liked] > 5 * q[liked])]
    plain = np.argsort(-np.where(sure < 1, in0, -1), kind="stable")[: landmarks - len(liked)]
    z = features([words[i] for i in np.concatenate((liked, plain))])
    used = np.flatnonzero(z.any(axis=0))  # what no landmark has does not enter the kernel
    z = z[:, used]
    value, vec = np.linalg.eigh((z @ z.T).astype(np.float64))
    keep = value > 1e-6 * value[-1]
    root = vec[:, keep] / np.sqrt(value[keep])  # Nystroem: k(x, Z) @ root
    certain = np.flatnonzero((in1 >= 5) & (p > 20 * q))  # other words of texts whose witness is another
    rng = np.random.default_rng(11)
    extra = rng.choice(len(words), min(len(words), 2000), replace=False)
    extra = extra[in1[extra] <= in0[extra]]
    score = sure.copy()
    machine = None
    for _ in range(rounds):
        best = np.array([r[np.argmax(score[r])] if len(r) else -1 for r in rows])
        pos = best[(y == 1) & (best >= 0)]
        neg = np.concatenate((best[(y == 0) & (best >= 0)], extra))
        if not len(pos) or not len(neg):
            return machine
        some, n = np.unique(pos, return_counts=True)
        # a word that clean texts hold about as often is no witness
        fair = p[some] > 5 * q[some]
        some = np.union1d(some[fair] if fair.any() else some, certain)
        n = np.sqrt(in1[some])
        changed = [_inserted(words[i], rng) for i in some]  # the same words with a letter put in
        neg = np.setdiff1d(neg, some)
        use = [*(words[i] for i in some), *changed, *(words[i] for i in neg)]
        x = np.concatenate([features(use[s : s + 128])[:, used] @ z.T for s in range(0, len(use), 128)]).astype(np.float64) @ root
        target = np.concatenate((np.ones(2 * len(some)), -np.ones(len(neg))))
        weight = np.concatenate((n * len(neg) / n.sum(), 0.1 * n * len(neg) / n.sum(), np.ones(len(neg))))
        w, bias = _svm(x, target, weight)
        weights = np.zeros(LETTERS**3)
        weights[used] = (root @ w) @ z
        machine = Machine(weights, bias)
        score = np.concatenate([machine.score(words[s : s + 20000]) for s in range(0, len(words), 20000)])
    top = np.array([score[r].max() if len(r) else machine.bias for r in rows])
    machine.slope, machine.shift = _logistic(top, y)
    return machine


def learn(docs: DataFrame, labels: DataFrame, per_class: int = 1500) -> Machine | None:
    """A machine from a sample of the labelled rows that are not held out."""
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = [F.xxhash64(F.lit("toxic"), "doc_id"), F.col("doc_id")]
    some = known.where("toxic = 1").orderBy(*order).limit(per_class).union(known.where("toxic = 0").orderBy(*order).limit(per_class))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [sorted({unit(t) for t in tokens(x.as_py())} - {""}) for x in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(units, pa.list_(pa.string()))], names=["doc_id", "toxic", "units"])

    # at most 2 * per_class rows: small enough to send to every task, and as many texts come back, one for each id
    texts = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id").groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    rows = texts.mapInArrow(run, "doc_id long, toxic int, units array<string>").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["units"]))
    return train([r["units"] for r in rows], [r["toxic"] for r in rows])


_STATE: dict = {}


def score(docs: DataFrame, machine: Machine | None, cache: int = 1_000_000) -> DataFrame:
    """``docs`` without its text, with ``score``: the probability of being toxic."""
    import uuid

    shared = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, machine))
    rest = [c for c in docs.columns if c not in ("text", "score")]
    docs = docs.select(*rest, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, machine = shared.value
        if _STATE.get("key") != key:
            _STATE.update(key=key, known={})
        known = _STATE["known"]
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 500):
                sets = [tokens(x) for x in batch.column("text").slice(at, 500).to_pylist()]
                if machine is None:
                    out += [0.0] * len(sets)
                    continue
                if len(known) > cache:
                    known.clear()
                new = list(set().union(*sets).difference(known)) if sets else []
                for s in range(0, len(new), 20000):
                    part = new[s : s + 20000]
                    known.update(zip(part, machine.score([unit(t) for t in part]).tolist(), strict=True))
                out += [machine.probability(max(map(known.__getitem__, t), default=machine.bias)) for t in sets]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], pa.array(out, pa.float64())], names=[*rest, "score"])

    return docs.mapInArrow(run, extended(docs, rest, score="double"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled rows that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = learn(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    scored = score(docs, machine)
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
