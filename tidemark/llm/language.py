"""Language identification by multilingual mixture inference.

A document is a mixture of languages: each of its letter n-grams (orders 2 and
3, lower case, everything but letters read as one space, hashed to
``cells`` cells) comes from one language, by that language's smoothed n-gram
probabilities. Expectation-maximisation estimates the document's proportions;
the set of languages is the nested one of highest log-likelihood less
``penalty`` * log(number of n-grams) for each language. The prediction is the
language of the largest proportion in that set, its score that proportion.
Proportions are taken as settled when none moves by a thousandth, or after 12 rounds.

The n-gram counts are learned from some ``per_language`` documents of each
language, chosen by a hash of their id among the rows that training may use (a
bounded, documented sample; a language with fewer documents is learned from all
of them). The model is ``cells`` numbers for each language, and broadcast.

Defined cases: a null text or one without a letter is ``und`` with score 0; with no
learned language every document is ``und``; rows are independent, so repeated
rows give repeated results; ties go to the first language in code point
order; a null doc_id counts as not held out but is never learned from; only the
named columns are read. An empty table gives an empty result of the same schema.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import extended, held_out, table

_STATE: dict = {}


def _letters() -> np.ndarray:
    """For each code point, whether it is a letter."""
    if "letters" not in _STATE:
        _STATE["letters"] = np.array([unicodedata.category(chr(i))[0] == "L" for i in range(0x110000)])
    return _STATE["letters"]


def grams(text: str | None, cells: int) -> np.ndarray:
    """Cell of every n-gram (orders 2 and 3) of the letters of a text; empty without a letter."""
    if not text:
        return np.zeros(0, np.int64)
    a = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    a = np.where(_letters()[a], a, 32)
    a = a[np.concatenate(([True], (a[1:] != 32) | (a[:-1] != 32)))].astype(np.uint64)
    if len(a) < 3:
        return np.zeros(0, np.int64)
    two = a[:-1] * np.uint64(0x9E3779B97F4A7C15) + a[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    three = two[:-1] * np.uint64(0x165667B19E3779F9) + a[2:] * np.uint64(0x27D4EB2F165667C5)
    h = np.concatenate((two, three))
    h ^= h >> np.uint64(31)
    h *= np.uint64(0x94D049BB133111EB)
    return ((h >> np.uint64(33)) % np.uint64(cells)).astype(np.int64)


def learn(docs: DataFrame, cells: int, per_language: int) -> tuple[list[str], np.ndarray]:
    """(languages, log-probability of each cell in each) from the rows of ``docs`` (doc_id, text, lang)."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(sizes, key=lambda x: x.encode())
    if not langs:
        return [], np.zeros((cells, 0))
    part = F.element_at(F.map_from_arrays(F.array(*map(F.lit, langs)), F.array(*[F.lit(per_language / sizes[x]) for x in langs])), F.col("lang"))
    chance = F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    index = {x: i for i, x in enumerate(langs)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(langs), cells), np.int64)
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                total[index[lang]] += np.bincount(grams(text, cells), minlength=cells)
        lang, cell = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang.astype(np.int32)), pa.array(cell.astype(np.int32)), pa.array(total[lang, cell])], names=["l", "c", "n"])

    sample = rows.where(chance < part).select("text", "lang")
    found = sample.mapInArrow(count, "l int, c int, n long").groupBy("l", "c").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros((cells, len(langs)))
    n[found["c"], found["l"]] = found["n"]
    n += 0.1
    return langs, np.log(n / n.sum(axis=0))


def mixture(cell: np.ndarray, log_p: np.ndarray, penalty: float, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(indices of the selected languages, their proportions), largest proportion first."""
    if len(cell) < 4096:
        seen, c = np.unique(cell, return_counts=True)
    else:
        c = np.bincount(cell)
        seen = np.flatnonzero(c)
        c = c[seen]
    lp = log_p[seen]
    c = c.astype(np.float64)
    n = c.sum()
    top = lp.max(axis=1)
    p = np.exp(lp - top[:, None])
    base = c @ top
    price = penalty * np.log(n + 1)
    single = c @ lp
    best = int(single.argmax())

    def fit(of: np.ndarray) -> tuple[np.ndarray, float]:
        q, share = p[:, of], np.full(len(of), 1 / len(of))
        w = c / n
        for _ in range(rounds):
            new = share * ((w / (q @ share)) @ q)
            if np.abs(new - share).max() < 1e-3:
                share = new
                break
            share = new
        return share, base + float(c @ np.log(q @ share))

    chosen, shares, value = np.array([best]), np.ones(1), float(single[best]) - price
    if len(single) > 1:
        share, full = fit(np.arange(len(single)))
        order = np.argsort(-share, kind="stable")
        for k in range(2, len(order) + 1):
            if full - k * price <= value:
                break  # no set of this size or a larger one can win
            own, got = fit(np.sort(order[:k]))
            if got - k * price > value:
                chosen, shares, value = np.sort(order[:k]), own, got - k * price
    rank = np.argsort(-shares, kind="stable")
    return chosen[rank], shares[rank]


def identify(docs: DataFrame, langs: list[str], log_p: np.ndarray, penalty: float = 8.0, keep_text: bool = False) -> DataFrame:
    """``docs`` (doc_id, text, ...), without its text unless ``keep_text``, with lang_pred, score and ``mix`` (language -> proportion)."""
    cells = log_p.shape[0]
    model = docs.sparkSession.sparkContext.broadcast((langs, log_p))
    rest = [c for c in docs.columns if c not in ("lang_pred", "score", "mix") and (c != "text" or keep_text)]
    docs = docs.select(*rest) if keep_text else docs.select(*rest, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, log_p = model.value
        for batch in batches:
            pred, score, mixes = [], [], []
            for text in batch.column("text"):
                cell = grams(text.as_py(), cells)
                if not len(cell) or not langs:
                    pred.append("und")
                    score.append(0.0)
                    mixes.append({})
                    continue
                of, share = mixture(cell, log_p, penalty)
                pred.append(langs[of[0]])
                score.append(min(1.0, float(share[0])))
                mixes.append({langs[i]: float(x) for i, x in zip(of, share, strict=True)})
            own = [batch.column(c) for c in rest]
            maps = pa.array([list(m.items()) for m in mixes], pa.map_(pa.string(), pa.float64()))
            yield pa.RecordBatch.from_arrays([*own, pa.array(pred, pa.string()), pa.array(score, pa.float64()), maps], names=[*rest, "lang_pred", "score", "mix"])

    return docs.mapInArrow(run, extended(docs, rest, lang_pred="string", score="double", mix="map<string,double>"))


def predictions(docs: DataFrame, cells: int = 65536, per_language: int = 2000, penalty: float = 8.0) -> DataFrame:
    """(doc_id, lang_pred, score, mix) of every row, by a model of the rows that are not held out."""
    langs, log_p = learn(docs, cells, per_language)
    return identify(docs.select("doc_id", "text"), langs, log_p, penalty)


def known_language(docs: DataFrame, cells: int = 65536, per_language: int = 2000, penalty: float = 8.0) -> DataFrame:
    """The rows of ``docs`` whose text has a language; all columns as they are."""
    langs, log_p = learn(docs.select("doc_id", "text", "lang"), cells, per_language)
    rest = [c for c in docs.columns if c != "text"]
    found = identify(docs.select(F.struct(*rest).alias("row"), "text"), langs, log_p, penalty, keep_text=True)
    return found.where("lang_pred <> 'und'").select(*[F.col("text") if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the four fifths that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return predictions(docs).select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")
