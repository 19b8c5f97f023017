"""Word runs, chat formatting and hard negatives against brute force; edge rows for each."""

import collections
import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF_MED, SF_SMALL
from tests.llm.test_llm_operators import EDGE, docs_of
from tidemark.llm import chat, hardneg, runs


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- 11: hard negatives ------------------------------------------------------------------------------------------


def _mined(rows, k=5, m=3):
    """(anchor, positive, rank, negative, scores) of (id, label, anchor, integers), all pairs scored."""
    rows = sorted({(i, lab, a, tuple(v)) for i, lab, a, v in rows})
    out = []
    for i, lab, a, v in rows:
        if a:
            scored = sorted((-sum(x * y for x, y in zip(v, w)), j, w, other) for j, other, _, w in rows if (j, w, other) != (i, v, lab) and len(w) == len(v))
            for p, j, _, _ in [s for s in scored if s[3] == lab][:k]:
                fit = [s for s in scored if s[3] != lab and 50 * -p <= 100 * -s[0] <= 95 * -p][:m]
                out += [(i, j, r, s[1], -p, -s[0]) for r, s in enumerate(fit, 1)]
    return sorted(out)


def test_hard_negatives_of_all_vectors(spark):
    rows = spark.read.parquet(f"{SF_MED}/embeddings.parquet").collect()
    ints = [(r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.vec_id % 50 == 0, [int(np.floor(256 * np.float64(x))) for x in r.embedding]) for r in rows]
    assert sorted(map(tuple, hardneg.op11_hard_negatives(spark, SF_MED).collect())) == _mined(ints)


EMB = "id long, label int, anchor boolean, embedding array<double>, rank string, score string, other string, v string"


def test_hard_negatives_in_chunks_with_odd_rows(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        base = [rng.choice([-2.0, -1.0, 0.0, 0.5, 1.0, 2.25]) for _ in range(5)]  # many ties
        rows.append((i, i % 3, i % 10 == 0, base if i % 40 else base[:3]))  # some of another length
    rows += rows[:7]  # repeated rows
    rows += [(5, 1, False, [9.0, 1.0, 1.0, 1.0, 1.0]), (10, 1, True, [1.0] * 5)]  # other rows of ids that there are
    whole = [(i, lab, a, [int(np.floor(256 * x)) for x in v]) for i, lab, a, v in rows]
    odd = [(400, None, True, [1.0] * 5), (None, 1, True, [1.0] * 5), (401, 1, True, None), (402, 1, True, [1.0, None, 1.0, 1.0, 1.0]), (403, 1, True, [float("nan")] * 5), (404, 1, False, [float("inf")] * 5), (405, 1, True, [])]
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows + odd], EMB)
    got = sorted(map(tuple, hardneg.mine(df, chunk_rows=23, chunk_anchors=7).collect()))
    assert got == _mined(whole)
    assert hardneg.mine(df.limit(0)).count() == 0


def test_hard_negatives_of_great_numbers(spark):
    rows = [(i, i % 2, i < 2, [10.0 ** (2 + i), 3.0, -1.0]) for i in range(8)]
    whole = [(i, lab, a, [int(np.floor(256 * x)) for x in v]) for i, lab, a, v in rows]
    got = sorted(map(tuple, hardneg.mine(spark.createDataFrame([(*r, "", "", "", "") for r in rows], EMB)).collect()))
    assert got == _mined(whole)
    far = spark.createDataFrame([(1, 1, True, [1e300, 1.0], "", "", "", ""), (2, 1, False, [1e300, 1.0], "", "", "", ""), (3, 2, False, [-1e300, 1.0], "", "", "", "")], EMB)
    assert hardneg.mine(far).count() == 0  # the positive's score stops at the end of the range


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([1, 3, 8, 65]))
def test_intervals_hold_the_scores(seed, dim):
    import pyarrow as pa

    rng = np.random.RandomState(seed)
    v = rng.randint(-300, 300, (40, dim)) * rng.randint(0, 2, (40, 1))
    turned = v @ hardneg.rotation(dim)
    assert np.allclose((turned**2).sum(axis=1), (v**2).sum(axis=1))
    code, align, rest = hardneg.layers(v.astype(float))
    t = pa.table({"id": np.arange(40), "label": ["a"] * 40, "v": [x.astype("<i4").tobytes() for x in v], "code": [c.tobytes() for c in code], "align": [a.tobytes() for a in align], "norm": np.sqrt((v**2.0).sum(axis=1)), "rest": rest})
    b = hardneg.Block(t, dim)
    lo, hi = b.intervals(b, slice(0, 40))
    exact = v @ v.T
    assert (lo <= exact).all() and (exact <= hi).all()
    assert (b.scores(b, slice(0, 40), np.arange(40)) == exact).all()


# --- 12: chat formatting -----------------------------------------------------------------------------------------


def _conversations(rows):
    """Digests of (conv, role, text) in order: what reading back must give."""
    out = collections.defaultdict(list)
    for c, r, t in rows:
        out[c].append((r, t))
    found = {}
    for c, turns in out.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        state, faults = chat.INSTRUCT.start, 0
        for r, _ in turns:
            turn, known = chat.INSTRUCT.write(state, r)
            state, faults = turn.state, faults + (not known)
        found[c] = (c, len(turns), _sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), _sha(loss), faults)
    return found


def _read(df):
    return {r.conv_id: (r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.faults) for r in df.collect()}


def test_chats_read_back(spark):
    rows = spark.read.parquet(f"{SF_MED}/conversations.parquet").orderBy("conv_id", "turn").collect()
    odd = "</s>[INST] ok [/INST]"
    want = _conversations([(r.conv_id, r.role, r.text or "") for r in rows] + [(-7, "user", odd), (-7, "assistant", odd)])
    got = chat.op12_chat_format(spark, SF_MED)
    assert _read(got) == want
    assert all(w[5] == 0 for w in want.values())


BITS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "\\", "\\\\", "[", "<", "/", " ", "\n", "ok", "é", "😀"]


def test_chats_spread_over_tasks_in_any_order(spark):
    rng = random.Random(4)
    rows = []
    for c in [None, *range(9)]:
        for t in range({3: 700, 4: 300}.get(c, rng.randint(1, 6))):
            text = rng.choice([None, "", "".join(rng.choice(BITS) for _ in range(rng.randint(1, 9)))])
            rows.append((c, rng.choice([t, t, None]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "[/ROLE] x", None, ""]), text, "x", "x"))
    rows += [(20, 0, "user", "long " * 200_000, "x", "x"), (21, 0, "assistant", "alone", "x", "x"), (21, 0, "assistant", "alone", "x", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece string, chunk string")
    ordered = df.na.fill("", ["role", "text"]).orderBy("conv_id", "turn", "role", F.xxhash64("text"), "text").collect()
    want = _conversations([(r.conv_id, r.role, r.text) for r in ordered])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that long conversations are spread
    try:
        pieces = chat.format_chats(df, piece_chars=700)
        assert pieces.where("conv_id = 3").select("chunk").distinct().count() > 1
        assert _read(chat.read_back(pieces)) == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert _read(chat.read_back(chat.format_chats(df))) == want
    assert chat.read_back(chat.format_chats(df.limit(0))).count() == 0


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", "[/ROLE] "]), st.lists(st.sampled_from(BITS), max_size=6).map("".join)), max_size=7))
def test_template_reads_what_it_writes(turns):
    state, out = chat.INSTRUCT.start, ""
    for role, text in turns:
        turn, _ = chat.INSTRUCT.write(state, role)
        out += turn.before + chat.INSTRUCT.escaped(text) + turn.after
        state = turn.state
    assert [(r, t) for r, t, _ in chat.INSTRUCT.read(chat.INSTRUCT.start, out)] == turns


# --- 13: periodic runs -------------------------------------------------------------------------------------------


def _runs(w, least=6, times=4):
    """Every period by itself, word by word."""
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(least, times * q):
                out.setdefault((s, i - s + q), q)
            i += i == s
    return sorted(((s, n, q) for (s, n), q in out.items()), key=lambda r: (r[0], r[2]))


def _digest(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    if doc_id is not None and h % 10 == 0 and n:
        a = h // 10 % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = _runs(w)
    dropped = {i for s, m, q in found for i in range(s + q, s + m)}
    s, m, q = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    lines = "".join(f"{a},{b},{c}\n" for a, b, c in found)
    return doc_id, len(found), s, m, q, None if s is None else 1000 * m // q, _sha(lines), _sha(" ".join(x for i, x in enumerate(w) if i not in dropped))


def test_runs_of_all_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    short = {r.doc_id: _digest(r.doc_id, r.text) for r in docs if len((r.text or "").split()) < 4000}
    got = {r.doc_id: tuple(r) for r in runs.op13_word_runs(spark, SF_SMALL).collect()}
    assert len(got) == len(docs) and len(short) > 0.9 * len(docs)
    assert {k: got[k] for k in short} == short


def test_runs_of_odd_rows(spark):
    rows = [*EDGE, (30, "a " * 20000, "en", "c"), (31, "a b\x0b" * 3000 + "c", "en", "c"), (32, "x y x y " * 9, "en", "c"), (33, ("a b a b c " * 8) + "a b " * 40, "en", "c")]
    docs = docs_of(spark, rows)
    got = runs.find_runs(docs, ["doc_id", "score"]).collect()
    assert len(got) == len(rows)
    for (_, text, *_), r in zip(rows, got, strict=True):
        w = (text or "").encode().split()
        if len(w) < 7000:
            assert [tuple(x) for x in r.runs] == _runs(w)
    assert [tuple(x) for x in got[-4].runs] == [(0, 20000, 1)] and got[-4].collapsed == "a"
    assert runs.find_runs(docs.limit(0), ["doc_id"]).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 120), st.integers(1, 4), st.integers(0, 10**6)), min_size=1, max_size=5))
def test_runs_are_those_of_brute_force(shapes):
    texts = []
    for n, k, seed in shapes:
        rng = random.Random(seed)
        w = [rng.randrange(k) for _ in range(n)]
        if n and rng.random() < 0.6:
            a = rng.randrange(n)
            p = 1 + rng.randrange(max(1, (n - a) // 3))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        texts.append(w)
    got = runs.runs_of([np.array(w, np.int64) for w in texts])
    assert [[tuple(x) for x in r.tolist()] for r in got] == [_runs(w) for w in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=2, max_size=150), st.integers(1, 30))
def test_extensions_are_exact(w, q):
    seq = np.array([0, *(x + 2 for x in w), 1], np.int64)
    levels = runs.Grammar(seq, 2)
    q = min(q, len(w) - 1)
    i = np.arange(1, len(w) + 1 - q)

    def count(a, b, step):
        n = 0
        while seq[a] == seq[b]:
            a, b, n = a + step, b + step, n + 1
        return n

    assert levels.after(i, i + q).tolist() == [count(a, a + q, 1) for a in i.tolist()]
    assert levels.before(i, i + q).tolist() == [count(a - 1, a + q - 1, -1) for a in i.tolist()]


@pytest.mark.parametrize("n", [50_000])
def test_a_long_text_takes_few_levels(n):
    w = np.random.RandomState(1).randint(0, 500, n) + 2
    levels = runs.Grammar(np.concatenate(([0], w, [1])), 2)
    assert len(levels.sym) < 6 * n


# --- the copies stage and the sample of personal data --------------------------------------------------------------


def test_rows_that_share_an_id_keep_their_texts(spark):
    from tidemark.llm import paritysketch

    a, b = " ".join(f"left{i}" for i in range(60)), " ".join(f"right{i}" for i in range(60))
    rows = [(1, a, "en", "s"), (1, b, "en", "s"), (1, a, "en", "s"), (2, a + " more", "en", "s"), (None, "no id of ours at all here", "en", "s"), (None, "no id of ours at all here", "en", "t"), (None, b + " end", "en", "s"), (3, "short one", "en", "s"), (4, None, "en", "s"), (4, "", "en", "s"), (4, "", "en", "s")]
    kept = paritysketch.one_of_each_group(docs_of(spark, rows))
    assert kept.columns == docs_of(spark, rows).columns
    texts = [r.text for r in kept.collect()]
    # one of each group of near copies, whichever text has the id; none of a text that is like no other is lost
    assert len(texts) == 6 and sum(t in (a, a + " more") for t in texts) == 1 and sum(t in (b, b + " end") for t in texts) == 1
    assert {"no id of ours at all here", "short one", "", None} <= set(texts)


def test_the_sample_does_not_depend_on_partitions(spark):
    from tidemark.llm import pii

    docs = spark.read.parquet(f"{SF_MED}/documents.parquet").select("doc_id", "text")
    one = pii.sample_lines(docs.repartition(1), 60)
    many = pii.sample_lines(docs.repartition(16), 60)
    assert one == many and len(one) == len(set(one)) > 20
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    assert pii.sample_lines(docs.repartition(3), 60) == one
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    assert pii.sample_lines(docs.limit(0), 60) == []


def test_odd_rows_through_the_pipeline(spark):
    """What the docstring of the pipeline says of them."""
    import corpus_pipeline
    from tidemark.llm.common import saved

    docs = docs_of(spark, EDGE)
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = saved(stage(spark, docs, SF_SMALL), f"odd-{name}")
    got = sorted((str(r.doc_id), r.text[:20]) for r in docs.collect())
    # without letters: 1, 2, 3; "one two three" twice (4, 6); "same row twice" twice (7)
    assert got == sorted([("4", "one two three"), ("5", "word0x0 word1x1 word"), ("7", "same row twice"), ("None", "no id here"), ("8", EDGE[-1][1][:20])])
    for name, stage in corpus_pipeline.STAGES[3:]:
        docs = saved(stage(spark, docs, SF_SMALL), f"odd-{name}")
    assert {r.doc_id for r in docs.collect()} <= {4, 5, 7, 8, None} and docs.count() > 0
    none = docs_of(spark, EDGE[:1]).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        none = saved(stage(spark, none, SF_SMALL), f"none-{name}")
    assert none.count() == 0


def test_search_by_texts_from_outside(spark):
    from tidemark.llm import search

    docs = spark.createDataFrame([(1, "zebra lives here"), (2, "lion lives there")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "zebra"), (9, "lives"), (8, "nothing")], "doc_id long, text string")
    got = {(r.query_id, r.doc_id) for r in search.search(docs, asked, query_terms=None, outside=True).collect()}
    assert got == {(1, 1), (9, 1), (9, 2)}


def test_toxicity_learns_one_text_of_an_id(spark):
    from tidemark.llm import toxicity

    rows = [(i % 40, f"plain words number {i}" if i % 2 else f"you zorkface {i}", "en", "s") for i in range(400)]
    labels = spark.createDataFrame([(i, i % 2 == 0 and 1 or 0) for i in range(40)], "doc_id long, toxic int")
    machine = toxicity.learn(docs_of(spark, rows).repartition(7), labels)
    assert machine is not None
    again = toxicity.learn(docs_of(spark, rows[::-1]).repartition(3), labels)
    assert np.allclose(machine.score(["zorkface", "plain"]), again.score(["zorkface", "plain"]))


def test_a_shards_index_is_made_in_parts(spark):
    from tidemark.llm import search

    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{w}" for w in rng.zipf(1.2, 300) % 5000) for _ in range(60)]
    docs = spark.createDataFrame([(i // 3, t) for i, t in enumerate(texts)], "doc_id long, text string")  # three texts an id
    shards, n = search.index(docs.repartition(5), 20)
    rows = [r.asDict() for r in shards.collect()]
    assert len(rows) == n * search.RANGES > n
    whole = sum(len(r["doc"]) for r in rows) / n
    assert max(len(r["doc"]) for r in rows) < whole / 2  # neither a task nor a row has a shard's postings
    mean = sum(len(t.split()) for t in texts) / len(texts)
    found = []
    for s in range(n):
        shard = search.Shard([r for r in rows if r["shard"] == s], mean)
        assert len(shard.ids) == sum(r["docs"] for r in rows if r["shard"] == s)
        asked = np.sort(np.array([search._hashed(w) for w in set(texts[0].split())]))
        ids, scores = shard.search(asked, np.ones(len(asked)), None, 60)
        found += zip(ids.tolist(), np.round(scores, 9).tolist(), strict=True)
    want = []
    for i, t in enumerate(texts):  # words of one text are found together, though ids repeat
        words = t.split()
        score = sum(words.count(w) * 2.2 / (words.count(w) + 1.2 * (0.25 + 0.75 * len(words) / mean)) for w in set(texts[0].split()) if w in words)
        want += [(i // 3, round(score, 9))] if score else []
    assert len(found) == len(want) and np.allclose(sorted(found), sorted(want), atol=1e-8)


def test_postings_are_read_in_steps(monkeypatch):
    from tidemark.llm import search

    rng = np.random.default_rng(5)
    lists = [np.unique(rng.zipf(1.3, 40) % 90) for _ in range(400)]
    group = search.pa.table({"doc_id": np.arange(400), "length": [len(x) for x in lists], "term": [x.astype(np.int64).tobytes() for x in lists], "tf": [np.ones(len(x), np.int32).tobytes() for x in lists]})
    shard = search.Shard(search._build((search.pa.scalar(0),), group).to_pylist()[0], 20.0)
    ask = lambda: [shard.search(x.astype(np.int64), 1 / (1 + x % 7), i, 10) for i, x in enumerate(lists[:50])]
    once = ask()
    monkeypatch.setattr(search, "AT_ONCE", 300)
    for (a, b), (c, d) in zip(once, ask(), strict=True):
        assert (a == c).all() and (b == d).all()


def test_a_shards_queries_come_in_batches(spark):
    """A task has a shard's index and some queries, not all the queries that meet the shard."""
    from tidemark.llm import search

    rng = np.random.default_rng(11)
    texts = [" ".join(f"w{w}" for w in rng.zipf(1.3, 40) % 300) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(7, "w1 w2 w3"), (500, None)], "doc_id long, text string").repartition(3)
    at_once = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = lambda found: sorted((r.query_id, r.rank, r.doc_id, r.score) for r in found.collect())
    whole = rows(search.search(docs, docs.where("doc_id % 2 = 1"), query_terms=None))
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")  # less than an index's rows, so these come in pieces too
        found = search.search(docs, docs.where("doc_id % 2 = 1"), query_terms=None, docs_per_shard=40, chunk=30)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "Group" not in plan.replace("WindowGroupLimit", "")
        assert rows(found) == whole and len(whole) == 10 * 100
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", at_once)


def test_frequent_terms_are_rows_of_a_shard(monkeypatch):
    from tidemark.llm import search

    rng = np.random.default_rng(6)
    lists = [np.unique(rng.zipf(1.3, 60) % 900) for _ in range(600)]
    lists += [lists[0]] * 40  # ties
    tf = [rng.integers(1, 9, len(x)).astype(np.int32) for x in lists[:600]]
    tf += [tf[0]] * 40
    group = search.pa.table({"doc_id": np.arange(640) // 2, "length": [int(n.sum()) for n in tf], "term": [x.astype(np.int64).tobytes() for x in lists], "tf": [n.tobytes() for n in tf]})
    row = search._build((search.pa.scalar(0),), group).to_pylist()[0]
    asked = [(x.astype(np.int64), 1 / (1 + x % 7), i // 2) for i, x in enumerate(lists[:100])] + [(np.array([5, 999]), np.ones(2), None), (np.array([999]), np.ones(1), None)]
    shard = search.Shard(row, 100.0)
    assert 0 < len(shard.rows) < len(shard.terms)
    found = list(shard.search_all(asked, 10))
    monkeypatch.setattr(search, "ROWS", 0)
    lists_only = search.Shard(row, 100.0)
    assert not len(lists_only.rows)
    for (ids, scores), (i, s), (term, idf, own) in zip(found, lists_only.search_all(asked, 10), asked, strict=True):
        assert (ids == i).all() and (scores == s).all()
        docs, place = np.flatnonzero(shard.ids != (-1 if own is None else own)), np.flatnonzero(np.isin(term, shard.terms))
        at = np.searchsorted(shard.terms, term[place])
        full = shard._scored(at, idf[place], docs)
        assert (full == shard._scored_few(at, idf[place], docs)).all()
        best = np.lexsort((shard.ids[docs], -full))[:10]
        best = best[full[best] > 0]
        assert (shard.ids[docs[best]] == ids).all() and (full[best] == scores).all()
