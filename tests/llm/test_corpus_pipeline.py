"""The pipeline, stage by stage on its own input, against brute force."""

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.test_llm_operators import DOCS, EDGE, ENC, _jaccard_truth, docs_of
from tidemark.llm import pii
from tidemark.llm.common import saved, table


def test_stages_in_order(spark):
    docs = table(spark, SF_SMALL, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = saved(stage(spark, docs, SF_SMALL), f"test-{name}")
        after = docs.collect()
        if name != "tokens":
            assert docs.columns == columns
        if name == "language":
            assert sorted(after) == sorted(r for r in before if any(c.isalpha() for c in r.text or ""))
        elif name == "copies":
            _, comp = _jaccard_truth([(r.doc_id, r.text) for r in before])
            assert sorted(after) == sorted(r for r in before if comp[r.doc_id] == r.doc_id)
        elif name == "personal":
            assert len(after) == len(before)
            assert not any(k == 0 for r in after for _, k, _ in pii.base_spans(r.text))
        elif name == "mix":
            whole = {r.doc_id: r.text for r in before}
            assert after and all(set(r.text.split()) <= set(whole[r.doc_id].split()) for r in after)
        else:
            texts = {}
            for r in before:
                texts.setdefault(r.doc_id, []).append(ENC.encode_ordinary(r.text))
            assert len(after) == len(before) and all(list(r.ids) in texts[r.doc_id] and r.n_tokens == len(r.ids) for r in after)


def test_stages_take_odd_rows_and_none(spark):
    for rows in (EDGE, []):
        docs = docs_of(spark, rows) if rows else spark.createDataFrame([], DOCS)
        for name, stage in corpus_pipeline.STAGES:
            docs = saved(stage(spark, docs, SF_SMALL), f"test-odd-{name}")
        assert docs.count() == 0 or rows
