"""The corpus operators as named queries, and the SQL of those that SQL can express."""

from __future__ import annotations

from tidemark.llm import bpe, chat, hardneg, language, mixing, paritysketch, pii, repair, runs, search, sitestyle, subspace, toxicity


def llm_queries() -> dict:
    return {
        "op1_byte_bpe": bpe.op1_byte_bpe,
        "op2_main_text": sitestyle.op2_main_text,
        "op3_embedding_dedup": subspace.op3_embedding_dedup,
        "op4_search": search.op4_search,
        "op5_mix_sources": mixing.op5_mix_sources,
        "op6_language_id": language.op6_language_id,
        "op7_ngram_jaccard": paritysketch.op7_ngram_jaccard,
        "op8_pii": pii.op8_pii,
        "op9_token_files": repair.op9_token_files,
        "op10_toxicity": toxicity.op10_toxicity,
        "op11_hard_negatives": hardneg.op11_hard_negatives,
        "op12_chat_format": chat.op12_chat_format,
        "op13_word_runs": runs.op13_word_runs,
    }


def llm_oracle() -> dict[str, str]:
    return {"op5_mix_sources": mixing.OP5_SQL}
