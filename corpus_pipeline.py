"""A corpus from raw documents to token ids, in five stages.

``STAGES`` are applied in order; each takes (spark, docs, sf_dir) and works on all that its
predecessor kept. All but the last return the columns of ``documents``:

language  documents without a language go (no text, or no letter in it)
copies    of each group of near copies (five-word shingles, Jaccard 0.8) the smallest id stays
personal  personal data are replaced by their kind
mix       sources are repeated or cut to their target weights
tokens    texts become byte-level BPE ids

Every stage's rows are written as Parquet in the shared folder and read again.

Defined cases: rows without a text, or a letter in it, go in the first stage; of rows of equal id and text one
stays, and different texts that share an id, or have none, are documents of their own in the second; from the third on every row is a document
of its own, whatever its id; other null columns stay null; ties go by id. An empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, language, mixing, paritysketch, pii
from tidemark.llm.common import ready, saved, table


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return language.known_language(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return paritysketch.one_of_each_group(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return pii.without_personal_data(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ready(spark)
    return mixing.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of ``docs`` but the text, with ``ids`` and ``n_tokens``."""
    import public_tokenizers

    ready(spark)
    ranks = bpe.ByteBpe(bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), public_tokenizers.PATTERN)
    return bpe.encode(docs, ranks).drop("text").withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("language", keep_languages),
    ("copies", drop_copies),
    ("personal", replace_personal_data),
    ("mix", mix_sources),
    ("tokens", tokenize),
]

#: SQL cannot express the language model, the random-field spans or the merges; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
