"""All named queries and their oracle twins."""

from __future__ import annotations

from tidemark.plans.catalog import batch_queries
from tidemark.plans.io_catalog import io_oracle, io_queries
from tidemark.plans.model_catalog import model_oracle, model_queries
from tidemark.plans.oracle import batch_oracle
from tidemark.plans.stream_catalog import stream_oracle, stream_queries
from tidemark.session import configure


def _configured(fn):
    def run(spark, sf_dir):
        configure(spark)
        return fn(spark, sf_dir)

    run.__name__ = getattr(fn, "__name__", "query")
    return run


def all_queries() -> dict:
    return {k: _configured(v) for k, v in {**batch_queries(), **io_queries(), **stream_queries(), **model_queries()}.items()}


def all_oracle() -> dict[str, str]:
    return {**batch_oracle(), **io_oracle(), **stream_oracle(), **model_oracle()}
