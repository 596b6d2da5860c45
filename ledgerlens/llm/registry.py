"""Queries and SQL oracles of the corpus operators; `register` is used by the query modules below."""

from __future__ import annotations

LLM_QUERIES: dict = {}
LLM_ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register `fn(spark, sf_dir)` under `name`, with its DuckDB SQL where SQL can express it."""

    def deco(fn):
        LLM_QUERIES[name] = fn
        if oracle is not None:
            LLM_ORACLES[name] = oracle
        return fn

    return deco


def _load() -> None:
    from . import queries  # noqa: F401


def llm_queries() -> dict:
    _load()
    return dict(LLM_QUERIES)


def llm_oracles() -> dict[str, str]:
    _load()
    return dict(LLM_ORACLES)
