"""Catalogue of named queries: each entry is a DataFrame builder + optional oracle SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class NamedQuery:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle_sql: str | None
    ids: tuple[str, ...]  # SURVEY §2 ids covered


REGISTRY: dict[str, NamedQuery] = {}
PLAN_MODULES = ("credit", "fraud", "market", "cleaning_jobs", "segments", "evaluation", "profiling", "models", "fraud_models", "forecasting", "streaming_jobs", "tables",
                "load_jobs", "features", "sliced")


def register(name: str, sql: str | None = None, ids: tuple[str, ...] = ()):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = NamedQuery(name, fn, sql, tuple(ids))
        return fn
    return deco


def load_all() -> dict[str, NamedQuery]:
    # importing the plan modules fills REGISTRY
    import importlib

    for mod in PLAN_MODULES:
        importlib.import_module(f"tallyspark.plans.{mod}")
    return REGISTRY
