"""Query registry: name -> (callable on a Model, optional SQL twin)."""
from __future__ import annotations

from dataclasses import dataclass
from textwrap import dedent
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ringlens.sources.model import Model


@dataclass(frozen=True)
class Entry:
    build: Callable[[Model], DataFrame]
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(model)`` under ``name``; ``sql`` is the twin used as an oracle."""

    def register(build):
        if name in ENTRIES:
            raise ValueError(f"query {name!r} registered twice")
        ENTRIES[name] = Entry(build, dedent(sql).strip() if sql else None)
        return build

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build):
        return lambda spark, sf_dir: build(Model(spark, sf_dir))

    return {name: bind(entry.build) for name, entry in ENTRIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: entry.sql for name, entry in ENTRIES.items() if entry.sql}
