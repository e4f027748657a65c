"""The queries of this package by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Run], Run]:
    def add(run: Run) -> Run:
        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run

    return add
