"""Named queries over the given tables, each with the SQL that says what it must return."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[["Tables"], DataFrame]

QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


@dataclass(frozen=True)
class Tables:
    """The tables of one data folder: ``tables.events`` reads ``events.parquet``."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}.parquet"


def query(name: str, oracle: str | None = None) -> Callable[[Build], Build]:
    """Register a query; without SQL only its rows are checked."""

    def add(build: Build) -> Build:
        QUERIES[name] = build
        if oracle:
            ORACLES[name] = oracle
        return build

    return add


def runner(build: Build) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        # Times without zone are read as UTC, and time text is written in UTC.
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(Tables(spark, folder))

    return run
