"""Registered queries: a Spark callable and, where SQL can say it, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, TimestampType

from hazardlake.catalog.fixtures import Tables, with_fixtures
from hazardlake.session import prepare


class Entry(NamedTuple):
    build: Callable[[Tables], DataFrame]
    sql: str | None
    decimals: int


ENTRIES: dict[str, Entry] = {}


def query(name: str, sql: str | None = None, decimals: int = 6):
    """Register a builder under its inventory id, with the SQL it must agree with.

    ``decimals`` is where both sides round doubles to absorb the order of summation.
    """
    def register(build: Callable[[Tables], DataFrame]):
        if name in ENTRIES:
            raise ValueError(f"{name} is registered twice")
        ENTRIES[name] = Entry(build, with_fixtures(sql) if sql else None, decimals)
        return build
    return register


def comparable(df: DataFrame, decimals: int) -> DataFrame:
    """Instants without zone and rounded doubles, as the SQL side writes them."""
    columns = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(field.dataType, DoubleType):
            column = F.round(column, decimals)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = ENTRIES[name]
    return comparable(entry.build(Tables(prepare(spark), sf_dir)), entry.decimals)


def callables() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        name: (lambda spark, sf_dir, name=name: run(name, spark, sf_dir)) for name in ENTRIES
    }


def twins() -> dict[str, str]:
    return {name: entry.sql for name, entry in ENTRIES.items() if entry.sql}
